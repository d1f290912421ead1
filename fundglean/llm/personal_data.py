"""Personal data spans: base patterns, and weak supervision that adds spans.

Base spans of four kinds (email, ip, card, phone) follow fixed patterns and checks.
More candidates come from looser patterns: e-mail addresses spelled out, national
phone numbers, and secrets, long runs of letters and digits. Four labelers vote on every
candidate, base or not: the strict pattern with its checksum (for secrets: forms of
well-known keys and digests), a gazetteer (domain endings, card prefixes, country codes,
address ranges; for secrets: how many different characters there are), words of the
context, and the span's borders. Expectation
maximisation over the counts of vote patterns (81 at most for a kind) estimates how
reliable each labeler is, and the probability of each pattern. These probabilities
weigh the training of a naive Bayes span classifier over hashed shape and context
features. A loose candidate becomes a span if both agree on it and it touches no base
span; base spans always stay.

Everything is column expressions, joins and aggregates. Positions are code points,
ends excluded. Edge cases: a null or empty text has no spans; repeated rows get equal
results; ties of spans are sorted by kind, then end; an empty table gives no rows.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.llm.common import checkpoint, row_key

KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret",)
#: The base patterns. Possessive repeats match the same texts and do not
#: retry; \G and the look-behind keep a failed start from being tried at each later
#: place of the same run of characters.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SPELLED_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)|(?<= )at ) ?[A-Za-z0-9-]{1,63}+"
    r"(?: ?(?:\[dot\]|\(dot\)|(?<= )dot ) ?[A-Za-z0-9-]{1,63}+){1,4}"
)
NATIONAL_PHONE = (
    r"(?<![0-9A-Za-z+.()-])(?<![0-9)] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])"
)
_RUN = r"[A-Za-z0-9+/_=-]"
SECRET = (
    rf"(?<!{_RUN})(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z]){_RUN}{{20,200}}+(?!{_RUN})"
)
#: (kind, pattern, what a text must contain to be searched, whether it is a base pattern)
SEARCHES = (
    ("email", EMAIL, r"@", True),
    ("ip", IP, r"[0-9]\.[0-9]", True),
    ("card", CARD, r"[0-9](?:[\x20-]?[0-9]){11}", True),
    ("phone", PHONE, r"\+[0-9]", True),
    ("email", SPELLED_EMAIL, r"(?:\[at\]|\(at\)| at ).{1,80}(?:\[dot\]|\(dot\)| dot )", False),
    ("phone", NATIONAL_PHONE, r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", False),
    ("secret", SECRET, SECRET, False),
)
#: Gazetteers.
ENDINGS = "com|net|org|edu|gov|info|io|co|de|fr|es|it|uk|eu|us|nl|ch|at|be|pl|pt|se|br|jp|cn|in|ru"
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)"
COUNTRY = r"^(?:1|7|20|27|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
KEY_FORM = (
    r"^(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{30,}|"
    r"sk[-_]\w[\w-]{18,}|xox[abprs]-[\w-]{15,}|eyJ[\w-]+)$"
)
MANY_CHARACTERS = 12
#: Context words.
CUES = (
    r"(?i)\b(?:e-?mail|mail|contact|write|phone|tel|telephone|call|fax|mobile|cell|ip|address|host|"
    r"server|card|credit|visa|payment|konto|telefon|correo|courriel)\W*(?:\w+\W+){0,2}$"
)
OTHER_CUES = (
    r"(?i)\b(?:version|release|build|order|invoice|isbn|issn|token|serial|ticket|page|section|"
    r"figure|chapter)\W*(?:\w+\W+){0,1}$"
)
SECRET_CUES = (
    r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|key|auth|bearer|credential)s?\W*(?:\w+\W+){0,1}$"
)
LABELERS = 4
ROUNDS = 25
BUCKETS = 4096
AROUND = 40


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of at most 19 digits passes the check sum."""
    backwards = F.split(F.reverse(number), "")

    def value(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = F.when(n > 4, 2 * n - 9).otherwise(2 * n)
        return F.when(i % 2 == 1, twice).otherwise(n)

    numbers = F.filter(F.transform(backwards, value), lambda x: x.isNotNull())
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """The checks of the base patterns."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(
            parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
        )
    if kind == "card":
        return let(
            digits(match),
            lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False),
        )
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    return F.lit(True)


def found(text: Column, number: int) -> Column:
    """Matches of one search: place in order, text before it, match, texts around."""
    kind, pattern, needed, _ = SEARCHES[number]
    both = F.lit(rf"(?s)(.*?)((?:{pattern})|\z)")

    def pairs(gaps: Column, matches: Column) -> Column:
        return F.transform(
            matches,
            lambda m, i: F.struct(
                F.lit(number).alias("search"),
                i.alias("i"),
                F.length(F.get(gaps, i)).alias("gap"),
                m.alias("match"),
                F.right(F.get(gaps, i), F.lit(AROUND)).alias("before"),
                F.left(F.coalesce(F.get(gaps, i + 1), F.lit("")), F.lit(AROUND)).alias("after"),
            ),
        )

    matches = let(
        F.regexp_extract_all(text, both, F.lit(1)),
        lambda gaps: let(
            F.regexp_extract_all(text, both, F.lit(2)),
            lambda m: F.filter(pairs(gaps, m), lambda x: x["match"] != ""),
        ),
    )
    kinds = "array<struct<search:int,i:int,gap:int,match:string,before:string,after:string>>"
    return F.when(text.rlike(rf"(?s){needed}"), matches).otherwise(F.array().cast(kinds)).cast(kinds)


def candidates(docs: DataFrame) -> DataFrame:
    """All matches of all searches with their positions: one row for each text and span."""
    text = F.col("text")
    every = F.concat(*[found(text, i) for i in range(len(SEARCHES))])
    rows = (
        docs.where(text.rlike(r"[0-9@]|dot[ \])]"))
        .select(row_key("doc_id", "text").alias("key"), F.explode_outer(every).alias("c"))
        .where("c IS NOT NULL")
        .select("key", "c.*")
        .dropDuplicates(["key", "search", "i"])
    )
    upto = Window.partitionBy("key", "search").orderBy("i")
    length = F.length("match")
    placed = rows.withColumn("end", F.sum(F.col("gap") + length).over(upto).cast("long"))
    kind, base = F.lit(None).cast("string"), F.lit(False)
    for i, (name, _, _, strict) in enumerate(SEARCHES):
        here = F.col("search") == i
        kind = F.when(here, name).otherwise(kind)
        if strict:
            base = F.when(here, passes(name, F.col("match"))).otherwise(base)
    return placed.select(
        "key", "search", kind.alias("kind"), base.alias("base"),
        (F.col("end") - length).alias("start"), "end", "match", "before", "after",
    )


def votes() -> Column:
    """The labelers' votes: 0 no, 1 abstains, 2 yes."""
    strict = F.array_contains(
        F.array(*[F.lit(i) for i, s in enumerate(SEARCHES) if s[3]]), F.col("search")
    )
    kind, number, match = F.col("kind"), digits(F.col("match")), F.col("match")
    secret = kind == "secret"
    pattern = (
        F.when(secret, F.when(match.rlike(KEY_FORM), 2).otherwise(1))
        .when(F.col("base"), 2)
        .when(strict, 0)
        .otherwise(1)
    )
    characters = F.size(F.array_distinct(F.split(match, "")))
    mixed = (F.length(number) >= 4) & (characters >= MANY_CHARACTERS)
    first = F.regexp_extract(match, "^([0-9]{1,3})", 1).try_cast("int")
    gazetteer = (
        F.when(secret, F.when(mixed, 2).otherwise(0))
        .when(kind == "email", F.when(match.rlike(rf"(?i)\W(?:{ENDINGS})$"), 2).otherwise(1))
        .when(kind == "ip", F.when(first.between(1, 223), 2).otherwise(0))
        .when(kind == "card", F.when(number.rlike(CARD_PREFIX), 2).otherwise(0))
        .otherwise(F.when(F.length(number) == 10, 2).when(number.rlike(COUNTRY), 2).otherwise(0))
    )
    cue = (
        F.when(secret, F.when(F.col("before").rlike(SECRET_CUES), 2).otherwise(0))
        .when(F.col("before").rlike(CUES), 2)
        .when(F.col("before").rlike(OTHER_CUES), 0)
        .otherwise(1)
    )
    joined = F.col("before").rlike(r"[A-Za-z0-9_/=#-]$") | F.col("after").rlike(r"^[A-Za-z0-9_/=#-]")
    return F.array(pattern, gazetteer, cue, F.when(joined, 0).otherwise(2))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def total(rows: Column, value) -> Column:
    return F.aggregate(rows, F.lit(0.0), lambda a, r: a + value(r))


def reliabilities(patterns: Column) -> Column:
    """For each pattern (``votes``, ``n``) the probability of a true span, by EM.

    The latent truth starts at the majority; labelers vote independently given it.
    """
    start = F.transform(
        patterns,
        lambda p: sigmoid(F.aggregate(p["votes"], F.lit(0.0), lambda a, v: a + v - 1)),
    )

    def round_(chances: Column, _: Column) -> Column:
        weighed = F.zip_with(
            patterns,
            chances,
            lambda p, q: F.struct(
                p["votes"].alias("votes"), (p["n"] * q).alias("yes"), (p["n"] * (1 - q)).alias("no")
            ),
        )

        def share(rows: Column, k: Column, side: str) -> Column:
            hits = total(
                rows,
                lambda r: F.when(
                    F.get(r["votes"], F.floor(k / 3).cast("int")) == k % 3, r[side]
                ).otherwise(0.0),
            )
            return (hits + 1) / (total(rows, lambda r: r[side]) + 3)

        def posteriors(rows: Column) -> Column:
            ratios = F.transform(
                F.sequence(F.lit(0), F.lit(3 * LABELERS - 1)),
                lambda k: F.log(share(rows, k, "yes") / share(rows, k, "no")),
            )
            odds = F.log(
                (total(rows, lambda r: r["yes"]) + 1) / (total(rows, lambda r: r["no"]) + 1)
            )
            return let(
                F.struct(ratios.alias("ratios"), odds.alias("odds")),
                lambda m: F.transform(
                    rows,
                    lambda r: sigmoid(
                        m["odds"]
                        + F.aggregate(
                            F.sequence(F.lit(0), F.lit(LABELERS - 1)),
                            F.lit(0.0),
                            lambda a, j: a + F.get(m["ratios"], j * 3 + F.get(r["votes"], j)),
                        )
                    ),
                ),
            )

        return let(weighed, posteriors)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_)


def pattern_chances(voted: DataFrame) -> DataFrame:
    """``kind``, ``votes``, ``chance``; 81 rows a kind at most."""
    counted = voted.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n"))
    each = counted.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("p"))
    chances = each.select("kind", "p", reliabilities(F.col("p")).alias("q"))
    return chances.select("kind", F.explode(F.arrays_zip("p", "q")).alias("x")).select(
        "kind", F.col("x.p.votes").alias("votes"), F.col("x.q").alias("chance")
    )


def features() -> Column:
    """Numbers of the hashed features of a span's shape and context."""
    shape = F.regexp_replace(F.regexp_replace(F.col("match"), "[0-9]", "9"), "[A-Za-z]+", "a")
    word_before = F.lower(F.regexp_extract("before", r"(\S*)\s*$", 1))
    word_after = F.lower(F.regexp_extract("after", r"^\s*(\S*)", 1))
    named = {
        "shape": F.left(shape, F.lit(40)),
        "length": F.floor(F.log2(F.length("match"))),
        "before": word_before,
        "after": word_after,
        "edges": F.concat(F.right(F.col("before"), F.lit(1)), F.lit("/"), F.left("after", F.lit(1))),
    }
    return F.array(
        *[F.pmod(F.xxhash64(F.lit(k), v), F.lit(BUCKETS)).cast("int") for k, v in named.items()]
    )


def classified(voted: DataFrame) -> DataFrame:
    """``voted`` with ``chance`` of EM and ``odds``, the span classifier's log odds.

    The classifier is trained on every candidate, weighed by its chance; its weights
    are at most ``BUCKETS`` rows a kind.
    """
    weighed = voted.join(F.broadcast(pattern_chances(voted)), ["kind", "votes"])
    spread = weighed.withColumn("feature", F.explode(features()))
    yes, no = F.sum("chance"), F.sum(1 - F.col("chance"))
    sums = spread.groupBy("kind", "feature").agg(yes.alias("yes"), no.alias("no"))
    whole = weighed.groupBy("kind").agg(yes.alias("all_yes"), no.alias("all_no"))
    size = F.lit(float(BUCKETS) / 100)  # smoothing, a hundredth of a count in each bucket
    share = lambda own, every: (F.col(own) + 0.01) / (F.col(every) + size)
    weights = sums.join(F.broadcast(whole), "kind").select(
        "kind", "feature", F.log(share("yes", "all_yes") / share("no", "all_no")).alias("weight"),
        F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)).alias("prior"),
    )
    same = [c for c in voted.columns if c != "votes"]
    return (
        spread.join(F.broadcast(weights), ["kind", "feature"])
        .groupBy(*same)
        .agg(F.first("chance").alias("chance"), (F.sum("weight") + F.first("prior")).alias("odds"))
    )


def spans(docs: DataFrame) -> DataFrame:
    """``key`` (of id and text), ``kind``, ``start``, ``end``, ``base`` of all spans."""
    voted = checkpoint(candidates(docs).withColumn("votes", votes()))
    base = voted.where("base").select("key", "kind", "start", "end", "base")
    loose = [i for i, s in enumerate(SEARCHES) if not s[3]]
    judged = classified(voted).where(F.col("search").isin(loose))
    added = judged.where("chance >= 0.5 AND odds >= 0")
    either = base.unionAll(added.select("key", "kind", "start", "end", "base"))
    ahead = Window.partitionBy("key").orderBy("start", "end")
    behind = Window.partitionBy("key").orderBy(F.desc("start"), F.desc("end"))
    of_base = lambda name: F.when(F.col("base"), F.col(name))
    clear = (
        either.withColumn("reach", F.max(of_base("end")).over(ahead))
        .withColumn("next", F.min(of_base("start")).over(behind))
    )
    touches = (F.coalesce("reach", F.lit(-1)) > F.col("start")) | (
        F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    )
    return clear.where(F.col("base") | ~touches).select("key", "kind", "start", "end", "base")


def listed(which: Column) -> Column:
    """Spans as ``kind:start:end``, sorted by start, kind and end."""
    number = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, *ADDED_KINDS)]), F.col("kind"))
    item = F.struct("start", number.alias("number"), "end", "kind")
    ordered = F.sort_array(F.collect_list(F.when(which, item)))
    return F.array_join(
        F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, counts of base spans, their digest, all spans."""
    docs = docs.select("doc_id", "text")
    own = spans(docs).groupBy("key").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        listed(F.col("base")).alias("base"),
        listed(F.lit(True)).alias("spans"),
        F.count_if(~F.col("base")).alias("n_added"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ADDED_KINDS],
    )
    keyed = docs.select("doc_id", row_key("doc_id", "text").alias("key"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return keyed.join(own, "key", "left").select(
        "doc_id",
        *[zero(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        zero("n_added"),
        *[zero(f"n_{k}") for k in ADDED_KINDS],
    )
