"""Line deduplication by a suffix array over line ids.

Every document is a sequence of lines; lines without a word are passed over. A line's
id is a 96-bit hash of it. Suffixes are ranked by prefix doubling: ranks by one line are
numbers in the sorted order of the ids, ranks by the first 2**j lines, made of pairs of
ranks by half as many, are numbers in the sorted order of the distinct pairs; both are
spread over tasks by range. Suffixes that start with a line that
occurs once are never ranked, and a stretch of repeated lines stops being ranked when
no run that matters is that long. Suffixes that share a prefix form an interval of the
suffix array; the interval cut at ``min_words`` words, the first n lines of each of its
suffixes, is told from others by the ranks of the first and the last 2**j of those n
lines. In each such interval the run that comes first (by document id, then text hash,
then line) stays, and the lines of all others are deleted. For each line the shortest
run that starts there is taken, and the shortest that ends there. Every line of a
maximal repeated run is in one of those inside it, and runs that overlap join, so
whole maximal repeated runs go and nothing else. A run needs at most ``min_words``
lines, or two, hence log2(min_words) doublings are enough for any input.

Edge cases: a null text stays null; a text without repeated runs stays as it is; copies
of a row (same id and text) count as one document and are treated alike; documents
all of whose lines go keep an empty text; a null id sorts first; lines without words inside
a deleted run go with it. Columns of the documents keep their names and values except
``text``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.llm.common import checkpoint, fresh, row_key

MIN_WORDS = 50


def n_words(line: Column) -> Column:
    """Words apart from ASCII white space."""
    return F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines that occur more than once: ``doc_id``, ``key``, ``place``, ``line``, ``words``, ``rank``.

    ``place`` numbers the document's lines that have words, ``line`` all of its lines.
    """
    each = docs.select("doc_id", row_key("doc_id", "text").alias("key"), F.split("text", "\n", -1).alias("lines"))
    with_words = F.filter(
        F.transform(
            "lines",
            lambda x, i: F.struct(
                i.alias("line"),
                n_words(x).alias("words"),
                F.xxhash64(x).alias("id"),
                F.hash(x).alias("more"),
            ),
        ),
        lambda x: x["words"] > 0,
    )
    rows = each.select("doc_id", "key", F.posexplode(with_words).alias("place", "l")).select(
        "doc_id", "key", "place", "l.line", "l.words", "l.id", "l.more"
    )
    often = rows.groupBy("id", "more").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(ranked(often, "id", "more"), ["id", "more"]).drop("id", "more")


def ranked(rows: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns with ``rank``, a number that grows in their order.

    Written out: ranks stay what they are when a task is run again, and a join with
    them shuffles both of its sides itself, so that a hot value can be split.
    """
    order = rows.select(*columns).distinct().repartitionByRange(*columns)
    rank = F.monotonically_increasing_id().alias("rank")
    return checkpoint(order.sortWithinPartitions(*columns).select(*columns, rank))


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Maximal stretches of neighbouring repeated lines, one row each.

    ``at`` (line number), ``last`` for each start the index (from 1) of the last line
    of the shortest run with ``min_words`` words, 0 if there is none, and ``ranks``.
    ``more`` has, for each line at which none of those ends, the shortest run with
    ``min_words`` words that ends there, from ``low`` (from 0) to ``e`` (from 1). If one
    of those ends at a line, the shortest that ends there is among them. It also has
    neighbours that are long enough each, so that lines without words between them go.
    """
    w = Window.partitionBy("key").orderBy("place")
    once = lines.withColumn("before", F.lag("place").over(w)).where(
        "before IS NULL OR before <> place"
    )
    part = F.col("place") - F.row_number().over(w)
    item = F.struct("place", "line", "words", "rank", "upto")
    grouped = (
        once.withColumn("part", part)
        .withColumn("upto", F.sum("words").over(w))
        .groupBy("key", "part")
        .agg(F.min("doc_id").alias("doc_id"), F.sort_array(F.collect_list(item)).alias("items"))
    )
    head = F.element_at("items", 1)
    summed = grouped.select(
        "doc_id",
        "key",
        F.col("items.line").alias("at"),
        F.col("items.rank").alias("ranks"),
        # words before each line, and of all at the end
        F.concat(F.array(head["upto"] - head["words"]), F.col("items.upto")).alias("total"),
    ).where(F.element_at("total", -1) - F.element_at("total", 1) >= min_words)
    # Binary search: for start i the first e with total[e] - total[i] >= min_words.
    size = F.size("ranks")
    steps = F.sequence(F.lit(1), F.ceil(F.log2(size + 1)).cast("int") + 1)

    def halve(i: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
            enough = F.get("total", middle) - F.get("total", i) >= min_words
            done = s["low"] >= s["high"]
            return F.struct(
                F.when(done | enough, s["low"]).otherwise(middle + 1).alias("low"),
                F.when(~done & enough, middle).otherwise(s["high"]).alias("high"),
            )

        start = F.struct((i + 1).alias("low"), size.alias("high"))
        return F.aggregate(steps, start, step, lambda s: s["low"])

    last = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.when(
            F.element_at("total", -1) - F.get("total", i) >= min_words, halve(i)
        ).otherwise(0),
    )

    def back(e: Column) -> Column:
        """The last start from which the words up to line ``e`` are enough."""

        def step(s: Column, _: Column) -> Column:
            middle = F.ceil((s["low"] + s["high"]) / 2).cast("int")
            enough = F.get("total", e) - F.get("total", middle) >= min_words
            done = s["low"] >= s["high"]
            return F.struct(
                F.when(~done & enough, middle).otherwise(s["low"]).alias("low"),
                F.when(done | enough, s["high"]).otherwise(middle - 1).alias("high"),
            )

        start = F.struct(F.lit(0).alias("low"), (e - 1).alias("high"))
        return F.aggregate(steps, start, step, lambda s: s["low"])

    ends = F.filter(
        F.array_except(F.sequence(F.lit(1), size), "last"),
        lambda e: F.get("total", e) - F.element_at("total", 1) >= min_words,
    )
    two = F.transform(
        "last", lambda e, i: F.when((e - i == 1) & (F.get("last", i + 1) - i == 2), i)
    )
    more = F.concat(
        F.transform(ends, lambda e: F.struct(back(e).alias("low"), e.alias("e"))),
        F.transform(F.array_compact(two), lambda i: F.struct(i.alias("low"), (i + 2).alias("e"))),
    )
    return summed.withColumn("last", last).withColumn("more", more).drop("total")


def runs(rows: DataFrame, step: int) -> DataFrame:
    """Runs of ``step`` up to ``2 * step - 1`` lines, with the ranks that tell them apart."""

    def run(i: Column, e: Column) -> Column:
        return F.struct(
            F.get("at", i).alias("start"),
            F.get("at", e - 1).alias("end"),
            (e - i).alias("n"),
            F.get("ranks", i).alias("head"),
            F.get("ranks", e - F.lit(step)).alias("tail"),
        )

    both = F.concat(
        F.transform("last", lambda e, i: run(i, e)),
        F.transform("more", lambda m: run(m["low"], m["e"])),
    )
    pick = F.filter(both, lambda r: (r["n"] >= step) & (r["n"] < 2 * step))
    return rows.select("doc_id", "key", F.explode(pick).alias("r")).select("doc_id", "key", "r.*")


def doubled(rows: DataFrame, step: int) -> DataFrame:
    """Ranks by ``2 * step`` lines from ranks by ``step``, for stretches with runs that long.

    Starts with fewer lines left get no rank; no run that matters starts there.
    """
    need = F.exists(F.transform("last", lambda e, i: e - i), lambda n: n >= 2 * step)
    kept = rows.where(need | F.exists("more", lambda m: m["e"] - m["low"] >= 2 * step))
    both = F.transform(
        "ranks", lambda head, i: F.struct(head.alias("head"), F.get("ranks", i + step).alias("tail"))
    )
    first = F.element_at("at", 1).alias("first")
    pairs = kept.select("key", first, F.posexplode(both).alias("i", "p")).select(
        "key", "first", "i", "p.head", "p.tail"
    )
    pairs = pairs.where("head IS NOT NULL AND tail IS NOT NULL")
    found = pairs.join(ranked(pairs, "head", "tail"), ["head", "tail"])
    # Starts without enough lines are the last ones, so the ranks found fill the front.
    lists = found.groupBy("key", "first").agg(
        F.sort_array(F.collect_list(F.struct("i", "rank"))).alias("found")
    )
    joined = kept.withColumn("first", F.element_at("at", 1)).join(lists, ["key", "first"])
    return joined.select("doc_id", "key", "at", F.col("found.rank").alias("ranks"), "last", "more")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs to delete: ``key`` of the document, ``start``, ``end`` (line numbers, included).

    Every run has an equal one earlier; runs of one document may overlap.
    """
    rows = checkpoint(stretches(repeated_lines(docs), min_words))
    found = None
    step = 1
    longest = max(min_words, 2)
    while step <= longest:
        here = runs(rows, step)
        same = ["n", "head", "tail"]
        here = here.select("doc_id", "key", "start", "end", F.lit(step).alias("step"), *same)
        found = here if found is None else found.unionAll(here)
        step *= 2
        if step <= longest:
            rows = checkpoint(doubled(rows, step // 2))
            if rows.isEmpty():
                break
    place = F.struct("doc_id", "key", "start")
    first = found.groupBy("step", "n", "head", "tail").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    # Written out for the same reason as the repeated lines.
    first = checkpoint(first.where("copies > 1"))
    later = found.join(first, ["step", "n", "head", "tail"])
    return later.where(place != F.col("first")).select("key", "start", "end")


def merged(found: DataFrame) -> DataFrame:
    """``key`` and ``gone``: the maximal deleted runs of a document, in order."""
    by_start = Window.partitionBy("key").orderBy("start", "end")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce((F.col("start") > F.max("end").over(before) + 1).cast("int"), F.lit(1))
    return (
        found.withColumn("opens", opens)
        .withColumn("part", F.sum("opens").over(by_start))
        .groupBy("key", "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("gone"))
    )


def remaining(lines: Column, gone: Column) -> Column:
    """The lines outside the deleted runs, run by run of what stays."""
    n = F.size(gone)
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), n),
            lambda i: let(
                F.struct(
                    F.when(i == 0, 0).otherwise(F.get(gone, i - 1)["end"] + 1).alias("start"),
                    F.when(i == n, F.size(lines)).otherwise(F.get(gone, i)["start"]).alias("stop"),
                ),
                lambda r: F.slice(lines, r["start"] + 1, F.greatest(r["stop"] - r["start"], F.lit(0))),
            ),
        )
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, all columns kept, with later copies of runs of lines cut out of ``text``.

    Column ``n_deleted`` (replaced if there) counts the deleted lines.
    """
    key, gone = fresh(docs, "dedup_key"), fresh(docs, "dedup_gone")
    cuts = merged(later_copies(docs.select("doc_id", "text"), min_words))
    cuts = cuts.select(F.col("key").alias(key), F.col("gone").alias(gone))
    joined = docs.withColumn(key, row_key("doc_id", "text")).join(cuts.hint("shuffle_hash"), key, "left")
    split = F.split("text", "\n", -1)
    cut = let(split, lambda x: F.array_join(remaining(x, F.col(gone)), "\n"))
    deleted = F.aggregate(gone, F.lit(0), lambda a, r: a + r["end"] - r["start"] + 1)
    others = [c for c in docs.columns if c.lower() != "n_deleted"]
    return joined.select(
        *[
            F.when(F.col(gone).isNull(), F.col("text")).otherwise(cut).alias(c)
            if c.lower() == "text"
            else F.col(c)
            for c in others
        ],
        F.coalesce(deleted, F.lit(0)).cast("long").alias("n_deleted"),
    )


def sql(min_words: int = MIN_WORDS) -> str:
    """SQL for ``dedup_lines(documents)``, comparing all pairs of equal lines.

    Pairs of equal lines of two documents (or of one) with the same distance between their
    places lie on one diagonal; neighbours on it are a maximal common run, which goes from
    the later side if it has ``min_words`` words.
    """
    return f"""
WITH rows AS (
    SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS doc
    FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)
), split AS (
    SELECT doc, unnest(string_split(text, chr(10))) AS l,
        unnest(range(0, len(string_split(text, chr(10))))) AS line
    FROM rows
), counted AS (
    SELECT *, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) AS words FROM split
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY doc ORDER BY line) AS place
    FROM counted WHERE words > 0
), often AS (
    SELECT * FROM placed WHERE l IN (SELECT l FROM placed GROUP BY l HAVING count(*) > 1)
), pairs AS (
    SELECT a.doc, a.line, a.words, a.place, b.doc AS other, a.place - b.place AS apart,
        a.place - row_number() OVER (
            PARTITION BY a.doc, b.doc, a.place - b.place ORDER BY a.place) AS island
    FROM often a JOIN often b ON a.l = b.l AND (b.doc < a.doc OR b.doc = a.doc AND b.place < a.place)
), runs AS (
    SELECT doc, min(line) AS first, max(line) AS last
    FROM pairs GROUP BY doc, other, apart, island HAVING sum(words) >= {min_words}
), gone AS (
    SELECT DISTINCT s.doc, s.line FROM split s
    JOIN (SELECT DISTINCT * FROM runs) r ON s.doc = r.doc AND s.line BETWEEN r.first AND r.last
), kept AS (
    SELECT doc, string_agg(l, chr(10) ORDER BY line) AS text
    FROM split ANTI JOIN gone USING (doc, line) GROUP BY doc
), deleted AS (
    SELECT doc, count(*) AS n FROM gone GROUP BY doc
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
    d.lang, d.source, d.n_chars, coalesce(g.n, 0) AS n_deleted
FROM documents d
    LEFT JOIN rows r ON r.doc_id IS NOT DISTINCT FROM d.doc_id AND r.text = d.text
    LEFT JOIN kept k USING (doc) LEFT JOIN deleted g USING (doc)
"""
