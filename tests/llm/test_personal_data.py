import hashlib
import random
import re

from fundglean.llm import personal_data as pii

SCHEMA = "doc_id long, text string, spans string, key string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(number) <= 19 and luhn(number),
                "phone": 9 <= len(number) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans).encode()).hexdigest()


def check(spark, rows):
    got = pii.personal_data(spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(want), texts[r["doc_id"]]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[3] == k for x in want) for k in PATTERNS]
        listed = set(filter(None, r["spans"].split(",")))
        assert {f"{k}:{s}:{e}" for s, _, e, k in want} <= listed
        assert len(listed) == len(want) + r["n_added"]
    return {r["doc_id"]: r for r in got}


def test_base_against_plain_python(spark):
    rng = random.Random(1)
    parts = list("aB1290.@-+ ()") + ["4111 1111 1111 1111", "1.2.3.4", "a@b.co", "+1 415 555 1234", "é", "😀", "\n",
             "555-123-4567 ", "00255", "256", "name at host dot com"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 50)))) for i in range(800)]
    check(spark, rows)


def test_edge_cases(spark):
    """Nulls, copies, and long texts on which repeats in a pattern could recurse or retry."""
    rows = [
        (1, None), (2, ""), (3, "1" * 30_000), (4, "a." * 15_000), (5, "1 " * 15_000 + "2"),
        (6, "a@" + "b." * 20_000 + "c"), (7, "1." * 20_000 + "1"), (8, "+1" + " 1" * 20_000),
        (9, "a@b.c+d@e.fg@h.i"), (None, "10.0.0.1"), (10, "x@y.zz"), (10, "x@y.zz"),
    ]
    check(spark, rows)
    assert pii.personal_data(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spans_are_added(spark):
    """Loose phones and spelled-out addresses in a context join; numbers elsewhere do not."""
    rows = [(i, f"My email: user{i}@mail.example.com, phone: +1 415 555 {1000 + i}.") for i in range(60)]
    rows += [(100 + i, f"please call 415-555-{2000 + i} today") for i in range(20)]
    rows += [(200 + i, f"write to john{i} at example dot com please") for i in range(20)]
    rows += [(300 + i, f"order number 415-555-{3000 + i}x and serial 123-456-7890a") for i in range(20)]
    got = check(spark, rows)
    assert all(got[100 + i]["spans"] == "phone:12:24" for i in range(20))
    assert all(got[200 + i]["n_added"] == 1 for i in range(20))
    assert all(got[300 + i]["n_added"] == 0 for i in range(20))


def test_reliabilities_against_plain_em(spark):
    patterns = [([2, 2, 1, 2], 40), ([0, 2, 1, 2], 9), ([1, 0, 0, 0], 12), ([0, 0, 1, 0], 30), ([2, 2, 2, 2], 5)]
    df = spark.createDataFrame([(patterns,)], "p array<struct<votes:array<int>,n:bigint>>")
    got = df.select(pii.reliabilities(pii.F.col("p"))).first()[0]
    from math import exp, log

    q = [1 / (1 + exp(-sum(v - 1 for v in votes))) for votes, _ in patterns]
    for _ in range(pii.ROUNDS):
        sides = [[n * x for (_, n), x in zip(patterns, q, strict=True)], [n * (1 - x) for (_, n), x in zip(patterns, q, strict=True)]]
        rate = [
            [[(sum(w for (votes, _), w in zip(patterns, side, strict=True) if votes[j] == v) + 1) / (sum(side) + 3) for v in range(3)] for j in range(4)]
            for side in sides
        ]
        odds = log((sum(sides[0]) + 1) / (sum(sides[1]) + 1))
        q = [1 / (1 + exp(-(odds + sum(log(rate[0][j][v] / rate[1][j][v]) for j, v in enumerate(votes))))) for votes, _ in patterns]
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, q, strict=True))
    assert got[0] > 0.9 > 0.1 > got[3]


def plain_odds(rows):
    """Log odds of a naive Bayes classifier over (features, chance) of one kind's candidates."""
    from math import log

    yes, no = sum(q for _, q in rows), sum(1 - q for _, q in rows)
    size = pii.BUCKETS / 100
    out = []
    for own, _ in rows:
        odds = log((yes + 1) / (no + 1))
        for f in own:
            a = sum(q * fs.count(f) for fs, q in rows)
            b = sum((1 - q) * fs.count(f) for fs, q in rows)
            odds += log((a + 0.01) / (yes + size) / ((b + 0.01) / (no + size)))
        out.append(odds)
    return out


def hex_token(rng, n=40):
    return "".join(rng.choices("0123456789abcdef", k=n))


def test_secrets_are_found(spark):
    rng = random.Random(9)
    rows = [(i, f'some words token = "{hex_token(rng)}" and others') for i in range(40)]
    rows += [(100 + i, f"password: {hex_token(rng, 24)}Zq9 rest") for i in range(15)]
    rows += [(200 + i, f"a long unhappilyverylongwordindeed and file-of-year-2024-{i}-aaaaaaaaaa here") for i in range(40)]
    rows += [(300 + i, f"number {10**24 + i} or a1a1a1a1a1a1a1a1a1a1a1a1 stands") for i in range(20)]
    rows += [(400, "x" * 30_000 + "1"), (401, "a1" * 20_000), (402, None)]
    got = check(spark, rows)
    assert sum(got[i]["n_secret"] == 1 for i in range(40)) >= 36
    assert sum(got[100 + i]["n_secret"] for i in range(15)) >= 10
    assert all(got[i]["n_secret"] == 0 for i in [*range(200, 240), *range(300, 320), 400, 401, 402])
    start = rows[0][1].index('"') + 1
    assert got[0]["spans"] == f"secret:{start}:{start + 40}"


def test_classifier_against_plain_python(spark):
    rng = random.Random(3)
    rows = [(i, f'token = "{hex_token(rng)}" end') for i in range(12)]
    rows += [(50 + i, f"see {hex_token(rng, 30)} or call 415-555-{1000 + i} now") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    voted = pii.candidates(df).withColumn("votes", pii.votes())
    got = pii.classified(voted).select("kind", "chance", "odds", pii.features().alias("f")).collect()
    for kind in {r["kind"] for r in got}:
        own = [r for r in got if r["kind"] == kind]
        want = plain_odds([(list(r["f"]), r["chance"]) for r in own])
        assert all(abs(a["odds"] - b) < 1e-6 for a, b in zip(own, want, strict=True))


def test_planted_secrets_of_the_given_tables(spark):
    import os

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        return
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    planted = {r["doc_id"] for r in docs.collect() if re.search(r'token = "[0-9a-f]{40}"', r["text"] or "")}
    got = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    assert planted and sum(got[i]["n_secret"] > 0 for i in planted) > 0.9 * len(planted)
    assert sum(r["n_secret"] > 0 for i, r in got.items() if i not in planted) <= 2
