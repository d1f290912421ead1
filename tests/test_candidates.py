from pyspark.sql import functions as F

from fundglean.operators import calls
from fundglean.operators.candidates import candidate_texts, reduce_cascade

CHOICES = (
    "cik string, accession_number string, "
    "choices array<struct<ordinal:int,method:string,chunks:array<int>>>"
)
CHUNKS = "cik string, accession_number string, chunk_num int, chunk_text string"
LONG = "x" * 60


def candidates(spark, choices, chunks, **options):
    rows = [(f, "a", [(i, f"m{i}", c) for i, c in lists]) for f, lists in choices.items()]
    texts = [(f, "a", n, t) for f, n, t in chunks]
    df = candidate_texts(
        spark.createDataFrame(rows, CHOICES), spark.createDataFrame(texts, CHUNKS), **options
    )
    return df, {
        r.cik: [(c.ordinal, c.chunks, c.text) for c in r.candidates] for r in df.collect()
    }


def test_completeness_order_and_length(spark):
    choices = {
        "ok": [(0, [2, 3]), (2, [3])],
        "missing": [(0, [1, 2]), (1, [2])],
        "repeated": [(0, [1, 2]), (3, [2])],
        "short": [(0, [1])],
        "none": [(0, [7])],
        "pair": [(0, [4, 5])],
    }
    chunks = [
        ("ok", 3, "b" + LONG), ("ok", 2, "a" + LONG), ("ok", 9, "z"),
        ("missing", 2, LONG * 2),
        ("repeated", 1, LONG), ("repeated", 2, LONG * 2), ("repeated", 2, LONG * 2),
        ("short", 1, "x" * 99),
        ("pair", 4, "p" + LONG), ("pair", 4, "o" + LONG),
    ] + [("repeated", 1, LONG)] * 50
    _, got = candidates(spark, choices, chunks)
    assert got == {
        "ok": [(0, [2, 3], f"a{LONG}\nb{LONG}")],
        "missing": [(1, [2], LONG * 2)],
        # as many rows as chunk numbers is the test, also when one is there twice
        "pair": [(0, [4, 5], f"o{LONG}\np{LONG}")],
    }


def answered(spark, data):
    rows = [
        (f, "a", [(o, [o], f"t{o}", r, n, None) for o, r, n in tries]) for f, tries in data.items()
    ]
    return spark.createDataFrame(
        rows, f"cik string, accession_number string, answers {calls.ANSWERS_TYPE}"
    )


def test_cascade(spark):
    data = {
        "first": [(0, "r0", 2)],
        "third": [(0, "r0", 1), (1, None, None), (3, "r3", 5)],
        "failed": [(0, "r0", 1), (2, "bad", None)],
        "one": [(1, None, None)],
    }
    got = {
        r.cik: (r.selected_chunks, r.selected_text, r.response, r.n_trustee)
        for r in reduce_cascade(answered(spark, data)).collect()
    }
    assert got == {
        "first": ([0], "t0", "r0", 2),
        "third": ([3], "t3", "r3", 5),
        "failed": ([2], "t2", "", 0),
        "one": ([1], "t1", "", 0),
    }


def test_later_candidates_are_not_sent(spark, tmp_path):
    choices = {f: [(0, [1]), (1, [2]), (3, [3])] for f in ("early", "late")}
    chunks = [(f, n, f"{f}{n} " + LONG * 2) for f in choices for n in (1, 2, 3)]
    df, _ = candidates(spark, choices, chunks)
    log = str(tmp_path / "log")

    def ask(prompts):
        return [one(p) for p in prompts]

    def one(prompt):
        with open(log, "a") as out:
            out.write(prompt.split()[0] + "\n")
        if prompt.startswith(("early1", "late3")):
            return '```json\n{"trustees": [{}, {}, {}]}\n```'
        return None if prompt.startswith("late2") else '{"trustees": [{"name": "x"}]}'

    results = reduce_cascade(calls.ask_in_turn(df, ask, "{SEC_FILING_SNIPPET}"))
    got = {r.cik: (r.selected_chunks, r.n_trustee) for r in results.collect()}
    assert got == {"early": ([1], 3), "late": ([3], 3)}
    with open(log) as sent:
        assert sorted(sent.read().split()) == ["early1", "late1", "late2", "late3"]


def test_a_failed_call_is_no_response(spark):
    """One bad prompt neither ends the job nor takes the answers beside it."""
    choices = {f: [(0, [1])] for f in ("good", "bad", "fine")}
    df, _ = candidates(spark, choices, [(f, 1, f"{f} " + LONG * 2) for f in choices])

    def ask(prompts):
        if any(p.startswith("bad") for p in prompts):
            raise RuntimeError("no luck")
        return ['{"trustees": [{}, {}]}'] * len(prompts)

    asked = calls.ask_in_turn(df, ask, "{SEC_FILING_SNIPPET}", parallelism=1, prompts_per_call=3)
    got = {r.cik: (r.n_trustee, r.error) for r in reduce_cascade(asked).collect()}
    assert got == {"good": (2, None), "fine": (2, None), "bad": (0, "RuntimeError: no luck")}
    assert calls.tried(lambda p: [], ["x"])[0][1].startswith("ValueError")


def test_texts_stay_where_they_are_read(spark, tmp_path):
    choices = {"1": [(0, [1, 2])], "2": [(0, [1])]}
    chunks = [(f, n, f"{f}{n} " + LONG * 2) for f in choices for n in (1, 2, 3)]
    narrow, _ = candidates(spark, choices, chunks)
    plan = narrow._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    below = plan[plan.rindex("BroadcastHashJoin") :]
    assert "Exchange hashpartitioning" not in below.split("BroadcastExchange")[0]
    assert plan.count("array_join") == 1
    wide, _ = candidates(spark, choices, chunks, broadcast_rows=0)
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))


def test_embedding_calls_keep_order(spark):
    def embed(texts):
        assert 0 < len(texts) <= 2
        return [[float(len(t)), 1.0] for t in texts]

    rows = [(str(i % 2), "a", i, "w " * i) for i in range(1, 8)]
    df = spark.createDataFrame(rows, "cik string, accession_number string, chunk_num int, t string")
    out = calls.embedded_chunks(df, "t", embed, calls.RequestLimits(5, 2))
    assert {r.chunk_num: r.embedding for r in out.collect()} == {i: [2.0 * i, 1.0] for i in range(1, 8)}
