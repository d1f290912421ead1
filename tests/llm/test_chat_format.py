import hashlib
import random

from fundglean.llm import chat_format as chat

PARTS = ["a", "\\", "<", "|", "<|im_end|>", "<|im_start|>user\n", "</s>", "[INST]", "[/INST]", "\n", "😀", "<\\|", "<<SYS>>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[conv] = (len(own), sha(turns), len(said), sha(said))
    return out


def test_round_trip(spark):
    rng = random.Random(8)
    text = lambda: "".join(rng.choices(PARTS, k=rng.randint(0, 12)))
    roles = ["user", "assistant", "system", "tool <|im_end|>", "two\nlines", None]
    rows = [(c, t, rng.choice(roles), text()) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(100, 0, "assistant", None), (101, None, None, None), (None, 1, "user", "x" * 200_000),
             (102, 1, "user", "same"), (102, 1, "user", "same"), (102, 1, "assistant", "more")]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, message string, seq int")
    rendered = chat.format_conversations(df)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(rendered).collect()}
    assert got == expected(rows)
    for r in rendered.collect():
        body = r["formatted"][len(chat.START) : -len(chat.END) - 1]
        assert not any(x in body for x in chat.CONTROL)
    assert chat.digests(chat.format_conversations(df.limit(0))).collect() == []


def fold(events):
    """Plain fold of one message's events, in order."""
    said, role = "", None
    for _, kind, text, who in events:
        said = text if kind == "edit" else "" if kind == "regenerate" else said + text
        role = who if who is not None else role
    return role or "", said


def test_events_fold(spark):
    rng = random.Random(9)
    events = []
    for c in range(20):
        for s in range(rng.randint(1, 25)):
            kind = rng.choice(["delta", "delta", "delta", "edit", "regenerate"])
            events.append((c, rng.randrange(4), s, kind, rng.choice([None, "user", "assistant"]), rng.choice("abc")))
    df = spark.createDataFrame(events, "conv_id long, message int, seq int, kind string, role string, text string")
    got = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat.reconstruct(df).collect()}
    want = {}
    for e in sorted(events, key=lambda e: e[2]):
        want.setdefault((e[0], e[1]), []).append((e[2], e[3], e[5], e[4]))
    assert got == {k: fold(v) for k, v in want.items()}


def test_nulls_and_ties_in_events(spark):
    rows = [(1, 1, 5, None, None, "b"), (1, 1, 5, None, None, "a"), (1, 1, None, None, "user", None),
            (1, 1, 5, None, None, "a")]
    df = spark.createDataFrame(rows, "conv_id long, message int, seq int, kind string, role string, text string")
    assert [(r["role"], r["text"]) for r in chat.reconstruct(df).collect()] == [("user", "aab")]


def test_loss_spans(spark):
    rows = [(1, 0, "user", "q<s>"), (1, 1, "assistant", "a</s>é")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spans = [
        chat.unescape(r["formatted"][r["loss_start"] : r["loss_end"]])
        for r in chat.format_conversations(df).orderBy("message").collect()
    ]
    assert spans == ["", "a</s>é"]


def test_text_ids(spark):
    rows = [("a", 1, "user", "hi"), ("a", 2, "assistant", "</s> yes"), (None, 1, "user", None)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.digests(chat.format_conversations(df)).collect()}
    assert got == {"a": (2, 8), None: (1, 0)}
    assert chat.digests(chat.format_conversations(df.limit(0))).collect() == []
