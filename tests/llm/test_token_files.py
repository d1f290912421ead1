import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fundglean.llm import token_files as tf
from fundglean.llm.queries import QUERIES
from fundglean.llm.tokenizing import Encoder, bpe_words, public_path

SCHEMA = "doc_id long, text string, part int, tie string, ids string"
ODD = [
    "", " ", "\n\n", "a", "Hello, World!", "x<|endoftext|>y <|startoftext|> z", "tab\there\r\nthere", "é é ́x",
    "ΑΣ ΟΔΟΣ", "nb sp  em　wide", "a\x1cb \x85 c\x00d", "it's we'll 'S don'T", "１２ 345 ٣٤", "日本語 テキスト",
    "🙂🙂 🙂", "  lead and trail  ", "a  b   c\n d", "​zero​ width", "ǅ İ ı ß ﬁ", "x" * 3000, "<|endoftext|>" * 3,
]


def library_ids(texts):
    tokenizer = Tokenizer.from_file(public_path(tf.VOCABULARY))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [tf.END] for t in texts]


def lists(encode, texts):
    return encode(pa.array(texts, pa.string())).to_pylist()


def rows_of(docs, spark, folder, **options):
    df = spark.createDataFrame([(*d, 0, "x", None) for d in docs], SCHEMA).repartition(3)
    tf.write(df, folder, **options)
    return tf.read(spark, folder)


def test_ids_of_pieces_are_those_of_whole_texts():
    encode = bpe_words(public_path(tf.VOCABULARY))
    odd_words = ["İstanbul", "T̈ a", "İ", "Word.", "word,", "word..", "É.", "a's.", "ﬁ.", "Straße!", "Ǆ", "x." * 3, "<|", "<|END.", "Raci***", "then,###", "a<|endoftext|>", "é!’", "a'!", "ñ. e.́ x"]
    texts = [*odd_words, " ".join(odd_words), " ".join(f"w{i}ord Word{'abc'[i % 3] * i}." for i in range(40))]
    texts += [*ODD, *[" ".join(random.Random(i).sample(ODD, 6)) for i in range(30)]]
    assert [[*x, tf.END] for x in lists(encode, texts)] == library_ids(texts)


def test_memory_is_bounded():
    rules = bpe_words(public_path(tf.VOCABULARY))._rules
    asked = []
    encoder = Encoder(rules._replace(encode=lambda new: asked.extend(new) or rules.encode(new)), held_bytes=300)
    for i in range(50):
        text = f"a{'x' * i} bb, a{'x' * i}"
        assert lists(encoder, [text]) == [x[:-1] for x in library_ids([text])]
    assert 2 <= sum("bb" in x for x in asked) < 50


@pytest.mark.parametrize("seed", range(12))
def test_grammars_round_trip(seed):
    rng = np.random.default_rng(seed)
    first_rule = [4, 300, 60_000, 70_000][seed % 4]
    shapes = [
        lambda n: rng.integers(0, min(first_rule, 4), n),
        lambda n: np.resize(rng.integers(0, first_rule, 7), n),
        lambda n: np.zeros(n, np.int64),
    ]
    docs = [shapes[rng.integers(3)](rng.integers(1, 400)) for _ in range(60)]
    sizes = np.array([len(d) for d in docs])
    g = tf.compressed(np.concatenate(docs), sizes, first_rule)
    decoder = tf.Decoder(g.rules, g.lengths, first_rule)
    assert len(g.rules) > 0 and len(g.symbols) < sizes.sum() / 2
    upto = np.concatenate(([0], np.cumsum(g.doc_symbols)))
    assert upto[-1] == len(g.symbols)
    for k, doc in enumerate(docs):
        own = g.symbols[upto[k] : upto[k + 1]]
        assert decoder.ids(own).tolist() == doc.tolist()
        a, b = sorted(rng.integers(0, len(doc) + 3, 2).tolist())
        assert decoder.between(own, a, b).tolist() == doc[a:b].tolist()


def test_rules_are_told_best_first():
    ids = np.array([5, 6] * 50 + [7, 7] * 20 + [1, 2, 3])
    g = tf.compressed(ids, np.array([len(ids)]), 10)
    assert [5, 6] in g.rules.tolist() and [7, 7] in g.rules.tolist() and len(g.symbols) < 20


@pytest.mark.parametrize("shard_tokens", [1, 50, 10_000])
def test_against_the_library(spark, tmp_path, shard_tokens):
    docs = list(enumerate(ODD, start=-3)) + [(50, None), (50, None), (None, "none"), (7, "again"), (60, "w " * 20_000)]
    got = rows_of(docs, spark, str(tmp_path / "f"), shard_tokens=shard_tokens).collect()
    want = {}
    for (i, _), ids in zip(docs, library_ids([t for _, t in docs]), strict=True):
        want.setdefault(i, []).append(ids)
    assert len(got) == len(docs)
    at = 0
    for row in sorted(got, key=lambda r: r["start"]):
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        want[row["doc_id"]].remove(ids)
        assert row["start"] == at and row["n_tokens"] == len(ids)
        at += len(ids)
    ordered = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))


def test_ranges(spark, tmp_path):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["the", "cat", "sat", "on"]) for _ in range(rng.randint(0, 200)))) for i in range(80)]
    folder = str(tmp_path / "f")
    rows_of(docs, spark, folder, shard_tokens=900)
    ids = dict(zip([i for i, _ in docs], library_ids([t for _, t in docs]), strict=True))
    asked = [(i, rng.randint(-2, 50), rng.randint(0, 250)) for i in rng.sample(range(90), 40)]
    got = tf.read_ranges(spark, folder, spark.createDataFrame(asked, "doc_id long, first long, end long")).collect()
    want = sorted((i, a, b, ids[i][max(a, 0) : max(b, 0)]) for i, a, b in asked if i in ids)
    assert sorted((r["doc_id"], r["first"], r["end"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want


def test_empty_table_and_text_ids(spark, tmp_path):
    assert rows_of([], spark, str(tmp_path / "e")).collect() == []
    df = spark.createDataFrame([("b", "two words"), ("a", "one")], "doc_id string, text string")
    tf.write(df, str(tmp_path / "t"))
    got = tf.read(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in got] == [("a", 0, 2), ("b", 2, 3)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want, at = [], 0
    for row, ids in zip(docs, library_ids([r["text"] for r in docs]), strict=True):
        want.append((row["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = QUERIES["op11_token_files"](spark, "/root/testdata/sf0.001").orderBy(F.col("doc_id"))
    assert [tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()] == want
