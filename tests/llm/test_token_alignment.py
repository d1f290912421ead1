import hashlib
import os
import random
from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fundglean.llm import token_alignment as ta
from fundglean.llm.queries import QUERIES
from fundglean.llm.tokenizing import bpe_bytes, bpe_pieces, byte_entries, piece_entries, public_path
from test_token_files import ODD, lists

A, B = public_path(ta.VOCABULARY_A), public_path(ta.VOCABULARY_B)
SCHEMA = "doc_id long, text string, row int, pair string, kind string"


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B)
    return lambda t: (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t))


def test_ids_of_pieces_are_those_of_whole_texts(library):
    rng = random.Random(1)
    texts = [*ODD, "a▁b ▁c", "<0x41> <s> </s> <unk>", *[rng.choice(" \n").join(rng.sample(ODD, 6)) for _ in range(40)]]
    texts = [t for t in texts if t]
    a, b = lists(bpe_bytes(A), texts), lists(bpe_pieces(B), texts)
    for k, text in enumerate(texts):
        assert (a[k], b[k]) == library(text), text


def plain(texts, library):
    """Rows of the query by comparing all tokens of a text."""
    entries = byte_entries(A), piece_entries(B)
    docs = []
    for text in texts:
        links, groups, n = [], [], (0, 0)
        if text:
            ids = library(text)
            raw = (" " + text).encode()
            if all(b"".join(e[i] for i in x) == raw for x, e in zip(ids, entries, strict=True)):
                n = tuple(map(len, ids))
                spans = []
                for x, e in zip(ids, entries, strict=True):
                    at, own = 0, []
                    for i in x:
                        own.append((at, at + len(e[i]), i))
                        at += len(e[i])
                    spans.append(own)
                links = [(i, j) for s, t, i in spans[0] for u, v, j in spans[1] if s < v and u < t]
                shared = sorted({t for _, t, _ in spans[0]} & {v for _, v, _ in spans[1]})
                for first, last in zip([0, *shared], shared):
                    sides = [",".join(str(i) for s, t, i in own if first <= s and t <= last) for own in spans]
                    groups.append("|".join(sides))
        docs.append((n, links, groups))
    counts = Counter(link for _, links, _ in docs for link in links)
    best = {}
    for (_, j), c in counts.items():
        best[j] = max(best.get(j, 0), c)
    return [
        (*n, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if links else "")
        for n, links, groups in docs
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("frequent", [0, 5, 1 << 19])
def test_against_all_tokens(spark, library, frequent):
    rng = random.Random(frequent)
    texts = [*ODD, None, None, "a▁b", "the cat", "the cat", "antidisestablishmentarianism 12345 éà"]
    texts += [" ".join(rng.choices(["the", "unhappily", "tokenization", "caféteria", "don't", "x1y2"], k=30)) for _ in range(20)]
    docs = [(i // 2, t, 1, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", 1, "x", "y")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = [tuple(r) for r in ta.align_documents(df, frequent=frequent).select("doc_id", *COLUMNS).collect()]
    want = plain([d[1] for d in docs], library)
    assert Counter(got) == Counter((d[0], *w) for d, w in zip(docs, want, strict=True))
    assert any(w[2] and w[2] < w[0] for w in want)


def test_a_long_text_and_slices(spark, library, monkeypatch):
    text = "some words that repeat and others " * 3000
    df = spark.createDataFrame([(1, text), (2, "x" * 20_000), (3, "others")], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in ta.align_documents(df).select("doc_id", *COLUMNS).collect()}
    a, b = library(text)
    assert got[1][:2] == (len(a), len(b)) and got[3][3] > 0
    assert all(r[3] == r[0] + r[1] - r[2] for r in got.values())


def test_empty_table(spark):
    got = ta.align_documents(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", *COLUMNS] and got.collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query_against_all_tokens(spark, library, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.where("length(text) < 4000").write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r["doc_id"], r["text"]) for r in docs.where("length(text) < 4000").collect()]
    got = [tuple(r) for r in QUERIES["op12_token_alignment"](spark, str(tmp_path)).select("doc_id", *COLUMNS).collect()]
    want = plain([t for _, t in rows], library)
    assert sorted(got) == sorted((i, *w) for (i, _), w in zip(rows, want, strict=True))
