import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundglean.llm import language_id as lid

SCHEMA = "doc_id long, text string, lang string, score double, held_out string"
EN, DE = "the cat sat on the mat and was happy there", "der hund und die katze sind heute nicht da"


def plain_grams(text):
    """Runs of two to four characters with A-Z in lower case."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return Counter(low[i : i + n] for n in (2, 3, 4) for i in range(len(low) - n + 1))


def counter_of(gram):
    (found,) = (c for n, c in lid.grams(lid.lowered(gram)) if n == len(gram))
    return int(found[0])


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", EN + DE, "日本語の文です。日本", "ÀÉ mixed Ünïcode 🙂🙂🙂"])
def test_counters_are_those_of_characters(text):
    want = np.zeros(lid.BUCKETS, np.int64)
    for gram, n in plain_grams(text).items():
        want[counter_of(gram)] += n
    assert (lid.gram_counts(text) == want).all()


def test_pieces_count_like_one(monkeypatch):
    text = (EN + DE) * 7
    whole = lid.gram_counts(text)
    several = ["", text, "x", text[:33], DE]
    apart = [lid.gram_counts(t) for t in several]
    for piece in (50, 1000):
        monkeypatch.setattr(lid, "PIECE", piece)
        assert (lid.gram_counts(text) == whole).all()
        found = np.zeros((len(several), lid.BUCKETS), np.int64)
        for code, owner in lid.pieces(several):
            np.add.at(found, (owner, code), 1)
        assert (found == np.stack(apart)).all()


def test_edge_cases(spark):
    rows = [(i, (EN, DE)[i % 2], ("en", "de")[i % 2], 1.0, "x") for i in range(40)]
    odd = [
        (100, None, "en", None, None), (101, "", "de", None, None), (102, "123 ... !", "en", None, None),
        (None, EN, None, None, None), (103, DE * 5000, None, None, None), (103, DE * 5000, None, None, None),
    ]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = lid.learn_and_predict(df).collect()
    assert len(got) == len(rows) + len(odd)
    want = {r[0]: r[2] for r in rows} | {100: "und", 101: "und", 102: "und", None: "en", 103: "de"}
    assert {r["doc_id"]: r["lang_pred"] for r in got} == want
    for r in got:
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(text.encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    assert lid.learn_and_predict(df.limit(0)).collect() == []
    nothing = lid.learn_and_predict(df.where("lang IS NULL")).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


def plain_model(rows):
    counts, texts = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang, Counter())
        texts[lang] += 1
        for gram, n in plain_grams(text).items():
            own[counter_of(gram)] += n
    return {
        lang: (math.log(texts[lang] / len(rows)), own, sum(own.values()) + lid.SMOOTHING * lid.BUCKETS)
        for lang, own in counts.items()
    }


def plain_prediction(text, model):
    fit = {}
    for lang in sorted(model):
        prior, own, total = model[lang]
        fit[lang] = prior + sum(
            n * math.log((own[counter_of(g)] + lid.SMOOTHING) / total) for g, n in plain_grams(text).items()
        )
    best = max(fit, key=lambda k: fit[k])  # the first of equals
    return best, 1 / sum(math.exp(x - fit[best]) for x in fit.values())


def test_predictions_against_plain_python(spark):
    rng = random.Random(3)
    letters = {"en": "etaoin shr", "de": "enisra tdhu", "ja": "日本語の文です", "el": "αβγδε ζη"}
    said = lambda k, n: "".join(rng.choices(letters[k], k=n))
    rows = [(said(k, 80), k) for k in letters for _ in range(6)]
    texts = [said(k, n) for k in letters for n in (3, 10, 60)] + ["ETA OIN", "日本 eta"]
    model = lid.learn(spark.createDataFrame(rows, "text string, lang string"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r for r in lid.language_id(docs, model, F.lit(True)).collect()}
    want = plain_model(rows)
    for i, text in enumerate(texts):
        lang, score = plain_prediction(text, want)
        assert got[i]["lang_pred"] == lang
        assert got[i]["score"] == pytest.approx(score, rel=1e-3)


def test_many_languages(spark, monkeypatch):
    """Three hundred languages, in several passes or in one."""
    rows = [(f"word{chr(0x4E00 + i)}{chr(0x4E00 + i)} said", f"l{i:03}") for i in range(300)]
    model = lid.learn(spark.createDataFrame(rows, "text string, lang string").repartition(4))
    assert model.languages == [lang for _, lang in rows]
    docs = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id long, text string")
    got = []
    for sent in (64, 1000):
        monkeypatch.setattr(lid, "LANGUAGES_SENT", sent)
        found = lid.language_id(docs, model, F.lit(True)).collect()
        assert {r["doc_id"]: r["lang_pred"] for r in found} == {i: r[1] for i, r in enumerate(rows)}
        got.append([r["score"] for r in sorted(found)])
    assert got[0] == pytest.approx(got[1], rel=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lid.learn_and_predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) > 0.9 * len(got)
