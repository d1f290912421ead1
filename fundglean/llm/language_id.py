"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is a sequence of characters (code points) with A-Z in lower case. Runs of two, three
and four characters are hashed to one of 32,768 counters; a language's counters,
smoothed, give log probabilities. Texts are scored a batch at a time: the counters that its
texts meet form a sparse matrix, whose product with the log probabilities is summed up by
text. The matrix of log probabilities is broadcast, 128 KB for a language, in parts of
``LANGUAGES_SENT`` languages; each part is a pass over the texts, which hands on
the best language so far and the sum of all chances.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so is
everything if nothing could be learned; ties go to the language that sorts first;
rows to learn from without text or language teach nothing; repeated rows count
each time. Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundglean.llm.common import fold

BITS = 15
BUCKETS = 1 << BITS
# One factor for each character of a run of each length.
FACTORS = {
    2: (0x9E3779B1, 0x85EBCA77),
    3: (0xC2B2AE3D, 0x27D4EB2F, 0x165667B1),
    4: (0xD3A2646D, 0xFD7046C5, 0xB55A4F09, 0x8DA6B343),
}
PIECE = 1 << 20  # characters hashed at a time
SMOOTHING = 0.5
#: Languages whose log probabilities are sent at once: 8 MB.
LANGUAGES_SENT = 64
#: Languages counted at once in a task before their counters are handed on.
HELD = 32
UNDETERMINED = "und"


def lowered(text: str) -> np.ndarray:
    """The code points, A-Z in lower case."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((x >= 65) & (x <= 90), x + np.uint32(32), x)


def grams(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each length, the counters of all runs of so many characters, by where they begin."""
    for order, factors in FACTORS.items():
        n = len(points) - order + 1
        if n <= 0:
            continue
        code = np.full(n, order, np.uint32)
        for i, factor in enumerate(factors):
            code += points[i : i + n] * np.uint32(factor)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        yield order, (code >> np.uint32(32 - BITS)).astype(np.int32)


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counters met, and the text of each, for texts joined up to ``PIECE`` characters or one text.

    Runs do not stretch from one text to the next.
    """
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        points = lowered(text)
        held.append(points)
        owners.append(i)
        size += len(points)
        if size >= PIECE:
            yield from joined(held, owners)
            held, owners, size = [], [], 0
    yield from joined(held, owners)


def joined(held: list[np.ndarray], owners: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if not held:
        return
    owner = np.repeat(np.array(owners, np.int32), [len(x) for x in held])
    points = np.concatenate(held)
    for first in range(0, len(points), PIECE):
        own = owner[first : first + PIECE + 3]
        for order, code in grams(points[first : first + PIECE + 3]):
            n = min(PIECE, len(code))
            within = own[:n] == own[order - 1 : order - 1 + n]
            yield code[:n][within], own[:n][within]


def gram_counts(text: str) -> np.ndarray:
    """How often each counter is met in the whole text."""
    total = np.zeros(BUCKETS, np.int64)
    for code, _ in pieces([text]):
        total += np.bincount(code, minlength=BUCKETS)
    return total


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # languages x counters


def learn(rows: DataFrame) -> LanguageModel:
    """Counters of each language over all ``rows`` (``text``, ``lang``).

    What the driver holds is the model itself: 128 KB for each language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            raw = [total.tobytes() for total in held.values()]
            found = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(raw, pa.binary())], ["lang", "counters"]
            )
            held.clear()
            return found

        for batch in batches:
            texts, langs = (batch.column(i).to_pylist() for i in (0, 1))
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs, strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                if lang not in held:
                    if len(held) == HELD:
                        yield out()
                    held[lang] = np.zeros(BUCKETS + 1, np.int64)
                for code, _ in pieces(own):
                    held[lang][:BUCKETS] += np.bincount(code, minlength=BUCKETS)
                held[lang][BUCKETS] += len(own)  # the last counter holds the number of texts
        if held:
            yield out()

    def added(key: tuple, parts: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS + 1, np.int64)
        for raw in parts.column("counters").to_pylist():
            total += np.frombuffer(raw, np.int64)
        probability = np.log(total[:BUCKETS] + SMOOTHING) - np.log((total[:BUCKETS] + SMOOTHING).sum())
        return pa.table(
            {
                "lang": [key[0].as_py()],
                "n": [int(total[BUCKETS])],
                "row": pa.array([probability.astype(np.float32).tobytes()], pa.binary()),
            }
        )

    known = rows.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    found = (
        known.mapInArrow(count, "lang string, counters binary")
        .groupBy("lang")
        .applyInArrow(added, "lang string, n long, row binary")
        .collect()
    )
    found.sort(key=lambda r: r["lang"])
    texts = np.array([r["n"] for r in found], float)
    matrix = [np.frombuffer(r["row"], np.float32) for r in found]
    return LanguageModel(
        [r["lang"] for r in found],
        np.log(texts / max(1.0, texts.sum())),
        np.stack(matrix) if matrix else np.zeros((0, BUCKETS), np.float32),
    )


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


def fits(texts: list[str], prior: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """The log chance of each text and language, from the sparse counts of the whole batch."""
    fit = np.tile(prior, (len(texts), 1))
    for code, owner in pieces(texts):
        cell, n = np.unique(owner.astype(np.int64) << BITS | code, return_counts=True)
        met, own = cell & (BUCKETS - 1), cell >> BITS
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        if len(starts):
            terms = np.empty((len(starts), len(prior)))
            for k in range(len(prior)):
                terms[:, k] = np.add.reduceat(probability[k, met] * n, starts)
            fit[own[starts]] += terms
    return fit


def one_pass(sent: Broadcast):
    """Function of texts: the best of the languages sent, and the sum of their chances."""

    @F.pandas_udf("lang string, top double, total double")
    def best(texts: pd.Series) -> pd.DataFrame:
        languages, prior, probability = sent.value
        there = [x or "" for x in texts]
        fit = fits(there, prior, probability)
        at = fit.argmax(axis=1)
        top = fit[np.arange(len(there)), at]
        total = top + np.log(np.exp(fit - top[:, None]).sum(axis=1))
        letters = np.array([has_letter(x) for x in there], bool)
        return pd.DataFrame(
            {
                "lang": np.where(letters, np.array(languages, object)[at], None),
                "top": np.where(letters, top, np.nan),
                "total": np.where(letters, total, np.nan),
            }
        )

    return best


def scored(model: LanguageModel, docs: DataFrame, text: str) -> Column | None:
    """A struct ``lang``, ``top`` and ``total`` (logarithms) of each text, by passes."""
    context = docs.sparkSession.sparkContext
    best = None
    for first in range(0, len(model.languages), LANGUAGES_SENT):
        some = slice(first, first + LANGUAGES_SENT)
        sent = context.broadcast(
            (model.languages[some], model.log_prior[some], model.log_probability[some])
        )

        found = one_pass(sent)(F.col(text))
        best = found if best is None else F.struct(best.alias("a"), found.alias("b"))
        if first:
            best = better(best)
    return best


def better(both: Column) -> Column:
    """Of two passes over a text, the better language, the first on a tie, and both sums."""
    a, b = both["a"], both["b"]
    high = F.greatest(a["total"], b["total"])
    total = high + F.log1p(F.exp(F.least(a["total"], b["total"]) - high))
    return F.struct(
        F.when(b["top"] > a["top"], b["lang"]).otherwise(a["lang"]).alias("lang"),
        F.greatest(a["top"], b["top"]).alias("top"),
        total.alias("total"),
    )


def language_id(docs: DataFrame, model: LanguageModel, held_out: Column) -> DataFrame:
    best = scored(model, docs, "text")
    if best is None:
        best = F.struct(
            F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("top"), F.lit(0.0).alias("total")
        )
    rows = docs.select("doc_id", held_out.alias("held_out"), best.alias("_p"))
    score = F.when(F.col("_p.lang").isNotNull(), F.exp(F.col("_p.top") - F.col("_p.total")))
    return rows.select(
        "doc_id",
        "held_out",
        F.coalesce("_p.lang", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.least(F.coalesce(score, F.lit(0.0)), F.lit(1.0)).alias("score"),
    )


def learn_and_predict(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """Learn from the documents outside fold 0 of ``modulus`` and predict all of them."""
    docs = docs.select("doc_id", "text", "lang")
    held_out = fold("doc_id", modulus) == 0
    return language_id(docs, learn(docs.where(~held_out)), held_out)
