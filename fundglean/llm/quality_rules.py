"""Quality rules: counts per document, and content lines by a linear-chain CRF.

Every line with a word gets a label, content or boilerplate, by Viterbi decoding
of a linear-chain conditional random field over the document's lines. The field
is trained here, on labelled documents with partial labels of their lines. Lines of good
documents are content, their repeated lines may be either. In bad documents lines of a
junk form (symbols, shouting, few different words, digits) are boilerplate, lines that
also stand in a good document are content, and beside lines of a junk form the others
may be either; without any, they are boilerplate. What may be either is
latent: the fit raises the chance of all labellings that agree with what is known, by the
difference of the expected counts of forward and backward messages with and without it.
A document is kept if it passes the base rules and at least half of its words stand
in content lines.

Edge cases: a null or empty text has no words and fails the base rules; repeated
rows are judged alike; without labelled documents the field has zero weights and
ties decode as content; an empty table gives no rows. Only ``doc_id`` and ``text``
are read, so other columns may have any names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = b"0123456789"
FEATURES = 9
#: What makes a line's form junk: symbols a word, repeated words, exclamation marks, digits.
JUNK = ((1, 0.25), (3, 0.5), (4, 0.5), (5, 0.5))
#: Bounds of the training sample; they bound the fit alone.
MAX_LABELLED = 2000
MAX_LINES = 400
BARRED = -1e6  # score of a label that a known one excludes
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lines long, content_share double, kept boolean"
)


@dataclass(frozen=True)
class LineField:
    """Log-linear weights: content against boilerplate, and change of label."""

    weights: np.ndarray
    transition: np.ndarray

    @staticmethod
    def blank() -> LineField:
        return LineField(np.zeros(FEATURES), np.zeros((2, 2)))


def without(raw: bytes, drop: bytes) -> int:
    return len(raw) - len(raw.translate(None, drop))


def line_features(line: bytes, words: list[bytes], copied: bool) -> tuple[float, ...]:
    n, size = len(words), len(line)
    letters = without(line, LETTERS)
    return (
        1.0,
        min(1.0, without(line, SYMBOLS) / n),
        without(line, UPPER) / max(1, letters),
        1.0 - len(set(words)) / n,
        min(1.0, without(line, b"!") / n),
        without(line, DIGITS) / size,
        1.0 if n < 4 else 0.0,
        1.0 if copied else 0.0,
        1.0 if line.rstrip()[-1:] in b".?:" else 0.0,
    )


def junk(features: np.ndarray) -> np.ndarray:
    """Lines that are boilerplate by their form alone."""
    columns, least = zip(*JUNK, strict=True)
    return (features[:, columns] >= np.array(least)).any(axis=1)


def line_labels(good: bool, features: np.ndarray, known: np.ndarray) -> np.ndarray:
    """1 for content, 0 for boilerplate, -1 for either; ``known`` marks lines of good documents."""
    if good:
        return np.where(features[:, 7] > 0, -1, 1)
    bad = junk(features)
    return np.where(bad, 0, np.where(known, 1, -1 if bad.any() else 0))


def parsed(raw: bytes | None) -> tuple[list[bytes], list[tuple[float, ...]], list[int], int]:
    """Words, features and word counts of the lines that have a word, copies of lines."""
    words: list[bytes] = []
    features, sizes, seen, copies = [], [], set(), 0
    for line in (raw or b"").split(b"\n"):
        own = line.split()
        if not own:
            continue
        copied = line in seen
        copies += copied
        seen.add(line)
        words += own
        sizes.append(len(own))
        features.append(line_features(line, own, copied))
    return words, features, sizes, copies


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    code = code * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    total = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        total = total * np.uint64(0xD6E8FEB86659FD93) + code[i : i + n]
    order = np.sort(total)
    if not (order[1:] == order[:-1]).any():
        return 0
    # Exact from here on: names of windows of 1, 2, 4 and 8 words, by pairs of names.
    ids: dict[bytes, int] = {}
    name = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    step = 1
    while step < WINDOW:
        pairs = name[:-step] * (len(words) + 1) + name[step:]
        name = np.unique(pairs, return_inverse=True)[1]
        step *= 2
    often = np.bincount(name)[name] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def viterbi(scores: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The best labels; ``scores`` are those of content against boilerplate (zero)."""
    (t00, t01), (t10, t11) = transition.tolist()
    a, b = 0.0, 0.0
    back = []
    for i, s in enumerate(scores.tolist()):
        if i == 0:
            a, b = 0.0, s
            continue
        to0, to1 = b + t10 >= a + t00, b + t11 >= a + t01
        a, b = (b + t10 if to0 else a + t00), (b + t11 if to1 else a + t01) + s
        back.append((to0, to1))
    labels = np.zeros(len(scores), bool)
    now = b >= a
    for i in range(len(scores) - 1, -1, -1):
        labels[i] = now
        if i:
            now = back[i - 1][int(now)]
    return labels


def judge(raw: bytes | None, field: LineField, share: float) -> tuple:
    words, features, sizes, copies = parsed(raw)
    n = len(words)
    joined = b"".join(words)
    chars = len(joined) - without(joined, bytes(range(128, 192)))
    repeats = repeated_words(words)
    failed = n < 20 or 100 * repeats > 30 * n
    content = 0.0
    if sizes:
        labels = viterbi(np.array(features) @ field.weights, field.transition)
        content = float((labels * np.array(sizes)).sum() / n)
    return (
        n, chars, without(joined, SYMBOLS), copies, repeats, failed,
        len(sizes), content, not failed and content >= share,
    )


def verdicts(
    docs: DataFrame, field: LineField, share: float = 0.5, name: str = "verdict"
) -> DataFrame:
    """``docs`` with a struct ``name`` of the counts and the decision, row by row."""

    @F.pandas_udf(SCHEMA)
    def verdict(raw: pd.Series) -> pd.DataFrame:
        columns = [x.split()[0] for x in SCHEMA.split(", ")]
        return pd.DataFrame([judge(x, field, share) for x in raw], columns=columns)

    return docs.withColumn(name, verdict.asNondeterministic()(F.col("text").cast("binary")))


def sample(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> list[tuple]:
    """At most ``bound`` labelled documents as (labels, feature rows) of lines, by hash of the id."""
    drawn = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    limit = MAX_LINES

    @F.pandas_udf("lines array<bigint>, features array<double>")
    def flat(raw: pd.Series) -> pd.DataFrame:
        lines, features = [], []
        for x in raw:
            own = [line for line in (x or b"").split(b"\n") if line.split()]
            lines.append([zlib.crc32(line) << 31 | zlib.adler32(line) >> 1 for line in own[:limit]])
            features.append([v for f in parsed(x)[1][:limit] for v in f])
        return pd.DataFrame({"lines": lines, "features": features})

    rows = (
        docs.select("doc_id", F.col("text").cast("binary").alias("_raw"))
        .join(F.broadcast(drawn), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_raw")
        .limit(bound)
        .select("_label", flat("_raw").alias("_f"))
        .select("_label", "_f.lines", "_f.features")
        .collect()
    )
    of_good = {line for label, lines, _ in rows if label > 0 for line in lines}
    out = []
    for label, lines, features in rows:
        if features:
            x = np.array(features).reshape(-1, FEATURES)
            known = np.array([line in of_good for line in lines], bool)
            out.append((line_labels(label > 0, x, known), x))
    return out


def fit(sampled: list[tuple], steps: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> LineField:
    """Maximise the likelihood of the known labels, all others summed out, by gradient steps.

    ``sampled`` has the lines' labels (one label stands for all), -1 where either may be,
    and their features. Forward and backward messages run over all documents of the
    sample at once, for all labellings and for those that agree with the known labels.
    """
    if not sampled:
        return LineField.blank()
    sampled = sorted(sampled, key=lambda x: len(x[1]))
    n, longest = len(sampled), max(len(x) for _, x in sampled)
    x = np.zeros((n, longest, FEATURES))
    on = np.zeros((n, longest), bool)
    barred = np.zeros((2, n, longest, 2))  # all labellings, and those that agree
    for i, (labels, rows) in enumerate(sampled):
        own = np.broadcast_to(labels, len(rows))
        x[i, : len(rows)], on[i, : len(rows)] = rows, True
        for label in (0, 1):
            barred[1, i, : len(rows), label][own == 1 - label] = BARRED
    lengths = on.sum(1)
    # Documents are sorted by length: those with more than i lines come last.
    longer = np.searchsorted(lengths, np.arange(longest), "right")
    lines, pairs = on.sum(), max(1, (on[:, 1:]).sum())
    w, t = np.zeros(FEATURES), np.zeros((2, 2))
    state = [np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(FEATURES), np.zeros((2, 2))]
    for step in range(1, steps + 1):
        unary = barred.copy()
        unary[..., 1] += x @ w
        content, joint = expected(unary, t, on, lengths, longer)
        grads = (
            ((content[1] - content[0])[:, :, None] * x).sum((0, 1)) / lines - ridge * w,
            (joint[1] - joint[0]) / pairs - ridge * t,
        )
        for j, (value, grad) in enumerate(zip((w, t), grads, strict=True)):
            state[j] = 0.9 * state[j] + 0.1 * grad
            state[j + 2] = 0.99 * state[j + 2] + 0.01 * grad**2
            value += rate * (state[j] / (1 - 0.9**step)) / (
                np.sqrt(state[j + 2] / (1 - 0.99**step)) + 1e-8
            )
    return LineField(w, t)


def expected(
    unary: np.ndarray, t: np.ndarray, on: np.ndarray, lengths: np.ndarray, longer: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Chances of content of each line, and expected counts of pairs of labels.

    For each of the first axis of ``unary`` (scores of both labels by document and line).
    """
    ways, n, longest, _ = unary.shape
    ahead, behind = np.zeros_like(unary), np.zeros_like(unary)
    ahead[:, :, 0] = unary[:, :, 0]
    for i in range(1, longest):
        own = slice(longer[i], None)
        before = ahead[:, own, i - 1]
        ahead[:, own, i] = unary[:, own, i] + np.logaddexp(before[..., :1] + t[0], before[..., 1:] + t[1])
    for i in range(longest - 2, -1, -1):
        own = slice(longer[i + 1], None)
        after = unary[:, own, i + 1] + behind[:, own, i + 1]
        behind[:, own, i] = np.logaddexp(after[..., :1] + t[:, 0], after[..., 1:] + t[:, 1])
    last = ahead[:, np.arange(n), lengths - 1]
    total = np.logaddexp(last[..., 0], last[..., 1])[:, :, None]
    content = np.exp(np.minimum(ahead[..., 1] + behind[..., 1] - total, 0.0)) * on
    joint = np.zeros((ways, 2, 2))
    for a in (0, 1):
        for b in (0, 1):
            both = ahead[:, :, :-1, a] + t[a, b] + unary[:, :, 1:, b] + behind[:, :, 1:, b] - total
            joint[:, a, b] = (np.exp(np.minimum(both, 0.0)) * on[:, 1:]).sum((1, 2))
    return content, joint


def quality_rules(docs: DataFrame, field: LineField, share: float = 0.5) -> DataFrame:
    """One row per document: its id, the counts, the content share and the decision."""
    return verdicts(docs.select("doc_id", "text"), field, share).select("doc_id", "verdict.*")
