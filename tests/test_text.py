import math
import random
import re

import pytest

from fundglean.functions import text
from fundglean.functions.chunking import chunk_text, pack_pieces, text_pieces
from fundglean.functions.text import sentences
from fundglean.operators import abbreviations


def test_empty_lines(value):
    lines = ["   ", " -83-", " wo- wb- xp", " word ", "---|---", "ab | cd", "a1b", "été où a", ""]
    assert value(text.is_empty_line, lines) == [
        True, True, True, False, True, True, False, False, True,
    ]


def test_strip_is_unicode(value):
    assert value(text.strip, ["\u00a0 a\u2003b \u3000\r\n", "\x1c", "x"]) == ["a\u2003b", "", "x"]


def test_table_rows(value):
    assert value(text.is_table_row, ["a | b", "a | b | c", "||", "|"]) == [False, True, True, False]


def test_sentences(value):
    line = 'One. Two! (Three?) Four 3.5 is "five." Six'
    assert value(text.sentences, [line]) == [
        ["One.", "Two!", "(Three?)", 'Four 3.5 is "five."', "Six"]
    ]


def test_pieces_keep_a_table_whole_and_apart(value):
    content = (
        "First one. Second one.\n"
        "Name | Pay | Other\n---|---|---\nAnn | 100 | 200\n\n"
        "Bob | 300 | 400\n12\nCarl | 500 | 600\nLast line"
    )
    assert value(text_pieces, [content, "", "\n\n"]) == [
        [
            "First one.",
            "Second one.",
            "Name | Pay | Other\nAnn | 100 | 200",
            "Bob | 300 | 400\nCarl | 500 | 600",
            "Last line",
        ],
        [],
        [],
    ]


def _py_empty(line):
    content = line.strip()
    words = re.findall(r"\b\w+\b", content)
    short = len(content) < 5 and not any(c.isalpha() for c in content)
    return not content or short or all(len(w) <= 2 for w in words)


def _py_pieces(content):
    out = []
    for paragraph in content.split("\n\n"):
        run = []
        for line in (x.strip() for x in paragraph.split("\n") if not _py_empty(x)):
            if line.count("|") >= 2:
                run.append(line)
                continue
            if run:
                out.append("\n".join(run))
                run = []
            out += re.sub(r"""([.!?]["')\]]*)\s+""", "\\1\n", line).split("\n")
        if run:
            out.append("\n".join(run))
    return out


def _py_chunks(pieces, size):
    chunks, current, filled = [], [], 0
    for piece in pieces:
        if filled + len(piece) > size:
            chunks.append("\n\n".join(current))
            current, filled = [piece], len(piece)
        else:
            current.append(piece)
            filled += len(piece)
    chunks.append("\n\n".join(current))
    return [c for c in chunks if len(c.strip()) > 100]


def test_pieces_and_chunks_match_a_plain_fold(value):
    rng = random.Random(5)
    parts = ["word", "été", "a", "12", " ", "\n", "\n\n", "\n \n", ". ", "! ", " | ", "|", "x | y | zed\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 400))) for _ in range(300)]
    assert value(text_pieces, texts) == [_py_pieces(t) for t in texts]
    for size in (60, 150, 400):
        got = value(lambda x: chunk_text(x, size), texts)
        assert got == [_py_chunks(_py_pieces(t), size) for t in texts]


def test_oversized_pieces_stay_whole(value):
    big, small = "b" * 300, "s" * 60
    rows = [[big, small, small], [small, big, small, small], [small], []]
    got = value(lambda x: pack_pieces(x, 150), rows, "x array<string>")
    assert got == [[big, f"{small}\n\n{small}"], [big, f"{small}\n\n{small}"], [], []]


def test_separators_are_not_counted(value):
    piece = "p" * 60
    got = value(lambda x: pack_pieces(x, 120), [[piece, piece, piece, piece]], "x array<string>")
    assert [len(c) for c in got[0]] == [122, 122]


def test_sentences_that_abbreviations_do_not_end(value):
    known = ["inc", "no", "dr", "st"]
    lines = [
        "Funds Inc. The board met. It rose.",
        "See No. 5 of the list! Dr. Smith (St. Paul) came.",
        "J. R. Doe is a trustee. He is 61.",
        "The u.s. market, i.e. stocks. Bonds too.",
        "An end in Inc.",
        "Is it?  Yes.  no capital",
        "",
        None,
    ]
    cut = lambda c: sentences(c, known)
    assert value(cut, lines) == [
        ["Funds Inc. The board met.", "It rose."],
        ["See No. 5 of the list!", "Dr. Smith (St. Paul) came."],
        ["J. R. Doe is a trustee.", "He is 61."],
        ["The u.s. market, i.e. stocks.", "Bonds too."],
        ["An end in Inc."],
        ["Is it?", "Yes. no capital"],
        [""],
        None,
    ]
    assert value(lambda c: sentences(c, []), ["Inc. The A. B. x."]) == [["Inc.", "The A. B. x."]]


def test_abbreviations_are_learned(spark):
    """Words that mostly have their period, against the formula in plain Python."""
    rows = ["the fund inc. and dr. no. five fell."] * 30 + ["no fund of the dr. rose. the end came."] * 20
    rows += ["It is an end. The sum is big."] * 200 + ["", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    counts = {}
    for row in rows:
        for word in re.findall(r"[a-z]+\.?", (row or "").lower()):
            pair = counts.setdefault(word.rstrip("."), [0, 0])
            pair[0 if word.endswith(".") else 1] += 1
    p = sum(d for d, _ in counts.values()) / sum(d + b for d, b in counts.values())
    fit = lambda d, b, q: d * math.log(q) + b * math.log(1 - q)
    want = {
        w: 2 * (fit(d, b, 0.99) - fit(d, b, p)) * math.exp(-len(w)) * len(w) ** -float(b)
        for w, (d, b) in counts.items() if d
    }
    got = {r.word: r.score for r in abbreviations.scores(df, "t").collect()}
    assert got == pytest.approx({w: x for w, x in want.items() if x >= 0.3})
    assert {"inc", "dr"} <= set(got) and not {"end", "no", "the"} & set(got)
    assert abbreviations.learned(df, "t", most=1) == [max(got, key=got.get)]
    assert abbreviations.learned(df.limit(0), "t") == []


def test_chunks_by_learned_sentences(value):
    text = "Alpha Inc. The second part of it stands here at length, so that there is a chunk of it. Next one too. " * 3
    cut = lambda c: chunk_text(c, 60, ["inc"])
    assert all(not chunk.endswith("Inc.") for chunk in value(cut, [text])[0])
