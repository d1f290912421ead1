"""Line-level text rules: blank lines, table rows, sentences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundglean.functions.binding import let

# The characters stripped from the ends of lines (the Unicode
# white space characters).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Three word characters in a row: the same as having a word longer than two.
LONG_WORD = r"[\p{L}\p{N}_]{3}"
SHORT_LINE = 5


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_empty_line(line: Column) -> Column:
    """No word of three or more characters, or under five characters and no letter."""
    no_words = ~F.rlike(line, F.lit(LONG_WORD))
    no_letters = ~F.rlike(line, F.lit(r"\p{L}"))  # first: it settles most lines at once
    return no_words | (no_letters & (F.length(strip(line)) < SHORT_LINE))


def is_table_row(line: Column) -> Column:
    """At least two pipes."""
    return F.rlike(line, F.lit(r"\|[^|]*\|"))


def sentences(line: Column, abbreviations: Sequence[str] | None = None) -> Column:
    """Cut one line after ``.``, ``!`` or ``?`` (and closing marks) before a space.

    With ``abbreviations`` (lower case, without the period) there is no cut after the period
    of one of them or of an initial, nor before a small letter that follows a period. What
    is not cut keeps a single space.
    """
    marked = F.regexp_replace(line, r"""([.!?]["')\]]*)\s+""", "$1\n")
    parts = F.split(marked, "\n")
    if abbreviations is None:
        return parts

    def goes_on(part: Column, following: Column) -> Column:
        word = F.lower(F.regexp_extract(part, r"(\p{L}+)\.$", 1))
        known = word.isin(list(abbreviations)) if abbreviations else F.lit(False)
        initial = F.rlike(part, F.lit(r"(?:^|[^\p{L}])\p{Lu}\.$"))
        small = F.endswith(part, F.lit(".")) & F.rlike(following, F.lit(r"^\p{Ll}"))
        return known | initial | small

    def joined(found: Column) -> Column:
        begins = F.filter(
            F.transform(
                found, lambda part, i: F.when((i == 0) | ~goes_on(F.get(found, i - 1), part), i)
            ),
            lambda i: i.isNotNull(),
        )
        return let(begins, lambda starts: slices(found, starts, lambda run: F.array_join(run, " ")))

    return let(parts, joined)


def slices(items: Column, starts: Column, build) -> Column:
    """``build`` over the runs of ``items`` that begin at the 0-based ``starts``."""
    return F.transform(
        starts,
        lambda start, k: build(
            F.slice(
                items,
                start + 1,
                F.coalesce(F.get(starts, k + 1), F.size(items)) - start,
            )
        ),
    )
