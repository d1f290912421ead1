"""Text -> pieces -> chunks, one document per row and no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.functions.text import is_empty_line, is_table_row, sentences, slices, strip

DEFAULT_CHUNK_SIZE = 3500
MIN_CHUNK_CHARS = 100  # chunks of this length or less are dropped


def content_lines(text: Column) -> Column:
    """Stripped non-empty lines; an exactly blank line stays as ``''``.

    A blank line is where paragraphs part, and a run of table rows must not
    continue past it.
    """
    cleaned = F.transform(
        F.split(text, "\n"),
        lambda line: F.when(line == "", line).when(~is_empty_line(line), strip(line)),
    )
    return F.filter(cleaned, lambda line: line.isNotNull())


def _table_pieces(lines: Column, abbreviations: Sequence[str] | None = None) -> Column:
    """Pieces of lines among which there may be table rows."""

    def piece(run: Column) -> Column:
        first = F.element_at(run, 1)
        table = F.array_join(F.filter(run, lambda line: line != ""), "\n")
        return F.when(is_table_row(first), F.array(table)).otherwise(
            sentences(first, abbreviations)
        )

    def starts(table: Column) -> Column:
        def begins(row: Column, i: Column) -> Column:
            continues = row & F.coalesce(F.get(table, i - 1), F.lit(False))
            return F.when((F.get(lines, i) != "") & ~continues, i)

        return F.filter(F.transform(table, begins), lambda i: i.isNotNull())

    return let(
        let(F.transform(lines, is_table_row), starts),
        lambda s: F.flatten(slices(lines, s, piece)),
    )


def _prose_pieces(lines: Column) -> Column:
    """Pieces of lines without any table row: one regex pass over the document."""
    prose = F.array_join(F.filter(lines, lambda line: line != ""), "\n")
    return F.filter(sentences(prose), lambda sentence: sentence != "")


def text_pieces(text: Column, abbreviations: Sequence[str] | None = None) -> Column:
    """Array of pieces: a run of table rows is one piece, prose gives sentences."""

    def pieces(lines: Column) -> Column:
        by_line = _table_pieces(lines, abbreviations)
        if abbreviations is not None:
            return by_line
        return F.when(F.contains(text, F.lit("|")), by_line).otherwise(_prose_pieces(lines))

    return let(content_lines(text), pieces)


def pack_starts(lengths: Column, size: int) -> Column:
    """0-based positions at which greedy packing begins a new chunk.

    The fold keeps chunk starts, not strings: an array in the fold state is
    copied at each append, and this appends once per chunk. Separators are not
    counted, and a piece over ``size`` stays whole.
    """
    zero = F.struct(
        F.lit(0).alias("filled"),
        F.lit(0).alias("at"),
        F.array(F.lit(0)).alias("starts"),
    )

    def step(state: Column, length: Column) -> Column:
        full = state["filled"] + length > size
        return F.struct(
            F.when(full, length).otherwise(state["filled"] + length).alias("filled"),
            (state["at"] + 1).alias("at"),
            F.when(full, F.array_append(state["starts"], state["at"]))
            .otherwise(state["starts"])
            .alias("starts"),
        )

    return F.aggregate(lengths, zero, step, lambda state: state["starts"])


def pack_pieces(pieces: Column, size: int = DEFAULT_CHUNK_SIZE) -> Column:
    """Greedy packing of an array of pieces; chunks too short to matter are dropped."""

    def chunks(p: Column) -> Column:
        return let(
            pack_starts(F.transform(p, F.length), size),
            lambda s: slices(p, s, lambda run: F.array_join(run, "\n\n")),
        )

    return F.filter(
        let(pieces, chunks), lambda chunk: F.length(strip(chunk)) > MIN_CHUNK_CHARS
    )


def chunk_text(
    text: Column, size: int = DEFAULT_CHUNK_SIZE, abbreviations: Sequence[str] | None = None
) -> Column:
    """Array of chunks of a document; the position in the array is the chunk number."""
    return pack_pieces(text_pieces(text, abbreviations), size)
