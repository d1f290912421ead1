"""Texts of the selected chunks, and the cascade over candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.operators.lineage import cut_lineage
from fundglean.operators.relevance import PICKED
from fundglean.schemas import FILING_KEYS

MIN_TEXT_CHARS = 100
BROADCAST_ROWS = 500_000  # of keys and a number, some 60 bytes each


def candidate_texts(
    choices: DataFrame, chunks: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per filing with ``candidates``: array of (ordinal, method, chunks, text).

    A candidate counts only if its chunk list finds exactly as many rows in
    ``chunks`` as it has numbers (missing or repeated chunks void it) and its
    text has at least 100 characters.

    What is wanted, at most six numbers a filing, is written out and counted. Up
    to ``broadcast_rows`` it goes to where the texts are read, and only texts that
    are wanted move; beyond that texts and keys meet in a join by filing *and*
    chunk number. Each needed text travels once, however many rules picked it, and
    the choices join afterwards. Of repeated chunks only as many rows are kept as
    are needed to see that there are too many.
    """
    keys = list(FILING_KEYS)
    choices = cut_lineage(choices.select(*keys, "choices"))
    needed = F.array_distinct(F.flatten(F.transform("choices", lambda c: c["chunks"])))
    wanted = choices.select(*keys, F.explode(needed).alias("chunk_num"))
    if wanted.count() <= broadcast_rows:
        wanted = F.broadcast(wanted)
    copies = Window.partitionBy(*keys, "chunk_num").orderBy("chunk_text")
    found = (
        chunks.select(*keys, "chunk_num", "chunk_text")
        .join(wanted, [*keys, "chunk_num"])
        .withColumn("_copy", F.row_number().over(copies))
        .where(F.col("_copy") <= PICKED + 1)
    )
    gathered = (
        found.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("chunk_num", "chunk_text"))).alias("texts"))
        .join(choices, keys)
    )

    def with_text(choice):
        rows = F.filter(
            "texts", lambda t: F.array_contains(choice["chunks"], t["chunk_num"])
        )
        return let(
            rows,
            lambda r: F.struct(
                choice["ordinal"].alias("ordinal"),
                choice["method"].alias("method"),
                choice["chunks"].alias("chunks"),
                F.when(
                    F.size(r) == F.size(choice["chunks"]),
                    F.array_join(F.transform(r, lambda t: t["chunk_text"]), "\n"),
                ).alias("text"),
            ),
        )

    usable = F.filter(
        F.transform("choices", with_text), lambda c: F.length(c["text"]) >= MIN_TEXT_CHARS
    )
    # None or one row a filing: a filter on the result would put the texts together again.
    kept = let(usable, lambda found: F.when(F.size(found) > 0, F.array(found)))
    return gathered.select(*keys, F.explode(kept).alias("candidates"))


def reduce_cascade(answered: DataFrame) -> DataFrame:
    """One result per filing from its ``answers``.

    ``answers`` is an array of (ordinal, chunks, text, response, n_trustee, error) in
    trying order. The first with more than one trustee wins; otherwise the last
    one tried stays, with no response, a count of 0, and the error of its call.
    """
    accepted = F.filter("answers", lambda a: a["n_trustee"] > 1)
    keys = list(FILING_KEYS)
    picked = answered.select(
        *keys,
        F.get(accepted, 0).alias("won"),
        F.element_at("answers", -1).alias("last"),
    )
    kept = F.coalesce("won", "last")
    return picked.select(
        *keys,
        kept["chunks"].alias("selected_chunks"),
        kept["text"].alias("selected_text"),
        F.coalesce(F.col("won.response"), F.lit("")).alias("response"),
        F.coalesce(F.col("won.n_trustee"), F.lit(0)).alias("n_trustee"),
        F.when(F.col("won").isNull(), F.col("last.error")).alias("error"),
    )
