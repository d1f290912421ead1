"""A fold over an array that gives something for every element."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundglean.functions.binding import let

BLOCK = 128


def scanned(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    emit: Callable[[Column, Column, Column], Column],
    out_type: str,
    block: int = BLOCK,
) -> Column:
    """``emit(before, after, item)`` of every item, where ``step`` leads from state to state.

    An array in a fold's state is copied at each append, so what is given out is gathered
    for blocks of the items: the states at the blocks' starts first, then each block.
    """

    def part(number: Column) -> Column:
        return F.slice(items, number * block + 1, F.lit(block))

    def forward(state: Column, number: Column) -> Column:
        return F.struct(
            F.aggregate(part(number), state["now"], step).alias("now"),
            F.array_append(state["starts"], state["now"]).alias("starts"),
        )

    def gathered(start: Column, number: Column) -> Column:
        first = F.struct(start.alias("now"), F.array().cast(f"array<{out_type}>").alias("out"))
        return F.aggregate(
            part(number),
            first,
            lambda state, item: let(
                step(state["now"], item),
                lambda after: F.struct(
                    after.alias("now"),
                    F.array_append(state["out"], emit(state["now"], after, item)).alias("out"),
                ),
            ),
            lambda state: state["out"],
        )

    none = F.slice(F.array(zero), 1, 0)
    numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / block).cast("int"))
    starts = F.aggregate(
        numbers,
        F.struct(zero.alias("now"), none.alias("starts")),
        forward,
        lambda state: state["starts"],
    )
    found = F.flatten(F.transform(let(starts, lambda s: s), gathered))
    return F.when(F.size(items) > 0, found).otherwise(F.array().cast(f"array<{out_type}>"))
