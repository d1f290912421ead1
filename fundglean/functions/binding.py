"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A value that a lambda refers to may be inlined into the lambda by the
    optimizer and then runs once per element. Passing it through a one-element
    array keeps it bound.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
