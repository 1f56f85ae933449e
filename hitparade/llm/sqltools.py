"""Column helpers of the operators that stay in SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def int_table(values: list[int]) -> Column:
    """A constant array of integers (one literal, however long)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")

