"""Series held as arrays, oldest value first; used on streaming state.

Batch plans keep one row per (key, day) instead and never build these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_end(series: Column, k: int) -> Column:
    """The k-th value counted from the end (1 is the newest)."""
    return F.try_element_at(series, F.lit(-k))


def last_n(series: Column, n: int) -> Column:
    """The newest n values, or all of a shorter series."""
    size = F.size(series)
    return F.slice(series, F.greatest(size - F.lit(n - 1), F.lit(1)), F.lit(n))


def array_sum(series: Column, kind: str = "bigint") -> Column:
    return F.aggregate(
        series, F.lit(0).cast(kind), lambda total, x: (total + x).cast(kind)
    )


def sum_products(left: Column, right: Column, kind: str = "bigint") -> Column:
    """Sum of element-wise products of two aligned series."""
    side = "bigint" if kind == "bigint" else "decimal(19,0)"
    pairs = F.zip_with(
        left, right, lambda a, b: (a.cast(side) * b.cast(side)).cast(kind)
    )
    return array_sum(pairs, kind)


def replace_last(series: Column, value: Column) -> Column:
    size = F.size(series)
    kept = F.slice(series, F.lit(1), F.greatest(size - 1, F.lit(0)))
    return F.concat(kept, F.array(value))


def pad_left(series: Column, value: Column, length: int) -> Column:
    """Repeat a value in front of a series until it has ``length`` entries."""
    missing = F.greatest(F.lit(length) - F.size(series), F.lit(0))
    return F.concat(F.array_repeat(value, missing), series)


def prefix_sums(series: Column) -> Column:
    """Running totals of a short BIGINT array."""
    positions = F.sequence(F.lit(1), F.size(series))
    totals = F.transform(positions, lambda n: array_sum(F.slice(series, F.lit(1), n)))
    return F.when(F.size(series) > 0, totals).otherwise(
        F.array().cast("array<bigint>")
    )
