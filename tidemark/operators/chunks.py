"""Splitting hot keys into order-preserving chunks.

Order-sensitive operators work per (key, chunk) and pass a small carry between
the chunks of a key, so one key with a third of all rows spreads over as many
tasks as any other data. The chunk of a row is a deterministic function of the
row and of exact per-group counts, so recomputing a lost task gives the same
chunks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import pin

CHUNK = "_chunk"
ROWS_PER_CHUNK = 2_000_000
# Most pieces one group is cut into per level, and levels that still fit BIGINT.
FAN_OUT = 4096
MAX_LEVELS = 5
# A pinned side table up to this many rows (a few MB) is broadcast; a larger one
# is joined by shuffle.
BROADCAST_ROWS = 100_000


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def join_on(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """NULL-safe equi-join on equally named columns, keeping the left ones."""
    renamed = right.select(
        *[F.col(n).alias(f"_r_{n}") if n in names else F.col(n) for n in right.columns]
    )
    condition = None
    for n in names:
        test = same(F.col(n), F.col(f"_r_{n}"))
        condition = test if condition is None else condition & test
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"_r_{n}" for n in names])


@dataclass(frozen=True)
class Chunked:
    """Rows with a chunk column: all of them, and those of hot keys alone."""

    rows: DataFrame
    hot: DataFrame


def join_pinned(
    left: DataFrame, pinned: DataFrame, names: list[str], how: str
) -> DataFrame:
    """Joins a materialised side table, broadcast only if its count is small."""
    fits = pinned.count() <= BROADCAST_ROWS
    return join_on(left, F.broadcast(pinned) if fits else pinned, names, how)


def without_pinned(left: DataFrame, pinned: DataFrame, names: list[str]) -> DataFrame:
    """The rows that match none of a materialised side table."""
    fits = pinned.count() <= BROADCAST_ROWS
    return join_on(left, F.broadcast(pinned) if fits else pinned, names, "left_anti")


def assign_chunks(
    df: DataFrame,
    key: str,
    order: str,
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> Chunked | None:
    """Cuts the hot keys of ``df``; None when there are none.

    Runs one narrow, map-side combined count; ``rows_per_chunk=None`` skips it
    where keys are known to be small. Only keys above the limit are cut; cuts
    that are still too full (an uneven order) are cut again.
    """
    if rows_per_chunk is None:
        return None
    group = [key]
    rows = hot = df
    for _ in range(MAX_LEVELS):
        groups = _hot_groups(hot, group, order, rows_per_chunk).persist()
        if groups.count() == 0:
            groups.unpersist()
            break
        pinned = pin(groups)
        groups.unpersist()
        hot = _cut(hot, pinned, group, order, "inner" if group == [key] else "left")
        rows = _cut(rows, pinned, group, order, "left")
        group = [key, CHUNK]
    return Chunked(rows, hot) if CHUNK in group else None


def any_hot(
    df: DataFrame, key: str, order: str, rows_per_chunk: int | None
) -> bool:
    if rows_per_chunk is None:
        return False
    return not _hot_groups(df, [key], order, rows_per_chunk).isEmpty()


def _cut(
    df: DataFrame, groups: DataFrame, names: list[str], order: str, how: str
) -> DataFrame:
    before = F.col(CHUNK) if CHUNK in names else F.lit(0).cast("bigint")
    span = (F.col("_hi") - F.col("_lo")).cast("double")
    share = (F.col(order) - F.col("_lo")).cast("double") / span
    piece = F.least(
        F.floor(share * F.col("_pieces")).cast("bigint"), F.col("_pieces") - 1
    )
    cut = before * F.lit(FAN_OUT) + F.coalesce(piece, F.lit(0).cast("bigint"))
    joined = join_pinned(df, groups, names, how).withColumn(CHUNK, cut)
    return joined.drop("_lo", "_hi", "_pieces")


def _hot_groups(
    df: DataFrame, group: list[str], order: str, limit: int
) -> DataFrame:
    pieces = F.least(
        F.ceil(F.col("_n") * F.lit(2) / F.lit(limit)).cast("bigint"),
        F.lit(FAN_OUT).cast("bigint"),
    )
    return (
        df.groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(order).alias("_lo"),
            F.max(order).alias("_hi"),
        )
        .where((F.col("_n") > limit) & (F.col("_hi") > F.col("_lo")))
        .select(*group, "_lo", "_hi", pieces.alias("_pieces"))
    )


def chunk_window(key: str):
    """The chunks of a key in arrival order; one row per chunk."""
    return Window.partitionBy(key).orderBy(CHUNK)


def max_before(
    df: DataFrame,
    key: str,
    order: str,
    value: Column,
    name: str,
    chunked: Chunked | None,
) -> DataFrame:
    """Adds the largest ``value`` among earlier rows of the key.

    Chunked rows are windowed per chunk, and the maxima of the earlier chunks
    are joined in.
    """
    if chunked is None:
        whole = Window.partitionBy(key).orderBy(order)
        earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.max(value).over(earlier))
    carry = pin(carried_max(chunked.hot, key, value, "_carry"))
    local = Window.partitionBy(key, CHUNK).orderBy(order)
    local = local.rowsBetween(Window.unboundedPreceding, -1)
    return (
        join_pinned(chunked.rows, carry, [key, CHUNK], "left")
        .withColumn(name, F.greatest(F.max(value).over(local), F.col("_carry")))
        .drop("_carry")
    )


def carried_max(hot: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """One row per (key, chunk): the largest ``value`` in the chunks before it."""
    before = chunk_window(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        hot.groupBy(key, CHUNK)
        .agg(F.max(value).alias("_top"))
        .select(key, CHUNK, F.max("_top").over(before).alias(name))
    )
