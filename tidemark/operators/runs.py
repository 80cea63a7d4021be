"""Length of the current run of consecutive events sharing one date.

Any change of date starts a new run, a late older date included, so this is
not a count per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.chunks import (
    CHUNK,
    ROWS_PER_CHUNK,
    assign_chunks,
    chunk_window,
    join_on,
    join_pinned,
)
from tidemark.session import pin


def with_literal_count(df: DataFrame, name: str = "count") -> DataFrame:
    return df.withColumn(name, F.lit(1))


def running_count(
    df: DataFrame,
    key: str,
    date: str,
    order: str,
    count: str,
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Every event with the run count after it, as ``run_count``."""
    cut = assign_chunks(df, key, order, rows_per_chunk)
    if cut is None:
        runs = _numbered_runs(df, [key], date, order, count)
        return runs.select(*df.columns, "run_count")

    group = [key, CHUNK]
    runs = _numbered_runs(cut.rows, group, date, order, count)
    hot = _numbered_runs(cut.hot, group, date, order, count)
    carried = pin(_carried_runs(hot, key, date, order))
    # Run 1 of a chunk goes on from the previous chunk if the date is the same.
    joined = join_pinned(runs, carried, group, "left")
    goes_on = (F.col("_run") == 1) & F.col(date).eqNullSafe(F.col("_prev_date"))
    extra = F.when(goes_on, F.coalesce("_prev_count", F.lit(0))).otherwise(F.lit(0))
    return joined.select(*df.columns, (F.col("run_count") + extra).alias("run_count"))


def _numbered_runs(
    df: DataFrame, group: list[str], date: str, order: str, count: str
) -> DataFrame:
    """Numbers the runs of each group from 1 (``_run``) and counts along them.

    The count is the group's running total less the total before the run, so
    every window has the same partitioning and order: one shuffle, one sort.
    """
    ordered = Window.partitionBy(*group).orderBy(order)
    flagged = df.withColumns(
        {"_new": _is_change(date, ordered), "_total": _so_far(count, ordered)}
    )
    before_run = F.when(F.col("_new") == 1, F.col("_total") - F.col(count))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return flagged.withColumns(
        {
            "_run": _so_far("_new", ordered),
            "run_count": F.col("_total")
            - F.last(before_run, ignorenulls=True).over(so_far),
        }
    )


def _is_change(date: str, ordered) -> Column:
    before = F.lag(date).over(ordered)
    return F.when(F.col(date).eqNullSafe(before), 0).otherwise(1)


def _so_far(name: str, ordered) -> Column:
    return F.sum(name).over(ordered.rowsBetween(Window.unboundedPreceding, 0))


def _carried_runs(runs: DataFrame, key: str, date: str, order: str) -> DataFrame:
    """(key, chunk, _prev_date, _prev_count): the run open before each chunk."""
    per_chunk = runs.groupBy(key, CHUNK).agg(
        F.min_by(date, order).alias("_first_date"),
        F.max_by(date, order).alias("_last_date"),
        F.max_by("run_count", order).alias("_tail"),
        F.max("_run").alias("_runs"),
    )
    by_chunk = chunk_window(key)
    # The open run after a chunk is its last run, plus what came before when
    # that run is also its first and goes on from the previous chunk.
    goes_on = (F.col("_runs") == 1) & F.col("_first_date").eqNullSafe(
        F.lag("_last_date").over(by_chunk)
    )
    broken = per_chunk.withColumn("_break", F.when(goes_on, 0).otherwise(1))
    spans = broken.withColumn("_span", _so_far("_break", by_chunk))
    in_span = Window.partitionBy(key, "_span").orderBy(CHUNK)
    opened = spans.withColumn("_open", _so_far("_tail", in_span))
    return opened.select(
        key,
        CHUNK,
        F.lag("_last_date").over(by_chunk).alias("_prev_date"),
        F.lag("_open").over(by_chunk).alias("_prev_count"),
    )


def final_count(
    df: DataFrame, key: str, date: str, order: str, count: str
) -> DataFrame:
    """The open run of every key: its date and ``run_count``.

    Rows are reduced to one per (key, date) to find the last date and what arrived
    before it; the run is what arrived on the last date after that. For this the
    narrow rows of each key's last date are met once more, by (key, date), so a hot
    key's last day is one task: ``summaries.summarised_count`` splits it.
    """
    per_date = df.groupBy(key, date).agg(F.max(order).alias("_seen"))
    by_key = Window.partitionBy(key).orderBy(F.col("_seen").desc())
    ranked = per_date.select(
        key,
        date,
        F.row_number().over(by_key).alias("_rank"),
        F.lead("_seen").over(by_key).alias("_cut"),
    )
    current = ranked.where(F.col("_rank") == 1).drop("_rank")
    after = F.col("_cut").isNull() | (F.col(order) > F.col("_cut"))
    rows = join_on(df.select(key, date, order, count), current, [key, date], "inner")
    return (
        rows.where(after).groupBy(key, date).agg(F.sum(count).alias("run_count"))
    )
