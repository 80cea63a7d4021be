"""From accepted events to a gap-free daily series.

One row per (key, day) throughout. Every step after ``daily_endpoints`` works
on at most one row per key and observed day, on the partitioning of the first
window, so the whole series costs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import day_number
from tidemark.functions.numeric import (
    decimal_units,
    floor_div,
    half_up_div,
    to_units,
)
from tidemark.schema import SeriesSpec


def measure_kinds(df: DataFrame, names: list[str]) -> tuple[list[str], list[str]]:
    """(fractional, integral) measures, told apart by column type."""
    whole = [n for n in names if isinstance(df.schema[n].dataType, T.IntegralType)]
    return [n for n in names if n not in whole], whole


def in_units(df: DataFrame, names: list[str], scale: int) -> DataFrame:
    """Fractional measures as BIGINT minor units, counts as BIGINT."""
    fractional, integral = measure_kinds(df, names)
    columns = {n: _units(df, n, scale) for n in fractional}
    columns |= {n: F.col(n).cast("bigint") for n in integral}
    return df.withColumns(columns)


def _units(df: DataFrame, name: str, scale: int) -> Column:
    exact = isinstance(df.schema[name].dataType, T.DecimalType)
    convert = decimal_units if exact else to_units
    return convert(F.col(name), scale)


def daily_endpoints(
    accepted: DataFrame, spec: SeriesSpec, day: Column | None = None
) -> DataFrame:
    """First and last accepted value of every measure per (key, day).

    Both are needed: a gap runs from the last value of one day to the *first*
    value of the next observed day. ``last_order`` is the newest arrival of the
    day. All aggregates are primitive, so this is a hash aggregation with
    map-side combining, whatever the skew of the keys.
    """
    slot = day_number(F.col(spec.ts)) if day is None else day
    ends = [F.max(spec.order).alias("last_order")]
    for name in spec.measures:
        ends.append(F.min_by(name, spec.order).alias(f"first_{name}"))
        ends.append(F.max_by(name, spec.order).alias(f"last_{name}"))
    return accepted.withColumn("day", slot).groupBy(spec.key, "day").agg(*ends)


def linked_days(endpoints: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Every observed day of a key with the next one and what it starts with."""
    by_day = Window.partitionBy(spec.key).orderBy("day")
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return endpoints.select(
        spec.key,
        "day",
        *[f"first_{n}" for n in spec.measures],
        *[f"last_{n}" for n in spec.measures],
        F.lead("day").over(by_day).alias("_next_day"),
        *[F.lead(f"first_{n}").over(by_day).alias(f"_next_{n}") for n in spec.measures],
        (F.row_number().over(by_day) == 1).alias("_is_first"),
        F.last("day").over(whole).alias("_last_day"),
        F.last("last_order").over(whole).alias("last_order"),
    )


def fill_daily(endpoints: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The newest ``spec.days`` daily values of every key.

    ``age`` counts days back from the key's last accepted day (0 is newest).
    Days before the first observed one repeat its first value; days in a gap
    are interpolated; ``is_observed`` tells which days were seen and
    ``last_order`` is the arrival of the key's last accepted event.
    """
    linked = linked_days(endpoints, spec)
    oldest = F.col("_last_day") - F.lit(spec.days - 1)
    start = F.when(F.col("_is_first"), oldest).otherwise(
        F.greatest(F.col("day"), oldest)
    )
    end = F.coalesce(F.col("_next_day") - 1, F.col("day"))
    # Clipped to the horizon first, so a row yields at most ``days`` slots.
    reaching = linked.where(end >= oldest)
    slots = reaching.withColumn("_slot", F.explode(F.sequence(start, end))).where(
        F.col("_slot") >= F.col("_last_day") - F.lit(spec.days - 1)
    )

    return slots.select(
        spec.key,
        F.col("_slot").alias("day"),
        (F.col("_last_day") - F.col("_slot")).alias("age"),
        (F.col("_slot") == F.col("day")).alias("is_observed"),
        "last_order",
        *[_slot_value(n, _nth() * fraction_step(n, spec.scale)).alias(n) for n in spec.fractional],
        *[_slot_value(n, _count_step(n)).alias(n) for n in spec.integral],
    )


def _slot_value(name: str, gain: Column) -> Column:
    last = F.col(f"last_{name}")
    return (
        F.when(F.col("_slot") < F.col("day"), F.col(f"first_{name}"))
        .when(F.col("_slot") == F.col("day"), last)
        .otherwise(last + gain)
    )


def _nth() -> Column:
    return (F.col("_slot") - F.col("day")).cast("bigint")


def fraction_step(name: str, scale: int) -> Column:
    """The equal step of a gap, rounded to two decimals."""
    days = (F.col("_next_day") - F.col("day")).cast("bigint")
    rise = F.col(f"_next_{name}") - F.col(f"last_{name}")
    cent = 10 ** max(scale - 2, 0)
    return half_up_div(rise, days * F.lit(cent).cast("bigint")) * F.lit(cent)


def _count_step(name: str) -> Column:
    """Whole steps spread evenly: each is the floor or one more."""
    days = (F.col("_next_day") - F.col("day")).cast("bigint")
    rise = F.col(f"_next_{name}") - F.col(f"last_{name}")
    return floor_div(rise * _nth(), days)
