"""Trailing sums, products, lags and growth over the daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.arrays import array_sum, from_end, last_n, sum_products
from tidemark.functions.numeric import from_units, product_units, ratio6
from tidemark.schema import METRIC_NAMES, SeriesSpec

FRAMES = (1, 3, 7, 30)
LAGS = (2, 3, 4, 5, 6, 7)


def trailing_metrics(daily: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per key with the 16 metrics as of its last accepted day, and the
    arrival of its last accepted event (``last_order``)."""
    need_thirty(spec)
    age, level, price = F.col("age"), F.col(spec.level), F.col(spec.price)
    product = product_units(level, price, spec.scale)

    def newest(value: Column, days: int) -> Column:
        return F.sum(F.when(age < days, value))

    def at(value: Column, days_back: int) -> Column:
        return F.max(F.when(age == days_back, value))

    counter = F.col(spec.counter)
    sums = daily.groupBy(spec.key).agg(
        *[newest(level, n).alias(f"_level_{n}") for n in FRAMES],
        *[newest(product, n).alias(f"_product_{n}") for n in FRAMES],
        *[at(level, k - 1).alias(f"_lag_{k}") for k in (1, *LAGS)],
        at(counter, 0).alias("_counter_0"),
        at(counter, 29).alias("_counter_29"),
        F.max("last_order").alias("last_order"),
    )
    return sums.select(spec.key, "last_order", *metric_columns(spec, lambda name: F.col(name)))


def metric_history(daily: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The metrics for every day of the series, over the days it holds.

    Frames are short at the old end; lags that leave the series are NULL.
    """
    by_day = Window.partitionBy(spec.key).orderBy("day")
    level, price = F.col(spec.level), F.col(spec.price)
    product = product_units(level, price, spec.scale)

    def trailing(value: Column, days: int) -> Column:
        return F.sum(value).over(by_day.rowsBetween(-(days - 1), 0))

    framed = daily.select(
        spec.key,
        "day",
        "is_observed",
        *[trailing(level, n).alias(f"_level_{n}") for n in FRAMES],
        *[trailing(product, n).alias(f"_product_{n}") for n in FRAMES],
        level.alias("_lag_1"),
        *[F.lag(level, k - 1).over(by_day).alias(f"_lag_{k}") for k in LAGS],
        F.col(spec.counter).alias("_counter_0"),
        F.lag(spec.counter, 29).over(by_day).alias("_counter_29"),
    )
    return framed.select(
        spec.key, "day", "is_observed", *metric_columns(spec, lambda name: F.col(name))
    )


def array_metrics(level: Column, price: Column, counter: Column, spec: SeriesSpec):
    """The same 16 columns from arrays of minor units, oldest value first."""
    need_thirty(spec)
    kind = "bigint" if spec.scale <= 2 else "decimal(38,0)"

    def part(name: str) -> Column:
        _, what, n = name.split("_")
        if what == "level":
            return array_sum(last_n(level, int(n)))
        if what == "product":
            return sum_products(last_n(level, int(n)), last_n(price, int(n)), kind)
        if what == "lag":
            return from_end(level, int(n))
        return from_end(counter, int(n) + 1)

    return metric_columns(spec, part)


def daily_arrays(daily: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The series of a key as arrays, oldest value first (``days`` entries)."""
    slot = F.struct("day", *spec.measures)
    packed = daily.groupBy(spec.key).agg(
        F.array_sort(F.collect_list(slot)).alias("_series")
    )
    return packed.select(
        spec.key, *[F.col("_series").getField(n).alias(n) for n in spec.measures]
    )


def metric_columns(spec: SeriesSpec, part) -> list[Column]:
    columns = {
        "new_review_number_last_30": part("_counter_0") - part("_counter_29"),
        "sold_last_1_pop": ratio6(part("_lag_1") - part("_lag_2"), part("_lag_2")),
    }
    for n in FRAMES:
        columns[f"sold_last_{n}"] = from_units(part(f"_level_{n}"), spec.scale)
        columns[f"gmv_last_{n}"] = from_units(part(f"_product_{n}"), 2 * spec.scale)
    for k in LAGS:
        columns[f"sold_{k}_to_last"] = from_units(part(f"_lag_{k}"), spec.scale)
    return [columns[name].alias(name) for name in METRIC_NAMES]


def need_thirty(spec: SeriesSpec) -> None:
    if spec.days < max(FRAMES):
        raise ValueError("the 30-day metrics need a series of at least 30 days")
