"""The trailing metrics straight from the observed days, no day made up.

Between two observed days a measure rises by equal steps, so what a frame sums over a
gap is an arithmetic progression, and of two measures' product a sum of squares:
closed forms of the first value, the step and the number of days inside the frame. A
key costs one row for each observed day in place of one for each calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import floor_div, int_div
from tidemark.operators.daily import fraction_step, linked_days
from tidemark.operators.metrics import FRAMES, LAGS, metric_columns, need_thirty
from tidemark.schema import SeriesSpec


class _Segment:
    """One row: the padding before a key's first day, a day, and the gap after it."""

    def __init__(self, spec: SeriesSpec):
        self.spec = spec
        wide = spec.scale > 2
        # Beyond two decimals products leave the BIGINT range.
        self.exact = "decimal(38,0)" if wide else "bigint"
        self.factor = "decimal(19,0)" if wide else "bigint"
        self.day, self.newest = F.col("day"), F.col("_last_day")
        self.gap = (F.coalesce(F.col("_next_day"), self.day + 1) - self.day).cast("bigint")

    def padding(self, days: int) -> Column:
        """Days of a frame that lie before the key's first day."""
        before = self.day - (self.newest - F.lit(days - 1))
        inside = F.greatest(before, F.lit(0)).cast("bigint")
        return F.when(F.col("_is_first"), inside).otherwise(F.lit(0).cast("bigint"))

    def run(self, days: int) -> tuple[Column, Column]:
        """The first step of the day and its gap that a frame holds, and how many."""
        behind = (self.newest - F.lit(days - 1) - self.day).cast("bigint")
        first = F.greatest(behind, F.lit(0).cast("bigint"))
        return first, F.greatest(self.gap - first, F.lit(0).cast("bigint"))

    def at(self, name: str, nth: Column) -> Column:
        return F.col(f"last_{name}") + nth * self.step(name)

    def step(self, name: str) -> Column:
        return F.col(f"_step_{name}")

    def steps(self) -> dict[str, Column]:
        """Worked out once for all frames; a key's newest day has no gap and so no step."""
        none = F.lit(0).cast("bigint")
        return {
            f"_step_{n}": F.coalesce(fraction_step(n, self.spec.scale), none)
            for n in self.spec.fractional
        }

    def total(self, name: str, days: int) -> Column:
        """The sum of a measure over the part of the segment that a frame holds."""
        first, count = self.run(days)
        pairs = int_div(count * (count - 1), F.lit(2).cast("bigint"))
        inside = count * self.at(name, first) + self.step(name) * pairs
        return self.padding(days) * F.col(f"first_{name}") + inside

    def product(self, left: str, right: str, days: int) -> Column:
        """The sum of two measures' products over the part that a frame holds."""
        first, count = self.run(days)
        pairs = int_div(count * (count - 1), F.lit(2).cast("bigint"))
        squares = int_div(count * (count - 1) * (count * 2 - 1), F.lit(6).cast("bigint"))

        def times(a: Column, b: Column) -> Column:
            return (a.cast(self.factor) * b.cast(self.factor)).cast(self.exact)

        def scaled(value: Column, by: Column) -> Column:
            return (value * by.cast(self.exact)).cast(self.exact)

        a, s = self.at(left, first), self.step(left)
        b, t = self.at(right, first), self.step(right)
        inside = (
            scaled(times(a, b), count)
            + scaled(times(a, t) + times(b, s), pairs)
            + scaled(times(s, t), squares)
        )
        ends = times(F.col(f"first_{left}"), F.col(f"first_{right}"))
        return (scaled(ends, self.padding(days)) + inside).cast(self.exact)

    def value(self, name: str, age: int, whole: bool = False) -> Column:
        """The measure ``age`` days back, NULL where the segment does not hold that day."""
        nth = (self.newest - F.lit(age) - self.day).cast("bigint")
        rise = F.col(f"_next_{name}") - F.col(f"last_{name}")
        gain = floor_div(rise * nth, self.gap) if whole else nth * self.step(name)
        inside = F.when(nth == 0, F.col(f"last_{name}")).when(
            (nth > 0) & (nth < self.gap), F.col(f"last_{name}") + gain
        )
        return F.when(F.col("_is_first") & (nth < 0), F.col(f"first_{name}")).otherwise(inside)


def closed_form_metrics(endpoints: DataFrame, spec: SeriesSpec) -> DataFrame:
    """``trailing_metrics`` of ``daily_endpoints``: same columns, same values."""
    need_thirty(spec)
    part = _Segment(spec)
    level, price, counter = spec.level, spec.price, spec.counter
    oldest = F.col("_last_day") - F.lit(spec.days - 1)
    reaching = F.col("_is_first") | (part.day + part.gap - 1 >= oldest)
    segments = linked_days(endpoints, spec).where(reaching).withColumns(part.steps())
    parts = segments.select(
        spec.key,
        "last_order",
        *[part.total(level, n).alias(f"_level_{n}") for n in FRAMES],
        *[part.product(level, price, n).alias(f"_product_{n}") for n in FRAMES],
        *[part.value(level, k - 1).alias(f"_lag_{k}") for k in (1, *LAGS)],
        part.value(counter, 0, True).alias("_counter_0"),
        part.value(counter, 29, True).alias("_counter_29"),
    )
    sums = parts.groupBy(spec.key).agg(
        *[F.sum(f"_level_{n}").alias(f"_level_{n}") for n in FRAMES],
        *[F.sum(f"_product_{n}").alias(f"_product_{n}") for n in FRAMES],
        *[F.max(f"_lag_{k}").alias(f"_lag_{k}") for k in (1, *LAGS)],
        F.max("_counter_0").alias("_counter_0"),
        F.max("_counter_29").alias("_counter_29"),
        F.max("last_order").alias("last_order"),
    )
    return sums.select(spec.key, "last_order", *metric_columns(spec, F.col))
