"""Rows that must not reach the folds, with the reason why."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.decode import CORRUPT

REASON = "reason"
PRODUCT_TIMES = ("timestamp", "update_time")
PRODUCT_MEASURES = ("sold", "price", "review_number")
RUN_TIMES = ("update_time",)


#: Epoch seconds the declared INT times can hold.
TIME_RANGE = (-(2**31), 2**31 - 1)
#: Measures whose nine-decimal minor units fit a BIGINT.
MEASURE_LIMIT = 9.2e9
ORDER, CLOCK = "arrival", "arrival_time"


def with_reason(
    df: DataFrame, times: tuple[str, ...], measures: tuple[str, ...] = ()
) -> DataFrame:
    """Adds ``reason``, NULL when valid.

    In this order: malformed, null_order and null_clock (the arrival columns,
    where the input has them), null_time, bad_time (epoch seconds outside INT),
    null_measure, bad_measure (not a number, or too large for exact units).
    """
    reason = F.when(F.lit(False), F.lit(""))
    if CORRUPT in df.columns:
        reason = reason.when(F.col(CORRUPT).isNotNull(), "malformed")
    for name, fault in ((ORDER, "null_order"), (CLOCK, "null_clock")):
        if name in df.columns:
            reason = reason.when(F.col(name).isNull(), fault)
    reason = reason.when(_any_null(times), "null_time")
    reason = reason.when(_any(df, times, _bad_time), "bad_time")
    if measures:
        reason = reason.when(_any_null(measures), "null_measure")
        reason = reason.when(_any(df, measures, _bad_measure), "bad_measure")
    return df.withColumn(REASON, reason)


def _bad_time(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.IntegralType):
        return F.lit(False)
    return ~value.between(*TIME_RANGE)


def _bad_measure(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.NumericType):
        return F.lit(False)
    number = value.cast("double")
    return F.isnan(number) | (F.abs(number) >= MEASURE_LIMIT)


def _any(
    df: DataFrame, names: tuple[str, ...], test: Callable[[Column, T.DataType], Column]
) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | test(F.col(name), df.schema[name].dataType)
    return found


def split_valid(
    df: DataFrame,
    times: tuple[str, ...] = PRODUCT_TIMES,
    measures: tuple[str, ...] = PRODUCT_MEASURES,
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with ``reason``); checked before any shuffle."""
    judged = with_reason(df, times, measures)
    valid = judged.where(F.col(REASON).isNull()).drop(REASON, CORRUPT)
    return valid, judged.where(F.col(REASON).isNotNull())


def _any_null(names: tuple[str, ...]) -> Column:
    test = F.lit(False)
    for name in names:
        test = test | F.col(name).isNull()
    return test
