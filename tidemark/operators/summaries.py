"""Runs from mergeable summaries.

A stretch of a key's events in arrival order is summed up by its first date, its last
date, how many events the run at its end counts and whether that run is all of the
stretch. Two summaries of stretches that follow each other merge into one, and the
merge is associative, so stretches can be cut anywhere, summed up in any task and
merged in any grouping, today's with what was stored yesterday included.

Rows are dealt by ranges of (key, order), so a hot key is as many stretches as it
has tasks; one streaming pass per task sums up sorted rows in constant memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.workers import run_summaries

SUMMARY = ["first_date", "tail_date", "tail_count", "whole"]


def run_summary(df: DataFrame, key: str, date: str, order: str, count: str) -> DataFrame:
    """(key, last_order, ``SUMMARY``): a row for each stretch of a key.

    Stretches of a key do not overlap; ``last_order`` puts them in order.
    """
    rows = df.select(key, F.col(order).alias("_order"), F.col(date).alias("_date"), F.col(count).cast("bigint").alias("_count"))
    ordered = rows.repartitionByRange(key, "_order").sortWithinPartitions(key, "_order")
    schema = T.StructType(
        [
            rows.schema[key],
            T.StructField("last_order", rows.schema["_order"].dataType),
            T.StructField(SUMMARY[0], rows.schema["_date"].dataType),
            T.StructField(SUMMARY[1], rows.schema["_date"].dataType),
            T.StructField(SUMMARY[2], T.LongType()),
            T.StructField(SUMMARY[3], T.BooleanType()),
        ]
    )
    return ordered.mapInArrow(run_summaries(key), schema)


def merged(earlier: Column, later: Column) -> Column:
    """The summary of two stretches that follow each other."""
    goes_on = later.whole & later.first_date.eqNullSafe(earlier.tail_date)
    carried = F.when(goes_on, earlier.tail_count).otherwise(F.lit(0).cast("bigint"))
    return F.struct(
        earlier.first_date.alias(SUMMARY[0]),
        later.tail_date.alias(SUMMARY[1]),
        (later.tail_count + carried).alias(SUMMARY[2]),
        (goes_on & earlier.whole).alias(SUMMARY[3]),
    )


def merge_summaries(summaries: DataFrame, key: str) -> DataFrame:
    """One summary for each key; it has as many stretches as tasks and stored parts."""
    part = F.struct("last_order", *SUMMARY)
    parts = summaries.groupBy(key).agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    bare = F.transform("_parts", lambda p: F.struct(*[p[n].alias(n) for n in SUMMARY]))
    whole = F.aggregate(
        F.slice(bare, F.lit(2), F.size("_parts")), F.element_at(bare, 1), merged
    )
    newest = F.element_at("_parts", -1)["last_order"].alias("last_order")
    return parts.select(key, newest, whole.alias("_all")).select(
        key, "last_order", *[F.col(f"_all.{n}").alias(n) for n in SUMMARY]
    )


def summarised_count(df: DataFrame, key: str, date: str, order: str, count: str) -> DataFrame:
    """The open run of every key, as ``runs.final_count`` has it, from summaries."""
    whole = merge_summaries(run_summary(df, key, date, order, count), key)
    return whole.select(
        key, F.col("tail_date").alias(date), F.col("tail_count").alias("run_count")
    )
