"""Observation views over the star-schema test tables.

``events`` plays the product feed: users are products, values are levels in
cents, and a bounded shuffle of the ids gives arrival order with real late
data. ``lineitem`` plays a long history per part.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import epoch_seconds, iso_date, pack_order
from tidemark.functions.numeric import floor_div, int_div, to_units
from tidemark.schema import STALE_AFTER_SECONDS, SeriesSpec

# 2024-01-31T00:00:00Z, one day after the newest event.
SNAPSHOT = 1706659200

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

EVENT_SPEC = SeriesSpec(
    key="pid",
    ts="ts",
    batch="batch",
    order="arrival",
    level="sold_c",
    price="price_c",
    counter="review_number",
    scale=2,
)

PART_SPEC = EVENT_SPEC.with_(key="l_partkey")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def fresh_events(spark: SparkSession, sf_dir: str, as_of: int = SNAPSHOT) -> DataFrame:
    """Only events that are not stale at ``as_of``, tested on the stored column
    so that the bound reaches the Parquet scan."""
    bound = datetime.fromtimestamp(as_of - STALE_AFTER_SECONDS, timezone.utc)
    text = bound.strftime("%Y-%m-%d %H:%M:%S")
    return read_events(spark, sf_dir).where(
        F.col("ts") >= F.lit(text).cast("timestamp_ntz")
    )


def _shift() -> Column:
    return F.pmod(F.col("event_id") * 7919, F.lit(1009))


def arrival_order() -> Column:
    """Sorts like (event_id + shift, event_id), in one BIGINT."""
    return (F.col("event_id") + _shift()) * 1024 + (F.lit(1023) - _shift())


def arrival_time(ts: Column) -> Column:
    """A synthetic processing time, at most three days after the event."""
    return ts + _shift() * 260


def observations(
    events: DataFrame, batch: str = "general", also: list[Column] | None = None
) -> DataFrame:
    """``events`` as observations. ``batch`` is 'general' (ids return), 'monotone'
    (one batch per six hours) or 'mixed' (every third key general). ``also`` are more
    columns to keep."""
    ts = epoch_seconds(F.col("ts"))
    cents = to_units(F.col("value"), 2)
    ids = {
        "general": F.pmod(F.col("event_id") * 31, F.lit(5)) + 1,
        "monotone": floor_div(ts, F.lit(21600)),
    }
    third = F.col("user_id") % 3 == 0
    ids["mixed"] = F.when(third, ids["general"]).otherwise(ids["monotone"])
    return events.select(
        F.col("user_id").alias("pid"),
        "event_id",
        arrival_order().alias("arrival"),
        ts.alias("ts"),
        arrival_time(ts).alias("arrival_time"),
        ids[batch].cast("bigint").alias("batch"),
        cents.alias("sold_c"),
        (F.lit(10000) + int_div(cents, F.lit(7))).alias("price_c"),
        int_div(F.col("event_id"), F.lit(3)).alias("review_number"),
        iso_date(F.col("ts")).alias("obs_date"),
        "event_type",
        *(also or []),
    )


def part_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as the accepted daily history of each part.

    Lines of one part and date are ordered by order, line, quantity and price.
    (Order, line) repeats in the data, but lines equal in all four have equal
    measures, so the ends of a day are well defined.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    quantity = to_units(F.col("l_quantity"), 2)
    price = to_units(F.col("l_extendedprice"), 2)
    return lines.select(
        "l_partkey",
        epoch_seconds(F.col("l_shipdate")).alias("ts"),
        pack_order(
            (F.col("l_orderkey"), 15),
            (F.col("l_linenumber"), 4),
            (quantity, 7),
            (price, 12),
        ).alias("arrival"),
        quantity.alias("sold_c"),
        price.alias("price_c"),
        F.col("l_orderkey").alias("review_number"),
    )
