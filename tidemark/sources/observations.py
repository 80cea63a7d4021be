"""Where observations come from: Kafka, JSON lines or Parquet, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import pack_order
from tidemark.schema import OBSERVATION_SCHEMA
from tidemark.sources.decode import decode_json

# Columns every observation carries besides its declared ones.
ENVELOPE = T.StructType(
    [
        T.StructField("arrival", T.LongType()),
        T.StructField("arrival_time", T.LongType()),
    ]
)


def read_observations(
    spark: SparkSession,
    source: str,
    fmt: str,
    streaming: bool = False,
    options: dict[str, str] | None = None,
    schema: T.StructType = OBSERVATION_SCHEMA,
    flags: str = "lenient",
    keyed: bool = False,
) -> DataFrame:
    """Typed observations with ``arrival`` and ``arrival_time``.

    ``source`` is a topic for ``fmt="kafka"`` and a path for ``"json"`` (one
    document per line) and ``"parquet"``; files carry the two arrival columns
    themselves. ``options`` go to the reader: ``kafka.bootstrap.servers``,
    ``startingOffsets``, ``maxOffsetsPerTrigger``, ``maxFilesPerTrigger`` and
    the like. A restarted stream resumes from its own checkpoint; offsets
    committed by a consumer group are not read.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**(options or {}))
    if fmt == "kafka":
        raw = reader.format("kafka").option("subscribe", source).load()
        return from_kafka(raw, schema, flags, keyed)
    if fmt == "json":
        lines = reader.format("text").load(source)
        full = T.StructType(schema.fields + ENVELOPE.fields)
        return decode_json(lines, "value", full, flags)
    if fmt == "parquet":
        full = T.StructType(schema.fields + ENVELOPE.fields)
        return reader.schema(full).parquet(source)
    raise ValueError("fmt must be 'kafka', 'json' or 'parquet'")


def from_kafka(
    raw: DataFrame,
    schema: T.StructType = OBSERVATION_SCHEMA,
    flags: str = "lenient",
    keyed: bool = False,
) -> DataFrame:
    """Decodes rows with Kafka's columns (value, timestamp, partition, offset).

    Messages sent with the grouping key as message key keep a key in one
    partition, so the offset alone is its arrival order (``keyed=True``).
    Otherwise the order is message time, partition, offset.
    """
    stamped = raw.select(
        "value",
        kafka_order(keyed).alias("arrival"),
        F.unix_seconds("timestamp").alias("arrival_time"),
    )
    return decode_json(stamped, "value", schema, flags, ["arrival", "arrival_time"])


def kafka_order(keyed: bool) -> Column:
    if keyed:
        return F.col("offset")
    return pack_order(
        (F.unix_millis("timestamp"), 14), (F.col("partition"), 6), (F.col("offset"), 18)
    )


def register_tables(spark: SparkSession, tables: dict[str, DataFrame | str]) -> None:
    """Makes tables available by name: DataFrames as views, texts as DDL."""
    for name, table in tables.items():
        if isinstance(table, str):
            spark.sql(table)
        else:
            table.createOrReplaceTempView(name)


def lookup(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
