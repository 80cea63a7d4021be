"""Result rows to JSON and out to Kafka, files or a table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.documents import to_document

EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def encode_product(document: Column) -> Column:
    """``infos``: the result document as text, NULL where there is none."""
    return F.when(document.isNotNull(), to_document(document))


def encode_run(date: Column, count: Column) -> Column:
    return to_document(F.struct(date.alias("date"), count.alias("count")))


def encode_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON text ``value``. Members that already are JSON text
    stay text, so documents nest as strings."""
    return df.select(to_document(F.struct(*df.columns)).alias("value"))


def write_batch(df: DataFrame, fmt: str, target: str, options=None) -> None:
    """Writes result rows once: to a topic, or as files under a path."""
    writer = encode_rows(df).write.options(**(options or {}))
    if fmt == "kafka":
        writer.format("kafka").option("topic", target).save()
    else:
        writer.mode("overwrite").format("text").save(target)


def write_updates(
    updates: DataFrame,
    fmt: str,
    target: str,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = "30 seconds",
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Starts a query that writes new result values only, never retractions.

    ``fmt`` is 'kafka' (at least once), 'json' or 'parquet'. Files go to one
    folder per micro-batch, overwritten when a batch is retried, so they hold
    every update exactly once. ``interval=None`` drains the source and stops.
    """
    if fmt not in ("kafka", "json", "parquet"):
        raise ValueError("fmt must be 'kafka', 'json' or 'parquet'")
    rows = encode_rows(updates) if fmt == "kafka" else updates
    writer = rows.writeStream.outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    if fmt == "kafka":
        writer = writer.format("kafka").options(**(options or {}))
        writer = writer.option("topic", target)
    else:
        writer = writer.foreachBatch(batch_writer(fmt, target))
    if interval is not None:
        return writer.start()
    with _without_empty_batches(updates.sparkSession):
        return writer.start()


@contextmanager
def _without_empty_batches(spark: SparkSession):
    """For a query that drains its source: expiring state asks for one more
    empty batch for ever, so such a query would never end. A query copies the
    session's settings when it starts."""
    before = spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(EMPTY_BATCHES, "false")
    try:
        yield
    finally:
        spark.conf.set(EMPTY_BATCHES, before)


def batch_writer(fmt: str, target: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{target}/batch_id={batch_id}"
        if fmt == "json":
            encode_rows(batch).write.mode("overwrite").text(folder)
        else:
            batch.write.mode("overwrite").parquet(folder)

    return write
