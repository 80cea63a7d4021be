"""One read of the source for both results.

Two streams read and decode a source twice. Here one ``foreachBatch`` query persists
each decoded micro-batch once and moves two keyed states on: the daily series and the
runs. Both are versions in files: batch ``n`` reads versions below ``n`` and overwrites
version ``n``, as it does with the results, so a batch that is retried after a failure
gives the same files. Every ``FULL_EVERY``th version holds all keys, the others those
of their batch, so a batch reads a bounded number of versions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.incremental import advance_series, newest_state, state_metrics
from tidemark.operators.summaries import merge_summaries, run_summary
from tidemark.schema import SeriesSpec

FULL_EVERY = 20


@dataclass(frozen=True)
class RunSpec:
    """The columns a run count uses."""

    key: str
    date: str
    order: str
    count: str


class Versions:
    """A keyed state as versions under a folder."""

    def __init__(self, folder: str, key: str):
        self.folder, self.key = folder, key

    def before(self, spark, number: int) -> DataFrame | None:
        """The state of every key after version ``number - 1``; None if there is none."""
        if number == 0:
            return None
        base = (number - 1) // FULL_EVERY * FULL_EVERY
        paths = [f"{self.folder}/version={n}" for n in range(base, number)]
        rows = spark.read.option("basePath", self.folder).parquet(*paths)
        return newest_state(rows, self.key)

    def write(self, number: int, touched: DataFrame, before: DataFrame | None) -> DataFrame:
        """Writes the touched keys, or all of them; returns the touched keys as written."""
        path = f"{self.folder}/version={number}"
        rows = touched.withColumn("_touched", F.lit(True))
        if number % FULL_EVERY == 0 and before is not None:
            rows = before.drop("_touched").withColumns({"_touched": F.lit(False), "version": F.lit(0)}).unionByName(
                rows.withColumn("version", F.lit(1))
            )
            rows = newest_state(rows, self.key)
        rows.write.mode("overwrite").parquet(path)
        written = touched.sparkSession.read.schema(rows.schema).parquet(path)
        return written.where("_touched").drop("_touched")


def fan_out(
    events: DataFrame,
    root: str,
    spec: SeriesSpec,
    runs: RunSpec,
    as_of: Column | None = None,
    on_reject: str = "null",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Starts the query. Results go to ``root``/product and ``root``/run, a folder
    for each micro-batch with a row for each key of the batch."""
    writer = events.writeStream.option("checkpointLocation", f"{root}/checkpoint")
    writer = writer.foreachBatch(both_results(root, spec, runs, as_of, on_reject))
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def both_results(
    root: str, spec: SeriesSpec, runs: RunSpec, as_of: Column | None, on_reject: str
) -> Callable[[DataFrame, int], None]:
    series_state = Versions(f"{root}/series-state", spec.key)
    run_state = Versions(f"{root}/run-state", runs.key)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            before = series_state.before(spark, number)
            known = None if before is None else before.drop("_touched")
            touched = series_state.write(number, advance_series(known, batch, spec, as_of), before)
            result = state_metrics(touched, spec, on_reject)
            result.write.mode("overwrite").parquet(f"{root}/product/batch_id={number}")

            before = run_state.before(spark, number)
            parts = merge_summaries(run_summary(batch, runs.key, runs.date, runs.order, runs.count), runs.key)
            merged = parts
            if before is not None:
                keys = parts.select(F.col(runs.key).alias("_k"))
                stored = before.drop("_touched")
                stored = stored.join(keys, stored[runs.key].eqNullSafe(keys["_k"]), "left_semi")
                merged = merge_summaries(parts.unionByName(stored), runs.key)
            touched = run_state.write(number, merged, before)
            result = touched.select(
                runs.key, F.col("tail_date").alias(runs.date), F.col("tail_count").alias("run_count")
            )
            result.write.mode("overwrite").parquet(f"{root}/run/batch_id={number}")
        finally:
            batch.unpersist()

    return write


def newest_results(spark, folder: str, key: str) -> DataFrame:
    """The last result of every key under ``root``/product or ``root``/run."""
    return newest_state(spark.read.parquet(folder), key, "batch_id")
