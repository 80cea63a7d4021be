"""Named queries over the star-schema test tables, one per operator.

Each takes (spark, sf_dir), reads whole tables and returns a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import arrays, clock, documents, numeric
from tidemark.operators.admission import accepted_only, admit, drop_stale, late_only
from tidemark.operators.daily import daily_endpoints
from tidemark.operators.latest import latest_record, status_counts, validity
from tidemark.operators.metrics import (
    array_metrics,
    daily_arrays,
    metric_history,
    trailing_metrics,
)
from tidemark.operators.runs import final_count, running_count, with_literal_count
from tidemark.plans import tables
from tidemark.plans.product import (
    daily_series,
    flat_result,
    latest_accepted,
    product_metrics,
    product_result,
)
from tidemark.plans.tables import EVENT_SPEC, PART_SPEC, SNAPSHOT, observations
from tidemark.schema import METRIC_NAMES
from tidemark.session import shared_dir
from tidemark.sources.decode import decode_json
from tidemark.sources.observations import lookup, register_tables
from tidemark.sources.quality import with_reason
from tidemark.sources.results import encode_run, write_updates
from tidemark.streaming.updates import newest_updates, product_updates, run_updates

RECORD = ["event_id", "ts", "batch", "sold_c", "price_c", "review_number", "obs_date"]
_NARROW = ["pid", "ts", "batch", "arrival", *EVENT_SPEC.measures]
# Small chunks, so that the split path of the hot-key operators runs on test data.
TINY_CHUNK = 16


def _events(spark: SparkSession, sf_dir: str, batch: str = "general") -> DataFrame:
    return observations(tables.read_events(spark, sf_dir), batch)


def _fresh(spark: SparkSession, sf_dir: str, batch: str = "general") -> DataFrame:
    return observations(tables.fresh_events(spark, sf_dir), batch)


def _accepted(spark: SparkSession, sf_dir: str, batch: str, **how) -> DataFrame:
    """Accepted events of the snapshot, with the columns the series needs."""
    mode = "monotone" if batch == "monotone" else "fold"
    fresh = _fresh(spark, sf_dir, batch).select(*_NARROW, "event_id")
    return accepted_only(fresh, EVENT_SPEC, SNAPSHOT, mode, **how)


def _replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with general batches, each judged at its arrival time."""
    return _events(spark, sf_dir).drop("event_type")


def _arrived() -> Column:
    return F.col("arrival_time")


# -- projections and admission -------------------------------------------------


def project_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _events(spark, sf_dir).select("obs_date", "pid")
    return with_literal_count(columns, "count")


def drop_stale_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = drop_stale(_events(spark, sf_dir), EVENT_SPEC, SNAPSHOT)
    return fresh.select("pid", "event_id", "ts")


def admit_late_only(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    kept = late_only(_fresh(spark, sf_dir).select("pid", "event_id", "arrival", "ts"),
                     EVENT_SPEC, **how)
    return kept.select("pid", "event_id", "ts")


def admit_late_only_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admit_late_only(spark, sf_dir, rows_per_chunk=TINY_CHUNK)


def admit_general(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    accepted = _accepted(spark, sf_dir, "general", **how)
    return accepted.select("pid", "event_id", "ts", "batch")


def admit_general_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admit_general(spark, sf_dir, rows_per_chunk=TINY_CHUNK)


def admit_monotone(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    accepted = _accepted(spark, sf_dir, "monotone", **how)
    return accepted.select("pid", "event_id", "ts", "batch")


def admit_monotone_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admit_monotone(spark, sf_dir, rows_per_chunk=TINY_CHUNK)


def admit_monotone_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The general fold on monotone batches: same rows as the closed form."""
    rows = _fresh(spark, sf_dir, "monotone").select(
        "pid", "event_id", "arrival", "ts", "batch"
    )
    return accepted_only(rows, EVENT_SPEC).drop("arrival")


def _judged(spark: SparkSession, sf_dir: str, batch: str, mode: str) -> DataFrame:
    rows = _events(spark, sf_dir, batch).select(
        "pid", "event_id", "arrival", "ts", "batch"
    )
    return admit(rows, EVENT_SPEC, SNAPSHOT, mode)


def admission_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, "general", "fold").select("event_id", "status")


def admission_status_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _judged(spark, sf_dir, "monotone", "monotone")
    return judged.select("event_id", "status")


def admission_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(_judged(spark, sf_dir, "general", "fold"))


def validity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity(_judged(spark, sf_dir, "general", "fold"), EVENT_SPEC)


# -- latest record, daily series, metrics --------------------------------------


def latest_record_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fresh(spark, sf_dir).select("pid", "arrival", *RECORD)
    return latest_accepted(rows, EVENT_SPEC, SNAPSHOT).drop("arrival")


def latest_record_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fresh(spark, sf_dir, "monotone").select("pid", "arrival", *RECORD)
    accepted = accepted_only(rows, EVENT_SPEC, SNAPSHOT, "monotone")
    return latest_record(accepted, EVENT_SPEC).drop("arrival")


def daily_endpoints_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = daily_endpoints(_accepted(spark, sf_dir, "monotone"), EVENT_SPEC)
    return ends.drop("last_order")


def daily_series_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = daily_series(_accepted(spark, sf_dir, "monotone"), EVENT_SPEC)
    return series.select("pid", "day", "is_observed", "sold_c", "price_c")


def daily_series_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = daily_series(_accepted(spark, sf_dir, "general"), EVENT_SPEC)
    return series.select("pid", "day", "age", "review_number")


def product_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fresh(spark, sf_dir, "monotone")
    metrics = product_metrics(rows, EVENT_SPEC, SNAPSHOT, "monotone")
    return metrics.drop("last_order")


def product_metrics_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = product_metrics(_fresh(spark, sf_dir), EVENT_SPEC, SNAPSHOT)
    return metrics.drop("last_order")


def product_metrics_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fresh(spark, sf_dir)
    metrics = product_metrics(rows, EVENT_SPEC, SNAPSHOT, rows_per_chunk=TINY_CHUNK)
    return metrics.drop("last_order")


def product_metrics_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship through array functions, as the streams compute it."""
    series = daily_series(_accepted(spark, sf_dir, "monotone"), EVENT_SPEC)
    held = daily_arrays(series, EVENT_SPEC)
    columns = [F.col(n) for n in EVENT_SPEC.measures]
    return held.select("pid", *array_metrics(*columns, EVENT_SPEC))


def daily_metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _replay(spark, sf_dir)
    accepted = accepted_only(rows.select(*_NARROW, "arrival_time"), EVENT_SPEC, _arrived())
    return metric_history(daily_series(accepted, EVENT_SPEC), EVENT_SPEC)


def _result(spark: SparkSession, sf_dir: str, on_reject: str) -> DataFrame:
    rows = _replay(spark, sf_dir)
    result = product_result(rows, EVENT_SPEC, _arrived(), on_reject=on_reject)
    return flat_result(result, RECORD)


def lineitem_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = tables.part_history(spark, sf_dir)
    metrics = trailing_metrics(daily_series(history, PART_SPEC), PART_SPEC)
    return metrics.drop("last_order")


# -- runs ----------------------------------------------------------------------


def run_count_running(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    rows = with_literal_count(
        _events(spark, sf_dir).select("pid", "event_id", "arrival", "obs_date")
    )
    runs = running_count(rows, "pid", "obs_date", "arrival", "count", **how)
    return runs.select("pid", "event_id", "obs_date", "run_count")


def run_count_running_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_count_running(spark, sf_dir, rows_per_chunk=TINY_CHUNK)


def run_count_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_literal_count(_events(spark, sf_dir))
    return final_count(rows, "pid", "obs_date", "arrival", "count")


def run_count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_literal_count(_events(spark, sf_dir))
    return final_count(rows, "event_type", "obs_date", "arrival", "count")


def run_count_by_type_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hot keys, far above the chunk limit used here."""
    rows = with_literal_count(
        _events(spark, sf_dir).select("event_type", "event_id", "arrival", "obs_date")
    )
    runs = running_count(
        rows, "event_type", "obs_date", "arrival", "count", rows_per_chunk=500
    )
    return runs.select("event_type", "event_id", "run_count")


# -- quality, documents, scalar functions ---------------------------------------


def quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons on events with holes punched into measures and times."""
    events = tables.read_events(spark, sf_dir)
    holed = events.select(
        "event_id",
        F.when(F.col("event_id") % 101 != 0, F.col("ts")).alias("update_time"),
        F.nullif(F.col("event_id") % 97, F.lit(0)).alias("sold"),
        F.col("value").alias("price"),
    )
    judged = with_reason(holed, ("update_time",), ("sold", "price"))
    return judged.groupBy("reason").agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum")
    )


_DOCUMENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("seen", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("maybe", T.LongType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("flag", T.BooleanType()),
        T.StructField("loose_flag", T.BooleanType()),
    ]
)


def decode_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON texts, some broken, and decoded again."""
    events = tables.read_events(spark, sf_dir)
    even = F.col("event_id") % 2
    fields = F.struct(
        "event_id",
        clock.clock_text(F.col("ts")).alias("seen"),
        "event_type",
        "value",
        F.nullif(F.col("event_id") % 7, F.lit(0)).alias("maybe"),
        F.array("event_type", F.lit("x")).alias("tags"),
        even.alias("flag"),
        (even == 0).alias("loose_flag"),
    )
    whole = documents.to_document(fields)
    broken = F.when(F.col("event_id") % 53 == 0, F.lit("{broken")).otherwise(whole)
    rows = decode_json(events.select(broken.alias("value")), "value", _DOCUMENT)
    return rows.select(
        "event_id",
        clock.clock_text(F.col("seen")).alias("seen"),
        "event_type",
        "value",
        "maybe",
        F.concat_ws(",", "tags").alias("tags"),
        "flag",
        "loose_flag",
        F.col("_malformed").isNotNull().alias("malformed"),
    )


def decode_flags_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the word true is true: 1 becomes false."""
    events = tables.read_events(spark, sf_dir)
    fields = F.struct(
        "event_id",
        (F.col("event_id") % 2).alias("flag"),
        (F.col("event_id") % 3 == 0).alias("loose_flag"),
    )
    texts = events.select(documents.to_document(fields).alias("value"))
    rows = decode_json(texts, "value", _DOCUMENT, "legacy")
    return rows.select("event_id", "flag", "loose_flag")


def decode_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    events = tables.read_events(spark, sf_dir).select("event_id", "props")
    rows = decode_json(events, "props", schema, keep=["event_id"])
    return rows.select("event_id", "k")


def result_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested result document, encoded and decoded again."""
    rows = _replay(spark, sf_dir)
    result = product_result(rows, EVENT_SPEC, _arrived(), on_reject="keep_last")
    merged = documents.merge_structs(
        (F.col("metrics"), METRIC_NAMES), (F.col("latest"), RECORD)
    )
    sink = result.select(
        documents.to_document(
            F.struct("pid", documents.to_document(merged).alias("infos"))
        ).alias("value")
    )
    outer = T.StructType(
        [T.StructField("pid", T.LongType()), T.StructField("infos", T.StringType())]
    )
    inner = T.StructType(
        [
            result.schema[part].dataType[n]
            for part, names in (("metrics", METRIC_NAMES), ("latest", RECORD))
            for n in names
        ]
    )
    message = documents.from_document(F.col("value"), outer)
    opened = sink.select(message.alias("m")).select(
        F.col("m.pid").alias("pid"),
        documents.from_document(F.col("m.infos"), inner).alias("d"),
    )
    return opened.select("pid", "d.*")


def run_result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run results as {date, count} documents, decoded again."""
    runs = run_count_final(spark, sf_dir)
    sink = runs.select(
        "pid", encode_run(F.col("obs_date"), F.col("run_count")).alias("shop_agg")
    )
    schema = T.StructType(
        [T.StructField("date", T.StringType()), T.StructField("count", T.LongType())]
    )
    opened = documents.from_document(F.col("shop_agg"), schema)
    return sink.select("pid", opened.alias("d")).select(
        "pid", F.col("d.date").alias("obs_date"), F.col("d.count").alias("run_count")
    )


def clock_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.read_events(spark, sf_dir)
    epoch = clock.epoch_seconds(F.col("ts"))
    start = F.lit("2024-01-01").cast("date")
    return events.select(
        "event_id",
        epoch.alias("epoch"),
        clock.day_number(epoch).alias("day_number"),
        clock.local_date(epoch).cast("string").alias("local_date"),
        clock.iso_date(F.col("ts")).alias("iso_date"),
        clock.clock_text(F.col("ts")).alias("clock_text"),
        clock.days_between(start, clock.local_date(epoch)).alias("days"),
    )


def numeric_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.read_events(spark, sf_dir)
    cents = F.round(F.col("value") * 100).cast("bigint")
    signed = cents - F.lit(5000)
    divisor = F.col("event_id") % 9 + 2
    return events.select(
        "event_id",
        numeric.floor_div(signed, divisor).alias("floor_div"),
        numeric.half_up_div(signed, divisor).alias("half_up"),
        numeric.ratio6(signed, F.col("event_id") % 9).alias("ratio"),
        numeric.from_units(signed, 3).alias("two_places"),
        numeric.to_units(F.col("value"), 2).alias("units"),
    )


def array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each array function on the 30-day series of every key."""
    series = daily_series(_accepted(spark, sf_dir, "monotone"), EVENT_SPEC)
    return series_functions(daily_arrays(series, EVENT_SPEC))


def series_functions(held: DataFrame) -> DataFrame:
    sold, price = F.col("sold_c"), F.col("price_c")
    week = arrays.last_n(sold, 7)
    return held.select(
        "pid",
        arrays.from_end(sold, 2).alias("second"),
        arrays.array_sum(week).alias("week_sum"),
        arrays.sum_products(week, arrays.last_n(price, 7)).alias("week_product"),
        arrays.array_sum(arrays.replace_last(sold, F.lit(0).cast("bigint"))).alias(
            "without_last"
        ),
        arrays.array_sum(
            arrays.pad_left(week, arrays.from_end(sold, 1), 10)
        ).alias("padded_sum"),
        arrays.array_sum(arrays.prefix_sums(week)).alias("prefix_total"),
    )


def named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables registered by name, one from a DataFrame and one from DDL."""
    tag = uuid.uuid4().hex[:8]
    register_tables(
        spark,
        {
            f"observed_{tag}": _events(spark, sf_dir),
            f"raw_{tag}": f"CREATE OR REPLACE TEMPORARY VIEW raw_{tag} "
            f"USING parquet OPTIONS (path '{sf_dir}/events.parquet')",
        },
    )
    observed, raw = lookup(spark, f"observed_{tag}"), lookup(spark, f"raw_{tag}")
    per_key = observed.groupBy("pid").agg(F.count(F.lit(1)).alias("observed"))
    stored = raw.groupBy(F.col("user_id").alias("pid")).agg(
        F.count(F.lit(1)).alias("stored")
    )
    return per_key.join(stored, "pid")


# -- streams -------------------------------------------------------------------


def drained(
    spark: SparkSession, updates: DataFrame, name: str
) -> DataFrame:
    """Runs an update stream over everything there is and reads it back."""
    root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    query = write_updates(
        updates, "parquet", f"{root}/out", f"{root}/checkpoint", interval=None
    )
    query.awaitTermination()
    if not _status(spark, f"{root}/out"):
        return spark.createDataFrame([], updates.schema)
    return spark.read.schema(updates.schema).parquet(f"{root}/out/batch_id=*")


def _status(spark: SparkSession, path: str):
    """Spark's status of a file or folder, None if there is none."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(found) if system.exists(found) else None


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; a stream reads folders, so one file is
    picked from its parent."""
    stream = spark.readStream.schema(tables.EVENT_SCHEMA)
    stream = stream.option("maxFilesPerTrigger", "200")
    path = f"{sf_dir}/events.parquet"
    status = _status(spark, path)
    if status is not None and status.isDirectory():
        return stream.parquet(path)
    return stream.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def stream_run_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_literal_count(observations(event_stream(spark, sf_dir)))
    updates = run_updates(rows, "pid", "obs_date", "arrival", "count")
    written = drained(spark, updates, "run-count")
    newest = newest_updates(written, "pid", "arrival")
    return newest.select("pid", F.col("date").alias("obs_date"), "run_count")


def stream_run_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every update: one per event, with the run count after it."""
    rows = with_literal_count(observations(event_stream(spark, sf_dir)))
    updates = run_updates(rows, "pid", "obs_date", "arrival", "count")
    return drained(spark, updates, "run-updates").select("pid", "date", "run_count")


def stream_product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(event_stream(spark, sf_dir))
    updates = product_updates(
        rows, EVENT_SPEC, _arrived(), RECORD, coalesce_updates=True
    )
    newest = newest_updates(drained(spark, updates, "product"), "pid", "arrival")
    return flat_result(newest.drop("arrival"), RECORD)


def stream_update_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per accepted event, one per turn to rejection."""
    rows = observations(event_stream(spark, sf_dir))
    updates = product_updates(rows, EVENT_SPEC, _arrived(), ["event_id"])
    written = drained(spark, updates, "product-updates")
    return written.groupBy("pid", "valid").agg(F.count(F.lit(1)).alias("updates"))


def product_result_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result(spark, sf_dir, "null")


def product_result_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result(spark, sf_dir, "keep_last")


QUERIES = {
    "project_literal": project_literal,
    "drop_stale": drop_stale_query,
    "admit_late_only": admit_late_only,
    "admit_late_only_chunked": admit_late_only_chunked,
    "admit_general": admit_general,
    "admit_general_chunked": admit_general_chunked,
    "admit_monotone": admit_monotone,
    "admit_monotone_chunked": admit_monotone_chunked,
    "admit_monotone_by_fold": admit_monotone_by_fold,
    "admission_status": admission_status,
    "admission_status_monotone": admission_status_monotone,
    "admission_status_counts": admission_status_counts,
    "validity": validity_query,
    "latest_record": latest_record_query,
    "latest_record_monotone": latest_record_monotone,
    "daily_endpoints": daily_endpoints_query,
    "daily_series_fractional": daily_series_fractional,
    "daily_series_integer": daily_series_integer,
    "product_metrics": product_metrics_query,
    "product_metrics_general": product_metrics_general,
    "product_metrics_chunked": product_metrics_chunked,
    "product_metrics_arrays": product_metrics_arrays,
    "daily_metric_history": daily_metric_history,
    "product_result_typed": product_result_typed,
    "product_result_keep_last": product_result_keep_last,
    "lineitem_daily_series": lineitem_daily_series,
    "run_count_running": run_count_running,
    "run_count_running_chunked": run_count_running_chunked,
    "run_count_final": run_count_final,
    "run_count_by_type": run_count_by_type,
    "run_count_by_type_running": run_count_by_type_running,
    "quality_split": quality_split,
    "decode_observations": decode_observations,
    "decode_flags_legacy": decode_flags_legacy,
    "decode_props": decode_props,
    "result_json_roundtrip": result_json_roundtrip,
    "run_result_json": run_result_json,
    "clock_functions": clock_functions,
    "numeric_functions": numeric_functions,
    "array_functions": array_functions,
    "named_tables": named_tables,
    "stream_run_count": stream_run_count,
    "stream_run_updates": stream_run_updates,
    "stream_product_metrics": stream_product_metrics,
    "stream_update_counts": stream_update_counts,
}
