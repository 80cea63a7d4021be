"""Streams that go on from stored states, and what their states hold."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import (
    advance_series,
    newest_state,
    state_metrics,
    state_series,
)
from tidemark.operators.runs import with_literal_count
from tidemark.operators.summaries import merge_summaries, run_summary
from tidemark.plans import oracle as sql
from tidemark.plans import tables
from tidemark.plans.queries import RECORD, drained, event_stream
from tidemark.plans.product import flat_result
from tidemark.plans.tables import EVENT_SPEC, observations
from tidemark.schema import METRIC_NAMES
from tidemark.session import shared_dir
from tidemark.sources.results import write_updates
from tidemark.streaming.fanout import RunSpec, fan_out, newest_results
from tidemark.streaming.updates import (
    newest_updates,
    ordered_run_updates,
    product_states,
    product_updates,
    run_updates,
    with_records,
)

_RUNS = RunSpec("pid", "obs_date", "arrival", "count")


def _arrived() -> Column:
    return F.col("arrival_time")


def _replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(tables.read_events(spark, sf_dir)).drop("event_type")


def _slices(rows: DataFrame, count: int) -> list[Column]:
    """Tests that cut rows into parts that arrive one after another."""
    low, high = rows.agg(F.min("arrival"), F.max("arrival")).first()
    low, high = low or 0, high or 0
    cuts = [low + (high - low) * i // count for i in range(1, count)]
    place = sum(((F.col("arrival") > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return [place == i for i in range(count)]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _flat(result: DataFrame, *others: str) -> DataFrame:
    metrics = [F.col("metrics")[n].alias(n) for n in METRIC_NAMES]
    return result.select("pid", "valid", *metrics, *others)


# -- states in files --------------------------------------------------------------


def daily_series_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three slices of events, each read once, move the stored series on."""
    rows = _replay(spark, sf_dir)
    folder = _folder(spark, "series")
    state = None
    for number, test in enumerate(_slices(rows, 3)):
        moved = advance_series(state, rows.where(test), EVENT_SPEC, _arrived())
        moved.write.parquet(f"{folder}/version={number}")
        state = newest_state(spark.read.parquet(folder), "pid")
    return state_series(state, EVENT_SPEC)


def _slice_streams(spark: SparkSession, sf_dir: str, folder: str, count: int) -> Iterator[DataFrame]:
    """The events as a stream of ``count`` micro-batches in order of arrival.

    A stream is to be drained before the next is asked for: it finds one slice more, of
    as many files as there are cores, all of which are one micro-batch.
    """
    rows = observations(tables.read_events(spark, sf_dir))
    files = spark.sparkContext.defaultParallelism
    for number, test in enumerate(_slices(rows, count)):
        rows.where(test).repartition(files, "event_id", "arrival_time").write.parquet(f"{folder}/in/slice={number}")
        yield spark.readStream.schema(rows.schema).parquet(f"{folder}/in/slice=*")


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product metrics and run counts from one read of the source."""
    root = _folder(spark, "fan-out")
    read = 0
    for stream in _slice_streams(spark, sf_dir, root, 3):
        query = fan_out(with_literal_count(stream), root, EVENT_SPEC, _RUNS, _arrived(), interval=None)
        query.awaitTermination()
        read += sum(p.numInputRows for p in query.recentProgress)
    products = _flat(newest_results(spark, f"{root}/product", "pid"))
    runs = newest_results(spark, f"{root}/run", "pid")
    return products.join(runs, "pid").withColumn("input_rows", F.lit(read).cast("bigint"))


# -- streams that start from a history ----------------------------------------------


def stream_after_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch builds the state of the first part, the stream goes on with the rest."""
    past, rest = _slices(_replay(spark, sf_dir), 2)
    history = with_literal_count(_replay(spark, sf_dir)).where(past)
    state = advance_series(None, history, EVENT_SPEC, _arrived())
    folder = _folder(spark, "history")
    state.write.parquet(f"{folder}/series")
    state = spark.read.schema(state.schema).parquet(f"{folder}/series")
    parts = run_summary(history, "pid", "obs_date", "arrival", "count")
    runs = merge_summaries(parts, "pid")
    runs.write.parquet(f"{folder}/runs")
    runs = spark.read.schema(runs.schema).parquet(f"{folder}/runs")

    live = with_literal_count(observations(event_stream(spark, sf_dir))).where(rest)
    updates = product_updates(
        live, EVENT_SPEC, _arrived(), ["event_id"], coalesce_updates=True, initial=state
    )
    changed = newest_updates(drained(spark, updates, "after-history"), "pid", "arrival")
    before = state_metrics(state, EVENT_SPEC)
    products = _newer(changed.select("pid", "valid", "metrics"), before)

    counted = run_updates(live, "pid", "obs_date", "arrival", "count", initial=runs)
    counted = newest_updates(drained(spark, counted, "runs-after-history"), "pid", "arrival")
    counted = counted.select("pid", F.col("date").alias("obs_date"), "run_count")
    known = runs.select(
        "pid", F.col("tail_date").alias("obs_date"), F.col("tail_count").alias("run_count")
    )
    return _flat(products).join(_newer(counted, known), "pid")


def _newer(changed: DataFrame, before: DataFrame) -> DataFrame:
    """What a stream has changed, and the rest as it was."""
    rest = before.join(changed.select("pid"), "pid", "left_anti")
    return changed.unionByName(rest)


# -- other ways through a micro-batch ----------------------------------------------


def stream_ordered_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hot keys, whose rows are put in order in the state store."""
    rows = with_literal_count(observations(event_stream(spark, sf_dir)))
    updates = ordered_run_updates(rows, "event_type", "obs_date", "arrival", "count", held_rows=256)
    newest = newest_updates(drained(spark, updates, "ordered"), "event_type", "arrival")
    return newest.select("event_type", F.col("date").alias("obs_date"), "run_count")


def stream_product_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States move on by columns; the record is joined to the update that stays."""
    rows = observations(event_stream(spark, sf_dir))
    states = product_states(rows, EVENT_SPEC, _arrived())
    newest = newest_updates(drained(spark, states, "columnar"), "pid", "arrival")
    result = with_records(newest, _replay(spark, sf_dir), EVENT_SPEC)
    return flat_result(result, RECORD)


# -- states of streams ----------------------------------------------------------------


def _state_of(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """A stream's keyed state, read from its checkpoint: key and value columns."""
    reader = spark.read.format("statestore").option("stateVarName", variable)
    held = reader.load(checkpoint)
    # A state that expires stands next to the time at which it does.
    value = "value.value" if "ttlExpirationMs" in held.schema["value"].dataType.names else "value"
    return held.select("key.*", f"{value}.*")


def _last_of(state: DataFrame) -> DataFrame:
    return state.select(
        F.col("key").alias("pid"),
        "valid",
        "last_day",
        *[F.size(n).cast("bigint").alias(f"{n}_days") for n in ("level", "price", "counter")],
        F.try_element_at("level", F.lit(-1)).alias("sold_c"),
    )


def stream_state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the product stream holds of every key when it has read everything."""
    root = _folder(spark, "snapshot")
    rows = observations(event_stream(spark, sf_dir))
    updates = product_updates(rows, EVENT_SPEC, _arrived(), ["event_id"], coalesce_updates=True)
    write_updates(updates, "parquet", f"{root}/out", f"{root}/checkpoint", interval=None).awaitTermination()
    operators = spark.read.format("state-metadata").load(f"{root}/checkpoint")
    stateful = operators.agg(F.count_distinct("operatorId").alias("operators"))
    held = _last_of(_state_of(spark, f"{root}/checkpoint", "series"))
    return held.withColumn("operators", F.lit(stateful.first()["operators"]))


def stream_state_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys without an event for the time to live are forgotten: the run stream reads
    the odd keys, rests, reads the even ones, and holds those alone."""
    root = _folder(spark, "expired")
    rows = with_literal_count(observations(tables.read_events(spark, sf_dir)))
    for number, odd in enumerate((1, 0)):
        part = rows.where(F.col("pid") % 2 == odd)
        part.coalesce(1).write.parquet(f"{root}/in/part={number}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in/part=*")
        updates = run_updates(stream, "pid", "obs_date", "arrival", "count", True, ttl_seconds=2)
        query = write_updates(updates, "parquet", f"{root}/out", f"{root}/checkpoint", interval=None)
        query.awaitTermination()
        if odd:
            time.sleep(3)
    held = _state_of(spark, f"{root}/checkpoint", "run")
    return held.select(F.col("key").alias("pid"), F.col("date").alias("obs_date"), F.col("count").alias("run_count"))


QUERIES = {
    "daily_series_incremental": daily_series_incremental,
    "stream_fan_out": stream_fan_out,
    "stream_after_history": stream_after_history,
    "stream_ordered_buffer": stream_ordered_buffer,
    "stream_product_columnar": stream_product_columnar,
    "stream_state_snapshot": stream_state_snapshot,
    "stream_state_expired": stream_state_expired,
}

# -- SQL ---------------------------------------------------------------------------------

_SHOWN = ", ".join(f"CASE WHEN e.valid THEN m.{n} END AS {n}" for n in METRIC_NAMES)
_BOTH = (*sql.REPLAY, *sql.SERIES, sql.METRICS, sql.LAST_SEEN, sql.islands("pid"), f"runs AS ({sql.final('pid')})")
_JOINED = (
    f"FROM ends_of e LEFT JOIN metrics m USING (pid) JOIN runs r ON r.pid = e.pid"
)

ORACLE = {
    "daily_series_incremental": sql.with_(
        *sql.REPLAY,
        *sql.SERIES,
        then='SELECT pid, dday AS "day", age, sold_c, price_c, review_number FROM daily',
    ),
    "stream_fan_out": sql.with_(
        *_BOTH,
        then=f"SELECT e.pid, e.valid, {_SHOWN}, r.obs_date, r.run_count, "
        f"(SELECT count(*) FROM events) AS input_rows {_JOINED}",
    ),
    "stream_after_history": sql.with_(
        *_BOTH, then=f"SELECT e.pid, e.valid, {_SHOWN}, r.obs_date, r.run_count {_JOINED}"
    ),
    "stream_ordered_buffer": sql.ORACLE["run_count_by_type"],
    "stream_product_columnar": sql.ORACLE["stream_product_metrics"],
    "stream_state_snapshot": sql.with_(
        *sql.REPLAY,
        *sql.SERIES,
        sql.LAST_SEEN,
        """held AS (
  SELECT pid, max(dday) AS last_day, count(*) AS days, arg_max(sold_c, dday) AS sold_c
  FROM daily GROUP BY pid)""",
        then="SELECT e.pid, e.valid, h.last_day, coalesce(h.days, 0) AS level_days, "
        "coalesce(h.days, 0) AS price_days, coalesce(h.days, 0) AS counter_days, h.sold_c, "
        "1 AS operators FROM ends_of e LEFT JOIN held h USING (pid)",
    ),
    "stream_state_expired": sql.with_(
        sql.obs(), sql.islands("pid"), then=f"SELECT * FROM ({sql.final('pid')}) WHERE pid % 2 = 0"
    ),
}
