"""Update streams: one row per changed result, in a form sinks can write.

Admission and the open series live in keyed state; metrics and documents are
column expressions on what the state emits. Both functions also take a batch
DataFrame, which replays it as one micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import day_number
from tidemark.functions.documents import from_document, to_document
from tidemark.operators.admission import is_stale
from tidemark.operators.chunks import BROADCAST_ROWS
from tidemark.operators.metrics import array_metrics
from tidemark.operators.sieve import matching
from tidemark.schema import SeriesSpec
from tidemark.session import pin, use_rocksdb_state
from tidemark.streaming.processors import (
    ColumnarProducts,
    OrderedRunProcessor,
    ProductProcessor,
    RunProcessor,
    run_output,
    series_output,
    state_output,
)


def product_updates(
    events: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None,
    payload: list[str],
    on_reject: str = "null",
    coalesce_updates: bool = False,
    ttl_seconds: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """(key, order, valid, metrics, latest) per changed product result.

    ``initial`` is a state that ``operators.incremental`` has built from a history;
    the stream goes on from it.

    Lateness is decided against the key's state and ``as_of``, so no watermark
    is involved: ``as_of`` is the arrival time column of a replayable source or
    the wall clock.
    """
    rows = events.select(
        F.col(spec.key).alias("key"),
        F.col(spec.order).alias("order"),
        F.col(spec.ts).alias("ts"),
        F.col(spec.batch).alias("batch"),
        day_number(F.col(spec.ts)).alias("day"),
        is_stale(F.col(spec.ts), as_of).alias("stale"),
        F.col(spec.level).alias("level"),
        F.col(spec.price).alias("price"),
        F.col(spec.counter).alias("counter"),
        to_document(F.struct(*payload)).alias("payload"),
    )
    processor = ProductProcessor(
        days=spec.days,
        scale=spec.scale,
        ttl_ms=_milliseconds(ttl_seconds),
        coalesce=coalesce_updates,
        keep_last=on_reject == "keep_last",
    )
    output = series_output(rows.schema["key"].dataType, rows.schema["order"].dataType)
    begun = None if initial is None else series_state(initial, spec)
    states = _with_state(rows, processor, output, ttl_seconds, begun)

    payload_schema = T.StructType([events.schema[name] for name in payload])
    metrics = F.struct(
        *array_metrics(F.col("level"), F.col("price"), F.col("counter"), spec)
    )
    return states.select(
        F.col("key").alias(spec.key),
        F.col("order").alias(spec.order),
        "valid",
        F.when(F.col("valid"), metrics).alias("metrics"),
        from_document(F.col("payload"), payload_schema).alias("latest"),
    )


def run_updates(
    events: DataFrame,
    key: str,
    date: str,
    order: str,
    count: str,
    coalesce_updates: bool = False,
    ttl_seconds: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """(key, order, date, run_count) after each event.

    ``initial`` has summaries (``operators.summaries``) of a history, one a key.
    """
    rows = events.select(
        F.col(key).alias("key"),
        F.col(order).alias("order"),
        F.col(date).cast("string").alias("date"),
        F.col(count).cast("bigint").alias("count"),
    )
    processor = RunProcessor(_milliseconds(ttl_seconds), coalesce_updates)
    output = run_output(rows.schema["key"].dataType, rows.schema["order"].dataType)
    begun = None
    if initial is not None:
        begun = initial.select(
            F.col(key).alias("key"),
            F.col("tail_date").cast("string").alias("date"),
            F.col("tail_count").alias("count"),
        )
    states = _with_state(rows, processor, output, ttl_seconds, begun)
    return states.select(
        F.col("key").alias(key), F.col("order").alias(order), "date", "run_count"
    )


def ordered_run_updates(
    events: DataFrame,
    key: str,
    date: str,
    order: str,
    count: str,
    coalesce_updates: bool = False,
    held_rows: int = 100_000,
    block_rows: int = 256,
) -> DataFrame:
    """``run_updates`` for keys with more rows in a micro-batch than a worker holds.

    Timers put the rows in order, so this works in streams only.
    """
    rows = events.select(
        F.col(key).alias("key"),
        F.col(order).alias("order"),
        F.col(date).cast("string").alias("date"),
        F.col(count).cast("bigint").alias("count"),
    )
    kind = rows.schema["order"].dataType
    processor = OrderedRunProcessor(kind, held_rows, block_rows, coalesce_updates)
    use_rocksdb_state(rows.sparkSession)
    # As a text a key is never NULL, which frames would make a number that is not equal
    # to itself.
    named = T.StructType([rows.schema["key"]])
    states = rows.withColumn("key", to_document(F.struct("key"))).groupBy("key").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=run_output(T.StringType(), kind),
        outputMode="Update",
        timeMode="ProcessingTime",
    )
    return states.select(
        from_document(F.col("key"), named)["key"].alias(key),
        F.col("order").alias(order),
        "date",
        "run_count",
    )


def product_states(
    events: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None,
    on_reject: str = "null",
    ttl_seconds: int | None = None,
) -> DataFrame:
    """(key, order, valid, and the series as arrays): the newest state of every key of
    a micro-batch. Rows go to workers as columns of numbers, without a record."""
    rows = events.select(
        F.col(spec.key).alias("key"),
        F.col(spec.order).alias("order"),
        F.col(spec.ts).alias("ts"),
        F.col(spec.batch).alias("batch"),
        day_number(F.col(spec.ts)).alias("day"),
        is_stale(F.col(spec.ts), as_of).alias("stale"),
        F.col(spec.level).alias("level"),
        F.col(spec.price).alias("price"),
        F.col(spec.counter).cast("bigint").alias("counter"),
    )
    use_rocksdb_state(rows.sparkSession)
    rows.sparkSession.streams  # noqa: B018
    processor = ColumnarProducts(
        spec.days, spec.scale, _milliseconds(ttl_seconds), on_reject == "keep_last"
    )
    states = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=state_output(rows.schema["key"].dataType, rows.schema["order"].dataType),
        outputMode="Update",
        timeMode="ProcessingTime" if ttl_seconds else "None",
    )
    names = {"level": spec.level, "price": spec.price, "counter": spec.counter}
    return states.select(
        F.col("key").alias(spec.key),
        F.col("order").alias(spec.order),
        "valid",
        *[F.col(n).alias(to) for n, to in names.items()],
    )


def with_records(states: DataFrame, events: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(key, valid, metrics, latest) of written states, as ``product_result`` has them.

    The record is fetched by key and order for the states that are shown, from the
    stored ``events``; others of them are sifted out before they are shuffled.
    """
    states = pin(states)
    values = F.struct(*array_metrics(*[F.col(n) for n in spec.measures], spec))
    names = [spec.key, spec.order]
    shown = states.where("valid").select(*names)
    found = matching(events, pin(shown), names, BROADCAST_ROWS)
    records = found.select(*names, F.struct(*events.columns).alias("latest"))
    results = states.select(*names, "valid", F.when(F.col("valid"), values).alias("metrics"))
    return results.join(records, names, "left").drop(spec.order)


def newest_updates(updates: DataFrame, key: str, order: str) -> DataFrame:
    """The last update of every key, from a written history of updates."""
    others = [c for c in updates.columns if c != key]
    newest = updates.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return newest.select(key, *[F.col("_row").getField(c).alias(c) for c in others])


def series_state(state: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Stored series states under the names of a stream's state."""
    return state.select(
        F.col(spec.key).alias("key"),
        "last_ts",
        "last_batch",
        "last_day",
        "valid",
        F.col(spec.level).alias("level"),
        F.col(spec.price).alias("price"),
        F.col(spec.counter).alias("counter"),
    )


def _with_state(rows, processor, output, ttl_seconds, initial=None) -> DataFrame:
    spark = rows.sparkSession
    use_rocksdb_state(spark)
    # A batch replay needs the state coordinator too; asking for the session's
    # streams starts it.
    spark.streams  # noqa: B018
    # State variables that expire need a clock; without one there are no timers.
    time_mode = "ProcessingTime" if ttl_seconds else "None"
    return rows.groupBy("key").transformWithState(
        statefulProcessor=processor,
        outputStructType=output,
        outputMode="Update",
        timeMode=time_mode,
        initialState=None if initial is None else initial.groupBy("key"),
    )


def _milliseconds(seconds: int | None) -> int | None:
    return None if seconds is None else seconds * 1000
