"""Per-product metrics: admission, daily series, trailing metrics, latest record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import clock_text, epoch_seconds
from tidemark.functions.numeric import rounded
from tidemark.operators.admission import accepted_only, fresh_rows
from tidemark.operators.chunks import BROADCAST_ROWS, ROWS_PER_CHUNK, join_on, same
from tidemark.operators.daily import daily_endpoints, fill_daily, in_units
from tidemark.operators.latest import latest_record
from tidemark.operators.locate import PLACE, fetch
from tidemark.operators.metrics import trailing_metrics
from tidemark.operators.sieve import sieve, sifted
from tidemark.schema import METRIC_NAMES, OBSERVATION_SCHEMA, SeriesSpec
from tidemark.session import pin

# Columns a prepared observation table adds to the declared ones. Nine decimals
# keep the binary value of a FLOAT, so rounding falls where its own digits say.
SERIES = {"sold": "sold_units", "price": "price_units", "review_number": "reviews"}
OBSERVATION_SPEC = SeriesSpec(
    key="pid",
    ts="timestamp",
    batch="batch",
    order="arrival",
    level=SERIES["sold"],
    price=SERIES["price"],
    counter=SERIES["review_number"],
    scale=9,
)


def prepare(observations: DataFrame, scale: int = OBSERVATION_SPEC.scale) -> DataFrame:
    """Adds the batch id and exact measure columns to decoded observations."""
    measures = observations.select(
        "*",
        epoch_seconds(F.col("update_time")).alias("batch"),
        *[F.col(name).alias(units) for name, units in SERIES.items()],
    )
    return in_units(measures, list(SERIES.values()), scale)


def daily_series(accepted: DataFrame, spec: SeriesSpec) -> DataFrame:
    return fill_daily(daily_endpoints(accepted, spec), spec)


def product_metrics(
    events: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
    mode: str = "fold",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """The 16 metrics per key, and the arrival of its last accepted event.

    Reads only the columns the series needs.
    """
    accepted = _narrow_accepted(events, spec, as_of, mode, rows_per_chunk)
    return trailing_metrics(daily_series(accepted, spec), spec)


def product_result(
    events: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
    mode: str = "fold",
    on_reject: str = "null",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
    sift_rows: int | None = None,
) -> DataFrame:
    """Per key: ``valid``, the metrics and the latest accepted record.

    With ``on_reject="null"`` a key whose last event was rejected has NULL
    metrics and record, as a live result would; ``"keep_last"`` keeps the
    state of the last accepted event.

    Only narrow columns go through admission. A key's last event was accepted
    when no later arrival exists, and its record is fetched by (key, arrival).
    Should several rows share an arrival, one of them is shown (which one, only
    ``product_result_located`` fixes).

    With ``sift_rows`` the results are written first, and of the records only those
    that may be shown are shuffled: up to so many keys are broadcast, more are sifted.
    """
    if on_reject not in ("null", "keep_last"):
        raise ValueError("on_reject must be 'null' or 'keep_last'")
    metrics = product_metrics(events, spec, as_of, mode, rows_per_chunk)
    newest = events.groupBy(spec.key).agg(F.max(spec.order).alias("_newest"))
    standing = join_on(newest, metrics, [spec.key], "left").withColumn(
        "valid", F.col("last_order").eqNullSafe(F.col("_newest"))
    )
    shown = F.col("last_order").isNotNull()
    if on_reject == "null":
        shown = F.col("valid")
    values = F.struct(*[F.col(n) for n in METRIC_NAMES])
    # A NULL order finds no record, so hidden results are not fetched at all.
    wanted = standing.select(
        spec.key,
        F.when(shown, F.col("last_order")).alias(spec.order),
        "valid",
        F.when(shown, values).alias("metrics"),
    )
    if sift_rows is not None:
        wanted = pin(wanted)
        events = _maybe_shown(events, wanted, [spec.key, spec.order], sift_rows)
    records = events.select(
        F.col(spec.key).alias("_key"),
        F.col(spec.order).alias("_order"),
        F.struct(*events.columns).alias("latest"),
    )
    found = same(F.col(spec.key), F.col("_key")) & (
        F.col(spec.order) == F.col("_order")
    )
    shown = wanted.join(records, found, "left").groupBy(spec.key)
    return shown.agg(*[F.first(n).alias(n) for n in ("valid", "metrics", "latest")])


def _maybe_shown(
    events: DataFrame, wanted: DataFrame, names: list[str], broadcast_rows: int
) -> DataFrame:
    """The events that may match a row of ``wanted`` in (key, order), the key NULL-safe."""
    keys = wanted.select(*names).where(F.col(names[1]).isNotNull())
    count = keys.count()
    if count <= broadcast_rows:
        return join_on(events, F.broadcast(keys), names, "left_semi")
    bitmaps = pin(sieve(keys, names, count))
    return sifted(events, names, bitmaps, bitmaps.first()["_pages"])


def latest_accepted(
    events: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
    mode: str = "fold",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """The last accepted row of every key, whole; admission sees narrow rows."""
    accepted = _narrow_accepted(events, spec, as_of, mode, rows_per_chunk, ())
    last = accepted.groupBy(spec.key).agg(F.max(spec.order).alias(spec.order))
    # One row a key, should several share the arrival.
    return latest_record(join_on(events, last, [spec.key, spec.order], "left_semi"), spec)


def latest_located(
    rows: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
    mode: str = "fold",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``latest_accepted`` of a table read from Parquet, ``rows`` having its ``PLACE``.

    Admission carries the place instead of the record; the record is read for one
    row a key, found by place. Of rows with one arrival the last in place counts, so
    a key has one row whatever repeats.
    """
    narrow = fresh_rows(rows, spec, as_of).select(spec.key, spec.ts, spec.batch, spec.order, *PLACE)
    accepted = accepted_only(narrow, spec, None, mode, rows_per_chunk)
    return fetch(rows, newest_places(accepted, spec), spec.key, broadcast_rows)


def newest_places(accepted: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(key, ``PLACE``) of the last row of every key."""
    newest = accepted.groupBy(spec.key).agg(
        F.max(F.struct(spec.order, *PLACE)).alias("_newest")
    )
    return newest.select(spec.key, *[F.col(f"_newest.{c}").alias(c) for c in PLACE])


def product_result_located(
    rows: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
    mode: str = "fold",
    on_reject: str = "null",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``product_result`` of a table read from Parquet, ``rows`` having its ``PLACE``.

    Admission runs once over narrow rows; what it accepts is written, as narrow as it
    is, for the series and for the places of the records that are shown.
    """
    if on_reject not in ("null", "keep_last"):
        raise ValueError("on_reject must be 'null' or 'keep_last'")
    fresh = fresh_rows(rows, spec, as_of)
    names = [spec.key, spec.ts, spec.batch, spec.order, *spec.measures, *PLACE]
    accepted = pin(accepted_only(fresh.select(*names), spec, None, mode, rows_per_chunk))
    metrics = trailing_metrics(daily_series(accepted, spec), spec)
    newest = rows.groupBy(spec.key).agg(F.max(F.struct(spec.order, *PLACE)).alias("_last"))
    standing = join_on(newest, metrics, [spec.key], "left")
    places = newest_places(accepted, spec).select(spec.key, F.struct(*PLACE).alias("_place"))
    standing = join_on(standing, places, [spec.key], "left")
    last = F.struct(*[F.col(f"_last.{c}").alias(c) for c in PLACE])
    standing = standing.withColumn("valid", F.col("_place").eqNullSafe(last))
    shown = F.col("_place").isNotNull()
    if on_reject == "null":
        shown = F.col("valid")
    values = F.struct(*[F.col(n) for n in METRIC_NAMES])
    results = pin(
        standing.select(
            spec.key,
            "valid",
            F.when(shown, values).alias("metrics"),
            F.when(shown, F.col("_place")).alias("_place"),
        )
    )
    wanted = results.where(F.col("_place").isNotNull())
    wanted = wanted.select(spec.key, *[F.col(f"_place.{c}").alias(c) for c in PLACE])
    records = fetch(rows, wanted, spec.key, broadcast_rows)
    whole = F.struct(*records.columns)
    records = records.select(spec.key, whole.alias("latest"))
    return join_on(results.drop("_place"), records, [spec.key], "left")


def _narrow_accepted(
    events: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None,
    mode: str,
    rows_per_chunk: int | None,
    measures: list[str] | tuple[str, ...] | None = None,
) -> DataFrame:
    carried = spec.measures if measures is None else measures
    fresh = fresh_rows(events, spec, as_of)
    narrow = fresh.select(spec.key, spec.ts, spec.batch, spec.order, *carried)
    return accepted_only(narrow, spec, None, mode, rows_per_chunk)


def flat_result(result: DataFrame, latest_names: list[str]) -> DataFrame:
    """``product_result`` with one column per member, next to key and validity."""
    keys = [c for c in result.columns if c not in ("metrics", "latest")]
    return result.select(
        *keys,
        *[F.col("metrics").getField(n).alias(n) for n in METRIC_NAMES],
        *[F.col("latest").getField(n).alias(n) for n in latest_names],
    )


def result_document(metrics: Column, latest: Column) -> Column:
    """The result struct in document order: 16 metrics, then the 28 columns.

    Price, sold and score are shown with two decimals; clocks as text.
    """
    members = [metrics.getField(n).alias(n) for n in METRIC_NAMES]
    for field in OBSERVATION_SCHEMA.fields:
        value = latest.getField(field.name)
        if field.name in ("review_score", "price", "sold"):
            value = rounded(value, 2)
        elif field.name == "shipping_price":
            value = value.cast("double")
        elif field.dataType.typeName() == "timestamp_ntz":
            value = clock_text(value)
        members.append(value.alias(field.name))
    return F.when(metrics.isNotNull(), F.struct(*members))

