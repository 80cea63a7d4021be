"""The daily series as a stored state that a slice of new events moves on.

A key's state is what a stream would hold: the time, batch and order of its last
accepted event, whether its last event was accepted, and its newest daily values. A
slice is admitted from the stored state, its days are linked to the last stored day
and only they are filled in; stored days before that never change. Keys without an
event in the slice are not read beyond their key nor written.

States are kept as versions: each holds the keys it touched, and a key's state is the
one of its newest version (``newest_state``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.admission import admit_from
from tidemark.operators.chunks import join_on
from tidemark.operators.daily import daily_endpoints, fill_daily
from tidemark.operators.metrics import array_metrics, daily_arrays
from tidemark.schema import METRIC_NAMES, SeriesSpec
from tidemark.session import pin

MARKS = ["last_ts", "last_batch", "last_order", "last_day", "valid"]


def empty_state(events: DataFrame, spec: SeriesSpec) -> DataFrame:
    """No state, in the columns that ``advance_series`` returns."""
    fields = events.select(spec.key, F.col(spec.order).alias("last_order")).schema
    key, order = fields[spec.key].dataType.simpleString(), fields["last_order"].dataType.simpleString()
    lists = ", ".join(f"`{n}` array<bigint>" for n in spec.measures)
    shape = (
        f"`{spec.key}` {key}, last_ts bigint, last_batch bigint, last_order {order}, "
        f"last_day int, valid boolean, {lists}"
    )
    return events.sparkSession.createDataFrame([], shape)


def advance_series(
    state: DataFrame | None,
    events: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
) -> DataFrame:
    """The new state of every key that has an event in the slice.

    All events of a slice arrive after those of the slices before it.
    """
    state = empty_state(events, spec) if state is None else state
    clock = ["_clock"] if isinstance(as_of, Column) else []
    rows = events.withColumns({"_clock": as_of} if clock else {})
    rows = rows.select(spec.key, spec.ts, spec.batch, spec.order, *spec.measures, *clock)
    touched = rows.select(spec.key).distinct()
    own = pin(join_on(state, touched, [spec.key], "left_semi"))
    judged = pin(admit_from(rows, spec, F.col("_clock") if clock else as_of, own))

    good = F.col("status") == "accepted"
    last = F.max_by(F.struct(spec.ts, spec.batch, spec.order), F.when(good, F.col(spec.order)))
    marks = judged.groupBy(spec.key).agg(
        F.max_by(good, spec.order).alias("_valid"),
        F.when(F.count_if(good) > 0, last).alias("_last"),
    )
    fresh = _merged_days(own, judged.where(good), spec)
    days = fill_daily(fresh, spec)
    grown = daily_arrays(days, spec).select(
        spec.key, *[F.col(n).alias(f"_new_{n}") for n in spec.measures]
    )
    ends = fresh.groupBy(spec.key).agg(F.max("day").alias("_new_day"))

    joined = join_on(marks, own, [spec.key], "left")
    joined = join_on(join_on(joined, grown, [spec.key], "left"), ends, [spec.key], "left")
    return joined.select(
        spec.key,
        F.coalesce(F.col("_last")[spec.ts], "last_ts", F.lit(0).cast("bigint")).alias("last_ts"),
        F.coalesce(F.col("_last")[spec.batch], "last_batch", F.lit(0).cast("bigint")).alias("last_batch"),
        F.coalesce(F.col("_last")[spec.order], "last_order").alias("last_order"),
        F.coalesce("_new_day", "last_day").alias("last_day"),
        F.col("_valid").alias("valid"),
        *[_spliced(n, spec.days).alias(n) for n in spec.measures],
    )


def _merged_days(own: DataFrame, accepted: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Endpoints of the last stored day and of the slice's days.

    A stored day keeps the value it began with, to which the gap before it led; what
    it ends with is the slice's if the slice has that day.
    """
    stored = own.where(F.col("last_day").isNotNull()).select(
        spec.key,
        F.col("last_day").alias("day"),
        "last_order",
        *[F.element_at(n, -1).alias(f"{end}_{n}") for n in spec.measures for end in ("first", "last")],
        F.lit(0).alias("_part"),
    )
    sliced = daily_endpoints(accepted, spec).withColumn("_part", F.lit(1))
    return (
        stored.unionByName(sliced)
        .groupBy(spec.key, "day")
        .agg(
            F.max("last_order").alias("last_order"),
            *[F.min_by(f"first_{n}", "_part").alias(f"first_{n}") for n in spec.measures],
            *[F.max_by(f"last_{n}", "_part").alias(f"last_{n}") for n in spec.measures],
        )
    )


def _spliced(name: str, days: int) -> Column:
    """Stored days before the last stored one, then those filled in from it on."""
    new, old = F.col(f"_new_{name}"), F.col(name)
    count = F.least(F.col("_new_day") - F.col("last_day") + 1, F.lit(days))
    tail = F.slice(new, F.lit(1) + F.size(new) - count, count)
    whole = F.concat(F.slice(old, F.lit(1), F.lit(days - 1)), tail)
    spliced = F.slice(whole, F.size(whole) - F.lit(days - 1), F.lit(days))
    first = F.coalesce(new, F.array().cast("array<bigint>"))
    return F.when(F.col("last_day").isNull(), first).when(new.isNull(), old).otherwise(spliced)


def newest_state(versions: DataFrame, key: str, version: str = "version") -> DataFrame:
    """Every key's state from the newest version that has it."""
    others = [c for c in versions.columns if c not in (key, version)]
    newest = versions.groupBy(key).agg(F.max_by(F.struct(*others), version).alias("_row"))
    return newest.select(key, *[F.col("_row")[c].alias(c) for c in others])


def state_series(state: DataFrame, spec: SeriesSpec) -> DataFrame:
    """A row for each key and day held: day, age (0 is newest) and the measures."""
    places = F.posexplode(F.arrays_zip(*spec.measures)).alias("_place", "_value")
    rows = state.where(F.col("last_day").isNotNull()).select(spec.key, "last_day", places)
    age = F.lit(spec.days - 1) - F.col("_place")
    return rows.select(
        spec.key,
        (F.col("last_day") - age).alias("day"),
        age.alias("age"),
        *[F.col("_value")[n].alias(n) for n in spec.measures],
    )


def state_metrics(state: DataFrame, spec: SeriesSpec, on_reject: str = "null") -> DataFrame:
    """(key, valid, metrics): the 16 metrics of every state that shows any."""
    shown = F.col("last_day").isNotNull()
    if on_reject == "null":
        shown = shown & F.col("valid")
    values = F.struct(*array_metrics(*[F.col(n) for n in spec.measures], spec))
    held = F.when(shown, F.struct(*[values[n].alias(n) for n in METRIC_NAMES]))
    return state.select(spec.key, "valid", held.alias("metrics"))
