"""Which observations of a key count, decided in arrival order.

An event is accepted when it is not stale, its batch differs from the batch of
the last accepted event and it is not older than that event. Only accepted
events move that state, so the rule is a sequential fold per key.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.chunks import (
    CHUNK,
    ROWS_PER_CHUNK,
    Chunked,
    any_hot,
    assign_chunks,
    carried_max,
    chunk_window,
    join_on,
    join_pinned,
    max_before,
    without_pinned,
)
from tidemark.schema import STALE_AFTER_SECONDS, STATUSES, SeriesSpec
from tidemark.session import pin
from tidemark.workers import START, exit_fold, possible_fold, status_fold

MODES = ("fold", "monotone", "checked")
UNKNOWN = "NULL time or batch"


def is_stale(ts: Column, as_of: Column | int | None) -> Column:
    """Strictly older than 14 days; exactly 14 days still counts."""
    if as_of is None:
        return F.lit(False)
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("bigint")
    return ts < now - F.lit(STALE_AFTER_SECONDS)


def drop_stale(df: DataFrame, spec: SeriesSpec, as_of: Column | int) -> DataFrame:
    """Keeps fresh rows. Stale ones never move the state of a key, so this can
    run before any shuffle; with a literal it reaches the Parquet scan."""
    if isinstance(as_of, int):
        return df.where(F.col(spec.ts) >= F.lit(as_of - STALE_AFTER_SECONDS))
    return df.where(F.col(spec.ts) >= as_of - F.lit(STALE_AFTER_SECONDS))


def drop_stale_stored(df: DataFrame, clock: str, as_of: int) -> DataFrame:
    """``drop_stale`` by a stored clock column, a timestamp or epoch seconds.

    The bound is a literal of the column's own type, so the scan tests it on row
    groups and pages; one on epoch seconds made from a timestamp stays above it.
    """
    bound = as_of - STALE_AFTER_SECONDS
    kind = df.schema[clock].dataType
    if isinstance(kind, T.TimestampNTZType | T.TimestampType):
        moment = datetime.fromtimestamp(bound, timezone.utc)
        if isinstance(kind, T.TimestampNTZType):
            moment = moment.replace(tzinfo=None)
        return df.where(F.col(clock) >= F.lit(moment).cast(kind))
    return df.where(F.col(clock) >= F.lit(bound).cast(kind))


def fresh_rows(df: DataFrame, spec: SeriesSpec, as_of: Column | int | None) -> DataFrame:
    """``drop_stale`` before admission: a NULL time stays, to be refused there."""
    if as_of is None:
        return df
    return df.where(F.col(spec.ts).isNull() | ~is_stale(F.col(spec.ts), as_of))


def late_only(
    df: DataFrame, spec: SeriesSpec, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Keeps rows not older than any earlier row of their key."""
    cut = assign_chunks(df, spec.key, spec.order, rows_per_chunk)
    seen = max_before(df, spec.key, spec.order, F.col(spec.ts), "_seen", cut)
    on_time = F.col("_seen").isNull() | (F.col(spec.ts) >= F.col("_seen"))
    return seen.where(_known(F.col(spec.ts).isNull(), on_time)).select(*df.columns)


def unique_order(
    df: DataFrame, spec: SeriesSpec, ties: str = "refuse", by: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with an order that no two rows of a key share, as admission needs.

    ``ties="refuse"`` fails if two rows of a key have one order, and changes nothing
    else. ``"rank"`` replaces the order by the row's rank by key, order and the
    columns ``by``, which should tell rows apart (their place in the source does):
    one sort by range, so a key or an order with many rows is many tasks.
    """
    if ties == "rank":
        names = [spec.key, spec.order, *by]
        ranked = df.repartitionByRange(*names).sortWithinPartitions(*names)
        rank = F.monotonically_increasing_id()
        return pin(ranked.withColumn(spec.order, rank)).select(*df.columns)
    if ties != "refuse":
        raise ValueError("ties are 'refuse'd or told apart by 'rank'")
    repeated = df.groupBy(spec.key, spec.order).count().where("count > 1").take(1)
    if repeated:
        raise ValueError(f"two rows of a key share one {spec.order}: {repeated[0]}")
    return df


def admit(
    df: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
    mode: str = "fold",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Every row with its ``status``: accepted, stale, duplicate_batch or late.

    ``mode="monotone"`` is only for batches that never decrease with ``ts``;
    there the fold has a closed form. ``"checked"`` tests that for every key and
    folds the keys it does not hold for, so it is right on any input. Time and batch
    must not be NULL (see ``sources.quality``), which every mode refuses, and no two
    rows of a key may share an order (``unique_order``). ``as_of`` is a stored clock column, or one number
    for all rows; a batch reads the wall clock once (``clock.wall_clock``),
    because splitting hot keys takes several passes.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if isinstance(as_of, int):
        # Stale rows never meet the others, so they skip the shuffle.
        fresh = F.col(spec.ts).isNull() | ~is_stale(F.col(spec.ts), as_of)
        judged = admit(df.where(fresh), spec, None, mode, rows_per_chunk)
        stale = df.where(is_stale(F.col(spec.ts), as_of))
        return judged.unionByName(stale.withColumn("status", F.lit(STATUSES[1])))

    marked = df.withColumn("_stale", is_stale(F.col(spec.ts), as_of))
    if mode == "checked":
        fresh = marked.where(F.coalesce(~F.col("_stale"), F.lit(True)))
        keys = unordered_keys(fresh, spec, rows_per_chunk)
        folded = join_pinned(df, keys, [spec.key], "left_semi")
        closed = without_pinned(df, keys, [spec.key])
        folded = admit(folded, spec, as_of, "fold", rows_per_chunk)
        return folded.unionByName(admit(closed, spec, as_of, "monotone", rows_per_chunk))
    cut = assign_chunks(marked, spec.key, spec.order, rows_per_chunk)
    if mode == "monotone":
        coded = _monotone_codes(marked, spec, cut)
    elif cut is None:
        coded = _fold_codes(marked, spec, [spec.key])
    else:
        coded = _chunked_codes(cut, spec)
    names = F.array(*[F.lit(s) for s in STATUSES])
    status = F.element_at(names, F.col("_code").cast("int") + 1)
    return coded.select(*df.columns, status.alias("status"))


def accepted_only(
    df: DataFrame,
    spec: SeriesSpec,
    as_of: Column | int | None = None,
    mode: str = "fold",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """The accepted rows; stale ones are dropped before the shuffle."""
    fresh = fresh_rows(df, spec, as_of)
    if mode == "checked":
        keys = unordered_keys(fresh, spec, rows_per_chunk)
        folded = join_pinned(fresh, keys, [spec.key], "left_semi")
        closed = without_pinned(fresh, keys, [spec.key])
        folded = accepted_only(folded, spec, None, "fold", rows_per_chunk)
        return folded.unionByName(_first_of_batches(closed, spec, rows_per_chunk))
    if mode == "monotone":
        return _first_of_batches(fresh, spec, rows_per_chunk)
    judged = admit(fresh, spec, None, mode, rows_per_chunk)
    return judged.where(F.col("status") == "accepted").drop("status")


def admit_from(
    df: DataFrame, spec: SeriesSpec, as_of: Column | int | None, entry: DataFrame
) -> DataFrame:
    """``admit`` for rows that go on from a state: ``entry`` has (key, last_ts,
    last_batch) of the keys seen before, and other keys start afresh."""
    marked = df.withColumn("_stale", is_stale(F.col(spec.ts), as_of))
    begun = entry.select(
        spec.key, F.col("last_ts").alias("_in_ts"), F.col("last_batch").alias("_in_batch")
    )
    started = join_on(marked, begun, [spec.key], "left").withColumns(
        {
            "_in_ts": F.coalesce("_in_ts", F.lit(START[0]).cast("bigint")),
            "_in_batch": F.coalesce("_in_batch", F.lit(START[1]).cast("bigint")),
        }
    )
    coded = _fold_codes(started, spec, [spec.key], ("_in_ts", "_in_batch"))
    names = F.array(*[F.lit(s) for s in STATUSES])
    status = F.element_at(names, F.col("_code").cast("int") + 1)
    return coded.select(*df.columns, status.alias("status"))


def unordered_keys(
    fresh: DataFrame, spec: SeriesSpec, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """The keys whose batches, in order of their ids, are not apart in time.

    Where each batch of a key begins after all smaller ones have ended, and ids and
    times are above the state a key starts from, the closed form equals the fold.
    Rows are reduced to one range for each (key, batch) before they are compared.
    """
    ranges = fresh.groupBy(spec.key, spec.batch).agg(
        F.min(spec.ts).alias("_low"),
        F.max(spec.ts).alias("_high"),
        F.max(F.col(spec.ts).isNull()).alias("_unknown"),
    )
    cut = None
    if any_hot(fresh, spec.key, spec.order, rows_per_chunk):
        cut = assign_chunks(ranges, spec.key, spec.batch, rows_per_chunk)
    seen = max_before(ranges, spec.key, spec.batch, F.col("_high"), "_ended", cut)
    apart = F.col("_ended").isNull() | (F.col("_ended") < F.col("_low"))
    started = (F.col("_low") >= START[0]) & (F.col(spec.batch) > START[1])
    holds = F.coalesce(apart & started & ~F.col("_unknown"), F.lit(False))
    return pin(seen.where(~holds).select(spec.key).distinct())


def _known(unknown: Column, test: Column) -> Column:
    """``test``, failing on a row where it cannot be made."""
    refused = F.raise_error(F.lit(UNKNOWN)).cast("boolean")
    return F.when(unknown, refused).otherwise(test)


def _fold_codes(
    df: DataFrame, spec: SeriesSpec, group: list[str], entry=None
) -> DataFrame:
    ordered = df.repartition(*group).sortWithinPartitions(*group, spec.order)
    # Marked nondeterministic, as the code of a row depends on the rows before
    # it: the optimizer then neither drops the sort nor filters rows beneath.
    fold = F.arrow_udf(status_fold(group, entry is not None), "tinyint")
    columns = [*group, spec.ts, spec.batch, "_stale", *(entry or ())]
    return ordered.withColumn("_code", fold.asNondeterministic()(*columns))


def _chunked_codes(cut: Chunked, spec: SeriesSpec) -> DataFrame:
    """The fold with hot keys taken chunk by chunk.

    A first pass finds the state each chunk ends in; nearly always its own
    events settle that regardless of what came before. Chunks left open are
    thinned and folded from the settled one before them. The last pass folds
    every chunk from its entry state.
    """
    entries = pin(_entry_states(cut.hot, spec))
    joined = join_pinned(cut.rows, entries, [spec.key, CHUNK], "left")
    started = joined.withColumns(
        {
            "_in_ts": F.coalesce("_in_ts", F.lit(START[0]).cast("bigint")),
            "_in_batch": F.coalesce("_in_batch", F.lit(START[1]).cast("bigint")),
        }
    )
    return _fold_codes(started, spec, [spec.key, CHUNK], ("_in_ts", "_in_batch"))


def _entry_states(hot: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(key, chunk, _in_ts, _in_batch) for every chunk of a hot key."""
    key = spec.key
    by_chunk = chunk_window(key)
    narrow = hot.select(key, CHUNK, spec.order, spec.ts, spec.batch, "_stale")
    fresh_ts = F.when(~F.col("_stale"), F.col(spec.ts))
    floor = F.lit(START[0]).cast("bigint")
    first = F.row_number().over(by_chunk) == 1
    plan = pin(
        carried_max(narrow, key, fresh_ts, "_top").select(
            key,
            CHUNK,
            F.greatest("_top", floor).alias("_peak"),
            F.when(first, floor).alias("_in_ts"),
            F.when(first, F.lit(START[1]).cast("bigint")).alias("_in_batch"),
        )
    )
    planned = join_pinned(narrow, plan, [key, CHUNK], "inner")
    exits = pin(_exits(planned, spec, [CHUNK]))

    if not exits.where(~F.col("_known")).isEmpty():
        solved = _solve_open_chunks(narrow, plan, exits, spec)
        exits = (
            exits.unionByName(solved)
            .groupBy(key, CHUNK)
            .agg(
                F.max("_exit_ts").alias("_exit_ts"),
                F.max("_exit_batch").alias("_exit_batch"),
            )
        )

    # A chunk without an exit of its own leaves the state as it was.
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    return exits.select(
        key,
        CHUNK,
        F.last("_exit_ts", ignorenulls=True).over(before).alias("_in_ts"),
        F.last("_exit_batch", ignorenulls=True).over(before).alias("_in_batch"),
    )


def _solve_open_chunks(
    narrow: DataFrame, plan: DataFrame, exits: DataFrame, spec: SeriesSpec
) -> DataFrame:
    """Exit states of chunks that no event inside them settles.

    A stretch is a settled chunk and the open ones after it. Its chunks are
    first thinned in parallel: the time of the state never falls below that at
    the start of the stretch, and of what is left only events that some
    possible state would accept can matter (of a long run of duplicates or of
    late replays, next to none). The rest is folded along the stretch.
    """
    key = spec.key
    by_chunk = chunk_window(key)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    stretch = F.sum(F.col("_known").cast("int")).over(by_chunk)
    open_chunks = exits.select(
        key,
        CHUNK,
        "_known",
        stretch.alias("_stretch"),
        F.last("_exit_ts", ignorenulls=True).over(before).alias("_in_ts"),
        F.last("_exit_batch", ignorenulls=True).over(before).alias("_in_batch"),
    ).where(~F.col("_known"))
    peaks = plan.select(key, CHUNK, "_peak")
    todo = pin(join_on(open_chunks.drop("_known"), peaks, [key, CHUNK], "inner"))
    rows = join_pinned(narrow, todo, [key, CHUNK], "inner").where(
        ~F.col("_stale") & (F.col(spec.ts) >= F.col("_in_ts"))
    )
    group = [key, CHUNK]
    ordered = rows.repartition(*group).sortWithinPartitions(*group, spec.order)
    thin = possible_fold(group, spec.ts, spec.batch, "_in_ts", "_peak")
    return _exits(ordered.mapInArrow(thin, rows.schema), spec, ["_stretch"])


def _exits(rows: DataFrame, spec: SeriesSpec, unit: list[str]) -> DataFrame:
    row = [spec.key, CHUNK]
    unit = [spec.key, *unit]
    ordered = rows.repartition(*unit).sortWithinPartitions(*unit, CHUNK, spec.order)
    schema = T.StructType(
        [rows.schema[n] for n in row]
        + [
            T.StructField("_known", T.BooleanType()),
            T.StructField("_exit_ts", T.LongType()),
            T.StructField("_exit_batch", T.LongType()),
        ]
    )
    fold = exit_fold(
        unit, row, spec.ts, spec.batch, "_stale", "_peak", ("_in_ts", "_in_batch")
    )
    return ordered.mapInArrow(fold, schema)


def _monotone_codes(
    df: DataFrame, spec: SeriesSpec, cut: Chunked | None
) -> DataFrame:
    """Batch grows with time: accepted means a batch above all fresh ones before."""
    fresh_batch = F.when(~F.col("_stale"), F.col(spec.batch))
    seen = max_before(df, spec.key, spec.order, fresh_batch, "_seen", cut)
    last = F.greatest(F.col("_seen"), F.lit(START[1]).cast("bigint"))
    unknown = F.col(spec.ts).isNull() | F.col(spec.batch).isNull()
    code = (
        F.when(unknown, F.raise_error(F.lit(UNKNOWN)).cast("int"))
        .when(F.col("_stale"), 1)
        .when(F.col(spec.batch) == last, 2)
        .when(F.col(spec.batch) < last, 3)
        .otherwise(0)
    )
    return seen.withColumn("_code", code.cast("tinyint"))


def _first_of_batches(
    df: DataFrame, spec: SeriesSpec, rows_per_chunk: int | None
) -> DataFrame:
    """Accepted rows under the monotone rule, without windowing raw rows.

    Only the first arrival of a batch can be accepted, so rows are first
    reduced to one per (key, batch) with map-side combining.
    """
    carried = [c for c in df.columns if c not in (spec.key, spec.batch, spec.order)]
    firsts = df.groupBy(spec.key, spec.batch).agg(
        F.min(spec.order).alias(spec.order),
        F.max(F.col(spec.ts).isNull()).alias("_unknown"),
        *[F.min_by(c, spec.order).alias(c) for c in carried],
    )
    cut = None
    if any_hot(df, spec.key, spec.order, rows_per_chunk):
        cut = assign_chunks(firsts, spec.key, spec.order, rows_per_chunk)
    seen = max_before(firsts, spec.key, spec.order, F.col(spec.batch), "_seen", cut)
    last = F.greatest(F.col("_seen"), F.lit(START[1]).cast("bigint"))
    unknown = F.col(spec.batch).isNull() | F.col("_unknown")
    return seen.where(_known(unknown, F.col(spec.batch) > last)).select(*df.columns)
