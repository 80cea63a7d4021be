"""Keyed state for streams: the open series of a product, the open run of a shop.

A micro-batch hands a key's new rows over in no particular order, so they are
sorted by arrival first. What is held is one key's share of one micro-batch,
which the source's per-trigger limit bounds; state per key has a fixed size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Workers need no installed copy of this module: its code travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LONGS = T.ArrayType(T.LongType())

SERIES_STATE = T.StructType(
    [
        T.StructField("last_ts", T.LongType()),
        T.StructField("last_batch", T.LongType()),
        T.StructField("last_day", T.IntegerType()),
        T.StructField("valid", T.BooleanType()),
        T.StructField("level", _LONGS),
        T.StructField("price", _LONGS),
        T.StructField("counter", _LONGS),
    ]
)

RUN_STATE = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("count", T.LongType())]
)


def series_output(key_type: T.DataType, order_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("key", key_type),
            T.StructField("order", order_type),
            T.StructField("valid", T.BooleanType()),
            T.StructField("level", _LONGS),
            T.StructField("price", _LONGS),
            T.StructField("counter", _LONGS),
            T.StructField("payload", T.StringType()),
        ]
    )


def run_output(key_type: T.DataType, order_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("key", key_type),
            T.StructField("order", order_type),
            T.StructField("date", T.StringType()),
            T.StructField("run_count", T.LongType()),
        ]
    )


class _Keyed(StatefulProcessor):
    """One state value per key, optionally forgotten when idle."""

    state_name = ""
    state_schema = T.StructType()

    def __init__(self, ttl_ms: int | None, coalesce: bool) -> None:
        self.ttl_ms = ttl_ms
        self.coalesce = coalesce

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(
            self.state_name, self.state_schema, self.ttl_ms
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.state.get() if self.state.exists() else None
        newest = None
        for row in sorted(rows, key=lambda r: r["order"]):
            state, update = self.step(key[0], state, row)
            if update is None:
                continue
            if self.coalesce:
                newest = update
            else:
                yield update
        if newest is not None:
            yield newest
        # Written even if unchanged: that is what keeps a busy key from expiring.
        self.state.update(tuple(state))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Starts a key from a state that a batch query has built."""
        names = self.state_schema.fieldNames()
        self.state.update(tuple(initialState[n] for n in names))

    def step(self, key, state, row):
        raise NotImplementedError

    def close(self) -> None:
        pass


class ProductProcessor(_Keyed):
    """Admits events in arrival order and keeps the last ``days`` daily values.

    Emits the series after each accepted event, and one invalid result when
    acceptance turns into rejection (not with ``keep_last``).
    """

    state_name = "series"
    state_schema = SERIES_STATE

    def __init__(
        self,
        days: int = 30,
        scale: int = 6,
        ttl_ms: int | None = None,
        coalesce: bool = False,
        keep_last: bool = False,
    ) -> None:
        super().__init__(ttl_ms, coalesce)
        self.days = days
        self.cent = 10 ** max(scale - 2, 0)
        self.keep_last = keep_last

    def step(self, key, state, row):
        last_ts, last_batch, last_day, valid, *series = state or (
            0, 0, None, None, [], [], [],
        )
        if row["stale"] or row["batch"] == last_batch or row["ts"] < last_ts:
            rejected = (last_ts, last_batch, last_day, False, *series)
            if valid is False or self.keep_last:
                return rejected, None
            gone = Row(
                key=key, order=row["order"], valid=False,
                level=None, price=None, counter=None, payload=None,
            )
            return rejected, gone

        gap = None if last_day is None else row["day"] - last_day
        values = (row["level"], row["price"], row["counter"])
        rules = (self.fraction_at, self.fraction_at, self.count_at)
        series = [
            self.grown(list(old), gap, value, rule)
            for old, value, rule in zip(series, values, rules)
        ]
        update = Row(
            key=key, order=row["order"], valid=True,
            level=series[0], price=series[1], counter=series[2],
            payload=row["payload"],
        )
        return (row["ts"], row["batch"], row["day"], True, *series), update

    def grown(self, old, gap, value, rule):
        if gap is None:
            return [value] * self.days
        if gap == 0:
            return old[:-1] + [value]
        # Only the part of a gap that the horizon keeps is computed.
        first = max(1, gap - self.days + 1)
        between = [rule(old[-1], value - old[-1], gap, i) for i in range(first, gap)]
        return (old + between + [value])[-self.days :]

    def fraction_at(self, start, rise, gap, i):
        divisor = gap * self.cent
        step = (abs(rise) * 2 + divisor) // (divisor * 2)
        return start + i * (step if rise >= 0 else -step) * self.cent

    def count_at(self, start, rise, gap, i):
        return start + rise * i // gap


class RunProcessor(_Keyed):
    """Counts the current run of events sharing a date; emits after each event."""

    state_name = "run"
    state_schema = RUN_STATE

    def __init__(self, ttl_ms: int | None = None, coalesce: bool = False) -> None:
        super().__init__(ttl_ms, coalesce)

    def step(self, key, state, row):
        date, total = state or (None, 0)
        total = row["count"] + (total if row["date"] == date else 0)
        update = Row(key=key, order=row["order"], date=row["date"], run_count=total)
        return (row["date"], total), update


class ColumnarProducts(StatefulProcessor):
    """``ProductProcessor`` over columns: a key's share of a micro-batch comes as a few
    arrays of numbers, and only its newest series goes back. No record, no text."""

    def __init__(
        self, days: int = 30, scale: int = 6, ttl_ms: int | None = None, keep_last: bool = False
    ) -> None:
        self.rules = ProductProcessor(days, scale, ttl_ms, True, keep_last)
        self.ttl_ms, self.keep_last = ttl_ms, keep_last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("series", SERIES_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        frames = [f for f in rows if len(f)]
        if not frames:
            return
        whole = (pd.concat(frames) if len(frames) > 1 else frames[0]).sort_values("order", kind="stable")
        names = ("order", "ts", "batch", "day", "stale", "level", "price", "counter")
        held = self.state.get() if self.state.exists() else (0, 0, None, None, [], [], [])
        last_ts, last_batch, last_day, valid, *series = held
        series, changed, shown, newest = [list(v) for v in series], False, valid, None
        rules = self.rules
        steps = (rules.fraction_at, rules.fraction_at, rules.count_at)
        for order, ts, batch, day, stale, *values in zip(*(whole[n].tolist() for n in names)):
            if stale or batch == last_batch or ts < last_ts:
                if valid is not False and not self.keep_last:
                    newest = order, False
                valid = False
                continue
            gap = None if last_day is None else day - last_day
            if gap == 0:
                for own, value in zip(series, values):
                    own[-1] = value
            else:
                series = [
                    rules.grown(own, gap, value, step)
                    for own, value, step in zip(series, values, steps)
                ]
            last_ts, last_batch, last_day, valid = ts, batch, day, True
            newest = order, True
        # Written even if unchanged: that is what keeps a busy key from expiring.
        self.state.update((last_ts, last_batch, last_day, valid, *series))
        if newest is not None:
            order, good = newest
            shown = series if good else [None, None, None]
            yield pd.DataFrame(
                {
                    "key": [key[0]],
                    "order": [order],
                    "valid": [good],
                    "level": [shown[0]],
                    "price": [shown[1]],
                    "counter": [shown[2]],
                }
            )

    def close(self) -> None:
        pass


_BLOCK = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("block", T.IntegerType())])


class OrderedRunProcessor(StatefulProcessor):
    """``RunProcessor`` for keys whose share of a micro-batch is not held in memory.

    Rows are put in order by an external merge sort in the state store: every
    ``held_rows`` of them are sorted and written as a run of blocks, and a timer of the
    same micro-batch merges the runs, a block of each at a time, and counts. Of more
    than ``merged_runs`` runs, so many at a time are first merged into longer ones.
    Memory holds one frame of rows and ``held_rows`` of them, or one block of each of
    ``merged_runs`` runs. Rows come and updates go as frames: of rows, Spark would hold
    all updates of a partition before it writes the first.
    """

    def __init__(
        self,
        order_type: T.DataType,
        held_rows: int,
        block_rows: int,
        coalesce: bool,
        merged_runs: int = 256,
    ) -> None:
        self.held_rows, self.block_rows, self.coalesce = held_rows, block_rows, coalesce
        # Fewer than two would never leave one run.
        self.merged_runs = max(2, merged_runs)
        self.block_schema = T.StructType(
            [
                T.StructField("order", T.ArrayType(order_type)),
                T.StructField("date", T.ArrayType(T.StringType())),
                T.StructField("count", _LONGS),
            ]
        )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", RUN_STATE)
        self.blocks = handle.getMapState("blocks", _BLOCK, self.block_schema)
        self.runs = handle.getListState("runs", T.StructType([T.StructField("blocks", T.IntegerType())]))

    def handleInputRows(self, key, rows, timerValues):
        held, number = [], sum(1 for _ in self.runs.get())
        for frame in rows:
            if frame["order"].hasnans or frame["count"].hasnans:
                raise ValueError("a row has a NULL order or count")
            dates = [None if d != d else d for d in frame["date"].tolist()]
            held.extend(zip(frame["order"].tolist(), dates, frame["count"].tolist()))
            full = len(held) - len(held) % self.held_rows
            for start in range(0, full, self.held_rows):
                self.spill(held[start : start + self.held_rows], number)
                number += 1
            del held[:full]
        if held:
            self.spill(held, number)
        # Due before this micro-batch began, so it fires at its end.
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() - 1)
        yield from ()

    def spill(self, held: list[tuple], number: int) -> None:
        held.sort(key=lambda r: r[0])
        self.runs.appendValue((self.write(iter(held), number),))

    def write(self, rows: Iterator[tuple], number: int) -> int:
        """Writes sorted rows as the blocks of a run; returns how many there are."""
        import itertools

        blocks = 0
        while block := list(itertools.islice(rows, self.block_rows)):
            self.blocks.updateValue((number, blocks), tuple(map(list, zip(*block))))
            blocks += 1
        return blocks

    def run(self, number: int, blocks: int) -> Iterator[tuple]:
        for block in range(blocks):
            columns = self.blocks.getValue((number, block))
            self.blocks.removeKey((number, block))
            yield from zip(*columns)

    def merged(self, runs: list[tuple[int, int]]) -> Iterator[tuple]:
        import heapq

        return heapq.merge(*(self.run(*r) for r in runs), key=lambda r: r[0])

    def fewer(self, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The same rows in runs that are each merged from ``merged_runs`` neighbours."""
        longer, number = [], runs[-1][0]
        for start in range(0, len(runs), self.merged_runs):
            number += 1
            rows = self.merged(runs[start : start + self.merged_runs])
            longer.append((number, self.write(rows, number)))
        return longer

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        runs = [(number, blocks) for number, (blocks,) in enumerate(self.runs.get())]
        self.runs.clear()
        while len(runs) > self.merged_runs:
            runs = self.fewer(runs)
        date, total = self.state.get() if self.state.exists() else (None, 0)
        updates = []
        for order, day, count in self.merged(runs):
            total = count + (total if day == date else 0)
            date = day
            if self.coalesce:
                updates.clear()
            updates.append((key[0], order, date, total))
            if len(updates) >= self.held_rows and not self.coalesce:
                yield self.frame(updates)
                updates.clear()
        if updates:
            yield self.frame(updates)
        self.state.update((date, total))

    def frame(self, updates: list[tuple]):
        import pandas as pd

        return pd.DataFrame(updates, columns=["key", "order", "date", "run_count"])

    def close(self) -> None:
        pass


def state_output(key_type: T.DataType, order_type: T.DataType) -> T.StructType:
    whole = series_output(key_type, order_type)
    return T.StructType([f for f in whole.fields if f.name != "payload"])
