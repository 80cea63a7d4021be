"""Code that runs inside Python workers: sequential folds over sorted rows.

These are the only loops in the package. Spark partitions, shuffles and sorts;
a fold sees Arrow batches in (key, chunk, order) order and keeps O(1) state, so
a group never has to fit in memory.
"""

from __future__ import annotations

import sys
from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Workers need no installed copy of this module: its code travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ACCEPTED, STALE, DUPLICATE, LATE = range(4)
START = (0, 0)


def values(rows: pa.RecordBatch, name: str) -> list:
    """A column as a list of Python values; a NULL in it is an error."""
    if rows.column(name).null_count:
        raise ValueError(f"NULL in {name}: set such rows aside before admission")
    return rows.column(name).to_numpy(zero_copy_only=False).tolist()


def cell(rows: pa.RecordBatch, names, i: int) -> tuple:
    return tuple(rows.column(name)[i].as_py() for name in names)


def stretches(rows: pa.RecordBatch, names: list[str]):
    """(start, end) of consecutive rows that agree in ``names``."""
    count = rows.num_rows
    differs = np.zeros(max(count - 1, 0), dtype=bool)
    for name in names:
        column = rows.column(name)
        before, after = column.slice(0, count - 1), column.slice(1)
        unequal = pc.fill_null(pc.not_equal(before, after), False)
        one_null = pc.xor(pc.is_null(before), pc.is_null(after))
        differs |= pc.or_(unequal, one_null).to_numpy(zero_copy_only=False)
    starts = [0, *(np.flatnonzero(differs) + 1).tolist()]
    return zip(starts, [*starts[1:], count])


def status_fold(group: list[str], entry: bool):
    """The admission code of every row.

    The columns come as the group, time, batch, staleness and, with ``entry``,
    the time and batch of the state a group starts from; without it every group
    starts fresh. Other columns of the rows never leave the JVM.
    """
    names = [*group, "ts", "batch", "stale", *(["in_ts", "in_batch"] if entry else [])]

    def fold(columns: Iterator[Tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        current = None
        last_ts, last_batch = START
        for arrays in columns:
            rows = pa.RecordBatch.from_arrays(list(arrays), names=names)
            times, lots = values(rows, "ts"), values(rows, "batch")
            olds = values(rows, "stale")
            codes = bytearray(rows.num_rows)
            for start, end in stretches(rows, group) if codes else ():
                this = cell(rows, group, start)
                if this != current:
                    current = this
                    last_ts, last_batch = START
                    if entry:
                        last_ts, last_batch = cell(rows, ("in_ts", "in_batch"), start)
                for i in range(start, end):
                    if olds[i]:
                        codes[i] = STALE
                    elif lots[i] == last_batch:
                        codes[i] = DUPLICATE
                    elif times[i] < last_ts:
                        codes[i] = LATE
                    else:
                        last_ts, last_batch = times[i], lots[i]
            yield pa.Array.from_buffers(
                pa.int8(), len(codes), [None, pa.py_buffer(bytes(codes))]
            )

    return fold


def advance(states: dict, time: int, lot: int) -> bool:
    """Moves every possible state over one event; could it be accepted at all?

    ``states`` maps a batch to the range of times it may have been accepted at;
    None stands for any batch. Ranges may be wider than the truth, never
    narrower, so False is certain.
    """
    accepted = False
    for other in [x for x in states if x != lot]:
        low, high = states[other]
        if low > time:
            continue
        accepted = True
        if high <= time:
            del states[other]
        else:
            states[other] = (time + 1, high)
        if other is None:
            # The state may also be of this very batch, and then it stays.
            widen(states, lot, low, min(high, time))
    if accepted:
        widen(states, lot, time, time)
    return accepted


def widen(states: dict, lot: int, low: int, high: int) -> None:
    if lot in states:
        low, high = min(low, states[lot][0]), max(high, states[lot][1])
    states[lot] = (low, high)


def certain(states: dict):
    """(time, batch) when only one state is possible, else None."""
    if len(states) != 1:
        return None
    [(lot, (low, high))] = states.items()
    return (low, lot) if lot is not None and low == high else None


def possible_fold(group: list[str], ts: str, batch: str, low: str, high: str):
    """Keeps the fresh events of a group that some state before it would accept.

    That state's time lies between the columns ``low`` and ``high``.
    """

    def fold(batches):
        current = None
        states = {}
        for rows in batches:
            if rows.num_rows == 0:
                continue
            times, lots = values(rows, ts), values(rows, batch)
            keep = np.zeros(rows.num_rows, dtype=bool)
            for start, end in stretches(rows, group):
                this = cell(rows, group, start)
                if this != current:
                    current = this
                    states = {None: cell(rows, (low, high), start)}
                for i in range(start, end):
                    keep[i] = advance(states, times[i], lots[i])
            yield rows.filter(pa.array(keep))

    return fold


def exit_fold(
    unit: list[str],
    row: list[str],
    ts: str,
    batch: str,
    stale: str,
    peak: str,
    entry: tuple[str, str],
):
    """One row per ``row`` group: the state after its last event, where certain.

    State is carried along a ``unit`` (one or several consecutive chunks). With
    a known entry state the fold is exact. Without one it starts from every
    state there could be, with times up to ``peak`` (the largest of earlier
    chunks); usually few events leave a single state possible. Otherwise the
    group comes out unresolved.
    """

    def fold(batches):
        kinds = None
        done = []
        current_unit = current_row = None
        state, states = None, {}

        def close():
            done.append((*current_row, state is not None, *(state or (None, None))))

        def flush():
            columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
            names = [*row, "_known", "_exit_ts", "_exit_batch"]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for rows in batches:
            if rows.num_rows == 0:
                continue
            if kinds is None:
                kinds = [rows.schema.field(n).type for n in row]
                kinds += [pa.bool_(), pa.int64(), pa.int64()]
            times, lots = values(rows, ts), values(rows, batch)
            olds = values(rows, stale)
            for start, end in stretches(rows, row):
                this = cell(rows, row, start)
                if this != current_row:
                    if current_row is not None:
                        close()
                    current_row = this
                    whole = cell(rows, unit, start)
                    if whole != current_unit:
                        current_unit = whole
                        state = cell(rows, entry, start)
                        if state[0] is None:
                            state = None
                            states = {None: (START[0], cell(rows, [peak], start)[0])}
                for i in range(start, end):
                    if olds[i]:
                        continue
                    time, lot = times[i], lots[i]
                    if state is None:
                        advance(states, time, lot)
                        state = certain(states)
                    elif lot != state[1] and time >= state[0]:
                        state = (time, lot)
            if len(done) >= 10_000:
                yield flush()
        if current_row is not None:
            close()
        if done:
            yield flush()

    return fold


def run_summaries(key: str):
    """One row per key and task: the summary of a key's sorted events.

    The columns come as the key, order, date and count. Only the events after the
    last change of date matter to the run at the end, so a batch costs a few array
    operations and what is carried between batches has constant size.
    """

    def fold(batches):
        out = []
        current, state, shape = None, None, None

        def rows_out():
            arrays = [pa.array(c, k) for c, k in zip(zip(*out), shape)]
            names = [key, "last_order", "first_date", "tail_date", "tail_count", "whole"]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for rows in batches:
            if rows.num_rows == 0:
                continue
            if shape is None:
                kinds = [rows.schema.field(n).type for n in (key, "_order", "_date")]
                shape = [*kinds, kinds[2], pa.int64(), pa.bool_()]
            counts = rows.column("_count").to_numpy(zero_copy_only=False)
            for start, end in stretches(rows, [key]):
                (this,) = cell(rows, [key], start)
                part = rows.slice(start, end - start)
                runs = list(stretches(part, ["_date"]))
                (first,) = cell(part, ["_date"], 0)
                (last,) = cell(part, ["_date"], end - start - 1)
                (order,) = cell(part, ["_order"], end - start - 1)
                tail = int(counts[start + runs[-1][0] : end].sum())
                if state is not None and this == current:
                    goes_on = len(runs) == 1 and first == state[2]
                    tail += state[3] if goes_on else 0
                    state = (order, state[1], last, tail, goes_on and state[4])
                    continue
                if state is not None:
                    out.append((current, *state))
                current, state = this, (order, first, last, tail, len(runs) == 1)
            if len(out) >= 10_000:
                yield rows_out()
        if state is not None:
            out.append((current, *state))
        if out:
            yield rows_out()

    return fold
