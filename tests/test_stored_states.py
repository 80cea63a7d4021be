"""States in files and in streams: increments, retries, bootstraps, ordering."""

import heapq
import random
import time
from pathlib import Path

import model
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import (
    advance_series,
    newest_state,
    state_metrics,
    state_series,
)
from tidemark.plans import tables
from tidemark.plans.product import product_result
from tidemark.plans.stream_queries import QUERIES
from tidemark.plans.tables import EVENT_SPEC
from tidemark.schema import METRIC_NAMES, SeriesSpec
from tidemark.session import shared_dir
from tidemark.sources.results import write_updates
from tidemark.streaming import fanout
from tidemark.streaming.fanout import RunSpec, both_results, newest_results
from tidemark.streaming.processors import OrderedRunProcessor
from tidemark.streaming.updates import newest_updates, ordered_run_updates, product_states, product_updates

SF_DIR = "/root/testdata/sf0.01"
SPEC = SeriesSpec(level="sold", price="price", counter="reviews", scale=2)
SHAPE = "pid long, arrival long, ts long, batch long, sold long, price long, reviews long, date string, n int"


def events(seed, count=400):
    rng = random.Random(seed)
    rows, day = [], 0
    for i in range(count):
        day += rng.choice([0, 0, 0, 0, 1, 0, 3]) if rng.random() < 0.3 else 0
        key = rng.choice([0, 0, 0, 1, 2, 3, None])
        ts = 86400 * (day + rng.choice([0, 0, 1, -1])) + rng.randint(0, 80000) + 10**6
        rows.append((key, i, ts, rng.randint(1, 3), rng.randint(0, 900), rng.randint(0, 900), rng.randint(0, 99), f"d{day // 2}", 1))
    return rows


def expected_series(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        statuses = model.admit([(r[2], r[3], False) for r in own])
        kept = [r for r, s in zip(own, statuses, strict=True) if s == "accepted"]
        days = [(r[2] + 28800) // 86400 for r in kept]
        columns = [model.series(list(zip(days, [r[i] for r in kept], strict=True)), i == 6) for i in (4, 5, 6)]
        out[key] = (statuses[-1] == "accepted", list(zip(*columns, strict=True)))
    return out


@pytest.mark.parametrize("seed,slices", [(1, 2), (2, 5), (3, 9)])
def test_slices_move_a_state_as_one_pass_does(spark, tmp_path, seed, slices):
    rows = events(seed)
    cuts = sorted(random.Random(seed).sample(range(1, len(rows)), slices - 1))
    state = None
    for number, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        part = spark.createDataFrame(rows[low:high], SHAPE)
        moved = advance_series(state, part, SPEC)
        moved.write.parquet(str(tmp_path / f"version={number}"))
        written = spark.read.parquet(str(tmp_path / f"version={number}"))
        # A version holds the keys of its slice and no others.
        assert sorted({r["pid"] for r in written.collect()}, key=repr) == sorted({r[0] for r in rows[low:high]}, key=repr)
        state = newest_state(spark.read.parquet(str(tmp_path)), "pid")
    got = {}
    for r in state_series(state, SPEC).orderBy("pid", "day").collect():
        got.setdefault(r["pid"], []).append((r["sold"], r["price"], r["reviews"]))
    expected = expected_series(rows)
    assert got == {k: v for k, (_, v) in expected.items()}
    assert {r["pid"]: r["valid"] for r in state.collect()} == {k: v for k, (v, _) in expected.items()}


def test_an_empty_slice_and_a_key_without_accepted_events(spark):
    none = spark.createDataFrame([], SHAPE)
    assert advance_series(None, none, SPEC).collect() == []
    late = spark.createDataFrame([(5, 1, -10, 1, 1, 1, 1, "d", 1)], SHAPE)
    (row,) = advance_series(None, late, SPEC).collect()
    assert (row["valid"], row["last_day"], row["sold"]) == (False, None, [])
    state = advance_series(None, late, SPEC)
    assert state_series(state, SPEC).collect() == []
    assert state_metrics(state, SPEC, "keep_last").first()["metrics"] is None
    (row,) = advance_series(state, spark.createDataFrame([(5, 2, 10, 1, 7, 1, 1, "d", 1)], SHAPE), SPEC).collect()
    assert row["valid"] and row["sold"] == [7] * 30


def test_a_retried_batch_gives_the_same_files(spark, tmp_path, monkeypatch):
    """Batches of a fan-out, one of them run twice, and states folded to full versions."""
    monkeypatch.setattr(fanout, "FULL_EVERY", 2)
    rows = events(7)
    write = both_results(str(tmp_path), SPEC, RunSpec("pid", "date", "arrival", "n"), None, "null")
    cuts = [0, 90, 150, 151, 300, 400]
    for number, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        batch = spark.createDataFrame(rows[low:high], SHAPE)
        write(batch, number)
        if number in (1, 2, 4):
            before = [sorted(map(repr, spark.read.parquet(str(tmp_path / d)).collect())) for d in ("product", "run", "run-state")]
            write(batch, number)
            assert before == [
                sorted(map(repr, spark.read.parquet(str(tmp_path / d)).collect())) for d in ("product", "run", "run-state")
            ]
    got = {r["pid"]: r["run_count"] for r in newest_results(spark, str(tmp_path / "run"), "pid").collect()}
    assert got == {k: model.runs([r[7] for r in rows if r[0] == k])[-1] for k in {r[0] for r in rows}}
    whole = spark.createDataFrame(rows, SHAPE)
    expected = {r["pid"]: (r["valid"], r["metrics"]) for r in product_result(whole, SPEC).collect()}
    results = newest_results(spark, str(tmp_path / "product"), "pid")
    assert {r["pid"]: (r["valid"], r["metrics"]) for r in results.collect()} == expected
    assert results.select("metrics.*").columns == METRIC_NAMES


def drained(spark, updates, root):
    query = write_updates(updates, "parquet", f"{root}/out", f"{root}/checkpoint", interval=None)
    query.awaitTermination()
    return spark.read.schema(updates.schema).parquet(f"{root}/out/batch_id=*")


def test_one_key_larger_than_what_a_worker_holds(spark, tmp_path):
    """Rows of one key in random order, in runs far smaller than the key, over two batches."""
    rng = random.Random(4)
    rows = [("hot", i, f"d{i // 700 % 3}", 1) for i in range(6000)]
    held = [r for r in rows]
    for number, part in enumerate((held[:3500], held[3500:])):
        rng.shuffle(part)
        data = spark.createDataFrame(part, "shop string, arrival long, date string, n int")
        data.coalesce(1).write.parquet(str(tmp_path / "in" / f"part={number}"))
        time.sleep(0.1)
    shape = "shop string, arrival long, date string, n int"
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in/part=*")
    updates = ordered_run_updates(stream, "shop", "date", "arrival", "n", held_rows=200, block_rows=16)
    got = {r["arrival"]: r["run_count"] for r in drained(spark, updates, str(tmp_path)).collect()}
    assert got == dict(enumerate(model.runs([r[2] for r in rows])))


@pytest.mark.parametrize("on_reject", ["null", "keep_last"])
def test_columnar_states_equal_row_states(spark, on_reject):
    rows = tables.observations(tables.read_events(spark, SF_DIR))
    states = product_states(rows, EVENT_SPEC, F.col("arrival_time"), on_reject).collect()
    updates = product_updates(rows, EVENT_SPEC, F.col("arrival_time"), ["event_id"], on_reject, True)
    expected = {r["pid"]: (r["arrival"], r["valid"]) for r in newest_updates(updates, "pid", "arrival").collect()}
    assert {r["pid"]: (r["arrival"], r["valid"]) for r in states} == expected


def test_no_more_runs_are_merged_at_once_than_allowed(monkeypatch):
    """375 runs of a key, with orders that repeat: a block of each is never held."""
    seen, merge = [], heapq.merge
    monkeypatch.setattr(heapq, "merge", lambda *runs, key: seen.append(len(runs)) or merge(*runs, key=key))
    rng = random.Random(8)
    rows = [{"order": i // 2, "date": f"d{i // 700 % 3}" if i % 900 else None, "count": 1} for i in range(6000)]
    rng.shuffle(rows)
    ordered = sorted(rows, key=lambda r: r["order"])
    for most in (256, 7):
        seen.clear()
        processor = OrderedRunProcessor(T.LongType(), 16, 4, False)
        processor.merged_runs = most
        processor.init(FakeStore())
        frames = (pd.DataFrame(rows[i : i + 1000]) for i in range(0, 6000, 1000))
        list(processor.handleInputRows(("hot",), frames, FakeStore()))
        frames = list(processor.handleExpiredTimer(("hot",), None, None))
        assert max(seen) <= most
        # No frame has more updates than rows that are held.
        assert max(map(len, frames)) <= 16
        got = pd.concat(frames)
        assert got["order"].tolist() == [r["order"] for r in ordered]
        assert got["run_count"].tolist() == model.runs([r["date"] for r in ordered])
        assert not processor.blocks.held and not processor.runs.held


class FakeStore:
    """A handle, its map, list and value states and the clock, held in memory."""

    def __init__(self):
        self.held, self.value = {}, None

    def getMapState(self, *_):
        return FakeStore()

    getListState = getValueState = getMapState

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]

    def appendValue(self, value):
        self.held[len(self.held)] = value

    def get(self):
        return list(self.held.values())

    def clear(self):
        self.held.clear()

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    def getCurrentProcessingTimeInMs(self):
        return 0

    def registerTimer(self, _):
        pass


def test_ordered_updates_of_null_keys_are_one_key(spark, tmp_path):
    rows = [(key, i, f"d{i // 40}", 1) for i, key in enumerate([None, 7, 2**60 + 1] * 100)]
    shape = "shop long, arrival long, date string, n int"
    spark.createDataFrame(rows, shape).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(shape).parquet(str(tmp_path / "in"))
    updates = ordered_run_updates(stream, "shop", "date", "arrival", "n", held_rows=20, block_rows=8)
    got = {(r["shop"], r["arrival"]): r["run_count"] for r in drained(spark, updates, str(tmp_path)).collect()}
    expected = {}
    for key in (None, 7, 2**60 + 1):
        own = [r for r in rows if r[0] == key]
        expected |= dict(zip([(key, r[1]) for r in own], model.runs([r[2] for r in own]), strict=True))
    assert got == expected


def test_slices_come_in_as_many_files_as_there_are_cores(spark, tmp_path):
    """A slice is one micro-batch, however many files it has."""
    expected = sorted(map(repr, QUERIES["stream_fan_out"](spark, SF_DIR).collect()))
    assert expected
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("fan-out-*"))
    assert sorted(map(repr, QUERIES["stream_fan_out"](spark, str(tmp_path)).collect())) == expected
    [root] = set(shared.glob("fan-out-*")) - before
    cores = spark.sparkContext.defaultParallelism
    for number in range(3):
        assert len(list(root.glob(f"in/slice={number}/part-*"))) == cores > 1
    assert len(list(root.glob("product/batch_id=*"))) == 3
