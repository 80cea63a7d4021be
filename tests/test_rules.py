"""Hand-written sequences for one key, through batch and streaming plans."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.admission import accepted_only, admit, late_only
from tidemark.operators.daily import daily_endpoints, fill_daily
from tidemark.operators.metrics import trailing_metrics
from tidemark.operators.runs import final_count, running_count
from tidemark.plans.product import product_result
from tidemark.schema import SeriesSpec
from tidemark.streaming.updates import newest_updates, product_updates, run_updates

SPEC = SeriesSpec(
    level="sold", price="price", counter="reviews", order="arrival", scale=2
)
# 1970-04-11, so that a day number of the tests is a small positive one.
BASE = 100


def at(day, seconds=0):
    """Epoch second in a UTC+8 day."""
    return (BASE + day) * 86400 - 8 * 3600 + seconds


def frame(spark, events, key="p"):
    """events: (day, batch, sold in units or reviews)."""
    rows = []
    for i, (day, batch, value) in enumerate(events):
        cents = round(value * 100)
        rows.append((key, i, at(day, i), batch, cents, 1000, int(value)))
    return spark.createDataFrame(
        rows,
        "pid string, arrival long, ts long, batch long, sold long, price long, "
        "reviews long",
    )


def level_series(spark, events, name="sold", scale=100):
    accepted = accepted_only(frame(spark, events), SPEC)
    daily = fill_daily(daily_endpoints(accepted, SPEC), SPEC)
    rows = daily.orderBy("day").select(name).collect()
    return [r[0] / scale for r in rows]


CASES = {
    "first_only": ([(1, 1, 5.0)], [5.0] * 30, True),
    "same_day_replace": ([(1, 1, 5.0), (1, 2, 6.0)], [5.0] * 29 + [6.0], True),
    "next_day": ([(1, 1, 5.0), (2, 2, 8.0)], [5.0, 8.0], True),
    "gap_exact": ([(1, 1, 10.0), (4, 2, 16.0)], [10, 12, 14, 16], True),
    "gap_rounded": ([(1, 1, 1.0), (4, 2, 2.0)], [1.0, 1.33, 1.66, 2.0], True),
    "gap_then_update": (
        [(1, 1, 10.0), (4, 2, 16.0), (4, 3, 99.0)],
        [10, 12, 14, 99],
        True,
    ),
    "prev_day_update": (
        [(1, 1, 5.0), (1, 2, 10.0), (4, 3, 16.0)],
        [5, 10, 12, 14, 16],
        True,
    ),
    "dup_batch": ([(1, 1, 5.0), (2, 1, 9.0)], [5.0] * 30, False),
    "dup_then_older": (
        [(1, 1, 5.0), (3, 1, 9.0), (2, 2, 7.0)],
        [5.0, 7.0],
        True,
    ),
    "late": ([(2, 1, 5.0), (1, 2, 9.0)], [5.0] * 30, False),
    "batch_returns": ([(1, 1, 5.0), (2, 2, 6.0), (3, 1, 7.0)], [5, 6, 7], True),
    "long_gap": ([(1, 1, 0.0), (41, 2, 40.0)], [float(v) for v in range(11, 41)], True),
}


@pytest.mark.parametrize("name", list(CASES))
def test_sequence_in_batch(spark, name):
    events, tail, valid = CASES[name]
    values = level_series(spark, events)
    assert len(values) == 30
    assert values[-len(tail):] == tail
    result = product_result(frame(spark, events), SPEC).collect()
    assert [r["valid"] for r in result] == [valid]
    assert (result[0]["metrics"] is not None) == valid
    assert (result[0]["latest"] is not None) == valid


@pytest.mark.parametrize("name", list(CASES))
def test_sequence_in_state(spark, name):
    events, tail, valid = CASES[name]
    updates = product_updates(frame(spark, events), SPEC, None, ["reviews", "sold"])
    newest = newest_updates(updates, "pid", "arrival").collect()[0]
    assert newest["valid"] == valid
    batch = product_result(frame(spark, events), SPEC).collect()[0]
    assert newest["metrics"] == batch["metrics"]


def test_integer_gap(spark):
    up = level_series(spark, [(1, 1, 10), (4, 2, 15)], "reviews", 1)
    down = level_series(spark, [(1, 1, 10), (4, 2, 3)], "reviews", 1)
    assert up[-4:] == [10, 11, 13, 15]
    assert down[-4:] == [10, 7, 5, 3]


def test_negative_tie_rounds_away_from_zero(spark):
    # -0.01 over 2 days: a step of -0.005.
    assert level_series(spark, [(1, 1, 1.0), (3, 2, 0.99)])[-3:] == [1.0, 0.99, 0.99]


def test_stale_edge(spark):
    events = frame(spark, [(1, 1, 5.0)])
    limit = 14 * 86400
    exact = admit(events, SPEC, as_of=at(1) + limit).collect()
    over = admit(events, SPEC, as_of=at(1) + limit + 1).collect()
    assert [r["status"] for r in exact + over] == ["accepted", "stale"]
    per_row = admit(events, SPEC, as_of=F.col("ts") + limit + 1).collect()
    assert per_row[0]["status"] == "stale"


def test_equal_time_new_batch_is_accepted(spark):
    rows = [("p", 0, 500, 1), ("p", 1, 500, 2), ("p", 2, 499, 3)]
    df = spark.createDataFrame(rows, "pid string, arrival long, ts long, batch long")
    got = {r["arrival"]: r["status"] for r in admit(df, SPEC).collect()}
    assert got == {0: "accepted", 1: "accepted", 2: "late"}
    assert {r["arrival"] for r in late_only(df, SPEC).collect()} == {0, 1}


def test_initial_batch_zero_is_a_duplicate(spark):
    rows = [("p", 0, 500, 0), ("p", 1, 500, 2)]
    df = spark.createDataFrame(rows, "pid string, arrival long, ts long, batch long")
    for mode in ("fold", "monotone"):
        got = {r["arrival"]: r["status"] for r in admit(df, SPEC, mode=mode).collect()}
        assert got == {0: "duplicate_batch", 1: "accepted"}


@pytest.mark.parametrize("mode", ["fold", "monotone"])
def test_null_time_or_batch_is_an_error(spark, mode):
    schema = "pid string, arrival long, ts long, batch long"
    for row in (("p", 0, None, 1), ("p", 0, 500, None)):
        df = spark.createDataFrame([row], schema)
        for as_of in (None, 600):
            with pytest.raises(PySparkException):
                admit(df, SPEC, as_of, mode).collect()


def test_growth_from_zero(spark):
    events = frame(spark, [(1, 1, 0.0), (2, 2, 8.0)])
    daily = fill_daily(daily_endpoints(events, SPEC), SPEC)
    row = trailing_metrics(daily, SPEC).collect()[0]
    assert row["sold_last_1_pop"] == 0.0
    assert row["sold_last_1"] == 8.0
    assert row["gmv_last_1"] == 80.0


def test_null_key_is_a_group(spark):
    events = frame(spark, [(1, 1, 5.0), (2, 2, 8.0)], None).unionByName(
        frame(spark, [(1, 1, 1.0)], "q")
    )
    for limit in (None, 1):
        got = product_result(events, SPEC, rows_per_chunk=limit).collect()
        assert {r["pid"]: r["metrics"]["sold_last_1"] for r in got} == {
            None: 8.0,
            "q": 1.0,
        }
        assert all(r["latest"] is not None for r in got)


def test_short_series_is_refused(spark):
    daily = fill_daily(daily_endpoints(frame(spark, [(1, 1, 5.0)]), SPEC), SPEC)
    with pytest.raises(ValueError):
        trailing_metrics(daily, SPEC.with_(days=7))


RUNS = {
    ("d1", "d1", "d2", "d2", "d2"): ("d2", 3),
    ("d1", "d2", "d1"): ("d1", 1),
    ("d2", "d1"): ("d1", 1),
    ("d1", "d1"): ("d1", 2),
}


@pytest.mark.parametrize("dates", list(RUNS))
def test_runs(spark, dates):
    rows = [("s", i, d, 1) for i, d in enumerate(dates)]
    df = spark.createDataFrame(rows, "shop string, arrival long, date string, n int")
    args = ("shop", "date", "arrival", "n")
    final = final_count(df, *args).collect()[0]
    assert (final["date"], final["run_count"]) == RUNS[dates]
    for limit in (None, 1):
        history = running_count(df, *args, rows_per_chunk=limit)
        last = history.orderBy(F.desc("arrival")).first()
        assert (last["date"], last["run_count"]) == RUNS[dates]
    state = newest_updates(run_updates(df, *args), "shop", "arrival").collect()[0]
    assert (state["date"], state["run_count"]) == RUNS[dates]
