"""Set-based and chunked plans against the sequential model on random data."""

import random

import model
import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunks
from tidemark.operators.admission import admit, late_only
from tidemark.operators.daily import daily_endpoints, fill_daily
from tidemark.operators.runs import running_count
from tidemark.schema import SeriesSpec

SPEC = SeriesSpec(level="sold", price="price", counter="reviews", scale=2)
SCHEMA = (
    "pid long, arrival long, ts long, batch long, stale boolean, sold long, "
    "price long, reviews long, date string"
)


STYLES = ["drift", "reverse", "noise", "replay", "stuck", "weave"]


def history(seed, style, rows=400):
    """One hot key (0) with most rows and a few small ones."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        key = 0 if rng.random() < 0.7 else rng.randint(1, 4)
        ts = {
            "drift": 10**6 + i * 4000 + rng.randint(-40000, 40000),
            "reverse": 10**8 - i * 4000,
            "noise": rng.randint(1, 60) * 86400,
            "replay": 10**6 + (i % 100) * 4000,
            "stuck": 10**6 + i * 4000,
            "weave": 10**6 + (i + (i % 2) * -3) * 4000,
        }[style]
        batch = {
            "replay": 1 if rng.random() < 0.9 else rng.randint(1, 3),
            "stuck": 1 if rng.random() < 0.99 else 2,
            "weave": i // 2 % 2 + 1,
        }.get(style, rng.randint(1, 3))
        out.append(
            (
                key,
                i * 3 + 1,
                ts,
                batch,
                rng.random() < 0.05,
                rng.randint(0, 5000),
                rng.randint(0, 5000),
                rng.randint(0, 900),
                f"d{ts // 200000 % 3}",
            )
        )
    return out


def by_key(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("style", STYLES)
@pytest.mark.parametrize("limit", [None, 40, 3])
def test_admission(spark, style, limit):
    rows = history(style + str(limit), style)
    df = spark.createDataFrame(rows, SCHEMA)
    stale = F.when(F.col("stale"), F.col("ts") + 15 * 86400).otherwise(F.col("ts"))
    judged = admit(df, SPEC, as_of=stale, rows_per_chunk=limit).collect()
    got = {r["arrival"]: r["status"] for r in judged}
    expected = {}
    for group in by_key(rows).values():
        statuses = model.admit([(r[2], r[3], r[4]) for r in group])
        expected |= {r[1]: s for r, s in zip(group, statuses)}
    assert got == expected


def test_possible_events_are_never_missed():
    """Thinning keeps every event that any entry state makes acceptable."""
    from tidemark.workers import advance, certain

    rng = random.Random(9)
    for _ in range(300):
        events = [(rng.randint(1, 12), rng.randint(1, 4)) for _ in range(12)]
        low, high = 2, 8
        states, kept, settled = {None: (low, high)}, [], []
        for time, lot in events:
            kept.append(advance(states, time, lot))
            settled.append(certain(states))
        for last_ts in range(low, high + 1):
            for last_batch in range(1, 6):
                state = (last_ts, last_batch)
                for (time, lot), possible, known in zip(events, kept, settled):
                    if lot != state[1] and time >= state[0]:
                        assert possible
                        state = (time, lot)
                    assert known is None or known == state


def test_stuck_batch_leaves_few_events_to_walk(spark, monkeypatch):
    """A hot key repeating one batch is not walked row by row in one task."""
    from tidemark.operators import admission

    walked = []
    real = admission._exits

    def counting(rows, spec, unit):
        if unit == ["_stretch"]:
            walked.append(rows.count())
        return real(rows, spec, unit)

    monkeypatch.setattr(admission, "_exits", counting)
    rows = [(0, i, 1000 + i, 7) for i in range(3000)]
    rows += [(0, 3000 + i, 500 + i % 300, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "pid long, arrival long, ts long, batch long")
    judged = admit(df, SPEC, rows_per_chunk=100)
    statuses = [r["status"] for r in judged.orderBy("arrival").collect()]
    assert statuses == model.admit([(r[2], r[3], False) for r in rows])
    assert walked and walked[0] < 200


@pytest.mark.parametrize("seed", [1, 2])
def test_series(spark, seed):
    rows = history(seed, "drift")
    df = spark.createDataFrame(rows, SCHEMA)
    accepted = admit(df, SPEC).where("status = 'accepted'")
    daily = fill_daily(daily_endpoints(accepted, SPEC), SPEC).orderBy("pid", "day")
    got = {}
    for r in daily.collect():
        got.setdefault(r["pid"], []).append((r["sold"], r["price"], r["reviews"]))
    for key, group in by_key(rows).items():
        statuses = model.admit([(r[2], r[3], False) for r in group])
        kept = [r for r, s in zip(group, statuses) if s == "accepted"]
        days = [(r[2] + 28800) // 86400 for r in kept]
        columns = [
            model.series(list(zip(days, [r[i] for r in kept])), whole=i == 7)
            for i in (5, 6, 7)
        ]
        assert got[key] == list(zip(*columns))


@pytest.mark.parametrize("limit", [None, 40, 3])
def test_running_count(spark, limit):
    rows = [r + (1,) for r in history("runs", "drift")]
    df = spark.createDataFrame(rows, SCHEMA + ", n long")
    counted = running_count(df, "pid", "date", "arrival", "n", rows_per_chunk=limit)
    got = {r["arrival"]: r["run_count"] for r in counted.collect()}
    expected = {}
    for group in by_key(rows).values():
        lengths = model.runs([r[8] for r in group])
        expected |= {r[1]: n for r, n in zip(group, lengths)}
    assert got == expected


@pytest.mark.parametrize("limit", [40, 3])
def test_late_only(spark, limit):
    df = spark.createDataFrame(history("late", "drift"), SCHEMA)
    whole = {r["arrival"] for r in late_only(df, SPEC, None).collect()}
    cut = {r["arrival"] for r in late_only(df, SPEC, limit).collect()}
    assert cut == whole and 0 < len(whole) < df.count()


def test_uneven_order_is_cut_until_chunks_fit(spark):
    """Nearly all rows sit in a sliver of the order range."""
    rows = [(0, i) for i in range(500)] + [(0, 10**12)] + [(1, 5)]
    df = spark.createDataFrame(rows, "pid long, arrival long")
    cut = chunks.assign_chunks(df, "pid", "arrival", 20)
    sizes = cut.rows.groupBy("pid", chunks.CHUNK).count().collect()
    assert sum(r["count"] for r in sizes) == 502
    assert max(r["count"] for r in sizes) <= 20
    assert cut.hot.select("pid").distinct().collect() == [(0,)]
    # Chunk numbers rise with the order.
    pairs = [tuple(r) for r in cut.hot.select("arrival", chunks.CHUNK).collect()]
    numbers = [c for _, c in sorted(pairs)]
    assert numbers == sorted(numbers)


def test_no_hot_keys_means_no_chunks(spark):
    df = spark.createDataFrame([(0, 1), (0, 2)], "pid long, arrival long")
    assert chunks.assign_chunks(df, "pid", "arrival", 2) is None
    assert chunks.assign_chunks(df, "pid", "arrival", None) is None
