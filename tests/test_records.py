"""Places, sieves, summaries, closed forms and checked admission on odd data."""

import random

import model
import pytest
from pyspark.sql import functions as F
from test_model import SCHEMA, SPEC, STYLES, history
from test_plans import plan_of

from tidemark.operators.admission import accepted_only, admit, late_only, unique_order
from tidemark.operators.closed_form import closed_form_metrics
from tidemark.operators.daily import daily_endpoints, fill_daily
from tidemark.operators.locate import with_place
from tidemark.operators.metrics import trailing_metrics
from tidemark.operators.sieve import matching, sieve, sifted
from tidemark.operators.summaries import SUMMARY, merge_summaries, run_summary, summarised_count
from tidemark.plans import tables
from tidemark.plans.catalog import QUERIES
from tidemark.plans.product import latest_accepted, latest_located, product_result, product_result_located
from tidemark.plans.tables import EVENT_SPEC
from tidemark.plans.whole_queries import _placed

SF_DIR = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# -- sieve and places --------------------------------------------------------------


def test_a_sieve_loses_no_key_and_keeps_few_others(spark):
    rows = spark.range(20000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"))
    keys = rows.where("id % 50 = 7")
    bitmaps = sieve(keys, ["id", "s"]).cache()
    pages = bitmaps.first()["_pages"]
    left = sifted(rows, ["id", "s"], bitmaps, pages)
    assert left.columns == rows.columns
    got = {r["id"] for r in left.collect()}
    assert {r["id"] for r in keys.collect()} <= got and len(got) < 2400
    wanted = keys.where("s IS NOT NULL").select("id", "s").cache()
    for limit in (10**6, 0):
        assert {r["id"] for r in matching(rows, wanted, ["id", "s"], limit).collect()} == {
            i for i in range(20000) if i % 50 == 7 and i % 3
        }


def test_wide_rows_are_sifted_before_they_are_shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = latest_located(_placed(spark, SF_DIR), EVENT_SPEC, F.col("arrival_time"), broadcast_rows=0)
        plan = plan_of(latest)
        got = {r["pid"]: r["event_id"] for r in latest.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The wide side of the join: scan, place, bitmap lookup, filter, and only then an exchange.
    wide = plan[plan.index("Exchange hashpartitioning") : plan.index("FileScan parquet")]
    assert "BroadcastHashJoin" in wide and "Filter" in wide and "_bits" in wide
    expected = {r["pid"]: r["event_id"] for r in QUERIES["latest_record_whole"](spark, SF_DIR).collect()}
    assert got == expected


def test_repeated_arrivals_give_one_row_a_key(spark, tmp_path):
    rows = [(1, 100, "2024-01-05 00:00:00", 1), (1, 100, "2024-01-06 00:00:00", 2), (1, 100, "2024-01-06 00:00:00", 2)]
    rows += [(2, 7, "2024-01-05 00:00:00", 1), (None, 8, "2024-01-05 00:00:00", 3)]
    spec = EVENT_SPEC.with_(key="pid", ts="ts", batch="batch", order="arrival", level="m", price="m2", counter="m3")
    data = spark.createDataFrame(rows, "pid long, arrival long, seen string, batch long")
    data = data.select("*", F.unix_seconds(F.col("seen").cast("timestamp")).alias("ts"))
    data = data.select("*", *[F.lit(5).cast("long").alias(n) for n in ("m", "m2", "m3")])
    data.coalesce(1).write.parquet(str(tmp_path / "t"))
    placed = with_place(spark.read.parquet(str(tmp_path / "t")))
    for limit in (100, 0):
        for mode in ("fold", "checked"):
            latest = latest_located(placed, spec, None, mode, broadcast_rows=limit)
            assert sorted([r["pid"] for r in latest.collect()], key=repr) == [1, 2, None]
        result = product_result_located(placed, spec, on_reject="keep_last", broadcast_rows=limit).collect()
        assert sorted([r["pid"] for r in result], key=repr) == [1, 2, None]
        assert all(r["latest"]["pid"] == r["pid"] for r in result)


def test_shared_arrivals_multiply_no_result(spark):
    rows = [(1, 100, 1000, 1, 5, 5, 5), (1, 100, 1001, 2, 5, 5, 5), (1, 100, 1002, 3, 5, 5, 5), (2, 7, 1000, 1, 5, 5, 5)]
    df = spark.createDataFrame(rows, "pid long, arrival long, ts long, batch long, sold long, price long, reviews long")
    for on_reject in ("null", "keep_last"):
        assert sorted(r["pid"] for r in product_result(df, SPEC, on_reject=on_reject).collect()) == [1, 2]
    assert sorted(r["pid"] for r in latest_accepted(df, SPEC).collect()) == [1, 2]


def test_order_is_made_unique_or_refused(spark):
    rows = [(0, 5, 100, 5), (0, 5, 200, 3), (0, 5, 300, 4), (1, 5, 1, 1)]
    df = spark.createDataFrame(rows, "pid long, arrival long, ts long, batch long")
    with pytest.raises(ValueError, match="share one arrival"):
        unique_order(df, SPEC)
    assert unique_order(df.where("ts <= 100"), SPEC).count() == 2
    ranked = unique_order(df, SPEC, "rank", ("ts",))
    assert ranked.columns == df.columns
    assert len({r["arrival"] for r in ranked.collect()}) == 4
    judged = {r["ts"]: r["status"] for r in admit(ranked, SPEC, mode="checked").collect()}
    assert judged == {100: "accepted", 200: "accepted", 300: "accepted", 1: "accepted"}
    with pytest.raises(ValueError):
        unique_order(df, SPEC, "guess")


# -- checked admission -----------------------------------------------------------------


@pytest.mark.parametrize("style", STYLES)
@pytest.mark.parametrize("size", [None, 13])
def test_checked_admission_equals_the_model(spark, style, size):
    rows = history(11, style)
    rows += [(9, 3 * i, 10**6 + 5000 * i, i + 1, False, 1, 1, 1, "d") for i in range(60)]
    rows += [(8, i, 100 * (i + 1), b, False, 1, 1, 1, "d") for i, b in enumerate((5, 3, 4))]
    rows += [(7, i, t, b, False, 1, 1, 1, "d") for i, (t, b) in enumerate([(50, 1), (50, 2), (50, 1)])]
    rows += [(6, i, t, b, False, 1, 1, 1, "d") for i, (t, b) in enumerate([(5, -2), (6, -1), (7, 0), (8, 1)])]
    rows += [(5, i, t, b, False, 1, 1, 1, "d") for i, (t, b) in enumerate([(-5, 1), (-4, 2), (3, 3)])]
    keys, expected = {}, {}
    for r in rows:
        keys.setdefault(r[0], []).append(r)
    for key, held in keys.items():
        held.sort(key=lambda r: r[1])
        statuses = model.admit([(r[2], r[3], r[4]) for r in held])
        expected |= {(key, r[1]): s for r, s in zip(held, statuses, strict=True)}
    df = frame(spark, rows).withColumn("now", F.when(F.col("stale"), F.col("ts") + 10**7).otherwise(F.col("ts")))
    judged = admit(df, SPEC, F.col("now"), "checked", size)
    assert {(r["pid"], r["arrival"]): r["status"] for r in judged.collect()} == expected
    kept = accepted_only(df, SPEC, F.col("now"), "checked", size)
    assert {(r["pid"], r["arrival"]) for r in kept.collect()} == {k for k, s in expected.items() if s == "accepted"}


@pytest.mark.parametrize("mode", ["fold", "monotone", "checked"])
def test_every_mode_refuses_a_null_time(spark, mode):
    rows = [(1, 1, 100, 1), (1, 2, None, 2), (1, 3, 300, 3)]
    df = spark.createDataFrame(rows, "pid long, arrival long, ts long, batch long")
    with pytest.raises(Exception, match="NULL"):
        accepted_only(df, SPEC, 400, mode).collect()
    with pytest.raises(Exception, match="NULL"):
        late_only(df, SPEC).collect()


# -- summaries ---------------------------------------------------------------------------


def test_summaries_merge_in_any_grouping(spark):
    rng = random.Random(2)
    events = [(rng.choice([0, 0, 0, 1, 2, None]), i, rng.choice(["a", "a", "a", "b", None]), rng.randint(1, 3)) for i in range(900)]
    df = spark.createDataFrame(events, "pid long, arrival long, date string, n int")
    expected = {}
    for pid, _, date, n in events:
        last, total = expected.get(pid, ("", 0))
        expected[pid] = (date, total + n if date == last else n)
    whole = summarised_count(df, "pid", "date", "arrival", "n").collect()
    assert {r["pid"]: (r["date"], r["run_count"]) for r in whole} == expected
    # Stretches cut at random, summed up apart, merged pairwise and all at once.
    cuts = sorted(rng.sample(range(900), 6))
    parts = None
    for low, high in zip([0, *cuts], [*cuts, 900], strict=True):
        part = merge_summaries(run_summary(df.where(F.col("arrival").between(low, high - 1)), "pid", "date", "arrival", "n"), "pid")
        parts = part if parts is None else parts.unionByName(part)
        if rng.random() < 0.5:
            parts = merge_summaries(parts, "pid")
    merged = merge_summaries(parts, "pid").collect()
    assert {r["pid"]: (r["tail_date"], r["tail_count"]) for r in merged} == expected
    assert run_summary(df.limit(0), "pid", "date", "arrival", "n").collect() == []
    assert merge_summaries(run_summary(df.limit(0), "pid", "date", "arrival", "n"), "pid").columns == ["pid", "last_order", *SUMMARY]


def test_a_hot_key_is_several_stretches_and_rows_are_joined_to_nothing(spark):
    rows = tables.observations(tables.read_events(spark, SF_DIR)).withColumn("count", F.lit(1))
    # Small ranges are put together at run time unless that is off.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = run_summary(rows, "event_type", "obs_date", "arrival", "count")
        assert parts.count() > rows.select("event_type").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = plan_of(summarised_count(rows, "event_type", "obs_date", "arrival", "count"))
    assert "Join" not in plan and "rangepartitioning" in plan


# -- closed forms ---------------------------------------------------------------------------


@pytest.mark.parametrize("scale,seed", [(2, 1), (2, 2), (6, 3), (9, 4)])
def test_closed_forms_equal_the_sums_over_days(spark, scale, seed):
    rng = random.Random(seed)
    rows = []
    for key in range(40):
        day = rng.randint(0, 400)
        for i in range(rng.randint(1, 12)):
            day += rng.choice([0, 0, 1, 1, 2, 5, 29, 30, 31, 200])
            top = 10 ** (scale + rng.randint(0, 4))
            rows.append((key, i, 86400 * day + rng.randint(0, 50000), rng.randint(-top, top), rng.randint(-top, top), rng.randint(0, 9999)))
    df = spark.createDataFrame(rows, "pid long, arrival long, ts long, sold long, price long, reviews long")
    spec = SPEC.with_(scale=scale)
    ends = daily_endpoints(df.withColumn("ts", F.col("ts")), spec)
    expected = trailing_metrics(fill_daily(ends, spec), spec)
    got = closed_form_metrics(ends, spec)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert "Generate" not in plan_of(got) and "Generate" in plan_of(expected)
