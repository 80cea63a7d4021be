"""The shape of the plans: what reaches the scan, what is shuffled, and how."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.operators.admission import admit, drop_stale_stored
from tidemark.operators.chunks import assign_chunks
from tidemark.plans import tables
from tidemark.plans.product import product_metrics, product_result
from tidemark.plans.tables import EVENT_SPEC, SNAPSHOT

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(
        "simple"
    )
    return df._jdf.queryExecution().explainString(mode)


def shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)


def read_schema(plan: str) -> str:
    return re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)


def test_flagship_plan(spark):
    plan = plan_of(contract.queries()["product_metrics"](spark, SF_DIR))
    # The bound on the event time and the four columns needed reach Parquet.
    assert "GreaterThanOrEqual(ts,2024-01-17T00:00)" in plan
    columns = {c.split(":")[0] for c in read_schema(plan).split(",")}
    assert columns == {"event_id", "ts", "user_id", "value"}
    # One shuffle of pre-aggregated (key, batch) rows, one by key for the rest.
    assert len(shuffles(plan)) == 2
    assert "Python" not in plan and "Arrow" not in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_the_staleness_bound_reaches_the_scan(spark):
    plan = plan_of(contract.queries()["drop_stale_pushed"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-17T00:00)" in plan
    numbers = spark.range(3).selectExpr("id", "timestamp_seconds(1706659200 - 1209600 + id - 1) AS seen")
    assert drop_stale_stored(numbers, "seen", SNAPSHOT).count() == 2
    assert drop_stale_stored(numbers.selectExpr("unix_seconds(seen) AS s"), "s", SNAPSHOT).count() == 2


def test_general_plan(spark):
    events = tables.observations(tables.fresh_events(spark, SF_DIR))
    plan = plan_of(product_metrics(events, EVENT_SPEC, SNAPSHOT))
    assert plan.count("ArrowEvalPython") == 1
    assert "SortAggregate" not in plan
    # Admission by key, then (key, day) pre-aggregated, then by key.
    assert len(shuffles(plan)) == 3
    assert "event_type" not in read_schema(plan)


def test_stale_rows_skip_the_shuffle(spark):
    rows = tables.observations(tables.read_events(spark, SF_DIR))
    plan = plan_of(admit(rows, EVENT_SPEC, SNAPSHOT))
    fresh, stale = plan.split("ArrowEvalPython", 1)[1].split("FileScan", 1)
    assert "Exchange" in fresh and "Exchange" not in stale


def test_result_folds_narrow_rows_once(spark):
    events = tables.observations(tables.read_events(spark, SF_DIR))
    plan = plan_of(product_result(events, EVENT_SPEC, F.col("arrival_time")))
    assert plan.count("ArrowEvalPython") == 1
    fold = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "obs_date" not in fold and "event_type" not in fold


def test_fold_keeps_its_order_under_aggregation(spark):
    """Neither the sort nor the rows below the fold are optimized away."""
    rows = tables.observations(tables.read_events(spark, SF_DIR))
    judged = admit(rows, EVENT_SPEC, F.lit(SNAPSHOT))
    plan = plan_of(judged.where("event_id > 5000").groupBy("status").count())
    fold = plan.index("ArrowEvalPython")
    assert "Sort [pid" in plan[fold:]
    assert "event_id" not in " ".join(re.findall(r"PushedFilters: \[[^]]*\]", plan))
    whole = {r["event_id"]: r["status"] for r in judged.collect()}
    part = judged.where("event_id > 5000").collect()
    assert {r["event_id"]: r["status"] for r in part} == {
        k: v for k, v in whole.items() if k > 5000
    }


def test_run_count_reduces_before_the_shuffle(spark):
    plan = plan_of(contract.queries()["run_count_by_type"](spark, SF_DIR))
    assert "partial_max(arrival" in plan
    assert "partial_sum(" in plan


def test_hot_keys_are_windowed_by_chunk(spark):
    events = tables.observations(tables.read_events(spark, SF_DIR))
    cut = assign_chunks(events.select("pid", "arrival", "ts"), "pid", "arrival", 16)
    assert cut is not None
    sizes = cut.rows.groupBy("pid", "_chunk").count().agg(F.max("count")).collect()
    assert sizes[0][0] <= 16
    plan = plan_of(contract.queries()["admit_late_only_chunked"](spark, SF_DIR))
    assert any("_chunk" in s for s in shuffles(plan))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_query_plans_a_cross_join(spark):
    streams = ("stream_",)
    for name, query in contract.queries().items():
        if name.startswith(streams):
            continue
        plan = plan_of(query(spark, SF_DIR))
        assert "CartesianProduct" not in plan, name
        assert "NestedLoopJoin" not in plan, name
