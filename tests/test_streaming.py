"""Streams on files: parity with batch, restart, expiry, emission rules."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F
from sample import SAMPLE, SAMPLE_DOCUMENT, message, write_lines

from tidemark.functions.documents import from_document
from tidemark.plans.product import (
    OBSERVATION_SPEC,
    prepare,
    product_result,
    result_document,
)
from tidemark.plans.shop import run_input, shop_runs
from tidemark.sources.observations import read_observations
from tidemark.sources.quality import split_valid
from tidemark.sources.results import encode_product, write_updates
from tidemark.plans.queries import QUERIES
from tidemark.streaming.job import JobConfig, run_job, start_job
from tidemark.streaming.updates import product_updates, run_updates

DAY = 86400


def feed(seed, files, per_file, products=5):
    """Files of messages whose arrival numbers rise from file to file."""
    rng = random.Random(seed)
    arrival = 0
    out = []
    for _ in range(files):
        lines = []
        for _ in range(per_file):
            arrival += 1
            days = arrival // 6 + rng.randint(-2, 0)
            lines.append(
                message(
                    arrival,
                    pid=f"p{rng.randint(1, products)}",
                    shop_name=f"s{rng.randint(1, 3)}",
                    timestamp=SAMPLE["timestamp"] + days * DAY + rng.randint(0, 3000),
                    update_time=f"2020-07-{rng.randint(1, 3):02d} 0{rng.randint(0, 2)}:00:00",
                    sold=rng.randint(0, 500) / 100,
                    price=rng.randint(0, 500) / 100,
                    review_number=rng.randint(0, 300),
                )
            )
        rng.shuffle(lines)
        out.append(lines)
    return out


def config(tmp_path, **changes):
    settings = {
        "source": str(tmp_path / "in"),
        "source_format": "json",
        "product_target": str(tmp_path / "product"),
        "run_target": str(tmp_path / "run"),
        "sink_format": "json",
        "checkpoint_root": str(tmp_path / "checkpoint"),
        "source_options": {"maxFilesPerTrigger": "1"},
        "interval": None,
        "clock": "arrival",
        "name": "job" + tmp_path.name.replace("-", ""),
    }
    return JobConfig(**(settings | changes))


def updates_in(spark, folder):
    """Written JSON rows with the micro-batch they came in."""
    rows = spark.read.text(f"{folder}/batch_id=*").select(
        "value",
        F.regexp_extract("_metadata.file_path", r"batch_id=(\d+)", 1)
        .cast("int")
        .alias("batch"),
    )
    return [(r["batch"], json.loads(r["value"])) for r in rows.collect()]


def put(tmp_path, index, lines):
    write_lines(tmp_path / "in", f"part-{index:03d}.json", lines)
    time.sleep(0.02)


def last_documents(spark, tmp_path):
    """The newest document per product over all updates, by its timestamps."""
    newest = {}
    for batch, row in updates_in(spark, tmp_path / "product"):
        if row["infos"] is None:
            continue
        document = json.loads(row["infos"])
        mark = (batch, document["timestamp"])
        if document["pid"] not in newest or mark >= newest[document["pid"]][0]:
            newest[document["pid"]] = (mark, document)
    return {pid: document for pid, (_, document) in newest.items()}


def batch_documents(spark, tmp_path):
    rows, _ = split_valid(read_observations(spark, str(tmp_path / "in"), "json"))
    result = product_result(
        prepare(rows), OBSERVATION_SPEC, F.col("arrival_time"), on_reject="keep_last"
    )
    document = result_document(F.col("metrics"), F.col("latest"))
    texts = result.select(encode_product(document).alias("infos")).collect()
    documents = [json.loads(r["infos"]) for r in texts if r["infos"]]
    return {d["pid"]: d for d in documents}


def last_runs(spark, tmp_path):
    """Largest update per shop: runs only grow within their last batch."""
    newest = {}
    for batch, row in updates_in(spark, tmp_path / "run"):
        newest.setdefault(row["shop_name"], []).append((batch, json.loads(row["shop_agg"])))
    return newest


def test_job_with_restart_equals_batch(spark, tmp_path):
    files = feed(3, 4, 30)
    for i, lines in enumerate(files[:2]):
        put(tmp_path, i, lines)
    settings = config(tmp_path, rejects_target=str(tmp_path / "rejects"))
    run_job(spark, settings)
    for i, lines in enumerate(files[2:], 2):
        put(tmp_path, i, lines + ["{broken"])
    run_job(spark, settings)

    assert last_documents(spark, tmp_path) == batch_documents(spark, tmp_path)
    observed, rejects = split_valid(
        read_observations(spark, str(tmp_path / "in"), "json")
    )
    runs = last_runs(spark, tmp_path)
    for row in shop_runs(observed).collect():
        final = {"date": row["date"], "count": row["run_count"]}
        last_batch = max(b for b, _ in runs[row["shop_name"]])
        assert final in [v for b, v in runs[row["shop_name"]] if b == last_batch]
    # One run update per event.
    assert sum(len(v) for v in runs.values()) == observed.count()
    written = [row for _, row in updates_in(spark, tmp_path / "rejects")]
    assert [r["reason"] for r in written] == ["malformed"] * rejects.count()


def test_sample_through_the_job(spark, tmp_path):
    put(tmp_path, 0, [message(1)])
    run_job(spark, config(tmp_path))
    [(_, row)] = updates_in(spark, tmp_path / "product")
    assert json.loads(row["infos"]) == SAMPLE_DOCUMENT
    [(_, run)] = updates_in(spark, tmp_path / "run")
    assert run["shop_name"] == SAMPLE["shop_name"]
    assert json.loads(run["shop_agg"]) == {"date": "2021-01-05", "count": 1}


def test_sample_is_stale_by_the_wall_clock(spark, tmp_path):
    put(tmp_path, 0, [message(1)])
    run_job(spark, config(tmp_path, clock="processing"))
    assert [row for _, row in updates_in(spark, tmp_path / "product")] == [{"infos": None}]
    assert len(updates_in(spark, tmp_path / "run")) == 1


def events(spark, tmp_path, streaming):
    rows = read_observations(
        spark, str(tmp_path / "in"), "json", streaming, {"maxFilesPerTrigger": "1"}
    )
    return prepare(split_valid(rows)[0])


def drained(spark, updates, tmp_path, name):
    query = write_updates(
        updates, "parquet", str(tmp_path / name), str(tmp_path / f"{name}-cp"),
        interval=None,
    )
    query.awaitTermination()
    return spark.read.schema(updates.schema).parquet(f"{tmp_path / name}/batch_id=*")


def streak(tmp_path):
    """accepted, duplicate, duplicate, accepted, duplicate | stale, accepted"""
    start = SAMPLE["timestamp"]
    minute = "2020-07-02 00:0{}:00".format
    put(tmp_path, 0, [
        message(1, update_time=minute(1)),
        message(2, update_time=minute(1)),
        message(3, update_time=minute(1)),
        message(4, update_time=minute(2), timestamp=start + DAY),
        message(5, update_time=minute(2), timestamp=start + DAY),
    ])
    put(tmp_path, 1, [
        message(6, update_time=minute(2), timestamp=start - DAY),
        message(7, update_time=minute(3), timestamp=start + 2 * DAY),
    ])


def emitted(df):
    return [(r["arrival"], r["valid"]) for r in df.orderBy("arrival").collect()]


def test_rejection_is_reported_once_per_streak(spark, tmp_path):
    streak(tmp_path)
    updates = product_updates(
        events(spark, tmp_path, True), OBSERVATION_SPEC, None, ["pid"]
    )
    assert emitted(drained(spark, updates, tmp_path, "all")) == [
        (1, True), (2, False), (4, True), (5, False), (7, True),
    ]


def test_keep_last_reports_no_rejections(spark, tmp_path):
    streak(tmp_path)
    updates = product_updates(
        events(spark, tmp_path, True), OBSERVATION_SPEC, None, ["pid"],
        on_reject="keep_last",
    )
    assert emitted(drained(spark, updates, tmp_path, "kept")) == [
        (1, True), (4, True), (7, True),
    ]


def test_coalesced_updates_are_one_per_key_and_batch(spark, tmp_path):
    streak(tmp_path)
    updates = product_updates(
        events(spark, tmp_path, True), OBSERVATION_SPEC, None, ["pid"],
        coalesce_updates=True,
    )
    assert emitted(drained(spark, updates, tmp_path, "few")) == [(5, False), (7, True)]


def test_first_event_rejected_is_reported(spark, tmp_path):
    put(tmp_path, 0, [message(1), message(2)])
    updates = product_updates(
        events(spark, tmp_path, True),
        OBSERVATION_SPEC,
        F.col("timestamp") + 15 * DAY,
        ["pid"],
    )
    assert emitted(drained(spark, updates, tmp_path, "stale")) == [(1, False)]


@pytest.mark.parametrize("ttl,expected", [(None, 2), (1, 1)])
def test_idle_state_expires(spark, tmp_path, ttl, expected):
    put(tmp_path, 0, [message(1)])
    stream = read_observations(spark, str(tmp_path / "in"), "json", True)

    def run():
        updates = run_updates(
            run_input(stream), "shop_name", "date", "arrival", "count", ttl_seconds=ttl
        )
        return drained(spark, updates, tmp_path, "runs")

    run()
    time.sleep(2.5)
    put(tmp_path, 1, [message(2)])
    counts = {r["arrival"]: r["run_count"] for r in run().collect()}
    assert counts == {1: 1, 2: expected}


def test_continuous_job_keeps_running(spark, tmp_path):
    put(tmp_path, 0, [message(1)])
    queries = start_job(spark, config(tmp_path, interval="1 second"))
    try:
        for query in queries:
            query.processAllAvailable()
        assert all(q.isActive for q in queries)
        assert len(updates_in(spark, tmp_path / "product")) == 1
    finally:
        for query in queries:
            query.stop()


def test_documents_decode_again(spark, tmp_path):
    put(tmp_path, 0, [message(1)])
    run_job(spark, config(tmp_path))
    [(_, row)] = updates_in(spark, tmp_path / "product")
    df = spark.createDataFrame([(row["infos"],)], "infos string")
    schema = read_observations(spark, str(tmp_path / "in"), "json").schema
    opened = df.select(from_document(F.col("infos"), schema).alias("d")).collect()[0]
    assert opened["d"]["pid"] == SAMPLE["pid"]
    assert opened["d"]["tags"] == SAMPLE["tags"]


STREAM_QUERIES = ["stream_run_count", "stream_run_updates", "stream_product_metrics", "stream_update_counts"]


@pytest.mark.parametrize("name", STREAM_QUERIES)
def test_stream_queries_read_a_folder_of_part_files(spark, tmp_path, name):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "parts/events.parquet"))
    events.limit(0).write.parquet(str(tmp_path / "none/events.parquet"))
    query = QUERIES[name]
    expected = sorted(map(repr, query(spark, "/root/testdata/sf0.001").collect()))
    assert expected
    assert sorted(map(repr, query(spark, str(tmp_path / "parts")).collect())) == expected
    assert query(spark, str(tmp_path / "none")).collect() == []


def test_a_stream_without_files_has_no_rows(spark, tmp_path):
    (tmp_path / "events.parquet").mkdir()
    assert QUERIES["stream_run_updates"](spark, str(tmp_path)).collect() == []
