"""Decoding, checks, documents and batch sinks on the declared format."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from sample import (
    SAMPLE,
    SAMPLE_DOCUMENT,
    SAMPLE_METRICS,
    message,
    write_lines,
)

from tidemark.plans.feed_queries import QUERIES as FEED
from tidemark.plans.product import (
    OBSERVATION_SPEC,
    prepare,
    product_result,
    result_document,
)
from tidemark.plans.shop import shop_run_history, shop_runs
from tidemark.schema import METRIC_NAMES, OBSERVATION_SCHEMA
from tidemark.sources.decode import decode_json
from tidemark.sources.observations import (
    from_kafka,
    lookup,
    read_observations,
    register_tables,
)
from tidemark.sources.quality import RUN_TIMES, split_valid, with_reason
from tidemark.sources.results import encode_product, encode_run, write_batch


def decoded(spark, tmp_path, lines, **how):
    write_lines(tmp_path / "in", "part.json", lines)
    return read_observations(spark, str(tmp_path / "in"), "json", **how)


def result_of(observations, as_of):
    return product_result(prepare(observations), OBSERVATION_SPEC, as_of)


def test_sample_decodes_to_declared_types(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1)])
    assert df.schema.fields[:28] == OBSERVATION_SCHEMA.fields
    row = df.collect()[0].asDict()
    assert row["timestamp"] == SAMPLE["timestamp"]
    assert (row["is_pb"], row["is_hwc"], row["is_verified"]) == (False, False, True)
    assert row["category_l3_ids"] == []
    assert row["price"] == pytest.approx(4.0, abs=1e-6)
    assert row["update_time"] == datetime.datetime(2021, 1, 5, 8, 10, 0)
    assert row["_malformed"] is None


def test_flags(spark):
    texts = ['{"is_pb": 1}', '{"is_pb": "true"}', '{"is_pb": true}', '{"is_pb": 0}',
             '{"is_pb": "no"}', "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")

    def read(how):
        return [r["is_pb"] for r in decode_json(df, flags=how).collect()]

    assert read("lenient") == [True, True, True, False, None, None]
    assert read("legacy") == [False, True, True, False, False, None]


def test_reasons(spark, tmp_path):
    lines = [
        message(1),
        message(2, timestamp=None),
        message(3, update_time=None),
        message(4, sold=None),
        message(5, price=None),
        message(6, review_number=None),
        message(7, timestamp=None, sold=None),
        message(8, gen_time=None),
        "{not json",
    ]
    df = decoded(spark, tmp_path, lines)
    valid, rejects = split_valid(df)
    assert sorted(r["arrival"] for r in valid.collect()) == [1, 8]
    reasons = {r["arrival"]: r["reason"] for r in rejects.collect()}
    assert reasons == {
        2: "null_time",
        3: "null_time",
        4: "null_measure",
        5: "null_measure",
        6: "null_measure",
        7: "null_time",
        None: "malformed",
    }
    # The run count needs only its own clock.
    run_valid, _ = split_valid(df, RUN_TIMES, ())
    assert sorted(r["arrival"] for r in run_valid.collect()) == [1, 2, 4, 5, 6, 7, 8]
    assert "reason" in with_reason(df, RUN_TIMES).columns


def test_bad_clock_text_is_malformed(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1, update_time="yesterday")])
    assert split_valid(df)[1].collect()[0]["reason"] in ("malformed", "null_time")


def test_sample_result_document(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1)])
    result = result_of(df, SAMPLE["timestamp"])
    text = result.select(
        encode_product(result_document(F.col("metrics"), F.col("latest"))).alias("infos")
    ).collect()[0]["infos"]
    document = json.loads(text)
    assert document == SAMPLE_DOCUMENT
    assert list(document) == METRIC_NAMES + OBSERVATION_SCHEMA.fieldNames()


def test_stale_sample_has_no_document(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1)])
    result = result_of(df, SAMPLE["timestamp"] + 15 * 86400)
    document = result_document(F.col("metrics"), F.col("latest"))
    rows = result.select("valid", encode_product(document).alias("infos")).collect()
    assert [(r["valid"], r["infos"]) for r in rows] == [(False, None)]


def test_null_members_stay_in_the_document(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1, gen_time=None, title=None)])
    result = result_of(df, SAMPLE["timestamp"])
    document = result_document(F.col("metrics"), F.col("latest"))
    text = result.select(encode_product(document).alias("infos")).collect()[0]["infos"]
    assert json.loads(text) == SAMPLE_DOCUMENT | {"gen_time": None, "title": None}


def test_float_feed_matches_binary_rounding(spark, tmp_path):
    # In FLOAT, 0.57 is a little less than 0.57, so 0.57 * 2.5 rounds down.
    df = decoded(spark, tmp_path, [message(1, sold=0.57, price=2.5, review_score=0.125)])
    row = result_of(df, SAMPLE["timestamp"]).collect()[0]
    assert row["metrics"]["gmv_last_1"] == 1.42
    document = result_of(df, SAMPLE["timestamp"]).select(
        result_document(F.col("metrics"), F.col("latest")).alias("d")
    )
    assert document.collect()[0]["d"]["review_score"] == 0.12


def test_shop_runs(spark, tmp_path):
    times = ["2020-07-02 23:59:59", "2020-07-03 00:00:00", "2020-07-03 09:00:00"]
    lines = [message(i, update_time=t) for i, t in enumerate(times)]
    df = decoded(spark, tmp_path, lines)
    row = shop_runs(df).collect()[0]
    assert (row["shop_name"], row["date"], row["run_count"]) == (
        SAMPLE["shop_name"], "2020-07-03", 2,
    )
    text = shop_runs(df).select(encode_run(F.col("date"), F.col("run_count")))
    assert json.loads(text.collect()[0][0]) == {"date": "2020-07-03", "count": 2}
    history = shop_run_history(df).orderBy("arrival").collect()
    assert [r["run_count"] for r in history] == [1, 1, 2]


def test_kafka_rows(spark):
    """Rows as the Kafka source delivers them."""
    base = datetime.datetime(2021, 2, 25, 5, 0, 0)
    later = base + datetime.timedelta(seconds=1)
    rows = [
        (bytearray(message(0, sold=2.0).encode()), later, 0, 7),
        (bytearray(message(0, sold=1.0).encode()), base, 1, 9),
        (bytearray(message(0, sold=3.0).encode()), later, 1, 2),
    ]
    raw = spark.createDataFrame(
        rows, "value binary, timestamp timestamp, partition int, offset long"
    )
    ordered = from_kafka(raw).orderBy("arrival").collect()
    assert [r["sold"] for r in ordered] == [1.0, 2.0, 3.0]
    assert ordered[0]["arrival_time"] == 1614229200
    keyed = from_kafka(raw, keyed=True).orderBy("arrival").collect()
    assert [r["arrival"] for r in keyed] == [2, 7, 9]
    # The packed order drives every operator like a BIGINT does.
    result = result_of(from_kafka(raw), F.col("arrival_time")).collect()[0]
    assert result["valid"] is False
    assert result_of(from_kafka(raw).where("sold = 3"), None).collect()[0]["valid"]


def test_parquet_and_json_read_the_same(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1), message(2, sold=4.5)])
    df.drop("_malformed").write.parquet(str(tmp_path / "pq"))
    back = read_observations(spark, str(tmp_path / "pq"), "parquet")
    assert back.exceptAll(df.drop("_malformed")).isEmpty()
    assert back.count() == 2


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_observations(spark, "x", "xml")


def test_tables_by_name(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1)])
    df.write.parquet(str(tmp_path / "pq"))
    register_tables(
        spark,
        {
            "observed_view": df,
            "observed_ddl": "CREATE OR REPLACE TEMPORARY VIEW observed_ddl "
            f"USING parquet OPTIONS (path '{tmp_path / 'pq'}')",
        },
    )
    assert lookup(spark, "observed_view").count() == 1
    assert spark.sql("SELECT pid FROM observed_ddl").collect()[0][0] == SAMPLE["pid"]


def test_write_batch_nests_documents_as_text(spark, tmp_path):
    df = decoded(spark, tmp_path, [message(1)])
    result = result_of(df, SAMPLE["timestamp"])
    document = result_document(F.col("metrics"), F.col("latest"))
    rows = result.select(encode_product(document).alias("infos"))
    write_batch(rows, "text", str(tmp_path / "out"))
    line = spark.read.text(str(tmp_path / "out")).collect()[0][0]
    outer = json.loads(line)
    assert list(outer) == ["infos"]
    assert json.loads(outer["infos"])["sold_last_30"] == SAMPLE_METRICS["sold_last_30"]


def test_every_fault_has_a_reason(spark):
    schema = "arrival long, arrival_time long, timestamp long, price double"
    rows = [
        (1, 1, 100, 1.0),
        (None, 1, 100, 1.0),
        (1, None, 100, 1.0),
        (1, 1, None, 1.0),
        (1, 1, 10**18, 1.0),
        (1, 1, 100, None),
        (1, 1, 100, float("nan")),
        (1, 1, 100, 1e10),
    ]
    df = spark.createDataFrame(rows, schema)
    judged = with_reason(df, ("timestamp",), ("price",))
    assert [r.reason for r in judged.collect()] == [
        None, "null_order", "null_clock", "null_time", "bad_time", "null_measure",
        "bad_measure", "bad_measure",
    ]


def test_a_text_is_parsed_once_whatever_is_tested(spark):
    df = spark.createDataFrame([(message(1),), ("{broken",), (None,)], "value string")
    valid, rejects = split_valid(decode_json(df, keep=["value"]))
    for rows in (valid, rejects):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
    assert [r["pid"] for r in valid.collect()] == [SAMPLE["pid"]]
    assert sorted(r["reason"] for r in rejects.collect()) == ["malformed", "null_time"]


@pytest.mark.parametrize("sift_rows", [0, 100])
@pytest.mark.parametrize("on_reject", ["null", "keep_last"])
def test_sifted_records_are_those_of_the_whole_join(spark, sift_rows, on_reject):
    start = SAMPLE["timestamp"]
    shape = "pid string, arrival long, timestamp long, batch long, sold_units long, price_units long, reviews long, title string"
    rows = [(p, i, start + i * 3000 * (1 if i % 7 else -1), i % 3, i, 2 * i, i, f"{p}{i}")
            for i in range(60) for p in ("a", "b", None)[: 1 + i % 3]]
    df = spark.createDataFrame(rows + rows[-1:], shape)

    def read(**how):
        result = product_result(df, OBSERVATION_SPEC, None, "checked", on_reject, **how)
        return sorted(map(repr, result.collect()))

    assert read(sift_rows=sift_rows) == read()
    assert len(read()) == 3


def test_the_feed_is_decoded_once(spark, tmp_path):
    """Results and records are read from the rows that one pass has decoded."""
    result = FEED["feed_product_document"](spark, "/root/testdata/sf0.001")
    assert "events.parquet" not in " ".join(result.inputFiles())
    assert any("/stored-" in f for f in result.inputFiles())
