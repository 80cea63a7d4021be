"""The declared feed end to end: messages of 28 columns to result documents.

The events table is written as the JSON messages a producer would send, some of them
unusable, and goes the whole way of the job: decoding, the quality split, exact units,
checked admission, series, metrics, the latest record and the document that is sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clock, documents
from tidemark.operators.admission import drop_stale_stored
from tidemark.operators.chunks import BROADCAST_ROWS
from tidemark.plans import oracle as sql
from tidemark.plans import tables
from tidemark.plans.product import OBSERVATION_SPEC, prepare, product_result, result_document
from tidemark.plans.shop import RUN_KEY, shop_runs
from tidemark.plans.tables import SNAPSHOT
from tidemark.schema import METRIC_NAMES, METRIC_SCHEMA, OBSERVATION_SCHEMA
from tidemark.session import stored
from tidemark.sources.decode import decode_json
from tidemark.sources.observations import ENVELOPE
from tidemark.sources.quality import REASON, RUN_TIMES, split_valid, with_reason
from tidemark.sources.results import encode_product, encode_run

#: Numbers whose multiples, as event ids, are sent with a fault.
FAULTS = {
    "malformed": 53,
    "null_order": 59,
    "null_clock": 61,
    "null_time": 67,
    "bad_time": 71,
    "null_measure": 73,
    "bad_measure": 79,
}


def _nth(reason: str) -> Column:
    return F.col("event_id") % FAULTS[reason] == 0


def feed_messages(events: DataFrame) -> DataFrame:
    """``value``: one JSON message an event, with its arrival columns."""
    n, seen = F.col("event_id"), clock.epoch_seconds(F.col("ts"))
    at = tables.arrival_time(seen)
    # Every third product is sent in batches that return, the others in order.
    hour = F.when(F.col("user_id") % 3 == 0, F.pmod(n * 31, F.lit(5))).otherwise(
        F.floor(seen / 21600) % 100_000
    )
    batch_time = F.timestamp_seconds(F.lit(1_600_000_000) + hour * 3600).cast("timestamp_ntz")
    day = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    text = clock.clock_text
    columns = {
        "timestamp": F.when(_nth("bad_time"), F.lit(2**40)).otherwise(seen),
        "pid": F.concat(F.lit("p"), F.col("user_id").cast("string")),
        "merchant_id": F.concat(F.lit("m"), (F.col("user_id") % 7).cast("string")),
        "merchant_name": F.lit("merchant"),
        "shop_name": F.concat(F.lit("shop "), (F.col("user_id") % 11).cast("string")),
        "review_number": F.expr("event_id div 3"),
        "review_score": (n % 50) / 10,
        "shop_review_number": n % 1000,
        "title": F.concat(F.col("event_type"), F.lit(', "new"')),
        "is_pb": n % 2,
        "is_hwc": (n % 3 == 0),
        "is_verified": n % 5 == 1,
        "total_bought": n % 17,
        "total_wishlist": n % 640,
        "tags": F.array(F.col("event_type"), F.lit("x")),
        "category_ids": F.array(F.lit("t1")),
        "category_paths": F.array(F.lit("Home:Kitchen")),
        "category_l1_ids": F.array(F.lit("t1")),
        "category_l2_ids": F.array(F.lit("t2")),
        "category_l3_ids": F.array().cast("array<string>"),
        "leaf_category_ids": F.array(F.lit("t2")),
        "price": F.lit(100.0) + F.rint(F.col("value") * 100 / 7) / 100,
        "shipping_price": F.lit(1.25),
        "sold": F.when(~_nth("null_measure"), F.when(_nth("bad_measure"), F.lit(1e10)).otherwise(F.col("value"))),
        "update_time": F.when(~_nth("null_time"), text(batch_time)),
        "shop_open_time": text(day),
        "gen_time": text(F.col("ts")),
        "data_update_time": text(F.col("ts")),
        "arrival": F.when(~_nth("null_order"), tables.arrival_order()),
        "arrival_time": F.when(~_nth("null_clock"), at),
    }
    whole = documents.to_document(F.struct(*[c.alias(name) for name, c in columns.items()]))
    broken = F.when(_nth("malformed"), F.lit('{"pid": "p')).otherwise(whole)
    return events.select("event_id", broken.alias("value"))


def _decoded(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    full = T.StructType(OBSERVATION_SCHEMA.fields + ENVELOPE.fields)
    messages = feed_messages(tables.read_events(spark, sf_dir))
    return decode_json(messages, "value", full, keep=keep)


def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reason for which a message is set aside, and those that are none."""
    judged = with_reason(
        _decoded(spark, sf_dir, ["event_id"]), ("timestamp", "update_time"), ("sold", "price", "review_number")
    )
    return judged.groupBy(F.coalesce(REASON, F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum")
    )


def feed_product_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``infos`` of every product, decoded again: 16 metrics and 28 columns."""
    valid, _ = split_valid(_decoded(spark, sf_dir))
    # Admission and the records take several passes: messages are decoded in one.
    rows = stored(prepare(valid))
    result = product_result(
        rows, OBSERVATION_SPEC, F.col("arrival_time"), "checked", sift_rows=BROADCAST_ROWS
    )
    document = result_document(F.col("metrics"), F.col("latest"))
    sent = result.select("pid", "valid", encode_product(document).alias("infos"))
    shown = {"review_score": "double", "price": "double", "sold": "double", "shipping_price": "double"}
    fields = [T.StructField(f.name, f.dataType) for f in METRIC_SCHEMA.fields]
    for f in OBSERVATION_SCHEMA.fields:
        kind = T.DoubleType() if f.name in shown else f.dataType
        kind = T.StringType() if isinstance(kind, T.TimestampNTZType) else kind
        fields.append(T.StructField(f.name, kind))
    opened = documents.from_document(F.col("infos"), T.StructType(fields))
    rows = sent.select(F.col("pid").alias("product"), "valid", opened.alias("d"))
    columns = []
    for f in fields:
        column = F.col(f"d.`{f.name}`")
        columns.append((F.array_join(column, ",") if isinstance(f.dataType, T.ArrayType) else column).alias(f.name))
    return rows.select("product", "valid", *columns)


def feed_run_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shop_name, shop_agg`` of every shop, the document decoded again."""
    valid, _ = split_valid(_decoded(spark, sf_dir), RUN_TIMES, ())
    runs = shop_runs(valid)
    sent = runs.select(RUN_KEY, encode_run(F.col("date"), F.col("run_count")).alias("shop_agg"))
    shape = T.StructType([T.StructField("date", T.StringType()), T.StructField("count", T.LongType())])
    opened = documents.from_document(F.col("shop_agg"), shape)
    return sent.select(RUN_KEY, opened.alias("d")).select(RUN_KEY, "d.date", "d.count")


def drop_stale_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staleness bound on the stored clock, which Parquet can test by itself."""
    fresh = drop_stale_stored(tables.read_events(spark, sf_dir), "ts", SNAPSHOT)
    return tables.observations(fresh).select("pid", "event_id", "ts")


QUERIES = {
    "quality_reasons": quality_reasons,
    "feed_product_document": feed_product_document,
    "feed_run_document": feed_run_document,
    "drop_stale_pushed": drop_stale_pushed,
}

# -- SQL -------------------------------------------------------------------------------

_UNITS = "CAST(round(CAST(CAST({0} AS FLOAT) AS DOUBLE) * 1e9) AS HUGEINT)"
_PRICE = "100.0 + round_even(value * 100 / 7, 0) / 100"
_REASON = "CASE " + " ".join(f"WHEN event_id % {n} = 0 THEN '{r}'" for r, n in FAULTS.items()) + " END"

_FEED = f"""sent AS (
  SELECT *, {_REASON} AS reason, CAST(floor(epoch(ts)) AS BIGINT) AS seen,
         event_id + (event_id * 7919) % 1009 AS arrival,
         CAST(value AS FLOAT) AS sold, CAST({_PRICE} AS FLOAT) AS price,
         1600000000 + 3600 * CASE WHEN user_id % 3 = 0 THEN (event_id * 31) % 5
                                  ELSE (CAST(floor(epoch(ts)) AS BIGINT) // 21600) % 100000 END AS batch
  FROM events),
obs AS (
  SELECT 'p' || user_id AS pid, event_id, user_id, event_type, seen AS ts, batch, arrival, sold, price,
         ts AS written, seen + (event_id * 7919) % 1009 * 260 AS arrival_time,
         {_UNITS.format('sold')} AS sold_c, {_UNITS.format('price')} AS price_c,
         event_id // 3 AS review_number
  FROM sent WHERE reason IS NULL)"""


def _scaled_fill() -> str:
    """The series in units of nine decimals, its steps rounded to two."""
    text = sql.FILL
    for rise in ("ns - ls", "np - lp"):
        plain = sql._step(rise, "(nd - dy)")
        text = text.replace(f"({plain})", f"({sql._step(rise, '((nd - dy) * 10000000)')}) * 10000000")
    return text


def _two_places(units: str, scale: int = 9) -> str:
    whole = sql._step(f"CAST({units} AS HUGEINT)", f"CAST({10 ** (scale - 2)} AS HUGEINT)")
    return f"CAST({whole} AS DOUBLE) / 100"


_FEED_METRICS = (
    "metrics AS (SELECT pid, "
    + sql.metric_list(_two_places, lambda product: _two_places(product, 18))
    + " FROM daily GROUP BY pid)"
)
#: The columns of a record as SQL over the events table; lists are joined by commas.
_RECORD = {
    "timestamp": "ts",
    "pid": "pid",
    "merchant_id": "'m' || user_id % 7",
    "merchant_name": "'merchant'",
    "shop_name": "'shop ' || user_id % 11",
    "review_number": "CAST(review_number AS INTEGER)",
    "review_score": "round_even(CAST(CAST((event_id % 50) / 10 AS FLOAT) AS DOUBLE), 2)",
    "shop_review_number": "CAST(event_id % 1000 AS INTEGER)",
    "title": "event_type || ', \"new\"'",
    "is_pb": "event_id % 2 = 1",
    "is_hwc": "event_id % 3 = 0",
    "is_verified": "event_id % 5 = 1",
    "total_bought": "CAST(event_id % 17 AS INTEGER)",
    "total_wishlist": "CAST(event_id % 640 AS INTEGER)",
    "tags": "event_type || ',x'",
    "category_ids": "'t1'",
    "category_paths": "'Home:Kitchen'",
    "category_l1_ids": "'t1'",
    "category_l2_ids": "'t2'",
    "category_l3_ids": "''",
    "leaf_category_ids": "'t2'",
    "price": "round_even(CAST(price AS DOUBLE), 2)",
    "shipping_price": "1.25::DOUBLE",
    "sold": "round_even(CAST(sold AS DOUBLE), 2)",
    "update_time": "strftime(make_timestamp(batch * 1000000), '%Y-%m-%d %H:%M:%S')",
    "shop_open_time": "'2020-01-01 00:00:00'",
    "gen_time": "strftime(written, '%Y-%m-%d %H:%M:%S')",
    "data_update_time": "strftime(written, '%Y-%m-%d %H:%M:%S')",
}
_LAST = (
    f"last_of AS (SELECT pid, arg_max(status = 'accepted', {sql.SEQ}) AS valid FROM judged GROUP BY pid), "
    f"record AS (SELECT pid AS product, {', '.join(f'{e} AS {n}_' for n, e in _RECORD.items())} FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY pid ORDER BY {sql.SEQ} DESC) AS back FROM acc) WHERE back = 1)"
)

ORACLE = {
    "quality_reasons": f"""
SELECT coalesce({_REASON}, 'valid') AS reason, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM (SELECT event_id FROM events) GROUP BY 1""",
    "feed_product_document": sql.with_(
        _FEED,
        sql.walk(sql.ON_ARRIVAL),
        sql.ENDS,
        _scaled_fill(),
        _FEED_METRICS,
        _LAST,
        then="SELECT e.pid AS product, e.valid, "
        + ", ".join(f"CASE WHEN e.valid THEN m.{n} END AS {n}" for n in METRIC_NAMES)
        + ", "
        + ", ".join(f"CASE WHEN e.valid THEN r.{n}_ END AS {n}" for n in _RECORD)
        + " FROM last_of e LEFT JOIN metrics m ON m.pid = e.pid LEFT JOIN record r ON r.product = e.pid",
    ),
    "feed_run_document": sql.with_(
        _FEED.replace(
            "FROM sent WHERE reason IS NULL",
            "FROM sent WHERE " + " AND ".join(
                f"event_id % {FAULTS[r]} <> 0" for r in ("malformed", "null_order", "null_clock", "null_time")
            ),
        ).replace(
            "'p' || user_id AS pid,",
            "'p' || user_id AS pid, 'shop ' || user_id % 11 AS shop_name, "
            "strftime(make_timestamp(batch * 1000000), '%Y-%m-%d') AS obs_date,",
        ),
        sql.islands("shop_name"),
        then=f"SELECT shop_name, arg_max(obs_date, {sql.SEQ}) AS \"date\", "
        f"CAST(arg_max(run_count, {sql.SEQ}) AS BIGINT) AS \"count\" FROM counted GROUP BY shop_name",
    ),
    "drop_stale_pushed": sql.ORACLE["drop_stale"],
}
