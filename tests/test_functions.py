"""Column expressions against Python and across session zones."""

import datetime
import fractions
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import arrays, clock, numeric


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0]["x"]


def test_utc8_day_boundary(spark):
    last, first = F.lit(1614268799), F.lit(1614268800)
    assert one(spark, clock.local_date(last)) == datetime.date(2021, 2, 25)
    assert one(spark, clock.local_date(first)) == datetime.date(2021, 2, 26)
    assert one(spark, clock.day_number(F.lit(-28801))) == -1


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_clock_ignores_the_session_zone(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day.
        local = F.expr("TIMESTAMP_NTZ'2024-03-10 02:30:15'")
        assert one(spark, clock.epoch_seconds(local)) == 1710037815
        assert one(spark, clock.clock_text(local)) == "2024-03-10 02:30:15"
        assert one(spark, clock.iso_date(local)) == "2024-03-10"
        assert one(spark, clock.local_date(F.lit(1614268800))) == datetime.date(2021, 2, 26)
        assert one(spark, clock.days_between(F.lit("2024-01-01").cast("date"),
                                             F.to_date(local))) == 69
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_now(spark):
    now = datetime.datetime.now().timestamp()
    assert abs(one(spark, clock.now_epoch()) - now) < 600
    assert abs(clock.wall_clock() - now) < 600


def test_pack_order(spark):
    rows = [(5, 1, 3), (5, 0, 999), (4, 9, 9), (5, 1, 10)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    packed = clock.pack_order((F.col("a"), 14), (F.col("b"), 6), (F.col("c"), 18))
    ordered = [tuple(r) for r in df.orderBy(packed).collect()]
    assert ordered == sorted(rows)
    with pytest.raises(PySparkException):
        df.select(clock.pack_order((F.col("c"), 2))).collect()
    with pytest.raises(ValueError):
        clock.pack_order((F.col("a"), 20), (F.col("b"), 20))


def test_integer_arithmetic(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(-10**12, 10**12), rng.randint(1, 10**6)) for _ in range(200)]
    pairs += [(-7, 3), (7, 2), (-7, 2), (0, 5), (1, 2), (-1, 2)]
    df = spark.createDataFrame(pairs, "v long, d long")
    got = df.select(
        "v", "d",
        numeric.floor_div(F.col("v"), F.col("d")).alias("low"),
        numeric.half_up_div(F.col("v"), F.col("d")).alias("near"),
    ).collect()
    for r in got:
        assert r["low"] == r["v"] // r["d"]
        size = int(fractions.Fraction(abs(r["v"]), r["d"]) + fractions.Fraction(1, 2))
        assert r["near"] == (size if r["v"] >= 0 else -size)


def test_ratio(spark):
    def ratio(a, b):
        return one(spark, numeric.ratio6(F.lit(a).cast("bigint"), F.lit(b).cast("bigint")))

    assert ratio(1, 0) == 0.0
    assert ratio(1, 3) == 0.333333
    assert ratio(-2, 3) == -0.666667
    assert ratio(2, -3) == -0.666667
    assert ratio(10**9 * 7 + 1, 7) == 10**9 + 0.142857
    assert ratio(10**18, 1) == 1e18


def test_units(spark):
    small = F.lit(2.9).cast("float")
    assert one(spark, numeric.to_units(small, 2)) == 290
    assert one(spark, numeric.to_units(small, 9)) == 2900000095
    exact = F.lit("1.005").cast("decimal(18,6)")
    assert one(spark, numeric.decimal_units(exact, 2)) == 101
    assert one(spark, numeric.from_units(F.lit(12345).cast("bigint"), 3)) == 12.35
    assert one(spark, numeric.from_units(F.lit(-12345).cast("bigint"), 3)) == -12.35
    assert one(spark, numeric.from_units(F.lit(12).cast("bigint"), 0)) == 12.0
    assert one(spark, numeric.rounded(F.lit(0.375), 2)) == 0.38


def test_arrays(spark):
    series = F.array(*[F.lit(v).cast("bigint") for v in (1, 2, 3, 4)])
    assert one(spark, arrays.from_end(series, 1)) == 4
    assert one(spark, arrays.from_end(series, 9)) is None
    assert one(spark, arrays.last_n(series, 2)) == [3, 4]
    assert one(spark, arrays.last_n(series, 9)) == [1, 2, 3, 4]
    assert one(spark, arrays.array_sum(series)) == 10
    assert one(spark, arrays.sum_products(series, series)) == 30
    assert one(spark, arrays.sum_products(series, series, "decimal(38,0)")) == 30
    assert one(spark, arrays.replace_last(series, F.lit(9).cast("bigint"))) == [1, 2, 3, 9]
    assert one(spark, arrays.pad_left(series, F.lit(0).cast("bigint"), 6)) == [0, 0, 1, 2, 3, 4]
    assert one(spark, arrays.prefix_sums(series)) == [1, 3, 6, 10]
