"""Declared schemas and the column naming every operator is driven by."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# The declared input columns in wire order. Flags travel as text
# because producers send 0/1 as often as true/false; see sources.decode.
_TEXT = T.StringType()
_TEXTS = T.ArrayType(T.StringType())
_CLOCK = T.TimestampNTZType()

OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("pid", _TEXT),
        T.StructField("merchant_id", _TEXT),
        T.StructField("merchant_name", _TEXT),
        T.StructField("shop_name", _TEXT),
        T.StructField("review_number", T.IntegerType()),
        T.StructField("review_score", T.FloatType()),
        T.StructField("shop_review_number", T.IntegerType()),
        T.StructField("title", _TEXT),
        T.StructField("is_pb", T.BooleanType()),
        T.StructField("is_hwc", T.BooleanType()),
        T.StructField("is_verified", T.BooleanType()),
        T.StructField("total_bought", T.IntegerType()),
        T.StructField("total_wishlist", T.IntegerType()),
        T.StructField("tags", _TEXTS),
        T.StructField("category_ids", _TEXTS),
        T.StructField("category_paths", _TEXTS),
        T.StructField("category_l1_ids", _TEXTS),
        T.StructField("category_l2_ids", _TEXTS),
        T.StructField("category_l3_ids", _TEXTS),
        T.StructField("leaf_category_ids", _TEXTS),
        T.StructField("price", T.FloatType()),
        T.StructField("shipping_price", T.FloatType()),
        T.StructField("sold", T.FloatType()),
        T.StructField("update_time", _CLOCK),
        T.StructField("shop_open_time", _CLOCK),
        T.StructField("gen_time", _CLOCK),
        T.StructField("data_update_time", _CLOCK),
    ]
)

# The 16 metric names in document order.
METRIC_NAMES = [
    "new_review_number_last_30",
    "sold_last_1",
    "sold_last_3",
    "sold_last_7",
    "sold_last_30",
    "sold_last_1_pop",
    "sold_2_to_last",
    "sold_3_to_last",
    "sold_4_to_last",
    "sold_5_to_last",
    "sold_6_to_last",
    "sold_7_to_last",
    "gmv_last_1",
    "gmv_last_3",
    "gmv_last_7",
    "gmv_last_30",
]

# Admission outcomes, in the order their tests are made.
STATUSES = ["accepted", "stale", "duplicate_batch", "late"]

SERIES_DAYS = 30
STALE_AFTER_SECONDS = 14 * 86400

METRIC_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name.startswith("new_") else T.DoubleType())
        for name in METRIC_NAMES
    ]
)

PRODUCT_RESULT_SCHEMA = T.StructType([T.StructField("infos", _TEXT)])
RUN_RESULT_SCHEMA = T.StructType(
    [T.StructField("shop_name", _TEXT), T.StructField("shop_agg", _TEXT)]
)


@dataclass(frozen=True)
class SeriesSpec:
    """Names the columns an observation table uses.

    ``order`` must be one numeric column that totally orders the rows of a key
    by arrival (see ``functions.clock.pack_order`` to build it from several).
    ``fractional`` measures are BIGINT minor units with ``scale`` decimals;
    ``integral`` measures are plain counts.
    """

    key: str = "pid"
    ts: str = "ts"
    batch: str = "batch"
    order: str = "arrival"
    level: str = "sold"
    price: str = "price"
    counter: str = "review_number"
    scale: int = 6
    days: int = SERIES_DAYS

    @property
    def fractional(self) -> list[str]:
        return [self.level, self.price]

    @property
    def integral(self) -> list[str]:
        return [self.counter]

    @property
    def measures(self) -> list[str]:
        return self.fractional + self.integral

    def with_(self, **changes) -> "SeriesSpec":
        return replace(self, **changes)
