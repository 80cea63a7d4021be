"""The newest accepted record of a key and whether it still stands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schema import SeriesSpec


def latest_record(accepted: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The last accepted row of every key, whole."""
    others = [c for c in accepted.columns if c != spec.key]
    newest = accepted.groupBy(spec.key).agg(
        F.max_by(F.struct(*others), spec.order).alias("_row")
    )
    return newest.select(
        spec.key, *[F.col("_row").getField(c).alias(c) for c in others]
    ).select(*accepted.columns)


def validity(judged: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per key: was its last event, of whatever status, accepted?"""
    accepted = F.col("status") == "accepted"
    return judged.groupBy(spec.key).agg(
        F.max_by(accepted, spec.order).alias("valid"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(accepted).alias("accepted"),
    )


def status_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("status").agg(F.count(F.lit(1)).alias("events"))
