"""Per-shop run count of events sharing one update date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import iso_date
from tidemark.operators.runs import final_count, running_count, with_literal_count

RUN_KEY = "shop_name"


def run_input(observations: DataFrame) -> DataFrame:
    """Two columns of the 28, the arrival order and a literal count.

    The date is the clock as written; no zone shift.
    """
    projected = observations.select(
        RUN_KEY, "arrival", iso_date(F.col("update_time")).alias("date")
    )
    return with_literal_count(projected)


def shop_runs(observations: DataFrame) -> DataFrame:
    return final_count(run_input(observations), RUN_KEY, "date", "arrival", "count")


def shop_run_history(observations: DataFrame) -> DataFrame:
    return running_count(run_input(observations), RUN_KEY, "date", "arrival", "count")
