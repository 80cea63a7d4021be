"""Queries over whole tables, every event judged by the clock it arrived at.

They stand next to the snapshot queries, which keep the last 14 days of the same
tables, and cover what works on places, summaries and closed forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.admission import accepted_only, admit, late_only
from tidemark.operators.closed_form import closed_form_metrics
from tidemark.operators.daily import daily_endpoints
from tidemark.operators.latest import latest_record
from tidemark.operators.locate import PLACE, with_place
from tidemark.operators.metrics import array_metrics, daily_arrays, trailing_metrics
from tidemark.operators.runs import with_literal_count
from tidemark.operators.summaries import summarised_count
from tidemark.plans import oracle as sql
from tidemark.plans import tables
from tidemark.plans.product import (
    daily_series,
    flat_result,
    latest_accepted,
    latest_located,
    product_metrics,
    product_result_located,
)
from tidemark.plans.queries import RECORD, TINY_CHUNK, series_functions
from tidemark.plans.tables import EVENT_SPEC, PART_SPEC, observations

_NARROW = ["pid", "ts", "batch", "arrival", "arrival_time", *EVENT_SPEC.measures]
_ARRIVED = "arrival_time"


def _events(spark: SparkSession, sf_dir: str, batch: str = "general") -> DataFrame:
    return observations(tables.read_events(spark, sf_dir), batch)


def _accepted(spark: SparkSession, sf_dir: str, batch: str, **how) -> DataFrame:
    rows = _events(spark, sf_dir, batch).select(*_NARROW)
    mode = "fold" if batch == "general" else "checked"
    return accepted_only(rows, EVENT_SPEC, F.col(_ARRIVED), mode, **how)


def _placed(spark: SparkSession, sf_dir: str, batch: str = "general") -> DataFrame:
    """Observations with the place of each in the table's files."""
    events = with_place(tables.read_events(spark, sf_dir))
    named = observations(events, batch).columns
    places = [F.col(c) for c in PLACE]
    return observations(events, batch, places).select(*named, *PLACE)


# -- admission -------------------------------------------------------------------


def admit_late_only_whole(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    rows = _events(spark, sf_dir).select("pid", "event_id", "arrival", "ts")
    return late_only(rows, EVENT_SPEC, **how).select("pid", "event_id", "ts")


def admit_late_only_whole_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admit_late_only_whole(spark, sf_dir, rows_per_chunk=TINY_CHUNK)


def admit_checked(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    """Keys whose batches are apart in time by the closed form, the others folded."""
    rows = _events(spark, sf_dir, "mixed")
    rows = rows.select("pid", "event_id", "arrival", "arrival_time", "ts", "batch")
    judged = admit(rows, EVENT_SPEC, F.col(_ARRIVED), "checked", **how)
    return judged.select("pid", "event_id", "status")


def admit_checked_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admit_checked(spark, sf_dir, rows_per_chunk=TINY_CHUNK)


# -- records ---------------------------------------------------------------------


def latest_record_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("pid", "arrival", "arrival_time", *RECORD)
    latest = latest_accepted(rows, EVENT_SPEC, F.col(_ARRIVED))
    return latest.drop("arrival", "arrival_time")


def latest_record_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir, "mixed").select("pid", "arrival", "arrival_time", *RECORD)
    accepted = accepted_only(rows, EVENT_SPEC, F.col(_ARRIVED), "checked")
    return latest_record(accepted, EVENT_SPEC).drop("arrival", "arrival_time")


def latest_record_located(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    """Admission carries places; the records are read for one row a key."""
    latest = latest_located(_placed(spark, sf_dir), EVENT_SPEC, F.col(_ARRIVED), **how)
    return latest.select("pid", *RECORD)


def product_result_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = product_result_located(_placed(spark, sf_dir), EVENT_SPEC, F.col(_ARRIVED))
    return flat_result(result, RECORD)


# -- series and metrics ------------------------------------------------------------


def daily_endpoints_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = daily_endpoints(_accepted(spark, sf_dir, "monotone"), EVENT_SPEC)
    return ends.drop("last_order")


def daily_series_fractional_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = daily_series(_accepted(spark, sf_dir, "monotone"), EVENT_SPEC)
    return series.select("pid", "day", "is_observed", "sold_c", "price_c")


def daily_series_integer_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = daily_series(_accepted(spark, sf_dir, "general"), EVENT_SPEC)
    return series.select("pid", "day", "age", "review_number")


def daily_series_45(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A longer horizon than the 30 days of the metrics."""
    longer = EVENT_SPEC.with_(days=45)
    series = daily_series(_accepted(spark, sf_dir, "general"), longer)
    return series.select("pid", "day", "age", "is_observed", *EVENT_SPEC.measures)


def product_metrics_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: checked admission, two shuffles, all events."""
    rows = _events(spark, sf_dir, "monotone")
    metrics = product_metrics(rows, EVENT_SPEC, F.col(_ARRIVED), "checked")
    return metrics.drop("last_order")


def product_metrics_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir, "mixed")
    metrics = product_metrics(rows, EVENT_SPEC, F.col(_ARRIVED), "checked")
    return metrics.drop("last_order")


def product_metrics_general_whole(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    rows = _events(spark, sf_dir)
    return product_metrics(rows, EVENT_SPEC, F.col(_ARRIVED), **how).drop("last_order")


def product_metrics_whole_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_metrics_general_whole(spark, sf_dir, rows_per_chunk=TINY_CHUNK)


def product_metrics_arrays_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = daily_series(_accepted(spark, sf_dir, "general"), EVENT_SPEC)
    held = daily_arrays(series, EVENT_SPEC)
    columns = [F.col(n) for n in EVENT_SPEC.measures]
    return held.select("pid", *array_metrics(*columns, EVENT_SPEC))


def product_metrics_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No day is made up: sums over gaps are closed forms."""
    ends = daily_endpoints(_accepted(spark, sf_dir, "general"), EVENT_SPEC)
    return closed_form_metrics(ends, EVENT_SPEC).drop("last_order")


def lineitem_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of history a part, with gaps of months."""
    ends = daily_endpoints(tables.part_history(spark, sf_dir), PART_SPEC)
    return closed_form_metrics(ends, PART_SPEC).drop("last_order")


def array_functions_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = daily_series(_accepted(spark, sf_dir, "general"), EVENT_SPEC)
    return series_functions(daily_arrays(series, EVENT_SPEC))


# -- runs --------------------------------------------------------------------------


def run_count_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_literal_count(_events(spark, sf_dir))
    return summarised_count(rows, "pid", "obs_date", "arrival", "count")


def run_count_summary_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys: each is as many stretches as tasks, merged at the end."""
    rows = with_literal_count(_events(spark, sf_dir))
    return summarised_count(rows, "event_type", "obs_date", "arrival", "count")


QUERIES = {
    "admit_late_only_whole": admit_late_only_whole,
    "admit_late_only_whole_chunked": admit_late_only_whole_chunked,
    "admit_checked": admit_checked,
    "admit_checked_chunked": admit_checked_chunked,
    "latest_record_whole": latest_record_whole,
    "latest_record_checked": latest_record_checked,
    "latest_record_located": latest_record_located,
    "product_result_located": product_result_places,
    "daily_endpoints_whole": daily_endpoints_whole,
    "daily_series_fractional_whole": daily_series_fractional_whole,
    "daily_series_integer_whole": daily_series_integer_whole,
    "daily_series_45": daily_series_45,
    "product_metrics_whole": product_metrics_whole,
    "product_metrics_checked": product_metrics_checked,
    "product_metrics_general_whole": product_metrics_general_whole,
    "product_metrics_whole_chunked": product_metrics_whole_chunked,
    "product_metrics_arrays_whole": product_metrics_arrays_whole,
    "product_metrics_closed_form": product_metrics_closed_form,
    "lineitem_closed_form": lineitem_closed_form,
    "array_functions_whole": array_functions_whole,
    "run_count_summary": run_count_summary,
    "run_count_summary_by_type": run_count_summary_by_type,
}

# -- SQL -----------------------------------------------------------------------------

MONOTONE = (sql.obs("monotone"), sql.walk(sql.ON_ARRIVAL))
MIXED = (sql.obs("mixed"), sql.walk(sql.ON_ARRIVAL))

_LATE = sql.with_(
    sql.obs(),
    """seen AS (
  SELECT *, max(ts) OVER (PARTITION BY pid ORDER BY arrival, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM obs)""",
    then="SELECT pid, event_id, ts FROM seen WHERE top IS NULL OR ts >= top",
)
_CHECKED = sql.with_(*MIXED, then="SELECT pid, event_id, status FROM judged")
_RECORD = (
    "SELECT pid, "
    + ", ".join(f"arg_max({c}, {sql.SEQ}) AS {c}" for c in RECORD)
    + " FROM acc GROUP BY pid"
)
_METRICS = (*sql.SERIES, sql.METRICS)
_ALL_METRICS = sql.with_(*sql.REPLAY, *_METRICS, then="SELECT * FROM metrics")


def _longer(days: int) -> str:
    """The series over another number of days."""
    return sql.FILL.replace("dmax - 29", f"dmax - {days - 1}").replace("dmax - 30", f"dmax - {days}")


ORACLE = {
    "admit_late_only_whole": _LATE,
    "admit_late_only_whole_chunked": _LATE,
    "admit_checked": _CHECKED,
    "admit_checked_chunked": _CHECKED,
    "latest_record_whole": sql.with_(*sql.REPLAY, then=_RECORD),
    "latest_record_checked": sql.with_(*MIXED, then=_RECORD),
    "latest_record_located": sql.with_(*sql.REPLAY, then=_RECORD),
    "product_result_located": sql.ORACLE["product_result_typed"],
    "daily_endpoints_whole": sql.with_(
        *MONOTONE,
        sql.ENDS,
        then='SELECT pid, dy AS "day", fs AS first_sold_c, ls AS last_sold_c, '
        "fp AS first_price_c, lp AS last_price_c, fr AS first_review_number, "
        "lr AS last_review_number FROM ends",
    ),
    "daily_series_fractional_whole": sql.with_(
        *MONOTONE,
        *sql.SERIES,
        then='SELECT pid, dday AS "day", is_observed, sold_c, price_c FROM daily',
    ),
    "daily_series_integer_whole": sql.with_(
        *sql.REPLAY,
        *sql.SERIES,
        then='SELECT pid, dday AS "day", age, review_number FROM daily',
    ),
    "daily_series_45": sql.with_(
        *sql.REPLAY,
        sql.ENDS,
        _longer(45),
        then='SELECT pid, dday AS "day", age, is_observed, sold_c, price_c, review_number FROM daily',
    ),
    "product_metrics_whole": sql.with_(*MONOTONE, *_METRICS, then="SELECT * FROM metrics"),
    "product_metrics_checked": sql.with_(*MIXED, *_METRICS, then="SELECT * FROM metrics"),
    "product_metrics_general_whole": _ALL_METRICS,
    "product_metrics_whole_chunked": _ALL_METRICS,
    "product_metrics_arrays_whole": _ALL_METRICS,
    "product_metrics_closed_form": _ALL_METRICS,
    "lineitem_closed_form": sql.ORACLE["lineitem_daily_series"],
    "array_functions_whole": sql.with_(*sql.REPLAY, *sql.SERIES, then=sql.ARRAY_FUNCTIONS),
    "run_count_summary": sql.ORACLE["run_count_final"],
    "run_count_summary_by_type": sql.ORACLE["run_count_by_type"],
}
