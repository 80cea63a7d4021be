"""The same questions as ``queries`` in plain SQL for another engine.

Written from the rules, not from the Spark plans: admission is a recursive
walk, arrival is ordered by two columns, gaps are not clipped before expansion.
"""

from __future__ import annotations

from tidemark.plans.tables import SNAPSHOT
from tidemark.schema import METRIC_NAMES

BATCH = {
    "general": "(event_id * 31) % 5 + 1",
    "monotone": "CAST(floor(epoch(ts)) AS BIGINT) // 21600",
}
BATCH["mixed"] = f"CASE WHEN user_id % 3 = 0 THEN {BATCH['general']} ELSE {BATCH['monotone']} END"
FRESH = f"ts >= {SNAPSHOT} - 14 * 86400"
SEQ = "arrival * 1000000000 + event_id"
RECORD = ["event_id", "ts", "batch", "sold_c", "price_c", "review_number", "obs_date"]


def obs(batch: str = "general") -> str:
    return f"""obs AS (
  SELECT user_id AS pid, event_id, event_type,
         event_id + (event_id * 7919) % 1009 AS arrival,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         CAST(floor(epoch(ts)) AS BIGINT) + (event_id * 7919) % 1009 * 260 AS arrival_time,
         CAST({BATCH[batch]} AS BIGINT) AS batch,
         CAST(round(value * 100) AS BIGINT) AS sold_c,
         10000 + CAST(round(value * 100) AS BIGINT) // 7 AS price_c,
         event_id // 3 AS review_number,
         strftime(ts, '%Y-%m-%d') AS obs_date
  FROM events)"""


def walk(stale: str) -> str:
    """Admission of every event, one arrival at a time."""
    return f"""rn AS (
  SELECT *, {stale} AS stale,
         row_number() OVER (PARTITION BY pid ORDER BY arrival, event_id) AS n
  FROM obs),
fold AS (
  SELECT DISTINCT pid, CAST(0 AS BIGINT) AS n, '' AS status,
         CAST(0 AS BIGINT) AS lt, CAST(0 AS BIGINT) AS lb FROM rn
  UNION ALL
  SELECT r.pid, r.n,
         CASE WHEN r.stale THEN 'stale' WHEN r.batch = f.lb THEN 'duplicate_batch'
              WHEN r.ts < f.lt THEN 'late' ELSE 'accepted' END,
         CASE WHEN r.stale OR r.batch = f.lb OR r.ts < f.lt THEN f.lt ELSE r.ts END,
         CASE WHEN r.stale OR r.batch = f.lb OR r.ts < f.lt THEN f.lb ELSE r.batch END
  FROM fold f JOIN rn r ON r.pid = f.pid AND r.n = f.n + 1),
judged AS (
  SELECT r.*, f.status FROM fold f JOIN rn r ON r.pid = f.pid AND r.n = f.n),
acc AS (SELECT * FROM judged WHERE status = 'accepted')"""


AT_SNAPSHOT = f"NOT ({FRESH})"
ON_ARRIVAL = "ts < arrival_time - 14 * 86400"

MONOTONE = f"""seen AS (
  SELECT *, max(batch) OVER (PARTITION BY pid ORDER BY arrival, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM obs WHERE {FRESH}),
acc AS (SELECT * FROM seen WHERE batch > coalesce(top, 0))"""

ENDS = f"""ends AS (
  SELECT pid, CAST(floor((ts + 28800) / 86400.0) AS INTEGER) AS dy,
         arg_min(sold_c, {SEQ}) AS fs, arg_max(sold_c, {SEQ}) AS ls,
         arg_min(price_c, {SEQ}) AS fp, arg_max(price_c, {SEQ}) AS lp,
         arg_min(review_number, {SEQ}) AS fr, arg_max(review_number, {SEQ}) AS lr
  FROM acc GROUP BY ALL)"""


def _step(rise: str, d: str) -> str:
    return (
        f"CASE WHEN {rise} >= 0 THEN (2 * ({rise}) + {d}) // (2 * {d}) "
        f"ELSE -((2 * -({rise}) + {d}) // (2 * {d})) END"
    )


FILL = f"""lnk AS (
  SELECT *, lead(dy) OVER w AS nd, lead(fs) OVER w AS ns, lead(fp) OVER w AS np,
         lead(fr) OVER w AS nr, row_number() OVER w AS nth,
         max(dy) OVER (PARTITION BY pid) AS dmax
  FROM ends WINDOW w AS (PARTITION BY pid ORDER BY dy)),
slots AS (
  SELECT *, unnest(range(CASE WHEN nth = 1 THEN least(dy, dmax - 29) ELSE dy END,
                         coalesce(nd, dy + 1))) AS sd FROM lnk),
daily AS (
  SELECT pid, CAST(sd AS INTEGER) AS dday, CAST(dmax - sd AS INTEGER) AS age, sd = dy AS is_observed,
         CASE WHEN sd < dy THEN fs WHEN sd = dy THEN ls
              ELSE ls + (sd - dy) * ({_step('ns - ls', '(nd - dy)')}) END AS sold_c,
         CASE WHEN sd < dy THEN fp WHEN sd = dy THEN lp
              ELSE lp + (sd - dy) * ({_step('np - lp', '(nd - dy)')}) END AS price_c,
         CASE WHEN sd < dy THEN fr WHEN sd = dy THEN lr
              ELSE lr + CAST(floor((nr - lr) * (sd - dy) / CAST(nd - dy AS DOUBLE)) AS BIGINT)
              END AS review_number
  FROM slots WHERE sd > dmax - 30)"""


def _money(value: str) -> str:
    return f"CAST({value} AS DOUBLE) / 100"


def _cents(product: str) -> str:
    """Squared cents to cents, ties away from zero."""
    return _step(f"CAST({product} AS BIGINT)", "100")


def _growth(v0: str, v1: str) -> str:
    size = f"(2 * abs({v0} - {v1}) * 1000000 + abs({v1})) // (2 * abs({v1}))"
    return (
        f"CASE WHEN {v1} = 0 THEN 0.0 ELSE CAST(CASE WHEN ({v0} < {v1}) <> ({v1} < 0) "
        f"THEN -({size}) ELSE {size} END AS DOUBLE) / 1000000 END"
    )


def metric_list(money=_money, products=lambda total: _money(_cents(total))) -> str:
    """The metrics; ``money`` and ``products`` show sums of measures and of products."""
    parts = {
        "new_review_number_last_30": "max(review_number) FILTER (WHERE age = 0) "
        "- max(review_number) FILTER (WHERE age = 29)",
        "sold_last_1_pop": _growth(
            "max(sold_c) FILTER (WHERE age = 0)", "max(sold_c) FILTER (WHERE age = 1)"
        ),
    }
    for n in (1, 3, 7, 30):
        cut = f"FILTER (WHERE age < {n})"
        parts[f"sold_last_{n}"] = money(f"sum(sold_c) {cut}")
        parts[f"gmv_last_{n}"] = products(f"sum(sold_c * price_c) {cut}")
    for k in range(2, 8):
        parts[f"sold_{k}_to_last"] = money(
            f"max(sold_c) FILTER (WHERE age = {k - 1})"
        )
    return ", ".join(f"{parts[m]} AS {m}" for m in METRIC_NAMES)


METRICS = f"metrics AS (SELECT pid, {metric_list()} FROM daily GROUP BY pid)"


def _history() -> str:
    parts = {
        "new_review_number_last_30": "review_number - lag(review_number, 29) OVER w",
        "sold_last_1_pop": _growth("sold_c", "lag(sold_c, 1) OVER w"),
    }
    for n in (1, 3, 7, 30):
        frame = (
            f"OVER (PARTITION BY pid ORDER BY dday "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        )
        parts[f"sold_last_{n}"] = _money(f"sum(sold_c) {frame}")
        parts[f"gmv_last_{n}"] = _money(_cents(f"sum(sold_c * price_c) {frame}"))
    for k in range(2, 8):
        parts[f"sold_{k}_to_last"] = _money(f"lag(sold_c, {k - 1}) OVER w")
    listed = ", ".join(f"{parts[m]} AS {m}" for m in METRIC_NAMES)
    return (
        f'SELECT pid, dday AS "day", is_observed, {listed} FROM daily '
        "WINDOW w AS (PARTITION BY pid ORDER BY dday)"
    )


LAST_SEEN = f"""ends_of AS (
  SELECT pid, arg_max(status = 'accepted', {SEQ}) AS valid,
         {", ".join(f"arg_max({c}, {SEQ}) FILTER (WHERE status = 'accepted') AS {c}"
                    for c in RECORD)}
  FROM judged GROUP BY pid)"""


def _result(show: str) -> str:
    names = [f"m.{n}" for n in METRIC_NAMES] + [f"e.{c}" for c in RECORD]
    listed = ", ".join(f"CASE WHEN {show} THEN {n} END AS {n[2:]}" for n in names)
    return f"SELECT e.pid, e.valid, {listed} FROM ends_of e LEFT JOIN metrics m USING (pid)"


def with_(*parts: str, then: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + then


def islands(key: str) -> str:
    return f"""marked AS (
  SELECT *, CASE WHEN obs_date = lag(obs_date) OVER w THEN 0 ELSE 1 END AS brk
  FROM obs WINDOW w AS (PARTITION BY {key} ORDER BY arrival, event_id)),
island AS (
  SELECT *, sum(brk) OVER (PARTITION BY {key} ORDER BY arrival, event_id
                           ROWS UNBOUNDED PRECEDING) AS isl FROM marked),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY {key}, isl
                               ORDER BY arrival, event_id) AS run_count FROM island)"""


def final(key: str) -> str:
    return (
        f"SELECT {key}, arg_max(obs_date, {SEQ}) AS obs_date, "
        f"CAST(arg_max(run_count, {SEQ}) AS BIGINT) AS run_count "
        f"FROM counted GROUP BY {key}"
    )


GENERAL = (obs(), walk(AT_SNAPSHOT))
MONO = (obs("monotone"), MONOTONE)
REPLAY = (obs(), walk(ON_ARRIVAL))
SERIES = (ENDS, FILL)

_LATE = with_(
    obs(),
    f"""seen AS (
  SELECT *, max(ts) OVER (PARTITION BY pid ORDER BY arrival, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM obs WHERE {FRESH})""",
    then="SELECT pid, event_id, ts FROM seen WHERE top IS NULL OR ts >= top",
)
_ADMITTED = "SELECT pid, event_id, ts, batch FROM acc"
_GENERAL = with_(*GENERAL, then=_ADMITTED)
_MONOTONE = with_(*MONO, then=_ADMITTED)
_FLAGSHIP = with_(*MONO, *SERIES, METRICS, then="SELECT * FROM metrics")
_GENERAL_METRICS = with_(*GENERAL, *SERIES, METRICS, then="SELECT * FROM metrics")
_RUNNING = with_(
    obs(), islands("pid"), then="SELECT pid, event_id, obs_date, run_count FROM counted"
)
_RUN_FINAL = with_(obs(), islands("pid"), then=final("pid"))
_RESULT = (*REPLAY, *SERIES, METRICS, LAST_SEEN)

_PART = """acc AS (
  SELECT l_partkey AS pid, CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts,
         row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber,
                            l_quantity, l_extendedprice) AS event_id,
         CAST(0 AS BIGINT) AS arrival,
         CAST(round(l_quantity * 100) AS BIGINT) AS sold_c,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price_c,
         l_orderkey AS review_number
  FROM lineitem)"""

ARRAY_FUNCTIONS = """
SELECT pid, max(sold_c) FILTER (WHERE age = 1) AS second,
       CAST(sum(sold_c) FILTER (WHERE age < 7) AS BIGINT) AS week_sum,
       CAST(sum(sold_c * price_c) FILTER (WHERE age < 7) AS BIGINT) AS week_product,
       CAST(sum(sold_c) FILTER (WHERE age > 0) AS BIGINT) AS without_last,
       CAST(sum(sold_c) FILTER (WHERE age < 7)
            + 3 * max(sold_c) FILTER (WHERE age = 0) AS BIGINT) AS padded_sum,
       CAST(sum(sold_c * (age + 1)) FILTER (WHERE age < 7) AS BIGINT) AS prefix_total
FROM daily GROUP BY pid"""

ORACLE = {
    "project_literal": with_(
        obs(), then='SELECT obs_date, pid, 1 AS "count" FROM obs'
    ),
    "drop_stale": with_(
        obs(), then=f"SELECT pid, event_id, ts FROM obs WHERE {FRESH}"
    ),
    "admit_late_only": _LATE,
    "admit_late_only_chunked": _LATE,
    "admit_general": _GENERAL,
    "admit_general_chunked": _GENERAL,
    "admit_monotone": _MONOTONE,
    "admit_monotone_chunked": _MONOTONE,
    "admit_monotone_by_fold": _MONOTONE,
    "admission_status": with_(*GENERAL, then="SELECT event_id, status FROM judged"),
    "admission_status_monotone": with_(
        obs("monotone"),
        walk(AT_SNAPSHOT),
        then="SELECT event_id, status FROM judged",
    ),
    "admission_status_counts": with_(
        *GENERAL, then="SELECT status, count(*) AS events FROM judged GROUP BY status"
    ),
    "validity": with_(
        *GENERAL,
        then=f"SELECT pid, arg_max(status = 'accepted', {SEQ}) AS valid, "
        "count(*) AS events, count(*) FILTER (WHERE status = 'accepted') AS accepted "
        "FROM judged GROUP BY pid",
    ),
    "latest_record": with_(
        *GENERAL,
        then="SELECT pid, "
        + ", ".join(f"arg_max({c}, {SEQ}) AS {c}" for c in RECORD)
        + " FROM acc GROUP BY pid",
    ),
    "latest_record_monotone": with_(
        *MONO,
        then="SELECT pid, "
        + ", ".join(f"arg_max({c}, {SEQ}) AS {c}" for c in RECORD)
        + " FROM acc GROUP BY pid",
    ),
    "daily_endpoints": with_(
        *MONO,
        ENDS,
        then='SELECT pid, dy AS "day", fs AS first_sold_c, ls AS last_sold_c, '
        "fp AS first_price_c, lp AS last_price_c, fr AS first_review_number, "
        "lr AS last_review_number FROM ends",
    ),
    "daily_series_fractional": with_(
        *MONO,
        *SERIES,
        then='SELECT pid, dday AS "day", is_observed, sold_c, price_c FROM daily',
    ),
    "daily_series_integer": with_(
        *GENERAL,
        *SERIES,
        then='SELECT pid, dday AS "day", age, review_number FROM daily',
    ),
    "product_metrics": _FLAGSHIP,
    "product_metrics_arrays": _FLAGSHIP,
    "product_metrics_general": _GENERAL_METRICS,
    "product_metrics_chunked": _GENERAL_METRICS,
    "daily_metric_history": with_(*REPLAY, *SERIES, then=_history()),
    "product_result_typed": with_(*_RESULT, then=_result("e.valid")),
    "product_result_keep_last": with_(*_RESULT, then=_result("TRUE")),
    "lineitem_daily_series": with_(
        _PART,
        *SERIES,
        METRICS,
        then="SELECT pid AS l_partkey, "
        + ", ".join(METRIC_NAMES)
        + " FROM metrics",
    ),
    "run_count_running": _RUNNING,
    "run_count_running_chunked": _RUNNING,
    "run_count_final": _RUN_FINAL,
    "run_count_by_type": with_(
        obs(), islands("event_type"), then=final("event_type")
    ),
    "run_count_by_type_running": with_(
        obs(),
        islands("event_type"),
        then="SELECT event_type, event_id, run_count FROM counted",
    ),
    "quality_split": """
SELECT CASE WHEN event_id % 101 = 0 THEN 'null_time'
            WHEN event_id % 97 = 0 OR value IS NULL THEN 'null_measure' END AS reason,
       count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM events GROUP BY 1""",
    "decode_observations": """
SELECT CASE WHEN ok THEN event_id END AS event_id,
       CASE WHEN ok THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen,
       CASE WHEN ok THEN event_type END AS event_type,
       CASE WHEN ok THEN "value" END AS "value",
       CASE WHEN ok THEN nullif(event_id % 7, 0) END AS maybe,
       CASE WHEN ok THEN event_type || ',x' ELSE '' END AS tags,
       CASE WHEN ok THEN event_id % 2 = 1 END AS flag,
       CASE WHEN ok THEN event_id % 2 = 0 END AS loose_flag,
       NOT ok AS malformed
FROM (SELECT *, event_id % 53 <> 0 AS ok FROM events)""",
    "decode_flags_legacy": """
SELECT event_id, FALSE AS flag, event_id % 3 = 0 AS loose_flag FROM events""",
    "decode_props": """
SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
FROM events""",
    "result_json_roundtrip": with_(
        *_RESULT,
        then="SELECT e.pid, "
        + ", ".join([f"m.{n}" for n in METRIC_NAMES] + [f"e.{c}" for c in RECORD])
        + " FROM ends_of e LEFT JOIN metrics m USING (pid)",
    ),
    "run_result_json": _RUN_FINAL,
    "clock_functions": """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch,
       CAST(date_diff('day', DATE '1970-01-01', CAST(ts + INTERVAL 8 HOUR AS DATE))
            AS INTEGER) AS day_number,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_date,
       strftime(ts, '%Y-%m-%d') AS iso_date,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS clock_text,
       CAST(date_diff('day', DATE '2024-01-01', CAST(ts + INTERVAL 8 HOUR AS DATE))
            AS INTEGER) AS days
FROM events""",
    "numeric_functions": f"""
SELECT event_id,
       CAST(floor(v / CAST(d AS DOUBLE)) AS BIGINT) AS floor_div,
       {_step('v', 'd')} AS half_up,
       CASE WHEN z = 0 THEN 0.0 ELSE CAST({_step('v * 1000000', 'z')} AS DOUBLE)
            / 1000000 END AS ratio,
       CAST({_step('v', '10')} AS DOUBLE) / 100 AS two_places,
       v + 5000 AS units
FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) - 5000 AS v,
             event_id % 9 + 2 AS d, event_id % 9 AS z FROM events)""",
    "array_functions": with_(*MONO, *SERIES, then=ARRAY_FUNCTIONS),
    "named_tables": """
SELECT user_id AS pid, count(*) AS observed, count(*) AS stored
FROM events GROUP BY user_id""",
    "stream_run_count": _RUN_FINAL,
    "stream_run_updates": with_(
        obs(),
        islands("pid"),
        then='SELECT pid, obs_date AS "date", run_count FROM counted',
    ),
    "stream_product_metrics": with_(*_RESULT, then=_result("e.valid")),
    "stream_update_counts": with_(
        *REPLAY,
        """turns AS (
  SELECT pid, status = 'accepted' AS valid,
         lag(status = 'accepted') OVER (PARTITION BY pid ORDER BY n) AS was FROM judged)""",
        then="SELECT pid, valid, count(*) AS updates FROM turns "
        "WHERE valid OR was IS NULL OR was GROUP BY pid, valid",
    ),
}
