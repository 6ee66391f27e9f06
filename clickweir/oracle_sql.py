"""DuckDB SQL that computes each registered query independently of Spark.

Every statement reads the driver's views (``events``, ``part``) and
rebuilds the clickstream view in SQL, so it shares no code with the
Spark side. Used by the driver's correctness gate and by the tests.
"""

from __future__ import annotations

# The clickstream view (see clickweir.sources.fixture), in DuckDB SQL.
SRC = """
src AS (
  SELECT
    e.event_id,
    CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE e.ts END AS event_time,
    e.event_type,
    CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE p.p_partkey END AS product_id,
    CAST(p.p_size AS BIGINT) AS category_id,
    CASE e.event_id % 11
      WHEN 0 THEN 'nan'
      WHEN 1 THEN ' NaN '
      WHEN 2 THEN NULL
      WHEN 3 THEN lower(p.p_type)
      ELSE lower(p.p_type) || '.' || replace(p.p_name, ' ', '.')
    END AS category_code,
    p.p_brand AS brand,
    CAST(e.value AS DECIMAL(14,2)) AS price,
    e.user_id,
    CASE WHEN e.event_id % 101 = 0 THEN NULL
         ELSE CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) END AS user_session
  FROM events e
  LEFT JOIN part p ON p.p_partkey = TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT)
)"""

SOURCE_COLS = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"

CLEAN_CODE = "CASE WHEN lower(trim(category_code)) = 'nan' THEN NULL ELSE category_code END"


def _enriched(rows: str) -> str:
    """Derived target columns over a relation ``rows`` with source columns."""
    return f"""
SELECT event_time, event_type, product_id, category_id, cc AS category_code, brand, price, user_id, user_session,
       CAST(event_time AS DATE) AS event_date,
       CAST(hour(event_time) AS INTEGER) AS event_hour,
       CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
       string_split(cc, '.')[1] AS category_level_1,
       string_split(cc, '.')[2] AS category_level_2,
       string_split(cc, '.')[3] AS category_level_3
FROM (SELECT *, {CLEAN_CODE} AS cc FROM {rows})"""


def _capped(rows: str, per_minute: int, per_session: int) -> str:
    """Rows of ``rows`` (already null-filtered) whose groups are within the caps."""
    return f"""(
SELECT * EXCLUDE (n_minute, n_session) FROM (
  SELECT *,
    count(*) OVER (PARTITION BY user_id, date_trunc('minute', event_time)) AS n_minute,
    count(*) OVER (PARTITION BY user_session) AS n_session
  FROM {rows})
WHERE n_minute <= {per_minute} AND n_session <= {per_session})"""


FILTERED = "(SELECT * FROM src WHERE event_time IS NOT NULL AND product_id IS NOT NULL)"


def clean_sql(per_minute: int = 30, per_session: int = 500, rows: str = FILTERED) -> str:
    return _enriched(_capped(rows, per_minute, per_session))


def with_src(body: str, extra_ctes: str = "") -> str:
    ctes = SRC + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


SPLIT = "TIMESTAMP '2024-01-15 12:00:00'"


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["snapshot_scan"] = with_src(f"SELECT event_id, {SOURCE_COLS} FROM src")
    q["pruned_scan"] = with_src(f"SELECT {SOURCE_COLS} FROM src")
    q["filter_required"] = with_src(f"SELECT event_id, {SOURCE_COLS} FROM {FILTERED}")
    q["clean_category"] = with_src(f"SELECT event_id, {CLEAN_CODE} AS category_code FROM src")
    q["calendar_fields"] = with_src(
        "SELECT event_id, CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INTEGER) AS event_hour, "
        "CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week FROM src"
    )
    q["category_levels"] = with_src(
        f"SELECT event_id, string_split(cc, '.')[1] AS category_level_1, string_split(cc, '.')[2] AS category_level_2, "
        f"string_split(cc, '.')[3] AS category_level_3 FROM (SELECT *, {CLEAN_CODE} AS cc FROM src)"
    )
    q["minute_bucket"] = with_src("SELECT event_id, date_trunc('minute', event_time) AS event_minute FROM src")
    q["events_per_minute"] = with_src(
        "SELECT event_id, user_id, date_trunc('minute', event_time) AS event_minute, "
        f"count(*) OVER (PARTITION BY user_id, date_trunc('minute', event_time)) AS events_per_minute FROM {FILTERED}"
    )
    q["events_per_session"] = with_src(
        f"SELECT event_id, user_session, count(*) OVER (PARTITION BY user_session) AS events_per_session FROM {FILTERED}"
    )
    q["clean_events"] = with_src(clean_sql(30, 500))
    q["traffic_cap"] = with_src(clean_sql(1, 4))
    planted = (
        "(SELECT * REPLACE (CASE WHEN event_id % 83 = 0 THEN NULL ELSE event_type END AS event_type, "
        "CASE WHEN event_id % 79 = 0 THEN CAST(price AS DECIMAL(24,4)) + 1000000000000 ELSE CAST(price AS DECIMAL(24,4)) END AS price) "
        f"FROM {FILTERED})"
    )
    q["contract_check"] = with_src(
        "SELECT count(*) AS rows, "
        "count_if(event_time IS NULL) AS null_event_time, count_if(event_type IS NULL) AS null_event_type, "
        "count_if(product_id IS NULL) AS null_product_id, count_if(event_date IS NULL) AS null_event_date, "
        "count_if(event_hour IS NULL) AS null_event_hour, count_if(day_of_week IS NULL) AS null_day_of_week, "
        "count_if(event_time <> date_trunc('second', event_time)) AS sub_second_event_time, "
        "count_if(abs(price) >= 1000000000000) AS price_out_of_range "
        f"FROM ({clean_sql(30, 500, planted)})"
    )
    q.update(_increment_queries())
    q.update(_job_queries())
    q.update(_ingest_queries())
    q.update(_mart_queries())
    return q


def _ledger_row(seq: int, job: str, low: str, high: str, rows: str | None, per_minute: int, per_session: int) -> str:
    """One ledger row; ``rows`` is the batch relation, None for an empty run."""
    if rows is None:
        counts = "0 AS rows_read, 0 AS rows_before_filtering, 0 AS rows_after_filtering, 0 AS rows_written"
    else:
        filt = f"(SELECT * FROM {rows} WHERE event_time IS NOT NULL AND product_id IS NOT NULL)"
        kept = f"(SELECT count(*) FROM {_capped(filt, per_minute, per_session)})"
        counts = (
            f"(SELECT count(*) FROM {rows}) AS rows_read, (SELECT count(*) FROM {rows}) AS rows_before_filtering, "
            f"{kept} AS rows_after_filtering, {kept} AS rows_written"
        )
    return (
        f"SELECT CAST({seq} AS BIGINT) AS seq, '{job}' AS job_type, 'success' AS status, "
        f"CAST({low} AS TIMESTAMP) AS hwm_low, CAST({high} AS TIMESTAMP) AS hwm_high, {counts}"
    )


# Batches of the arrival scenario: the source as of SPLIT, then the rest.
SCENARIO_CTES = f"""
b1 AS (SELECT * FROM src WHERE event_time <= {SPLIT}),
h1 AS (SELECT max(event_time) AS t FROM b1),
b2 AS (SELECT * FROM src WHERE event_time > (SELECT t FROM h1)),
h2 AS (SELECT max(event_time) AS t FROM src)"""

H1 = "(SELECT t FROM h1)"
H2 = "(SELECT t FROM h2)"


def _scenario_rows(first_seq: int, per_minute: int, per_session: int) -> list[str]:
    return [
        _ledger_row(first_seq, "incremental", "NULL", H1, "b1", per_minute, per_session),
        _ledger_row(first_seq + 1, "incremental", H1, H2, "b2", per_minute, per_session),
        _ledger_row(first_seq + 2, "incremental", H2, "NULL", None, per_minute, per_session),
    ]


def _increment_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    above = f"(SELECT * FROM src WHERE event_time > {SPLIT})"
    q["hwm_bounds"] = with_src(
        f"SELECT {SPLIT} AS hwm_low, max(event_time) AS hwm_high, count(*) AS rows FROM {above}"
    )
    q["incremental_scan"] = with_src(
        f"SELECT event_id, {SOURCE_COLS} FROM {above} WHERE event_time <= (SELECT max(event_time) FROM {above})"
    )
    late_mark = f"(SELECT min(event_time) FROM {above})"
    q["incremental_late"] = with_src(
        f"SELECT event_id, {SOURCE_COLS} FROM src WHERE event_time > {late_mark} "
        f"AND event_time <= (SELECT max(event_time) FROM src WHERE event_time > {late_mark})"
    )
    q["incremental_run"] = with_src(" UNION ALL ".join(_scenario_rows(0, 1, 4)), SCENARIO_CTES)
    all_rows = "(SELECT * FROM src WHERE event_time IS NOT NULL)"
    q["incremental_empty"] = with_src(
        f"SELECT *, true AS wrote FROM ({_ledger_row(0, 'incremental', 'NULL', H2, all_rows, 30, 500)}) "
        f"UNION ALL SELECT *, false AS wrote FROM ({_ledger_row(1, 'incremental', H2, 'NULL', None, 30, 500)})",
        SCENARIO_CTES,
    )
    halves = [
        clean_sql(30, 500, f"(SELECT * FROM src WHERE event_time {side} {SPLIT} AND product_id IS NOT NULL)") for side in ("<=", ">")
    ]
    q["incremental_two_marks"] = with_src(" UNION ALL ".join(f"SELECT * FROM ({h})" for h in halves))
    b2_clean = clean_sql(30, 500, "(SELECT * FROM b2 WHERE event_time IS NOT NULL AND product_id IS NOT NULL)")
    q["incremental_preview"] = with_src(
        "SELECT event_time, event_type, product_id, category_code, event_date, event_hour, day_of_week "
        f"FROM ({b2_clean}) ORDER BY event_time NULLS FIRST, event_type NULLS FIRST, product_id NULLS FIRST, "
        "category_code NULLS FIRST, event_date NULLS FIRST, event_hour NULLS FIRST, day_of_week NULLS FIRST LIMIT 10",
        SCENARIO_CTES,
    )
    q["batch_max_time"] = with_src(f"SELECT max(event_time) AS max_event_time FROM ({b2_clean})", SCENARIO_CTES)
    # late rows five days and more under the mark of the first increment are never read
    first_mark = f"(SELECT max(event_time) FROM src WHERE event_time <= {SPLIT} AND event_id % 10 <> 3)"
    loaded = f"(SELECT * FROM {FILTERED} WHERE event_id % 10 <> 3 OR event_time > {first_mark} - INTERVAL 5 DAY)"
    once = clean_sql(1 << 60, 1 << 60, f"(SELECT * FROM {loaded})")
    q["incremental_lateness"] = with_src(f"SELECT * FROM ({once}) UNION ALL SELECT * FROM ({once})")
    first = clean_sql(1, 4, "(SELECT * FROM b1 WHERE product_id IS NOT NULL)")
    second = _enriched(f"(SELECT * FROM {_capped(FILTERED, 1, 4)} WHERE event_time > {H1})")
    q["traffic_cap_history"] = with_src(f"SELECT * FROM ({first}) UNION ALL SELECT * FROM ({second})", SCENARIO_CTES)
    return q


def _job_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_table_write"] = with_src(clean_sql(30, 500))
    q["full_refresh"] = with_src(clean_sql(1, 4))
    kept = f"(SELECT count(*) FROM ({clean_sql(1, 4)}))"
    q["job_metrics"] = with_src(
        "SELECT 'full_snapshot' AS job_type, 'success' AS status, (SELECT count(*) FROM src) AS rows_read, "
        f"(SELECT count(*) FROM src) AS rows_before_filtering, {kept} AS rows_after_filtering, {kept} AS rows_written"
    )
    q["sample_rows"] = with_src(
        f"SELECT * FROM ({clean_sql(30, 500)}) ORDER BY event_date NULLS LAST, event_time NULLS LAST, "
        "product_id NULLS LAST, user_id NULLS LAST, event_type NULLS LAST, user_session NULLS LAST LIMIT 20"
    )
    # a stream's loads carry no marks
    streamed = [_ledger_row(i, "stream_batch", "NULL", "NULL", b, 1, 4) for i, b in enumerate(("b1", "b2"))]
    q["stream_increments"] = with_src(" UNION ALL ".join(streamed), SCENARIO_CTES)
    q["stream_unordered"] = with_src(_enriched(FILTERED))
    q["run_history"] = with_src(
        f"SELECT * FROM ({' UNION ALL '.join(_scenario_rows(1, 1, 4))}) WHERE seq >= 1", SCENARIO_CTES
    )
    q["run_status"] = with_src(
        f"SELECT * FROM ({_ledger_row(0, 'full_snapshot', 'NULL', 'NULL', 'src', 1, 4)})"
    )
    return q


# Text read as missing (pandas read_csv defaults), as a SQL list.
NA_LIST = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({NA_LIST}) THEN NULL ELSE {c} END AS {c}"


INGESTED = (
    "SELECT date_trunc('second', event_time) AS event_time, "
    + _na("event_type")
    + ", product_id, category_id, "
    + _na("category_code")
    + ", "
    + "CASE WHEN event_id % 7 = 0 THEN brand || ' \"pro\", inc' || chr(10) || 'ltd' WHEN brand IN (" + NA_LIST + ") THEN NULL ELSE brand END AS brand"
    + ", CASE WHEN event_id % 13 = 0 THEN NULL ELSE price END AS price, user_id, "
    + _na("user_session")
    + " FROM src"
)


def _ingest_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["csv_ingest"] = with_src(INGESTED)
    order = ", ".join(f"{c.strip()} ASC NULLS LAST" for c in SOURCE_COLS.split(","))
    q["ingest_limit"] = with_src(f"SELECT * FROM ({INGESTED}) ORDER BY {order} LIMIT 2500")
    q["ingest_append"] = with_src(f"{INGESTED} UNION ALL {INGESTED}")
    q["ingest_event_time"] = with_src(
        "SELECT event_id, CASE event_id % 7 WHEN 3 THEN date_trunc('day', event_time) WHEN 5 THEN NULL ELSE event_time END AS event_time FROM src"
    )
    q["ingest_coerce_numeric"] = with_src(
        "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE product_id END AS product_id, category_id, "
        "CASE WHEN event_id % 13 = 0 THEN NULL "
        "WHEN event_id % 3 = 1 THEN TRY_CAST(CAST(price AS VARCHAR) || '5' AS DECIMAL(14,2)) ELSE price END AS price, "
        "CASE WHEN event_id % 3 = 2 THEN NULL ELSE user_id END AS user_id FROM src"
    )
    return q


def _measures(types: tuple[str, ...]) -> str:
    per_type = ", ".join(f"count_if(event_type = '{t}') AS {t}_events" for t in types)
    return (
        f"count(*) AS events, {per_type}, count(DISTINCT user_id) AS users, "
        "CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN price END), 0) AS DECIMAL(24,2)) AS revenue"
    )


def _mart_queries() -> dict[str, str]:
    by_loads = _mart_statements(f"({_enriched(FILTERED)})")  # those loads are not capped
    return _mart_statements(f"({clean_sql(30, 500)})") | {f"{name}_by_loads": sql for name, sql in by_loads.items()}


def _mart_statements(clean: str) -> dict[str, str]:
    types = ("view", "click", "purchase")
    q: dict[str, str] = {}
    q["product_metrics"] = with_src(
        f"SELECT event_date, product_id, {_measures(types)} FROM {clean} GROUP BY event_date, product_id"
    )
    q["category_metrics"] = with_src(
        f"SELECT event_date, category_level_1, category_level_2, {_measures(types)} FROM {clean} "
        "GROUP BY event_date, category_level_1, category_level_2"
    )
    flags = ", ".join(f"max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS s{i}" for i, t in enumerate(types, 1))
    q["funnel_metrics"] = with_src(
        "SELECT event_date, stage_1_users, stage_2_users, stage_3_users, "
        "CASE WHEN stage_1_users > 0 THEN round(stage_2_users / stage_1_users, 6) END AS stage_2_rate, "
        "CASE WHEN stage_2_users > 0 THEN round(stage_3_users / stage_2_users, 6) END AS stage_3_rate "
        "FROM (SELECT event_date, CAST(sum(s1) AS BIGINT) AS stage_1_users, CAST(sum(s1 * s2) AS BIGINT) AS stage_2_users, "
        "CAST(sum(s1 * s2 * s3) AS BIGINT) AS stage_3_users "
        f"FROM (SELECT event_date, user_id, {flags} FROM {clean} WHERE user_id IS NOT NULL GROUP BY event_date, user_id) "
        "GROUP BY event_date)"
    )
    return q
