"""The same results as SQL text, for checking in another engine."""

from __future__ import annotations

from brooklet.operators.quality import KPIS
from brooklet.plans.inputs import FAULTS, SESSION_ROWS
from brooklet.schema import EVENT_TYPES, SOURCE_COLUMNS, TARGET, TARGET_COLUMNS, TargetColumn

UE = f"""ue AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, CAST(e.user_id AS INTEGER) AS user_id,
    CAST(CAST(floor(e.event_id / {SESSION_ROWS}) AS BIGINT) AS VARCHAR) AS session_id, e.event_type,
    CAST(p.p_partkey AS INTEGER) AS product_id, p.p_name AS product_name, p.p_type AS category,
    p.p_retailprice AS price,
    CAST(CASE WHEN e.event_type = 'purchase' THEN 1 + e.event_id % 3 ELSE 1 END AS INTEGER) AS quantity,
    CAST(CAST(p.p_retailprice AS DECIMAL(10,2))
      * CAST(CASE WHEN e.event_type = 'purchase' THEN 1 + e.event_id % 3 ELSE 1 END AS INTEGER)
      AS DOUBLE) AS total_amount,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM events e JOIN part p ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey)"""

DAMAGED = f"""{UE}, damaged AS (
  SELECT {", ".join(f'{FAULTS[name]} AS "{name}"' for name in SOURCE_COLUMNS)}
  FROM (SELECT *, product_id AS product FROM ue))"""

PARSED = """try_strptime("timestamp", '%Y-%m-%d %H:%M:%S')"""
NOT_NULL = "event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL AND product_id IS NOT NULL"
KNOWN = "event_type IN ({})".format(", ".join(f"'{t}'" for t in EVENT_TYPES))
POSITIVE = "price > 0 AND total_amount > 0"

RULES = {
    "event_id_null": "event_id IS NULL",
    "user_id_null": "user_id IS NULL",
    "event_type_null": "event_type IS NULL",
    "product_id_null": "product_id IS NULL",
    "event_type_unknown": f"NOT ({KNOWN})",
    "price_not_positive": "price IS NULL OR price <= 0",
    "total_amount_not_positive": "total_amount IS NULL OR total_amount <= 0",
    "event_id_too_long": "length(event_id) > 36",
    "session_id_null": "session_id IS NULL",
    "session_id_too_long": "length(session_id) > 36",
    "event_type_too_long": "length(event_type) > 20",
    "product_name_null": "product_name IS NULL",
    "product_name_too_long": "length(product_name) > 100",
    "category_null": "category IS NULL",
    "category_too_long": "length(category) > 50",
    "price_not_finite": "NOT isfinite(price)",
    "price_too_large": "isfinite(price) AND abs(round(price, 2)) >= 100000000",
    "quantity_null": "quantity IS NULL",
    "total_amount_not_finite": "NOT isfinite(total_amount)",
    "total_amount_too_large": "isfinite(total_amount) AND abs(round(total_amount, 2)) >= 100000000",
    "event_timestamp_null": f"{PARSED} IS NULL",
    "ingested_at_null": "false",  # stamped by the job itself
}


def cleaning(source: str) -> str:
    """The cleaned rows of a landing relation."""
    return f"""cleaned AS (
  SELECT *, make_timestamp(CAST(ceil(epoch_us(event_timestamp) / 10000000.0) AS BIGINT) * 10000000)
    AS ingested_at
  FROM (SELECT * REPLACE (round(price, 2) AS price, round(total_amount, 2) AS total_amount),
      {PARSED} AS event_timestamp
    FROM {source} WHERE {NOT_NULL} AND {KNOWN} AND {POSITIVE}))"""


CLEANED = f"WITH {UE}, {cleaning('ue')}"
EXACT = "CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"
ELEVEN = ", ".join(name for name in TARGET_COLUMNS if name != "ingested_at")
LATENCY = "(epoch_us(ingested_at) - epoch_us(event_timestamp))"
VIOLATIONS = " UNION ALL ".join(
    f"SELECT event_id, '{name}' AS reason FROM damaged WHERE {broken}" for name, broken in RULES.items()
)
ACCEPTED = " AND ".join(f"coalesce(NOT ({broken}), true)" for broken in RULES.values())
CATEGORY = f"SELECT category, {EXACT} AS revenue FROM cleaned WHERE event_type = 'purchase' GROUP BY category"


def _kpis(source: str = CLEANED) -> str:
    actuals = {
        "throughput_per_s": "n / ((epoch_us(last) - epoch_us(first)) / 1e6)",
        "avg_latency_s": "us / 1e6 / n",
        "max_latency_s": "max_us / 1e6",
        "duplicate_pct": "100.0 * (n - keys) / n",
        "clean_pct": "100.0 * (n - bad) / n",
    }
    lines = " UNION ALL ".join(
        f"SELECT '{k.name}' AS kpi, CAST({k.target} AS DOUBLE) AS target, "
        f"round(CAST({actuals[k.name]} AS DOUBLE), 4) AS actual, '{k.comparison}' AS op FROM totals"
        for k in KPIS
    )
    table_rules = " OR ".join(
        f"({broken})" for name, broken in RULES.items() if name != "event_timestamp_null"
    )
    return f"""{source}, totals AS (
  SELECT count(*) AS n, count(DISTINCT event_id) AS keys, sum({LATENCY}) AS us, max({LATENCY}) AS max_us,
    count(*) FILTER (WHERE {table_rules} OR event_timestamp IS NULL) AS bad,
    min(event_timestamp) AS first, max(ingested_at) AS last FROM cleaned)
  SELECT kpi, target, actual,
    CASE op WHEN '>=' THEN actual >= target WHEN '<=' THEN actual <= target ELSE actual = target END AS pass
  FROM ({lines})"""


def _schema() -> str:
    return f"{CLEANED} " + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal_position, '{c.name}' AS column_name, "
        f"'{c.kind}' AS data_type, 'NO' AS is_nullable, "
        f"count(*) FILTER (WHERE {c.name} IS NULL) AS nulls FROM cleaned"
        for i, c in enumerate(TARGET, start=1)
    )


SQL: dict[str, str] = {
    "csv_scan": f"WITH {UE} SELECT * FROM ue",
    "parse_event_time": f"WITH {DAMAGED} SELECT event_id, {PARSED} AS event_timestamp FROM damaged",
    "filter_not_null": f"WITH {DAMAGED} SELECT event_id FROM damaged WHERE {NOT_NULL}",
    "filter_event_type": f"WITH {DAMAGED} SELECT event_id FROM damaged WHERE {KNOWN}",
    "filter_positive": f"WITH {DAMAGED} SELECT event_id FROM damaged WHERE {POSITIVE}",
    "round_money": """SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
      * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS net_price FROM lineitem""",
    "narrow_money": f"""{CLEANED} SELECT event_id, CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price,
      CAST(CAST(total_amount AS DECIMAL(10,2)) AS DOUBLE) AS total_amount FROM cleaned""",
    "clean_events": f"{CLEANED} SELECT {ELEVEN} FROM cleaned",
    "enrich_events": f"WITH {UE} SELECT * FROM ue",
    "select_columns": f"""{CLEANED} SELECT event_id, event_timestamp, price, total_amount, event_type
      FROM cleaned ORDER BY event_id LIMIT 10""",
    "total_events": f"{CLEANED} SELECT count(*) AS n FROM cleaned",
    "events_by_type": f"{CLEANED} SELECT event_type, count(*) AS n FROM cleaned GROUP BY event_type",
    "revenue_by_category": f"{CLEANED} {CATEGORY} ORDER BY revenue DESC, category",
    "category_revenue_purchases": f"""{CLEANED} SELECT category, {EXACT} AS total_revenue,
      count(*) AS purchases FROM cleaned WHERE event_type = 'purchase' GROUP BY category""",
    "category_coverage": f"""{CLEANED} SELECT count(*) AS categories, min(revenue) AS min_revenue
      FROM ({CATEGORY})""",
    "events_per_minute": f"""{CLEANED} SELECT CAST(date_trunc('minute', event_timestamp) AS TIMESTAMP)
      AS event_minute, count(*) AS n FROM cleaned GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_rows": f"""{CLEANED} SELECT CAST(count(*) - count(DISTINCT concat(user_id, '/',
      strftime(event_timestamp, '%Y-%m-%d %H:%M'))) AS BIGINT) AS duplicates FROM cleaned""",
    "dedupe_events": f"{CLEANED} SELECT DISTINCT event_id, event_timestamp FROM cleaned",
    "first_events": f"""{CLEANED} SELECT user_id, event_type, event_timestamp, event_id,
      concat(user_id, '/', event_type) AS holder
      FROM cleaned QUALIFY row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY event_timestamp, event_id) = 1""",
    "keyed_append": f"""{CLEANED} SELECT event_id,
      CAST(CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
      CASE WHEN event_type = 'purchase' THEN ingested_at ELSE ingested_at + INTERVAL 1 HOUR END AS ingested_at
      FROM cleaned""",
    "compact_events": f"""{CLEANED} SELECT CAST(event_timestamp AS DATE) AS event_date, event_type,
      count(*) AS n FROM cleaned GROUP BY 1, 2""",
    "latest_events": f"""{CLEANED} SELECT {", ".join(TARGET_COLUMNS)} FROM cleaned
      ORDER BY ingested_at DESC, event_id LIMIT 5""",
    "file_type_counts": f"""WITH {UE} SELECT CAST(session_id AS BIGINT) AS file_id,
      count(*) FILTER (WHERE event_type = 'view') AS views,
      count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM ue GROUP BY 1""",
    "running_total": f"""WITH {UE} SELECT file_id, n, CAST(sum(n) OVER (ORDER BY file_id) AS BIGINT) AS total
      FROM (SELECT CAST(session_id AS BIGINT) AS file_id, count(*) AS n FROM ue GROUP BY 1)""",
    "event_type_share": f"""{CLEANED} SELECT event_type, n,
      round(100.0::DOUBLE * (CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE)), 1) AS pct
      FROM (SELECT event_type, count(*) AS n FROM cleaned GROUP BY event_type)""",
    "latency_stats": f"""{CLEANED} SELECT CAST(sum({LATENCY}) AS DOUBLE) / count(*) / 1e6 AS avg_s,
      min({LATENCY}) / 1e6 AS min_s, max({LATENCY}) / 1e6 AS max_s FROM cleaned""",
    "quality_summary": f"WITH {DAMAGED} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {broken}) AS n FROM damaged"
        for name, broken in RULES.items()
    ),
    "contract_violations": f"WITH {DAMAGED} {VIOLATIONS}",
    "kpi_report": _kpis(),
    "schema_report": _schema(),
    "stream_ingest": f"WITH {DAMAGED}, sound AS (SELECT * FROM damaged WHERE {ACCEPTED}), "
    f"{cleaning('sound')} SELECT {ELEVEN} FROM cleaned",
    "stream_quarantine": f"WITH {DAMAGED} {VIOLATIONS}",
    "stream_events_per_minute": f"""{CLEANED} SELECT CAST(date_trunc('minute', event_timestamp) AS TIMESTAMP)
      AS event_minute, count(*) AS n, CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2)))
        FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE) AS revenue FROM cleaned GROUP BY 1""",
    "stream_dedupe": f"{CLEANED} SELECT event_id, event_timestamp FROM cleaned",
}
SOUND = f"WITH {DAMAGED}, sound AS (SELECT * FROM damaged WHERE {ACCEPTED}), {cleaning('sound')}"
# Every damaged event beside its number, which the damage does not touch.
NUMBERED = f"""{UE}, damaged AS (
  SELECT {", ".join(f'{FAULTS[name]} AS "{name}"' for name in SOURCE_COLUMNS)}, number
  FROM (SELECT *, product_id AS product, CAST(event_id AS BIGINT) AS number FROM ue))"""
BATCHES = "(VALUES (0), (1), (2), (3)) AS runs(batch)"
ARRIVED = f"{BATCHES} JOIN damaged ON number % 4 = batch OR number % 4 = batch - 1"
RUN_ROWS = f"""WITH {NUMBERED}, sound AS (SELECT * FROM damaged WHERE {ACCEPTED}), {cleaning("sound")}
  SELECT {ELEVEN}, number % 4 AS batch_id, sink FROM cleaned, (VALUES ('table'), ('second')) AS sinks(sink)"""
MOMENT = "CAST(floor(epoch(event_timestamp)) AS BIGINT)"
MIDDLE = f"(SELECT CAST(floor((min({MOMENT}) + max({MOMENT})) / 2) AS BIGINT) FROM cleaned)"
ROLLED = f"""{CLEANED} SELECT {", ".join("ingested_at + to_hours(CAST(CAST(event_id AS BIGINT) % 6 AS INTEGER)) AS ingested_at" if c == "ingested_at" else c for c in TARGET_COLUMNS)},
  CAST(event_id AS BIGINT) % 6 AS batch_id FROM cleaned"""
PART = "concat('part=', CAST(floor(CAST(event_id AS BIGINT) / 500) AS BIGINT) * 7)"

SQL |= {
    "rolled_up_append": ROLLED,
    "landing_file_counts": f"""WITH {UE} SELECT {PART} AS file_id,
      count(*) FILTER (WHERE event_type = 'view') AS views,
      count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM ue GROUP BY 1""",
    "landing_running_total": f"""WITH {UE} SELECT file_id, n, CAST(sum(n) OVER (ORDER BY file_id) AS BIGINT) AS total
      FROM (SELECT {PART} AS file_id, count(*) AS n FROM ue GROUP BY 1)""",
    "unmatched_quarantine": f"""WITH lacking AS (
        SELECT e.event_id, e.event_type FROM events e LEFT JOIN part p
          ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey AND p.p_partkey % 10 <> 3
        WHERE p.p_partkey IS NULL)
      SELECT CAST(event_id AS VARCHAR) AS event_id, reason FROM lacking,
        (VALUES ('product_name_null'), ('category_null'), ('price_not_positive'),
          ('total_amount_not_positive')) AS reasons(reason)
      UNION ALL SELECT CAST(event_id AS VARCHAR), 'event_type_unknown' FROM events WHERE NOT ({KNOWN})""",
    "accepted_events": f"{SOUND} SELECT {ELEVEN} FROM cleaned",
    "accepted_narrow_money": f"""{SOUND} SELECT event_id, CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price,
      CAST(CAST(total_amount AS DECIMAL(10,2)) AS DOUBLE) AS total_amount FROM cleaned""",
    "accepted_revenue_by_category": f"{SOUND} {CATEGORY}",
    "accepted_category_revenue_purchases": f"""{SOUND} SELECT category, {EXACT} AS total_revenue,
      count(*) AS purchases FROM cleaned WHERE event_type = 'purchase' GROUP BY category""",
    "accepted_category_coverage": f"""{SOUND} SELECT count(*) AS categories, min(revenue) AS min_revenue
      FROM ({CATEGORY})""",
    "damaged_kpi_report": _kpis(
        f"WITH {DAMAGED}, {cleaning('damaged').replace('cleaned AS', 'once AS', 1)}, "
        "cleaned AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE event_type = 'purchase')"
    ),
    "stream_minutes_append": f"""{CLEANED}, arrived AS (SELECT * FROM cleaned
        WHERE NOT ({MOMENT} < {MIDDLE} AND CAST(event_id AS BIGINT) % 50 = 0))
      SELECT CAST(date_trunc('minute', event_timestamp) AS TIMESTAMP) AS event_minute, count(*) AS n,
        CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE)
        AS revenue FROM arrived GROUP BY 1
      HAVING event_minute + INTERVAL 1 MINUTE <= (SELECT max(event_timestamp) FROM arrived) - INTERVAL 10 MINUTE""",
    "stream_runs": RUN_ROWS,
    "stream_runs_day": RUN_ROWS,
    "stream_runs_state": RUN_ROWS,
    "stream_runs_quarantine": f"WITH {NUMBERED}, arrived AS (SELECT damaged.*, CAST(batch AS BIGINT) AS batch_id FROM {ARRIVED}) "
    + " UNION ALL ".join(
        f"SELECT event_id, '{name}' AS reason, batch_id FROM arrived WHERE {broken}" for name, broken in RULES.items()
    ),
    "stream_runs_metrics": f"""WITH {NUMBERED}, counted AS (SELECT CAST(batch AS BIGINT) AS batch_id,
        count(*) FILTER (WHERE {ACCEPTED}) AS accepted, count(*) FILTER (WHERE NOT ({ACCEPTED})) AS rejected
        FROM {ARRIVED} GROUP BY 1)
      SELECT *, CAST(sum(accepted) OVER (ORDER BY batch_id) AS BIGINT) AS total FROM counted""",
}
SQL["stream_two_checkpoints"] = f"""WITH {NUMBERED}, sound AS (SELECT * FROM damaged WHERE {ACCEPTED}), {cleaning("sound")}
  SELECT {ELEVEN}, CASE number % 3 WHEN 2 THEN 1 ELSE 0 END::BIGINT AS batch_id,
    CASE number % 3 WHEN 1 THEN 'B' ELSE 'A' END AS checkpoint FROM cleaned"""
SQL |= {
    "stream_committed": f"""WITH {NUMBERED}, sound AS (SELECT * FROM damaged WHERE {ACCEPTED}), {cleaning("sound")}
      SELECT event_id, number % 3 AS batch_id, sink FROM cleaned, (VALUES ('table'), ('second')) AS sinks(sink)
      WHERE number % 3 < 2""",
    "stream_late_rows": f"""{CLEANED} SELECT event_id, event_timestamp,
        {MOMENT} < {MIDDLE} AND CAST(event_id AS BIGINT) % 50 = 0
          AND event_timestamp < (SELECT max(event_timestamp) FROM cleaned WHERE NOT ({MOMENT} < {MIDDLE}
            AND CAST(event_id AS BIGINT) % 50 = 0)) - INTERVAL 10 MINUTE AS late
      FROM cleaned""",
    "small_batches": f"""{CLEANED}, days AS (SELECT event_id, date_diff('day', DATE '2024-01-01',
        CAST(event_timestamp AS DATE)) % 9 AS day FROM cleaned)
      SELECT event_id, CAST(least(day, (day + 5) % 9) AS BIGINT) AS batch_id FROM days WHERE day >= 0""",
    "user_events_lookup": f"""{CLEANED}, ranked AS (SELECT user_id FROM cleaned GROUP BY user_id
        ORDER BY count(*) DESC, user_id LIMIT 1)
      SELECT {", ".join(TARGET_COLUMNS)}, CAST(event_timestamp AS DATE) AS event_date
      FROM cleaned SEMI JOIN ranked USING (user_id)""",
    "category_events_lookup": f"""{CLEANED}, ranked AS (SELECT category FROM cleaned WHERE event_type = 'purchase'
        GROUP BY category ORDER BY count(*) DESC, category LIMIT 1)
      SELECT {", ".join(TARGET_COLUMNS)}, CAST(event_timestamp AS DATE) AS event_date
      FROM cleaned SEMI JOIN ranked USING (category) WHERE event_type = 'purchase'""",
    "partials_running_total": f"""{CLEANED} SELECT day, n, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS total
      FROM (SELECT CAST(date_trunc('day', event_timestamp) AS TIMESTAMP) AS day, count(*) AS n FROM cleaned GROUP BY 1)""",
}
SQL |= {
    f"partials_{name}": SQL[name]
    for name in (
        "event_type_share",
        "category_revenue_purchases",
        "events_per_minute",
        "latency_stats",
        "kpi_report",
    )
}
PART_COUNTS = f"""WITH {NUMBERED}, parts AS (SELECT number % 4 AS batch_id, {ACCEPTED} AS good FROM damaged)"""
SQL |= {
    "stream_admission": f"""{PART_COUNTS} SELECT count(*) FILTER (WHERE good) AS accepted,
      count(*) FILTER (WHERE NOT good) AS rejected, true AS as_many_batches FROM parts""",
    "stream_archive": f"WITH {UE} SELECT count(*) AS n, true AS some_moved FROM ue",
    "stream_instants": f"""{PART_COUNTS} SELECT batch_id, count(*) AS n, CAST(1 AS BIGINT) AS instants, true AS rising
      FROM parts WHERE good GROUP BY batch_id""",
    "stream_empty_batches": f"""WITH {UE}, parts AS (SELECT CAST(event_id AS BIGINT) % 4 AS batch_id,
        {KNOWN} AND CAST(event_id AS BIGINT) % 2 = 0 AS good FROM ue)
      SELECT batch_id, count(*) FILTER (WHERE good) AS accepted, count(*) FILTER (WHERE NOT good) AS rejected,
        count(*) FILTER (WHERE good) AS stored, count(*) FILTER (WHERE NOT good) AS aside FROM parts GROUP BY batch_id""",
    "stream_throughput": f"""{PART_COUNTS} SELECT batch_id, count(*) FILTER (WHERE good) AS accepted, true AS agrees
      FROM parts GROUP BY batch_id""",
    "stream_triggers": SQL["stream_ingest"],
    "stream_stopped": f"{SOUND} SELECT event_id, true AS once FROM cleaned",
    "catalog_columns": f"{CLEANED} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal_position, '{c.name}' AS column_name, "
        f"'{c.kind}' AS data_type, count(*) AS n FROM cleaned"
        for i, c in enumerate((*TARGET, TargetColumn("event_date", "date")), start=1)
    ),
}
SQL["stream_repaired"] = f"""WITH {UE}, kinds AS (SELECT *, CAST(event_id AS BIGINT) % 7 AS kind FROM ue)
  SELECT event_id, CASE WHEN kind <> 1 OR ({KNOWN}) THEN price END AS price, CASE WHEN kind = 2 OR NOT ({KNOWN}) THEN 'open' ELSE 'stored' END AS place FROM kinds"""
SQL["stream_minutes_gated"] = SQL["stream_minutes_append"]
SQL["latest_stored"] = SQL["latest_events"]
SQL["newest_minutes"] = SQL["events_per_minute"]
