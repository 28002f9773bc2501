"""The queries of :mod:`weirflow.plans.catalog` in plain SQL over the same tables, for checking."""

from __future__ import annotations

SALES = """
sales AS (
  SELECT o.o_orderdate AS event_time, o.o_custkey AS customer_id, r.r_name AS region,
         l.l_partkey AS product_id, p.p_name AS product_name, p.p_type AS category,
         l.l_quantity AS quantity,
         COALESCE(CAST(p.p_retailprice AS DECIMAL(12,4)), 0) AS unit_price,
         CAST(COALESCE(CAST(p.p_retailprice AS DECIMAL(12,4)), 0) * CAST(l.l_quantity AS DECIMAL(12,4))
              AS DECIMAL(18,4)) AS total_amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  {how} JOIN customer c ON o.o_custkey = c.c_custkey
  {how} JOIN nation n ON c.c_nationkey = n.n_nationkey
  {how} JOIN region r ON n.n_regionkey = r.r_regionkey
  {how} JOIN part p ON l.l_partkey = p.p_partkey
)"""
LEFT_SALES = SALES.format(how="LEFT")

ACTIONS = """
actions AS (
  SELECT event_id, ts AS event_time, user_id, event_type AS action, CAST(value AS DECIMAL(12,2)) AS amount
  FROM events
)"""

BACKDATED = """
backdated AS (
  SELECT event_id, CASE WHEN event_id % 50 = 0 THEN ts - INTERVAL 90 MINUTE ELSE ts END AS event_time,
         user_id, event_type AS action, value AS amount
  FROM events
)"""


def bucket(size: str, time: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '{size}', {time}, TIMESTAMP '1970-01-01')"


def tumbling(source: str, keys: str, measures: str, size: str, where: str = "") -> str:
    columns = f", {keys}" if keys else ""
    return f"""
  SELECT {bucket(size)} AS window_start, {bucket(size)} + INTERVAL '{size}' AS window_end{columns}, {measures}
  FROM {source} WHERE event_time IS NOT NULL GROUP BY ALL {where}"""


def sliding(source: str, keys: str, measures: str, size: str, slide: str, copies: int) -> str:
    start = f"{bucket(slide)} - k * INTERVAL '{slide}'"
    return f"""
  SELECT {start} AS window_start, {start} + INTERVAL '{size}' AS window_end, {keys}, {measures}
  FROM {source}, range({copies}) AS t(k) GROUP BY ALL"""


def sessions(source: str, keys: str, gap: str) -> str:
    """Rows of ``source`` with the start and end of their session."""
    return f"""
marked AS (
  SELECT *, CASE WHEN lag(event_time) OVER w IS NULL OR event_time > lag(event_time) OVER w + INTERVAL '{gap}'
                 THEN 1 ELSE 0 END AS opens
  FROM {source} WHERE event_time IS NOT NULL WINDOW w AS (PARTITION BY {keys} ORDER BY event_time)
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY event_time
                             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
  FROM marked
),
in_session AS (
  SELECT *, min(event_time) OVER s AS session_start, max(event_time) OVER s + INTERVAL '{gap}' AS session_end
  FROM numbered WINDOW s AS (PARTITION BY {keys}, session_no)
)"""


MONEY = "CAST(sum(total_amount) AS DOUBLE)"
UNITS = "sum(quantity)"
SALES_MEASURES = f"{MONEY} AS revenue, {UNITS} AS units"
PRODUCT = "region, product_id, product_name, category"
EXACT = f"sum(total_amount) AS exact_revenue, {UNITS} AS units"

DASHBOARD = tumbling("sales", "region, category", SALES_MEASURES, "30 days")


def top_products(table: str) -> str:
    return f"""
WITH {LEFT_SALES}, totals AS ({table}),
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY window_start, window_end, region
                               ORDER BY exact_revenue DESC, units DESC) AS "rank"
  FROM totals
)
SELECT window_start, window_end, {PRODUCT}, CAST(exact_revenue AS DOUBLE) AS revenue, units,
       CAST("rank" AS INTEGER) AS "rank"
FROM ranked WHERE "rank" <= 5"""


SALES_SESSIONS = f"WITH {LEFT_SALES}, {sessions('sales', 'customer_id, region', '30 days')}"

KPIS = f"""{SALES_SESSIONS},
kpis AS (
  SELECT session_start, session_end, customer_id, region, count(*) AS events_count, {UNITS} AS units,
         round(sum(total_amount), 2) AS session_revenue
  FROM in_session GROUP BY ALL
)"""


def top_sessions(within: str, closed: str = "true") -> str:
    return f"""{KPIS},
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY {within} ORDER BY session_revenue DESC, units DESC) AS "rank"
  FROM kpis WHERE {closed}
)
SELECT session_start, session_end, region, customer_id, CAST("rank" AS INTEGER) AS "rank",
       CAST(session_revenue AS DOUBLE) AS session_revenue, units, events_count
FROM ranked WHERE "rank" <= 5"""


PRODUCT_TOTALS = """
product_totals AS (
  SELECT session_start, session_end, customer_id, region, product_id, product_name,
         sum(quantity) AS product_units, sum(total_amount) AS exact_revenue
  FROM in_session GROUP BY ALL
)"""

PRODUCT_MIX = """
mix AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY session_start, session_end, customer_id, region
                                 ORDER BY exact_revenue DESC, product_units DESC, product_id DESC) AS "position"
    FROM product_totals
  ) WHERE "position" <= 5
)"""

HIGH_VALUE = """
  SELECT event_id AS transaction_id, user_id, value AS amount, event_type AS region, ts AS event_time,
         'High Value > 200' AS fraud_reason
  FROM events WHERE value > 200"""

BURST = f"""
  SELECT {bucket('6 hours', 'ts')} AS window_start, {bucket('6 hours', 'ts')} + INTERVAL '6 hours' AS window_end,
         user_id, count(*) AS n, 'Burst Activity > 2 txns/6 h' AS fraud_reason
  FROM events GROUP BY ALL HAVING count(*) > 2"""

USER_SESSIONS = f"{ACTIONS}, {sessions('actions', 'user_id', '30 minutes')}"

SWITCH = """
  SELECT session_start, session_end, user_id, count(DISTINCT action) AS distinct_values,
         'Multiple Regions in Session' AS fraud_reason
  FROM in_session GROUP BY session_start, session_end, user_id HAVING count(DISTINCT action) > 1"""

ALERTS = """
SELECT * FROM high
UNION ALL SELECT NULL, user_id, NULL, NULL, NULL, fraud_reason FROM burst
UNION ALL SELECT NULL, user_id, NULL, NULL, NULL, fraud_reason FROM switch"""

AUDIT = f"""WITH {BACKDATED},
batches AS (SELECT event_id // 100 AS batch_id, max(event_time) AS latest FROM backdated GROUP BY ALL),
marks AS (
  SELECT batch_id, max(latest) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                   - INTERVAL 30 MINUTE AS watermark
  FROM batches
),
audit AS (
  SELECT event_id, event_time, batch_id, {bucket('1 hour')} + INTERVAL 1 HOUR AS window_end, watermark
  FROM (SELECT *, event_id // 100 AS batch_id FROM backdated) JOIN marks USING (batch_id)
),
status AS (
  SELECT *, CASE WHEN window_end <= watermark THEN 'dropped' WHEN event_time < watermark THEN 'late_kept'
                 ELSE 'on_time' END AS status
  FROM audit
)"""

ENRICHED = """SELECT event_time, customer_id, region, product_id, product_name, category, quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount FROM sales"""

ORACLE: dict[str, str] = {
    "enrich_sales": f"WITH {LEFT_SALES} {ENRICHED}",
    "enrich_sales_inner": f"WITH {SALES.format(how='')} {ENRICHED}",
    "tumbling_sales_by_region_category": f"WITH {LEFT_SALES} {DASHBOARD}",
    "dashboard_first_rows": f"WITH {LEFT_SALES} {DASHBOARD} ORDER BY window_start, region, category LIMIT 40",
    "tumbling_count_by_action": f"WITH {ACTIONS} {tumbling('actions', 'action', 'count(*) AS count', '1 hour')}",
    "tumbling_count": f"WITH {ACTIONS} {tumbling('actions', '', 'count(*) AS count', '1 hour')}",
    "tumbling_total_by_region":
        f"WITH {LEFT_SALES} {tumbling('sales', 'region', MONEY + ' AS total_sales', '30 days')}",
    "tumbling_product_revenue": f"WITH {LEFT_SALES} {tumbling('sales', PRODUCT, SALES_MEASURES, '30 days')}",
    "sliding_product_revenue":
        f"WITH {LEFT_SALES} {sliding('sales', PRODUCT, SALES_MEASURES, '28 days', '7 days', 4)}",
    "topn_products_tumbling": top_products(tumbling("sales", PRODUCT, EXACT, "30 days")),
    "topn_products_sliding": top_products(sliding("sales", PRODUCT, EXACT, "28 days", "7 days", 4)),
    "session_amount_by_user": f"""WITH {USER_SESSIONS}
SELECT session_start, session_end, user_id, CAST(sum(amount) AS DOUBLE) AS session_amount
FROM in_session GROUP BY session_start, session_end, user_id""",
    "session_kpis": f"""{KPIS}
SELECT * REPLACE (CAST(session_revenue AS DOUBLE) AS session_revenue) FROM kpis""",
    "session_spend_metrics": f"""{SALES_SESSIONS}
SELECT session_start, session_end, customer_id, region,
       CAST(sum(total_amount) * 10000 AS DOUBLE) / count(total_amount) / 10000 AS avg_spend, {UNITS} AS total_items
FROM in_session GROUP BY session_start, session_end, customer_id, region""",
    "session_order_revenue": f"""WITH placed AS (
  SELECT o_orderdate AS event_time, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         o_orderpriority AS region
  FROM orders
), {sessions('placed', 'customer_id, region', '30 days')}
SELECT session_start, session_end, customer_id, region, count(*) AS event_count,
       CAST(sum(amount) AS DOUBLE) AS session_revenue
FROM in_session GROUP BY session_start, session_end, customer_id, region""",
    "top_sessions_by_region": top_sessions("region"),
    "top_sessions_exact_interval": top_sessions("session_start, session_end, region"),
    "avg_session_duration_by_region": f"""{KPIS}
SELECT region, avg(epoch(session_end) - epoch(session_start)) AS avg_session_s FROM kpis GROUP BY region""",
    "session_product_totals": f"""{SALES_SESSIONS}, {PRODUCT_TOTALS}
SELECT * EXCLUDE (exact_revenue), CAST(exact_revenue AS DOUBLE) AS product_revenue FROM product_totals""",
    "session_product_mix": f"""{SALES_SESSIONS}, {PRODUCT_TOTALS}, {PRODUCT_MIX}
SELECT * EXCLUDE (exact_revenue) REPLACE (CAST("position" AS INTEGER) AS "position"),
       CAST(exact_revenue AS DOUBLE) AS product_revenue FROM mix""",
    "session_product_mix_json": f"""{SALES_SESSIONS}, {PRODUCT_TOTALS}, {PRODUCT_MIX}
SELECT session_start, session_end, customer_id, region,
       '[' || string_agg('{{"r":' || CAST(CAST(exact_revenue AS DECIMAL(18,2)) AS VARCHAR) || ',"u":' || product_units || ',"n":"'
                         || product_name || '"}}', ',' ORDER BY "position") || ']' AS top_products_json
FROM mix GROUP BY session_start, session_end, customer_id, region""",
    "session_product_fragments": f"""WITH {LEFT_SALES},
{sessions('sales', 'customer_id, region, product_id, product_name', '30 days')}, {PRODUCT_TOTALS}
SELECT * EXCLUDE (exact_revenue), CAST(exact_revenue AS DOUBLE) AS product_revenue FROM product_totals""",
    "fraud_high_value": HIGH_VALUE,
    "fraud_burst": BURST,
    "fraud_attribute_switch": f"WITH {USER_SESSIONS} {SWITCH}",
    "fraud_alerts": f"WITH {USER_SESSIONS}, high AS ({HIGH_VALUE}), burst AS ({BURST}), switch AS ({SWITCH}) {ALERTS}",
    "late_events_backdated": f"WITH {BACKDATED} SELECT * FROM backdated",
    "late_event_audit": f"{AUDIT} SELECT * FROM status",
    "late_event_counts": f"{AUDIT} SELECT status, count(*) AS events FROM status GROUP BY status",
    "parse_event_lines": """
SELECT CAST(user_id AS VARCHAR) AS user_id,
       CASE WHEN event_id % 101 <> 0 AND event_id % 97 <> 0 THEN date_trunc('second', ts) END AS event_time,
       CASE WHEN event_id % 101 <> 0 THEN event_type END AS action,
       CASE WHEN event_id % 101 <> 0 AND event_id % 97 <> 0 THEN CAST(floor(value) AS INTEGER) END AS amount
FROM events""",
    "parse_event_json": "SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
    "kafka_payload": """
SELECT user_id || '|' || event_id AS key,
       '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
FROM events""",
}

# Streams. Append mode holds back what the watermark has not passed; it stands at the latest event time, in
# milliseconds, less the allowed delay. A query with several watermarks goes by the slowest of them.


def passed(delay: str, end: str, source: str = "events", time: str = "ts") -> str:
    return f"{end} <= (SELECT date_trunc('milliseconds', max({time})) - INTERVAL '{delay}' FROM {source})"


ACTION_COUNTS = tumbling("actions", "action", "count(*) AS count", "1 hour")

LINES = """
lines AS (
  SELECT user_id, date_trunc('second', ts) AS event_time, event_type AS action, floor(value) AS amount
  FROM events WHERE event_id % 97 <> 0 AND event_id % 101 <> 0
)"""

# The end of the last slot that a 30-day watermark has closed. A session is over once an event that comes still, which lies
# in a later slot, can no longer be within a gap of its last event; a gap of just that length still joins.
CLOSED_UNTIL = f"""(
  SELECT max({bucket('30 days')} + INTERVAL '30 days') FROM sales
  WHERE {passed('30 days', bucket('30 days') + " + INTERVAL '30 days'", 'sales', 'event_time')}
)"""

# Four parts by id. Spark drops a row whose window had ended when its part came, by the watermark of the parts before.
LATE_COUNTS = f"""WITH {BACKDATED},
parts AS (
  SELECT *, {bucket('1 hour')} AS window_start, event_id // ((SELECT max(event_id) FROM events) // 4 + 1) AS part FROM backdated
),
marks AS (
  SELECT part, date_trunc('milliseconds', max(max(event_time)) OVER (ORDER BY part)) - INTERVAL 30 MINUTE AS passed FROM parts GROUP BY part
),
kept AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end FROM parts LEFT JOIN marks ON marks.part = parts.part - 1
  WHERE marks.passed IS NULL OR window_start + INTERVAL 1 HOUR > marks.passed
)
SELECT window_start, window_end, count(*) AS count FROM kept
WHERE window_end <= (SELECT max(passed) FROM marks) GROUP BY ALL"""

ORACLE.update(
    {
        "stream_tumbling_complete": f"WITH {ACTIONS} {ACTION_COUNTS}",
        "stream_tumbling_append": f"""WITH {ACTIONS}, counts AS ({ACTION_COUNTS})
SELECT * FROM counts WHERE {passed('30 minutes', 'window_end')}""",
        "stream_tumbling_update": f"WITH {ACTIONS} {ACTION_COUNTS}",
        "stream_session_append": f"""WITH {USER_SESSIONS}
SELECT session_start, session_end, user_id, CAST(sum(amount) AS DOUBLE) AS session_amount
FROM in_session WHERE {passed('30 minutes', 'session_end')} GROUP BY session_start, session_end, user_id""",
        "stream_sales_dashboard": f"WITH {LEFT_SALES} {DASHBOARD}",
        "stream_topn_tumbling": ORACLE["topn_products_tumbling"],
        "stream_topn_snapshot": ORACLE["topn_products_sliding"],
        "stream_top_sessions": top_sessions("region", passed("30 days", "session_end", "sales", "event_time")),
        "stream_batch_rows": f"""WITH {ACTIONS}, counts AS ({ACTION_COUNTS})
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n_rows FROM counts""",
        "stream_late_counts": LATE_COUNTS,
        "stream_json_folder": f"""WITH sent AS (
  SELECT date_trunc('milliseconds', ts) AS event_time, event_type AS action FROM events
), counts AS ({tumbling('sent', 'action', 'count(*) AS count', '1 hour')})
SELECT * FROM counts WHERE {passed('30 minutes', 'window_end', 'sent', 'event_time')}""",
        "stream_avg_session_duration": f"""{KPIS}
SELECT region, avg(epoch(session_end) - epoch(session_start)) AS avg_session_s FROM kpis
WHERE {passed('30 days', 'session_end', 'sales', 'event_time')} GROUP BY region""",
        "stream_session_product_mix": f"""{SALES_SESSIONS}, {PRODUCT_TOTALS}, {PRODUCT_MIX}
SELECT * EXCLUDE (exact_revenue) REPLACE (CAST("position" AS INTEGER) AS "position"),
       CAST(exact_revenue AS DOUBLE) AS product_revenue
FROM mix WHERE session_end < {CLOSED_UNTIL}""",
        "stream_fraud_alerts": f"""WITH {USER_SESSIONS}, high AS ({HIGH_VALUE}),
burst AS (SELECT * FROM ({BURST}) WHERE {passed('5 minutes', 'window_end')}),
switch AS (SELECT * FROM ({SWITCH}) WHERE {passed('5 minutes', 'session_end')}) {ALERTS}""",
        "stream_late_enrichment": f"""WITH {SALES.format(how='')} {ENRICHED.replace(
            'event_time,',
            "CASE WHEN product_id % 50 = 0 THEN event_time - INTERVAL 90 SECOND ELSE event_time END AS event_time,",
        )}""",
        "stream_line_sessions": f"""WITH {LINES}, {sessions('lines', 'user_id', '30 minutes')}
SELECT session_start, session_end, CAST(user_id AS VARCHAR) AS user_id,
       CAST(sum(amount) AS BIGINT) AS session_amount
FROM in_session WHERE {passed('30 minutes', 'session_end', 'lines', 'event_time')}
GROUP BY session_start, session_end, user_id""",
        "stream_line_counts": f"""WITH {LINES},
counts AS ({tumbling('lines', 'action', 'count(*) AS count', '1 hour')})
SELECT * FROM counts WHERE {passed('30 minutes', 'window_end', 'lines', 'event_time')}""",
        "stream_json_sessions": f"""WITH sent AS (
  SELECT date_trunc('milliseconds', ts) AS event_time, CAST(user_id AS INTEGER) AS customer_id, value AS amount,
         event_type AS region
  FROM events
), {sessions('sent', 'customer_id, region', '30 minutes')}
SELECT session_start, session_end, customer_id, region, count(*) AS event_count, round(sum(amount), 2) AS session_revenue
FROM in_session WHERE {passed('1 hour', 'session_end')}
GROUP BY session_start, session_end, customer_id, region""",
    }
)

DURATIONS = f"""{SALES_SESSIONS},
closed AS (
  SELECT DISTINCT session_start, session_end, customer_id, region FROM in_session
  WHERE {passed('30 days', 'session_end', 'sales', 'event_time')}
), placed AS (
  SELECT *, {bucket('90 days', "session_end - INTERVAL 1 MICROSECOND")} AS window_start FROM closed
)"""

ORACLE.update(
    {
        "stream_session_merge": f"""WITH {ACTIONS}, sent AS (
  SELECT *, CAST(2 * floor(date_diff('day', (SELECT min(event_time) FROM actions), event_time) / 15) + event_id % 2 AS BIGINT) AS part FROM actions
), {sessions('sent', 'user_id', '12 hours')}
SELECT session_start, session_end, user_id, CAST(sum(amount) AS DOUBLE) AS session_amount, count(*) AS events,
       min(part) AS first_part, max(part) AS last_part
FROM in_session WHERE {passed('15 days', 'session_end')} GROUP BY session_start, session_end, user_id""",
        "stream_session_duration_windows": f"""{DURATIONS}
SELECT window_start, window_start + INTERVAL '90 days' AS window_end, region, count(*) AS n_sessions,
       avg(epoch(session_end) - epoch(session_start)) AS avg_session_s
FROM placed WHERE {passed('30 days', "window_start + INTERVAL '90 days'", 'sales', 'event_time')} GROUP BY window_start, region""",
        "stream_state_sizes": f"""{DURATIONS},
open_sessions AS (
  SELECT count(DISTINCT (session_start, customer_id, region)) AS n FROM in_session
  WHERE NOT ({passed('30 days', 'session_end', 'sales', 'event_time')})
), open_windows AS (
  SELECT count(DISTINCT (window_start, region)) AS n FROM placed
  WHERE NOT ({passed('30 days', "window_start + INTERVAL '90 days'", 'sales', 'event_time')})
)
SELECT CAST(0 AS BIGINT) AS operator_id, n AS state_rows FROM open_windows UNION ALL SELECT 1, n FROM open_sessions""",
        "stream_two_outputs": f"""WITH {ACTIONS}, counts AS ({ACTION_COUNTS})
SELECT *, count = max(count) OVER (PARTITION BY window_start) AS busiest FROM counts""",
        "stream_topn_leaderboard": ORACLE["topn_products_sliding"],
        "stream_hot_enrichment": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_orderdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    }
)
