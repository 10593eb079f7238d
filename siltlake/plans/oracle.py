"""The same results in SQL for an independent engine, straight from the tables.

Nothing here shares code with the operators: every rule is written out again.
"""

from __future__ import annotations

START = 1706000000000
DELAY = 300000

EVENTS = """
ev AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, ts, user_id, event_type, value, props,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events)"""

CHANGES = f"""{EVENTS},
ch AS (
  SELECT event_id // 4 AS id, user_id, k AS product_id, CAST(k % 5 + 1 AS INTEGER) AS quantity,
         value AS total_amount, event_type AS status, ts_ms AS created_at, ts_ms AS updated_at,
         op, ts_ms, ts_ms + {DELAY} AS arrived_ms, event_id AS _position,
         CASE WHEN event_id % 4 < 2 THEN 0 ELSE 1 END AS in_order,
         CASE WHEN (event_id % 4 < 2) = ((event_id // 4) % 2 = 1) THEN 0 ELSE 1 END AS late
  FROM ev)"""

TIER = """CASE WHEN total_amount < 100 THEN 'Small' WHEN total_amount < 500 THEN 'Medium' ELSE 'Large' END"""

BRONZE = "id, user_id, product_id, quantity, total_amount, status, created_at, updated_at, op, ts_ms"
SILVER = (
    "id, user_id, product_id, quantity, total_amount, status, created_at, updated_at, "
    "order_value_category, is_active, op, ts_ms, _position"
)


def latest(where: str = "TRUE") -> str:
    """Silver rows of one batch of order changes."""
    return f"""(
  SELECT * EXCLUDE (rn), {TIER} AS order_value_category, op IS DISTINCT FROM 'd' AS is_active
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, _position DESC) AS rn
        FROM ch WHERE {where})
  WHERE rn = 1)"""


USERS = f"""
us AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE lower(c_mktsegment)
           WHEN 'machinery' THEN 'no-address-' || c_custkey
           WHEN 'household' THEN 'u@' || c_custkey || '@household'
           WHEN 'furniture' THEN NULL
           ELSE 'u' || c_custkey || '@' || lower(c_mktsegment) || '.example.com' END AS email,
         c_mktsegment AS department, {START} + c_custkey * 1000 AS ts_ms,
         CASE WHEN c_acctbal < 0 THEN 'd' ELSE 'c' END AS op
  FROM customer),
silver_users AS (
  SELECT *, CASE WHEN email IS NULL THEN NULL WHEN strpos(email, '@') = 0 THEN ''
                 ELSE substr(email, strpos(email, '@') + 1) END AS email_domain,
         op <> 'd' AS is_active
  FROM us)"""

PRODUCTS = f"""
pr AS (
  SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, p_type AS category,
         {START} + p_partkey * 1000 AS ts_ms, CASE WHEN p_size < 3 THEN 'd' ELSE 'c' END AS op
  FROM part)"""

ORDERS = f"{CHANGES},\nsilver_orders AS {latest()}"

MONEY = "CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"
DAY = "strftime(make_timestamp(created_at * 1000), '%Y-%m-%d')"

USER_STATS = f"""
user_totals AS (
  SELECT user_id, CAST(count(*) AS BIGINT) AS total_orders, {MONEY} AS total_spent,
         {MONEY} / count(total_amount) AS avg_order_value
  FROM silver_orders WHERE is_active GROUP BY user_id)"""

PRODUCT_STATS = f"""
product_totals AS (
  SELECT product_id, count(*) AS total_orders, {MONEY} AS total_revenue,
         count(DISTINCT user_id) AS unique_customers
  FROM silver_orders WHERE is_active GROUP BY product_id)"""

DAILY = f"""
live AS (SELECT *, {DAY} AS date_key FROM silver_orders WHERE is_active),
daily AS (
  SELECT date_key, count(*) AS total_orders, {MONEY} AS total_revenue,
         {MONEY} / count(total_amount) AS avg_order_value, count(DISTINCT user_id) AS unique_customers
  FROM live GROUP BY date_key),
by_product AS (
  SELECT date_key, product_id, {MONEY} AS product_revenue FROM live GROUP BY date_key, product_id),
best AS (
  SELECT date_key, product_id AS top_product FROM (
    SELECT *, row_number() OVER (PARTITION BY date_key ORDER BY product_revenue DESC, product_id) AS rn
    FROM by_product) WHERE rn = 1)"""

SUMMARY = f"""WITH {ORDERS}, {DAILY}
SELECT d.*, coalesce(b.top_product, 0) AS top_product FROM daily d LEFT JOIN best b USING (date_key)"""

MESSAGES = f"""{EVENTS},
msg AS (
  SELECT *, CASE WHEN event_type IN ('signup', 'error') THEN 'users' WHEN event_type = 'view' THEN 'products'
                 ELSE 'orders' END AS source_table,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'c' WHEN event_type = 'error' THEN 'd'
              ELSE 'u' END AS operation,
         CASE WHEN event_type IN ('signup', 'error') THEN user_id WHEN event_type = 'view' THEN k
              ELSE event_id // 4 END AS entity
  FROM ev)"""

ALL_CHANGES = f"WITH {CHANGES} SELECT {BRONZE} FROM ch"


def merged(split: str, hard: bool = False) -> str:
    """Batch 0, then batch 1 merged into it, by the rules of the merge."""
    columns = [c.strip() for c in SILVER.split(",")]
    head = f"WITH {CHANGES},\nt0 AS {latest(f'{split} = 0')},\ns AS {latest(f'{split} = 1')}"
    if hard:
        picked = ", ".join(f"CASE WHEN s.id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in columns)
        return f"""{head}, t AS (SELECT * FROM t0 WHERE op <> 'd')
SELECT {picked} FROM t FULL OUTER JOIN s ON t.id = s.id WHERE s.id IS NULL OR s.op <> 'd'"""
    marked = {"op": "'d'", "is_active": "FALSE"}
    cases = []
    for c in columns:
        mark = f"WHEN s.op = 'd' THEN {marked[c]} " if c in marked else ""
        cases.append(
            f"CASE WHEN t.id IS NULL THEN s.{c} WHEN s.id IS NULL THEN t.{c} "
            f"WHEN s.ts_ms > t.ts_ms THEN s.{c} {mark}ELSE t.{c} END AS {c}"
        )
    return f"{head}, t AS (SELECT * FROM t0)\nSELECT {', '.join(cases)} FROM t FULL OUTER JOIN s ON t.id = s.id"


def audit_row(name: str, source: str) -> str:
    counts = ", ".join(
        f"count(*) FILTER (op = '{op}') AS {label}" for op, label in (("c", "inserts"), ("u", "updates"), ("d", "deletes"))
    )
    return f"SELECT '{name}' AS table_name, count(*) AS total_events, {counts} FROM {source}"


def recent(name: str, source: str, position: str) -> str:
    return f"""SELECT * FROM (
  SELECT '{name}' AS table_name, id, op, ts_ms, ts_ms + {DELAY} AS arrived_ms FROM {source}
  ORDER BY ts_ms + {DELAY} DESC, {position} DESC LIMIT 20)"""


def by_op(op: str) -> str:
    return f"""SELECT * FROM (
  SELECT id, user_id, op, ts_ms, _position FROM ch WHERE op = '{op}'
  ORDER BY ts_ms DESC, _position DESC LIMIT 10)"""


ROUTES = f"""WITH {MESSAGES},
hit AS (
  SELECT 'processed.' || source_table AS topic, * FROM msg
  UNION ALL SELECT 'alerts.deletes' AS topic, * FROM msg WHERE operation = 'd')
SELECT topic, 'cdc.' || source_table AS key, event_id AS "offset", source_table || '_' || operation AS routing_key
FROM hit"""

VARIED_OP = "CASE WHEN event_type = 'view' THEN 'r' WHEN event_type = 'click' THEN NULL ELSE op END"
GAPPED_OP = "CASE WHEN event_type = 'click' THEN NULL ELSE op END"



def same_instant() -> str:
    """The last change of each user at the full hour: by position, or without
    one deletes last, then by the other columns in turn."""
    order = {
        "TRUE": "ts_ms DESC, event_id DESC",
        "FALSE": "ts_ms DESC, op = 'd' DESC, user_id DESC, product_id DESC, quantity DESC, total_amount DESC, "
        "status DESC, created_at DESC, updated_at DESC, op DESC",
    }
    parts = [
        f"""SELECT id, user_id, product_id, quantity, total_amount, status, created_at, updated_at, {TIER} AS
  order_value_category, op <> 'd' AS is_active, op, ts_ms, CASE WHEN {flag} THEN event_id END AS _position,
  {flag} AS positions
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {by}) AS rn FROM at_hour) WHERE rn = 1"""
        for flag, by in order.items()
    ]
    return f"""WITH {EVENTS}, at_hour AS (
  SELECT event_id, user_id AS id, user_id, k AS product_id, CAST(k % 5 + 1 AS INTEGER) AS quantity,
         value AS total_amount, event_type AS status, h AS created_at, h AS updated_at, op, h AS ts_ms
  FROM (SELECT *, ts_ms // 3600000 * 3600000 AS h FROM ev))
""" + "\nUNION ALL ".join(parts)


SQL: dict[str, str] = {
    "raw_json_read": ALL_CHANGES,
    "flat_normalise": f"WITH {CHANGES} SELECT id, status, total_amount, op, ts_ms FROM ch",
    "typed_projection": f"""WITH {EVENTS}
SELECT event_id AS id, CASE WHEN event_type <> 'click' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'signup' THEN k END AS product_id,
       CAST(CASE WHEN event_type <> 'error' THEN k END AS INTEGER) AS quantity,
       CASE WHEN event_type <> 'purchase' THEN value END AS total_amount, event_type AS status,
       CAST(NULL AS BIGINT) AS created_at, CAST(NULL AS BIGINT) AS updated_at, op, ts_ms
FROM ev""",
    "envelope_parse": f"""WITH {MESSAGES}
SELECT 'cdc.' || source_table AS topic, CAST(user_id % 8 AS INTEGER) AS "partition", event_id AS "offset",
       operation, CASE WHEN operation <> 'c' THEN CAST(entity AS VARCHAR) END AS before_id,
       CASE WHEN operation <> 'd' THEN CAST(entity AS VARCHAR) END AS after_id,
       CASE WHEN operation <> 'd' AND source_table <> 'orders' THEN source_table || '-' || entity END AS after_name,
       CASE WHEN operation <> 'd' AND source_table = 'orders' THEN CAST(user_id AS VARCHAR) END AS after_user_id,
       ts_ms AS source_timestamp, 'shop' AS source_database, source_table
FROM msg""",
    "routing_key": f"""WITH {EVENTS}, x AS (
  SELECT event_id, CASE WHEN k > 0 THEN 'orders' END AS source, {GAPPED_OP} AS op FROM ev)
SELECT event_id, source || '_' || op AS routing_key, op = 'd' AS is_delete FROM x""",
    "email_domain": f"WITH {USERS} SELECT id, email, email_domain FROM silver_users",
    "price_tier": """WITH x AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS a FROM events)
SELECT event_id,
       CASE WHEN a < 50 THEN 'Low' WHEN a < 200 THEN 'Medium' ELSE 'High' END AS price_category,
       CASE WHEN a IS NULL THEN 'Unknown' WHEN a < 50 THEN 'Low' WHEN a < 200 THEN 'Medium' ELSE 'High' END
         AS price_category_strict
FROM x""",
    "order_value_tier": """SELECT event_id, CASE WHEN event_type = 'error' THEN 'Large' WHEN value < 100 THEN 'Small'
       WHEN value < 500 THEN 'Medium' ELSE 'Large' END AS order_value_category FROM events""",
    "active_flag": "SELECT event_id, event_type <> 'error' AS is_active FROM events",
    "epoch_day_key": f"""WITH {EVENTS}
SELECT event_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS day,
       strftime(make_timestamp(-ts_ms * 1000), '%Y-%m-%d') AS day_before_1970 FROM ev""",
    "quality_score": f"""WITH {EVENTS}, x AS (SELECT event_id, {VARIED_OP} AS operation FROM ev)
SELECT event_id, operation, CASE WHEN operation IN ('c', 'u', 'd') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  AS quality_score FROM x""",
    "row_to_json": f"""WITH {MESSAGES}
SELECT 'out' AS topic, 'cdc.' || source_table AS key,
       '{{"topic":"cdc.' || source_table || '","partition":' || (user_id % 8) || ',"offset":' || event_id
       || ',"operation":"' || operation || '","source_table":"' || source_table || '","is_delete":'
       || CASE WHEN operation = 'd' THEN 'true}}' ELSE 'false,"id":"' || entity || '"}}' END AS value
FROM msg""",
    "inserts_only": f"{ALL_CHANGES} WHERE op = 'c'",
    "delete_alerts": f"""WITH {MESSAGES}
SELECT source_table, operation, CAST(entity AS VARCHAR) AS deleted_id, epoch_us(ts) AS at_us
FROM msg WHERE operation = 'd'""",
    "active_count": f"WITH {ORDERS} SELECT count(*) AS active_rows FROM silver_orders WHERE is_active",
    "op_counts": f"WITH {CHANGES} SELECT op, count(*) AS cnt FROM ch GROUP BY op",
    "table_event_audit": f"WITH {CHANGES}, {USERS}, {PRODUCTS}\n"
    + "\nUNION ALL ".join([audit_row("users", "us"), audit_row("products", "pr"), audit_row("orders", "ch")]),
    "recent_rows": f"WITH {CHANGES}, {USERS}, {PRODUCTS}\n"
    + "\nUNION ALL ".join(
        [recent("users", "us", "id"), recent("products", "pr", "id"), recent("orders", "ch", "_position")]
    ),
    "recent_by_op": f"WITH {CHANGES}\n" + "\nUNION ALL ".join(by_op(op) for op in "cud"),
    "layer_counts": f"""WITH {ORDERS}, {USERS}
SELECT 'orders' AS table_name, 'bronze' AS layer, count(*) AS row_count, CAST(NULL AS BIGINT) AS active_rows FROM ch
UNION ALL SELECT 'orders', 'silver', count(*), count(*) FILTER (is_active) FROM silver_orders
UNION ALL SELECT 'user_analytics', 'gold', count(*), NULL FROM silver_users WHERE is_active""",
    "windowed_op_counts": f"""WITH {EVENTS},
t AS (SELECT 'tumbling' AS kind, epoch_us(ts) // 3600000000 * 3600000 AS start_ms, 3600000 AS len, op FROM ev),
s AS (SELECT 'sliding' AS kind, epoch_us(ts) // 1800000000 * 1800000 - i * 1800000 AS start_ms, 7200000 AS len, op
      FROM ev, (SELECT unnest([0, 1, 2, 3]) AS i))
SELECT kind, start_ms, start_ms + len AS end_ms, op, count(*) AS cnt
FROM (SELECT * FROM t UNION ALL SELECT * FROM s) GROUP BY kind, start_ms, len, op""",
    "quality_gate_metrics": f"""WITH {CHANGES}
SELECT count(*) AS "rows", count(*) FILTER (total_amount < 1) AS corrupt_rows,
       count(*) FILTER (total_amount >= 1 AND product_id = 0) AS null_keys,
       count(*) FILTER (total_amount >= 1 AND status = 'click') AS unknown_ops,
       CAST({DELAY} AS BIGINT) AS max_lag_ms,
       (SELECT count(*) FROM events WHERE event_type NOT IN ('purchase', 'click')) AS quarantined_rows
FROM ch""",
    "enrich_users": f"""WITH {MESSAGES}, {USERS}
SELECT m.event_id AS "offset", m.source_table, m.operation, u.name AS users_name, u.email AS users_email
FROM msg m LEFT JOIN us u
  ON u.id = CASE WHEN m.operation = 'd' THEN NULL WHEN m.source_table IN ('users', 'orders') THEN m.user_id END""",
    "enrich_products": f"""WITH {MESSAGES}, {PRODUCTS}
SELECT m.event_id AS "offset", m.source_table, m.operation, p.name AS products_name,
       p.category AS products_category, p.price AS products_price
FROM msg m LEFT JOIN pr p ON p.id = CASE WHEN m.source_table IN ('products', 'orders') THEN m.k END""",
    "enrich_changelog": f"""WITH {CHANGES}, {USERS}
SELECT ch._position, ch.id, ch.user_id, us.name AS current_name, us.department AS current_department
FROM ch LEFT JOIN us ON us.id = ch.user_id WHERE ch.op = 'c'""",
    "user_order_stats": f"WITH {ORDERS}, {USER_STATS.replace(' WHERE is_active', '')} SELECT * FROM user_totals",
    "product_order_stats": f"WITH {ORDERS}, {PRODUCT_STATS.replace(' WHERE is_active', '')} SELECT * FROM product_totals",
    "daily_sales": f"WITH {ORDERS}, {DAILY.replace(' WHERE is_active', '')} SELECT * FROM daily",
    "daily_product_revenue": f"WITH {ORDERS}, {DAILY.replace(' WHERE is_active', '')} SELECT * FROM by_product",
    "top_product_per_day": f"WITH {ORDERS}, {DAILY.replace(' WHERE is_active', '')} SELECT * FROM best",
    "gold_user_analytics": f"""WITH {ORDERS}, {USERS}, {USER_STATS}
SELECT u.id AS user_id, u.name AS full_name, u.email_domain,
       strftime(make_timestamp(u.ts_ms * 1000), '%Y-%m-%d') AS registration_date,
       coalesce(t.total_orders, 0) AS total_orders, coalesce(t.total_spent, 0.0) AS total_spent,
       coalesce(t.avg_order_value, 0.0) AS avg_order_value,
       CASE WHEN t.total_spent > 1000 THEN 'Premium' WHEN t.total_spent > 500 THEN 'Regular' ELSE 'New' END
         AS user_segment,
       u.ts_ms + {DELAY} AS last_activity
FROM silver_users u LEFT JOIN user_totals t ON t.user_id = u.id WHERE u.is_active""",
    "pipeline_user_analytics": f"""WITH {ORDERS}, {USERS}, {USER_STATS}
SELECT u.id AS user_id, u.name AS full_name, u.email_domain,
       strftime(make_timestamp(u.ts_ms * 1000), '%Y-%m-%d') AS registration_date,
       coalesce(t.total_orders, 0) AS total_orders, coalesce(t.total_spent, 0.0) AS total_spent,
       coalesce(t.avg_order_value, 0.0) AS avg_order_value,
       CASE WHEN t.total_spent > 1000 THEN 'Premium' WHEN t.total_spent > 500 THEN 'Regular' ELSE 'New' END
         AS user_segment
FROM silver_users u LEFT JOIN user_totals t ON t.user_id = u.id WHERE u.is_active""",
    "gold_product_analytics": f"""WITH {ORDERS}, {PRODUCTS}, {PRODUCT_STATS}
SELECT p.id AS product_id, p.name AS product_name, p.category, p.price,
       coalesce(t.total_orders, 0) AS total_orders, coalesce(t.total_revenue, 0.0) AS total_revenue,
       coalesce(t.unique_customers, 0) AS unique_customers,
       CASE WHEN t.total_revenue > 5000 THEN 'Top Performer' WHEN t.total_revenue > 1000 THEN 'Good'
            ELSE 'Average' END AS performance_category
FROM pr p LEFT JOIN product_totals t ON t.product_id = p.id WHERE p.op <> 'd'""",
    "gold_sales_summary": SUMMARY,
    "gold_replace_idempotent": SUMMARY,
    "gold_user_value_tiers": f"""WITH {ORDERS}, {USERS}
SELECT u.id, u.name, count(o.id) AS total_orders, {MONEY.replace('total_amount', 'o.total_amount')} AS lifetime_value,
       CASE WHEN SUM(CAST(o.total_amount AS DECIMAL(18,2))) > 10000 THEN 'VIP'
            WHEN SUM(CAST(o.total_amount AS DECIMAL(18,2))) > 1000 THEN 'Gold' ELSE 'Silver' END AS segment
FROM silver_users u LEFT JOIN silver_orders o ON o.user_id = u.id WHERE u.is_active GROUP BY u.id, u.name""",
    "latest_per_key": f"WITH {ORDERS} SELECT {BRONZE} FROM silver_orders",
    "silver_merge_insert": f"WITH {ORDERS} SELECT {SILVER} FROM silver_orders",
    "silver_from_bronze": f"WITH {ORDERS} SELECT {SILVER} FROM silver_orders",
    "silver_merge_update": merged("in_order"),
    "silver_merge_late": merged("late"),
    "silver_table_late": merged("late"),
    "silver_merge_hard_delete": merged("late", hard=True),
    "snapshot_diff": f"""WITH {EVENTS},
r0 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS rn
       FROM ev WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
r1 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS rn FROM ev),
b AS (SELECT user_id AS id, event_type AS status, value FROM r0 WHERE rn = 1 AND op <> 'd'),
a AS (SELECT user_id AS id, event_type AS status, value FROM r1 WHERE rn = 1 AND op <> 'd')
SELECT a.id, a.status, a.value, 'c' AS op FROM a ANTI JOIN b USING (id)
UNION ALL SELECT b.id, b.status, b.value, 'd' FROM b ANTI JOIN a USING (id)
UNION ALL SELECT a.id, a.status, a.value, 'u' FROM a JOIN b USING (id)
  WHERE a.status IS DISTINCT FROM b.status OR a.value IS DISTINCT FROM b.value""",
    "bronze_append": f"""WITH {CHANGES}
SELECT {BRONZE}, _position, CASE WHEN late = 1 THEN upper(status) END AS channel,
       strftime(make_timestamp(arrived_ms * 1000), '%Y-%m-%d') AS processed_day FROM ch""",
    "bronze_day_slice": f"""WITH {CHANGES} SELECT {BRONZE} FROM ch
WHERE CAST(make_timestamp(arrived_ms * 1000) AS DATE) = DATE '2024-01-15'""",
    "bronze_dedup": f"""WITH {CHANGES},
twice AS (SELECT id, op, ts_ms, arrived_ms FROM ch UNION ALL SELECT id, op, ts_ms, arrived_ms + 86400000 FROM ch)
SELECT id, op, ts_ms, min(arrived_ms) AS arrived_ms FROM twice GROUP BY id, op, ts_ms""",
    "dedup_any_age": f"""WITH {CHANGES}
SELECT {BRONZE}, _position, epoch_ms(TIMESTAMP '2024-03-01 00:00:00') + (_position % 32) * 86400000 AS arrived_ms FROM ch""",
    "raw_archive_counts": f"""WITH {CHANGES}, x AS (SELECT make_timestamp(ts_ms * 1000) AS t, op FROM ch)
SELECT strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day,
       count(*) AS cnt, count(*) FILTER (op = 'd') AS deletes FROM x GROUP BY 1, 2, 3""",
    "bronze_export_days": ALL_CHANGES,
    "silver_state_at": f"WITH {CHANGES} SELECT {SILVER} FROM {latest('late = 0')}",
    "stream_source_replay": f"""WITH {MESSAGES}
SELECT 'cdc.' || source_table AS topic, CAST(user_id % 8 AS INTEGER) AS "partition", event_id AS "offset" FROM msg""",
    "stream_parse_equals_batch": f"""WITH {MESSAGES}
SELECT 'cdc.' || source_table AS topic, event_id AS "offset", operation, ts_ms AS source_timestamp, source_table,
       source_table || '_' || operation AS routing_key, operation = 'd' AS is_delete FROM msg""",
    "stream_bronze_equals_batch": ALL_CHANGES,
    "stream_dedup": ALL_CHANGES,
    "flat_same_instant": same_instant(),
    "flat_same_instant_split": same_instant(),
    "stream_merge_equals_batch": f"WITH {ORDERS} SELECT {SILVER} FROM silver_orders",
    "route_events": ROUTES,
    "route_events_batch": ROUTES,
    "enrich_as_of": f"""WITH {CHANGES},
acts AS (SELECT * FROM ch WHERE status IN ('click', 'purchase')),
known AS (
  SELECT user_id, ts_ms, arg_max(status, _position) AS status, arg_max(total_amount, _position) AS total_amount,
         arg_max(op, _position) AS op
  FROM ch WHERE status NOT IN ('click', 'purchase') GROUP BY user_id, ts_ms)
SELECT a._position, a.id, a.user_id, a.ts_ms, CASE WHEN k.op <> 'd' THEN k.status END AS user_status,
       CASE WHEN k.op <> 'd' THEN k.total_amount END AS user_total_amount
FROM acts a ASOF LEFT JOIN known k ON a.user_id = k.user_id AND a.ts_ms >= k.ts_ms""",
    "silver_partial_images": f"""WITH {CHANGES},
placed AS (SELECT *, ts_ms::HUGEINT * 10000000000 + _position AS place FROM ch),
merged AS (
  SELECT id, arg_max(user_id, place) AS user_id, arg_max(product_id, place) FILTER (_position % 3 <> 2) AS product_id,
         arg_max(quantity, place) AS quantity, arg_max(total_amount, place) FILTER (_position % 3 <> 0) AS total_amount,
         arg_max(status, place) FILTER (_position % 3 <> 1) AS status, arg_max(created_at, place) AS created_at,
         arg_max(updated_at, place) AS updated_at, arg_max(op, place) AS op, arg_max(ts_ms, place) AS ts_ms,
         arg_max(_position, place) AS _position
  FROM placed GROUP BY id)
SELECT *, {TIER} AS order_value_category, op <> 'd' AS is_active FROM merged""",
    "drift_capture": f"""WITH {CHANGES}
SELECT {BRONZE}, CASE WHEN _position % 3 > 0 THEN upper(status) END AS channel,
       CASE _position % 3 WHEN 1 THEN product_id::DOUBLE WHEN 2 THEN product_id + 0.5::DOUBLE END AS score,
       CASE WHEN _position % 3 = 1 THEN product_id > 5 END AS flag,
       CASE _position % 3 WHEN 1 THEN product_id::VARCHAR WHEN 2 THEN '{{"k":' || product_id || '}}' END AS note,
       CASE _position % 3 WHEN 1 THEN 'channel,flag,note,score'
                          WHEN 2 THEN 'channel,note,' || CASE WHEN _position % 3000 = 2 THEN 'rare,' ELSE '' END || 'score'
       END AS kept
FROM ch""",
    "gold_consistent_cut": f"""WITH {CHANGES},
ends AS (SELECT 0 AS phase, max(_position) AS cut FROM ch WHERE _position < (SELECT count(*) FROM ch) // 2
         UNION ALL SELECT 1, max(_position) + 1 FROM ch),
log AS (SELECT e.phase, c.* FROM ch c, ends e WHERE c._position < e.cut),
users AS (SELECT phase, user_id AS id, 'seen-' || arg_max(_position, ts_ms::HUGEINT * 10000000000 + _position) AS name
          FROM log GROUP BY phase, user_id),
orders AS (SELECT phase, id, arg_max(user_id, ts_ms::HUGEINT * 10000000000 + _position) AS user_id,
                  arg_max(total_amount, ts_ms::HUGEINT * 10000000000 + _position) AS total_amount
           FROM log GROUP BY phase, id)
SELECT CAST(u.phase AS INTEGER) AS phase, u.id, u.name, count(o.id) AS total_orders,
       {MONEY.replace('total_amount', 'o.total_amount')} AS lifetime_value,
       CASE WHEN SUM(CAST(o.total_amount AS DECIMAL(18,2))) > 10000 THEN 'VIP'
            WHEN SUM(CAST(o.total_amount AS DECIMAL(18,2))) > 1000 THEN 'Gold' ELSE 'Silver' END AS segment
FROM users u LEFT JOIN orders o ON o.phase = u.phase AND o.user_id = u.id GROUP BY u.phase, u.id, u.name""",
    "gold_incremental_equals_full": f"""WITH {ORDERS}, {DAILY}, {PRODUCT_STATS}, {USER_STATS},
every_order AS (SELECT user_id, count(*) AS n FROM silver_orders GROUP BY user_id)
SELECT 'day' AS kind, d.date_key AS key, d.total_orders, d.total_revenue, d.unique_customers, d.avg_order_value,
       coalesce(b.top_product, 0) AS top_product
FROM daily d LEFT JOIN best b USING (date_key)
UNION ALL SELECT 'product', product_id::VARCHAR, total_orders, total_revenue, unique_customers, NULL, NULL FROM product_totals
UNION ALL SELECT 'user', user_id::VARCHAR, total_orders, total_spent, n, avg_order_value, NULL
FROM user_totals JOIN every_order USING (user_id)""",
    "batch_profile": f"""WITH {CHANGES},
x AS (SELECT late, CASE WHEN NOT (late = 1 AND _position % 3 = 0) THEN total_amount END AS total_amount, quantity, status FROM ch)
SELECT late AS batch, 'total_amount' AS "column", count(*) AS "rows", count(*) FILTER (total_amount IS NULL) AS nulls,
       min(total_amount) AS low, max(total_amount) AS high FROM x GROUP BY late
UNION ALL SELECT late, 'quantity', count(*), count(*) FILTER (quantity IS NULL), min(quantity)::DOUBLE, max(quantity)::DOUBLE
FROM x GROUP BY late
UNION ALL SELECT late, 'status', count(*), count(*) FILTER (status IS NULL), NULL, NULL FROM x GROUP BY late""",
}
SQL["recent_rows_bounded"] = f"WITH {CHANGES}\n" + "\nUNION ALL ".join(
    f"""SELECT * FROM (SELECT '{kind}' AS kind, id, op, ts_ms, _position FROM ch WHERE {where}
  ORDER BY ts_ms DESC, _position DESC LIMIT {n})"""
    for kind, where, n in [("all", "TRUE", 20), *((op, f"op = '{op}'", 10) for op in "cud")]
)
SQL["snapshot_diff_digest"] = SQL["snapshot_diff"]
SQL["windowed_counts_late"] = SQL["windowed_op_counts"]
