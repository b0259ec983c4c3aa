"""DuckDB oracles: for each registered query, an independent SQL statement over
the driver's pre-registered views (region, nation, customer, supplier, part,
orders, lineitem, events, documents, ...).

The fixture views of :mod:`logweave.sources.fixtures` are restated here as
common table expressions; ``with_views`` prepends the ones a query needs.
"""

from __future__ import annotations

# Epoch helpers: whole seconds / microseconds of a TIMESTAMP column.
_US = "epoch_us({})"
_SEC = "CAST(epoch_us({}) // 1000000 AS BIGINT)"
_MONEY_TEXT = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"

LINE_ORDER = ("l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, "
              "l_quantity, l_discount, l_tax, l_linestatus, l_shipdate")

VIEWS: dict[str, str] = {}

VIEWS["analytics_events"] = f"""
SELECT event_id,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
            ELSE event_type END AS type,
       'user-' || CAST(user_id AS VARCHAR) AS user_id,
       'SKU-' || lpad(CAST(event_id % 20 AS VARCHAR), 3, '0') AS product,
       CAST({_US.format('ts')} AS DOUBLE) / CAST(1000000 AS DOUBLE) AS event_epoch,
       CASE WHEN event_type = 'purchase' THEN value END AS amount
FROM events"""

VIEWS["transactions"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS txn_id, o_totalprice AS amount,
       {_SEC.format('o_orderdate')} + o_orderkey % 86400 AS event_epoch
FROM orders"""

VIEWS["order_log"] = f"""
SELECT aggregate_id, seq, event_type, amount, customer, method, carrier, tracking, reason,
       order_epoch + seq * 60 AS event_epoch
FROM (
  SELECT o_orderkey AS aggregate_id, CAST(0 AS BIGINT) AS seq, 'OrderCreated' AS event_type,
         o_totalprice AS amount, CAST(o_custkey AS VARCHAR) AS customer,
         CAST(NULL AS VARCHAR) AS method, CAST(NULL AS VARCHAR) AS carrier,
         CAST(NULL AS VARCHAR) AS tracking, CAST(NULL AS VARCHAR) AS reason,
         {_SEC.format('o_orderdate')} AS order_epoch
  FROM orders
  UNION ALL
  SELECT l.l_orderkey, l.seq, 'PaymentReceived', l.l_extendedprice, NULL, l.l_returnflag,
         NULL, NULL, NULL, {_SEC.format('o.o_orderdate')}
  FROM (SELECT *, CAST(10 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER})
                       AS BIGINT) AS seq
        FROM lineitem) l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  UNION ALL
  SELECT o_orderkey, 100, 'OrderShipped', NULL, NULL, NULL, o_orderpriority,
         'TRK' || CAST(o_orderkey AS VARCHAR), NULL, {_SEC.format('o_orderdate')}
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, 5, 'OrderCancelled', NULL, NULL, NULL, NULL, NULL, 'test',
         {_SEC.format('o_orderdate')}
  FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 = 0
) t"""

VIEWS["cdc_log"] = """
SELECT off, op, before_id, before_customer, before_status, before_amount,
       after_id, after_customer, after_status, after_amount, ts_ms
FROM (
  SELECT o_orderkey * 10 AS off, 'c' AS op,
         CAST(NULL AS BIGINT) AS before_id, CAST(NULL AS VARCHAR) AS before_customer,
         CAST(NULL AS VARCHAR) AS before_status, CAST(NULL AS DOUBLE) AS before_amount,
         o_orderkey AS after_id, CAST(o_custkey AS VARCHAR) AS after_customer,
         'NEW' AS after_status, o_totalprice AS after_amount,
         epoch_us(o_orderdate) // 1000 AS ts_ms
  FROM orders
  UNION ALL
  SELECT o_orderkey * 10 + 1, 'u', o_orderkey, CAST(o_custkey AS VARCHAR), 'NEW', o_totalprice,
         o_orderkey, CAST(o_custkey AS VARCHAR),
         CASE WHEN o_orderstatus = 'F' THEN 'SHIPPED' ELSE 'PAID' END, o_totalprice,
         epoch_us(o_orderdate) // 1000 + 1000
  FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL
  SELECT o_orderkey * 10 + 2, 'd', o_orderkey, CAST(o_custkey AS VARCHAR),
         CASE WHEN o_orderstatus = 'O' THEN 'NEW' WHEN o_orderstatus = 'F' THEN 'SHIPPED'
              ELSE 'PAID' END, o_totalprice,
         NULL, NULL, NULL, NULL, epoch_us(o_orderdate) // 1000 + 2000
  FROM orders WHERE o_orderkey % 10 = 0
  UNION ALL
  SELECT o_orderkey * 10 + 3, 't', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         epoch_us(o_orderdate) // 1000 + 3000
  FROM orders WHERE o_orderkey % 97 = 0
) t"""

VIEWS["snapshot_old"] = """
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status,
       o_totalprice AS amount
FROM orders WHERE o_orderkey % 10 <> 1"""

VIEWS["snapshot_new"] = """
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS customer,
       CASE WHEN o_orderkey % 4 = 0 THEN 'SHIPPED' ELSE o_orderstatus END AS status,
       o_totalprice AS amount
FROM orders WHERE o_orderkey % 10 <> 0"""

VIEWS["raw_orders"] = f"""
SELECT o_orderkey AS off, CAST(o_orderkey AS VARCHAR) AS key,
       CASE o_orderkey % 10
         WHEN 0 THEN 'bad_message:{{not-json'
         WHEN 1 THEN '{{"order_id":"' || CAST(o_orderkey AS VARCHAR) || '","customer":"x"}}'
         WHEN 2 THEN '[1,2]'
         WHEN 3 THEN '{{"order_id":"' || CAST(o_orderkey AS VARCHAR) || '","note":"extra"}}'
         WHEN 4 THEN '{{"order_id":"' || CAST(o_orderkey AS VARCHAR)
                     || '","customer":null,"amount":1}}'
         ELSE '{{"order_id":"' || CAST(o_orderkey AS VARCHAR) || '","customer":"c'
              || CAST(o_custkey AS VARCHAR) || '","amount":'
              || {_MONEY_TEXT.format('o_totalprice')} || '}}'
       END AS value,
       'dlq.orders.v1' AS topic, CAST(o_orderkey % 3 AS INTEGER) AS "partition"
FROM orders"""

# Text form of the mixed payload log; row kind 0 is NULL and kind 6 holds
# bytes that are not valid UTF-8 (flagged by is_bytes).
VIEWS["raw_messages"] = f"""
SELECT event_id AS off, CAST(user_id AS VARCHAR) AS key,
       event_id % 8 = 6 AS is_bytes,
       CASE event_id % 8
         WHEN 0 THEN NULL
         WHEN 1 THEN props
         WHEN 2 THEN event_type
         WHEN 3 THEN {_MONEY_TEXT.format('value')}
         WHEN 4 THEN '[' || CAST(user_id AS VARCHAR) || ',"' || event_type || '"]'
         WHEN 5 THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'null' END
         WHEN 6 THEN event_type
         ELSE '{{"event_type":"' || event_type || '","value":'
              || {_MONEY_TEXT.format('value')} || '}}'
       END AS text
FROM events"""

VIEWS["transfers_staged"] = f"""
SELECT CAST(l_orderkey // 16 AS BIGINT) AS txn_id, CAST(l_orderkey AS VARCHAR) AS transfer_id, seq,
       CAST(100 * l_linenumber AS BIGINT) AS amount, l_orderkey * 16 + seq AS off,
       {_SEC.format('l_shipdate')} AS ship_epoch
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS seq
      FROM lineitem) t"""

VIEWS["txn_markers"] = """
SELECT DISTINCT CAST(l_orderkey // 16 AS BIGINT) AS txn_id, 'commit' AS state
FROM lineitem WHERE (l_orderkey // 16) % 7 <> 0"""

VIEWS["order_events"] = """
SELECT txn_id AS order_id, amount, event_epoch AS order_epoch FROM transactions"""

VIEWS["payment_events"] = """
SELECT txn_id AS order_id, amount, 'card' AS method,
       event_epoch + CAST(txn_id AS BIGINT) % 600 AS payment_epoch
FROM transactions WHERE CAST(txn_id AS BIGINT) % 10 <> 0"""

VIEWS["payment_events_repeated"] = """
SELECT * FROM payment_events UNION ALL
SELECT order_id, amount, method, payment_epoch + 120 FROM payment_events
WHERE CAST(order_id AS BIGINT) % 7 = 0"""

VIEWS["edge_events"] = """
SELECT CASE WHEN oid % 11 = 0 THEN NULL WHEN oid % 13 = 0 THEN ''
            ELSE CAST(oid + 9007199254740993 AS VARCHAR) END AS key, *
FROM (SELECT CAST(txn_id AS BIGINT) AS oid, event_epoch AS t, 0 AS side, NULL AS method
      FROM transactions
      UNION ALL SELECT CAST(txn_id AS BIGINT), event_epoch + 200, 0, NULL FROM transactions
      WHERE CAST(txn_id AS BIGINT) % 5 = 0
      UNION ALL SELECT CAST(txn_id AS BIGINT), event_epoch + CAST(txn_id AS BIGINT) % 600, 1,
        'card' FROM transactions WHERE CAST(txn_id AS BIGINT) % 10 <> 0
      UNION ALL SELECT CAST(txn_id AS BIGINT), event_epoch - 100, 1, 'early' FROM transactions
      WHERE CAST(txn_id AS BIGINT) % 10 <> 0 AND CAST(txn_id AS BIGINT) % 4 = 0) u"""

VIEWS["delivery_reports"] = f"""
SELECT l_returnflag AS config, CAST(l_linenumber AS BIGINT) AS attempt,
       l_partkey % 50 <> 0 AS ok, l_extendedprice / 1000.0 AS latency_ms,
       CAST(256 AS BIGINT) AS n_bytes, {_SEC.format('l_shipdate')} + l_linenumber AS sent_epoch
FROM lineitem"""

# View dependencies (a view may read another view).
_DEPS = {"order_events": ["transactions"], "payment_events": ["transactions"],
         "payment_events_repeated": ["payment_events"], "edge_events": ["transactions"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` (and their dependencies)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in order)
    return f"WITH {ctes}\n{sql}"


# ----------------------------------------------------------------- oracles
ORACLE: dict[str, str] = {}


def _kpi(window_s: int) -> str:
    return with_views(f"""
SELECT window_start, page_views, add_to_carts, purchases, gmv,
       CASE WHEN page_views = 0 THEN 0.0
            ELSE CAST((2 * purchases * 10000 + page_views) // (2 * page_views) AS DOUBLE)
                 / 10000.0 END AS cvr
FROM (
  SELECT CAST(floor(event_epoch / {window_s}.0) * {window_s} AS BIGINT) AS window_start,
         count(*) FILTER (WHERE type = 'page_view') AS page_views,
         count(*) FILTER (WHERE type = 'add_to_cart') AS add_to_carts,
         count(*) FILTER (WHERE type = 'purchase') AS purchases,
         CAST(COALESCE(SUM(CASE WHEN type = 'purchase' THEN CAST(amount AS DECIMAL(18,2)) END),
                       0) AS DOUBLE) AS gmv
  FROM analytics_events
  WHERE event_epoch IS NOT NULL
  GROUP BY 1
) t
ORDER BY window_start""", "analytics_events")


ORACLE["kpi_1m"] = _kpi(60)
ORACLE["kpi_1h"] = _kpi(3600)
# Purchases whose published amount is no number are rejected, not counted.
_BAD = "type = 'purchase' AND amount IS NOT NULL AND CAST(event_id AS BIGINT) % 97 = 0"
ORACLE["kpi_1m_from_log"] = ORACLE["kpi_1m"].replace(
    "WHERE event_epoch IS NOT NULL", f"WHERE event_epoch IS NOT NULL AND NOT ({_BAD})")
ORACLE["kpi_errors"] = with_views(f"""
SELECT CAST(event_id AS BIGINT) AS event_id, type, 'n/a' AS amount FROM analytics_events
WHERE {_BAD}""", "analytics_events")

ORACLE["sales_tumbling_30s"] = with_views("""
SELECT window_start, window_start + 30 AS window_end, count, total_amount
FROM (
  SELECT CAST(floor(event_epoch / 30.0) * 30 AS BIGINT) AS window_start, count(*) AS count,
         CAST(COALESCE(SUM(CAST(amount AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_amount
  FROM transactions WHERE event_epoch IS NOT NULL GROUP BY 1
) t ORDER BY window_start""", "transactions")

ORACLE["high_value_tier"] = with_views("""
SELECT txn_id, amount, event_epoch,
       CASE WHEN amount > 100000 THEN 'platinum' WHEN amount > 50000 THEN 'gold'
            ELSE 'silver' END AS tier
FROM transactions WHERE COALESCE(amount, 0) > 10000""", "transactions")


def _snapshot(window_s: int) -> str:
    return with_views(f"""
SELECT page_views, add_to_carts, purchases, gmv,
       CASE WHEN page_views > 0 THEN purchases / page_views ELSE 0.0 END AS cvr,
       window_count / CAST({window_s} AS DOUBLE) AS eps, window_count, total
FROM (
  SELECT count(*) FILTER (WHERE inw AND type = 'page_view') AS page_views,
         count(*) FILTER (WHERE inw AND type = 'add_to_cart') AS add_to_carts,
         count(*) FILTER (WHERE inw AND type = 'purchase') AS purchases,
         CAST(COALESCE(SUM(CASE WHEN inw AND type = 'purchase'
                                THEN CAST(amount AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS gmv,
         count(*) FILTER (WHERE inw) AS window_count, count(*) AS total
  FROM (SELECT *, event_epoch >= (SELECT max(event_epoch) FROM analytics_events) - {window_s}
                  AS inw FROM analytics_events) a
) t""", "analytics_events")


ORACLE["rolling_snapshot"] = _snapshot(60)
ORACLE["rolling_snapshot_1d"] = _snapshot(86400)


def _series(window_s: int) -> str:
    return with_views(f"""
SELECT event_id, event_epoch,
       count(*) FILTER (WHERE type = 'page_view') OVER w AS page_views,
       count(*) FILTER (WHERE type = 'add_to_cart') OVER w AS add_to_carts,
       count(*) FILTER (WHERE type = 'purchase') OVER w AS purchases,
       CAST(COALESCE(SUM(CASE WHEN type = 'purchase' THEN CAST(amount AS DECIMAL(18,2)) END)
                     OVER w, 0) AS DOUBLE) AS gmv,
       count(*) OVER w AS window_count
FROM analytics_events WHERE event_epoch IS NOT NULL
WINDOW w AS (ORDER BY event_epoch RANGE BETWEEN {window_s} PRECEDING AND CURRENT ROW)""",
                      "analytics_events")


ORACLE["rolling_series"] = _series(60)
ORACLE["rolling_series_1h"] = _series(3600)


def _top(window_s: int) -> str:
    return with_views(f"""
SELECT row_number() OVER (ORDER BY purchases DESC, first ASC, product ASC) AS rank,
       product, purchases
FROM (
  SELECT product, count(*) AS purchases, min((event_epoch, event_id)) AS first
  FROM analytics_events
  WHERE type = 'purchase'
    AND event_epoch >= (SELECT max(event_epoch) FROM analytics_events) - {window_s}
  GROUP BY product
  ORDER BY purchases DESC, first ASC, product ASC LIMIT 5
) t""", "analytics_events")


ORACLE["top_products"] = _top(60)
ORACLE["top_products_1d"] = _top(86400)

# --------------------------------------------------------- event sourcing
_FOLD_STEPS = """
steps AS (
  SELECT *,
         COALESCE(SUM(CASE WHEN event_type = 'PaymentReceived'
                           THEN CAST(amount AS DECIMAL(18,2)) END) OVER w, 0) AS run_paid,
         last_value(CASE WHEN event_type = 'OrderCreated' THEN CAST(amount AS DECIMAL(18,2)) END
                    IGNORE NULLS) OVER w AS known
  FROM ev
  WINDOW w AS (PARTITION BY aggregate_id ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
cand AS (
  SELECT *, CASE WHEN event_type = 'OrderCreated' THEN 'CREATED'
                 WHEN event_type = 'PaymentReceived' AND run_paid >= COALESCE(known, 0) THEN 'PAID'
                 WHEN event_type = 'OrderShipped' THEN 'SHIPPED'
                 WHEN event_type = 'OrderCancelled' THEN 'CANCELLED' END AS cand
  FROM steps
)"""


def _fold(where: str = "TRUE", extra_filter: str = "TRUE") -> str:
    return with_views(f"""
, ev AS (SELECT * FROM order_log WHERE {where} AND {extra_filter}),
{_FOLD_STEPS}
SELECT aggregate_id AS order_id,
       COALESCE(arg_max(cand, seq) FILTER (WHERE cand IS NOT NULL), 'UNKNOWN') AS status,
       CAST(COALESCE(SUM(CASE WHEN event_type = 'PaymentReceived'
                              THEN CAST(amount AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS paid,
       arg_max(amount, seq) FILTER (WHERE event_type = 'OrderCreated') AS amount
FROM cand GROUP BY aggregate_id""", "order_log").replace("\n, ev AS", ",\nev AS", 1)


ORACLE["fold_all"] = _fold()
ORACLE["replay_since"] = _fold("event_epoch >= 883612800")
ORACLE["replay_until"] = _fold("event_epoch <= 852076800")

ORACLE["fold_one"] = with_views("""
, ev AS (SELECT * FROM order_log WHERE aggregate_id = 8),
""" + _FOLD_STEPS + """
SELECT CAST(8 AS BIGINT) AS order_id,
       COALESCE((SELECT arg_max(cand, seq) FILTER (WHERE cand IS NOT NULL) FROM cand), 'UNKNOWN')
         AS status,
       (SELECT CAST(COALESCE(SUM(CASE WHEN event_type = 'PaymentReceived'
                                      THEN CAST(amount AS DECIMAL(18,2)) END), 0) AS DOUBLE)
        FROM ev) AS paid,
       (SELECT arg_max(amount, seq) FILTER (WHERE event_type = 'OrderCreated') FROM ev) AS amount,
       (SELECT arg_max(customer, seq) FILTER (WHERE event_type = 'OrderCreated') FROM ev)
         AS customer,
       (SELECT arg_max(carrier, seq) FILTER (WHERE event_type = 'OrderShipped') FROM ev)
         AS carrier,
       (SELECT arg_max(tracking, seq) FILTER (WHERE event_type = 'OrderShipped') FROM ev)
         AS tracking,
       (SELECT arg_max(reason, seq) FILTER (WHERE event_type = 'OrderCancelled') FROM ev)
         AS reason""", "order_log").replace("\n, ev AS", ",\nev AS", 1)

ORACLE["event_history"] = with_views("""
, ev AS (SELECT * FROM order_log WHERE aggregate_id = 8),
""" + _FOLD_STEPS + """
SELECT aggregate_id AS order_id, seq, event_type, amount, CAST(run_paid AS DOUBLE) AS paid,
       COALESCE(last_value(cand IGNORE NULLS) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING
                                                    AND CURRENT ROW), 'UNKNOWN') AS status
FROM cand ORDER BY seq""", "order_log").replace("\n, ev AS", ",\nev AS", 1)

ORACLE["whatif_drop_payments"] = with_views(f"""
, ev AS (SELECT * FROM order_log),
{_FOLD_STEPS},
actual AS (
  SELECT aggregate_id AS order_id,
         COALESCE(arg_max(cand, seq) FILTER (WHERE cand IS NOT NULL), 'UNKNOWN') AS status
  FROM cand GROUP BY aggregate_id
),
hypo AS (
  SELECT aggregate_id AS order_id,
         COALESCE(arg_max(CASE event_type WHEN 'OrderCreated' THEN 'CREATED'
                               WHEN 'OrderShipped' THEN 'SHIPPED'
                               WHEN 'OrderCancelled' THEN 'CANCELLED' END, seq)
                  FILTER (WHERE event_type IN ('OrderCreated', 'OrderShipped', 'OrderCancelled')),
                  'UNKNOWN') AS status,
         0.0::DOUBLE AS paid,
         arg_max(amount, seq) FILTER (WHERE event_type = 'OrderCreated') AS amount
  FROM order_log WHERE event_type <> 'PaymentReceived' GROUP BY aggregate_id
)
SELECT h.order_id, h.status, h.paid, h.amount, a.status AS actual_status,
       h.status IS DISTINCT FROM a.status AS changed
FROM hypo h LEFT JOIN actual a ON a.order_id = h.order_id""", "order_log").replace(
    "\n, ev AS", ",\nev AS", 1)

# --------------------------------------------------------------------- CDC
_CDC_LAST = """
, valid AS (
  SELECT *, CASE WHEN op = 'd' THEN before_id ELSE after_id END AS k FROM cdc_log
  WHERE (op IN ('c', 'u') AND after_id IS NOT NULL) OR (op = 'd' AND before_id IS NOT NULL)
),
last AS (
  SELECT k, arg_max(op, off) AS op, arg_max(after_id, off) AS id,
         arg_max(after_customer, off) AS customer, arg_max(after_status, off) AS status,
         arg_max(after_amount, off) AS amount
  FROM valid GROUP BY k
)"""

ORACLE["cdc_apply"] = with_views(
    "SELECT id, customer, status, amount FROM last WHERE op <> 'd'", "cdc_log").replace(
    "\nSELECT id, customer", _CDC_LAST.replace("\n, valid", ",\nvalid", 1) + "\nSELECT id, customer", 1)
ORACLE["cdc_count"] = with_views(
    "SELECT count(*) AS n FROM last WHERE op <> 'd'", "cdc_log").replace(
    "\nSELECT count(*)", _CDC_LAST.replace("\n, valid", ",\nvalid", 1) + "\nSELECT count(*)", 1)

ORACLE["cdc_diff"] = with_views("""
SELECT CASE WHEN o.id IS NULL THEN 'c' WHEN n.id IS NULL THEN 'd' ELSE 'u' END AS op,
       COALESCE(o.id, n.id) AS id,
       o.customer AS before_customer, o.status AS before_status, o.amount AS before_amount,
       n.customer AS after_customer, n.status AS after_status, n.amount AS after_amount
FROM snapshot_old o FULL OUTER JOIN snapshot_new n ON o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL
   OR (o.customer, o.status, o.amount) IS DISTINCT FROM (n.customer, n.status, n.amount)""",
                                "snapshot_old", "snapshot_new")

ORACLE["cdc_status_change"] = with_views("""
SELECT off, after_id AS id, after_amount AS amount FROM cdc_log
WHERE op = 'u' AND before_status = 'NEW' AND after_status = 'SHIPPED'""", "cdc_log")

# --------------------------------------------------------------------- DLQ
_DLQ = """
, classified AS (
  SELECT *,
         CASE WHEN value IS NULL OR NOT json_valid(value) THEN 'invalid_json'
              WHEN json_type(value) <> 'OBJECT' THEN 'not_an_object'
              WHEN len(missing) > 0 THEN 'missing_fields: ['
                   || array_to_string(list_transform(missing, lambda x: '''' || x || ''''), ', ')
                   || ']'
         END AS error
  FROM (SELECT *, CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT'
                       THEN list_filter(['order_id', 'customer', 'amount'],
                                        lambda x: NOT list_contains(json_keys(value), x)) END
                    AS missing
        FROM raw_orders) r
),
dead AS (SELECT * FROM classified WHERE error IS NOT NULL),
rec AS (
  SELECT key, value, error, keys, members,
         regexp_replace(value, '\\}\\s*$', '')
           || CASE WHEN len(keys) > 0 AND length(members) > 0 THEN ',' ELSE '' END
           || members || '}' AS fixed
  FROM (SELECT *, json_keys(value) AS keys,
               concat_ws(',',
                 CASE WHEN NOT list_contains(json_keys(value), 'customer')
                      THEN '"customer":"unknown"' END,
                 CASE WHEN NOT list_contains(json_keys(value), 'amount') THEN '"amount":0.0' END,
                 CASE WHEN NOT list_contains(json_keys(value), 'order_id')
                      THEN '"order_id":"recovered"' END) AS members
        FROM dead WHERE error LIKE 'missing_fields%') d
),
recovered AS (
  SELECT key, fixed AS value,
         CASE WHEN list_contains(keys, 'order_id') THEN json_extract_string(value, '$.order_id')
              ELSE 'recovered' END AS order_id,
         CASE WHEN list_contains(keys, 'customer') THEN json_extract_string(value, '$.customer')
              ELSE 'unknown' END AS customer,
         CASE WHEN list_contains(keys, 'amount')
              THEN TRY_CAST(json_extract_string(value, '$.amount') AS DOUBLE)
              ELSE 0.0 END AS amount
  FROM rec
)"""


def _dlq(sql: str) -> str:
    body = with_views("\n" + sql.strip(), "raw_orders")
    head, tail = body.rsplit("\n" + sql.strip(), 1)
    return head + _DLQ.replace("\n, classified", ",\nclassified", 1) + "\n" + sql.strip() + tail


ORACLE["dlq_classify"] = _dlq("SELECT off, key, error FROM classified")
ORACLE["dlq_route"] = _dlq("""
SELECT key, value, error, 'dlq.orders.v1' AS source_topic, CAST(off AS VARCHAR) AS source_offset,
       CAST("partition" AS VARCHAR) AS source_partition
FROM dead""")
ORACLE["dlq_recover"] = _dlq("SELECT key, value, order_id, customer, amount FROM recovered")
ORACLE["dlq_poison"] = _dlq("""
SELECT key, value, error FROM dead WHERE error NOT LIKE 'missing_fields%'""")
ORACLE["dlq_counters"] = _dlq("""
SELECT count(*) FILTER (WHERE error IS NULL) AS ok,
       count(*) FILTER (WHERE error IS NOT NULL) AS routed,
       count(*) FILTER (WHERE error LIKE 'missing_fields%') AS recovered,
       count(*) FILTER (WHERE error IS NOT NULL AND error NOT LIKE 'missing_fields%') AS poison
FROM classified""")
ORACLE["dlq_reprocess"] = _dlq("""
SELECT key, json_extract_string(value, '$.order_id') AS order_id,
       json_extract_string(value, '$.customer') AS customer,
       TRY_CAST(json_extract_string(value, '$.amount') AS DOUBLE) AS amount, 'main' AS origin
FROM classified WHERE error IS NULL
UNION ALL
SELECT key, order_id, customer, amount, 'recovered' AS origin FROM recovered""")

# ------------------------------------------------------------ exactly once
_COMMITTED = """
SELECT * FROM transfers_staged
WHERE txn_id IN (SELECT txn_id FROM txn_markers WHERE state = 'commit')"""

ORACLE["read_committed"] = with_views(f"""
SELECT txn_id, transfer_id, seq, amount, off FROM ({_COMMITTED}) c""",
                                      "transfers_staged", "txn_markers")
ORACLE["dedup_first"] = with_views(f"""
SELECT transfer_id, CAST(arg_min(amount, off) AS DOUBLE) AS amount, min(off) AS off
FROM ({_COMMITTED}) c WHERE transfer_id IS NOT NULL AND transfer_id <> ''
GROUP BY transfer_id""", "transfers_staged", "txn_markers")
ORACLE["dedup_counters"] = with_views(f"""
SELECT count(DISTINCT transfer_id) AS processed_unique,
       count(*) - count(DISTINCT transfer_id) AS duplicates,
       count(DISTINCT transfer_id) AS ledger_total
FROM ({_COMMITTED}) c WHERE transfer_id IS NOT NULL AND transfer_id <> ''""",
                                      "transfers_staged", "txn_markers")
ORACLE["ledger_new"] = with_views(f"""
SELECT transfer_id, CAST(arg_min(amount, off) AS DOUBLE) AS amount, min(off) AS off
FROM ({_COMMITTED}) c
WHERE transfer_id NOT IN (SELECT transfer_id FROM ({_COMMITTED}) p WHERE ship_epoch < 852076800)
GROUP BY transfer_id""", "transfers_staged", "txn_markers")

# ------------------------------------------------------------------- joins
ORACLE["order_payment_join"] = with_views("""
SELECT o.order_id, o.amount AS order_amount, p.amount AS payment_amount, p.method,
       o.order_epoch, p.payment_epoch
FROM order_events o JOIN payment_events p
  ON o.order_id = p.order_id
 AND p.payment_epoch BETWEEN o.order_epoch - 300 AND o.order_epoch + 300""",
                                          "order_events", "payment_events")
ORACLE["order_unpaid"] = with_views("""
SELECT o.order_id, o.amount, o.order_epoch FROM order_events o
WHERE NOT EXISTS (SELECT 1 FROM payment_events p WHERE p.order_id = o.order_id
                  AND p.payment_epoch BETWEEN o.order_epoch - 300 AND o.order_epoch + 300)""",
                                    "order_events", "payment_events")
# With the repeats, every repeated payment comes 120 s after the first one, so
# consume-on-match pairs an order with its first payment when that is within
# the bound and leaves the second pending.
ORACLE["order_payment_consume"] = ORACLE["order_payment_join"]

ORACLE["interval_unmatched"] = ORACLE["order_unpaid"]
ORACLE["interval_join"] = with_views("""
SELECT o.order_id, o.amount AS order_amount, p.amount AS payment_amount, p.method,
       o.order_epoch, p.payment_epoch
FROM order_events o JOIN payment_events_repeated p
  ON o.order_id = p.order_id AND abs(p.payment_epoch - o.order_epoch) <= 300""",
                                     "order_events", "payment_events_repeated")
# One event of every key at a time: the pending order and payment, and what
# the event matched.
ORACLE["order_consume_edges"] = with_views("""
SELECT key AS order_id, 9007199254740993 + oid AS big, m_order AS order_epoch,
       m_payment AS payment_epoch, m_method AS method
FROM (
  WITH RECURSIVE ev AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY t, side, method) AS i
    FROM edge_events WHERE key <> ''),
  st AS (
    SELECT key, oid, i, CASE WHEN side = 0 THEN t END AS lo, CASE WHEN side = 1 THEN t END AS lp,
           CASE WHEN side = 1 THEN method END AS lm, CAST(NULL AS BIGINT) AS m_order,
           CAST(NULL AS BIGINT) AS m_payment, CAST(NULL AS VARCHAR) AS m_method
    FROM ev WHERE i = 1
    UNION ALL
    SELECT key, oid, i, CASE WHEN m THEN NULL ELSE lo END, CASE WHEN m THEN NULL ELSE lp END,
           CASE WHEN m THEN NULL ELSE lm END, CASE WHEN m THEN lo END, CASE WHEN m THEN lp END,
           CASE WHEN m THEN lm END
    FROM (SELECT key, oid, i, lo, lp, lm, COALESCE(abs(lo - lp) <= 300, FALSE) AS m
          FROM (SELECT e.key, e.oid, e.i, CASE WHEN e.side = 0 THEN e.t ELSE st.lo END AS lo,
                       CASE WHEN e.side = 1 THEN e.t ELSE st.lp END AS lp,
                       CASE WHEN e.side = 1 THEN e.method ELSE st.lm END AS lm
                FROM st JOIN ev e ON e.key = st.key AND e.i = st.i + 1) a) b)
  SELECT * FROM st) r
WHERE m_order IS NOT NULL""", "edge_events")

# ----------------------------------------------------------------- metrics
ORACLE["delivery_metrics"] = with_views("""
SELECT config, produced, delivered, failed, bytes_sent,
       CASE WHEN delivered + failed = 0 THEN 0.0
            ELSE CAST((2 * failed * 10000 + (delivered + failed)) // (2 * (delivered + failed))
                      AS DOUBLE) / 10000.0 END AS error_rate,
       elapsed_s,
       CASE WHEN elapsed_s = 0 THEN 0.0
            ELSE CAST((2 * delivered * 10 + elapsed_s) // (2 * elapsed_s) AS DOUBLE) / 10.0 END
         AS throughput_msg_s,
       CASE WHEN elapsed_s = 0 THEN 0.0
            ELSE CAST((2 * bytes_sent * 1000 + elapsed_s * 1048576) // (2 * elapsed_s * 1048576)
                      AS DOUBLE) / 1000.0 END AS throughput_mb_s
FROM (
  SELECT config, count(*) AS produced, count(*) FILTER (WHERE ok) AS delivered,
         count(*) FILTER (WHERE NOT ok) AS failed,
         CAST(COALESCE(SUM(CASE WHEN ok THEN n_bytes END), 0) AS BIGINT) AS bytes_sent,
         CAST(max(sent_epoch) - min(sent_epoch) AS BIGINT) AS elapsed_s
  FROM delivery_reports GROUP BY config
) t""", "delivery_reports")

ORACLE["latency_percentiles"] = with_views("""
SELECT config, measured,
       CAST(round(CAST(p50 AS DECIMAL(38,10)), 3) AS DOUBLE) AS p50_ms,
       CAST(round(CAST(p95 AS DECIMAL(38,10)), 3) AS DOUBLE) AS p95_ms,
       CAST(round(CAST(p99 AS DECIMAL(38,10)), 3) AS DOUBLE) AS p99_ms,
       CAST(round(CAST(mx AS DECIMAL(38,10)), 3) AS DOUBLE) AS max_ms
FROM (
  SELECT config, count(*) AS measured, max(latency_ms) AS mx,
         list_sort(list(latency_ms))[CAST(round_even(0.5 * (count(*) - 1), 0) AS BIGINT) + 1]
           AS p50,
         list_sort(list(latency_ms))[CAST(round_even(0.95 * (count(*) - 1), 0) AS BIGINT) + 1]
           AS p95,
         list_sort(list(latency_ms))[CAST(round_even(0.99 * (count(*) - 1), 0) AS BIGINT) + 1]
           AS p99
  FROM delivery_reports WHERE latency_ms IS NOT NULL GROUP BY config
) t""", "delivery_reports")

ORACLE["throughput_by_config"] = with_views("""
SELECT config, count, CAST(el AS DOUBLE) AS elapsed_s,
       CASE WHEN el = 0 THEN 0.0
            ELSE CAST((2 * count * 10 + el) // (2 * el) AS DOUBLE) / 10.0 END AS msg_per_s,
       CASE WHEN el = 0 THEN 0.0
            ELSE CAST((2 * bytes * 100 + el * 1048576) // (2 * el * 1048576) AS DOUBLE) / 100.0
       END AS mb_per_s
FROM (SELECT config, count(*) AS count, CAST(max(sent_epoch) - min(sent_epoch) AS BIGINT) AS el,
             CAST(sum(n_bytes) AS BIGINT) AS bytes
      FROM delivery_reports GROUP BY config) t""", "delivery_reports")

ORACLE["bench_report"] = ORACLE["throughput_by_config"].replace(
    "SELECT config, count, CAST(el AS DOUBLE) AS elapsed_s,", """
SELECT config, '| ' || config || ' | ' || format('{:,}', count) || ' | '
       || format('{:,.3f}', CAST(el AS DECIMAL(38,3))) || ' | '
       || format('{:,}', CAST(round(CAST(msg_per_s AS DECIMAL(38,1)), 0) AS BIGINT)) || ' | '
       || format('{:,.2f}', CAST(mb_per_s AS DECIMAL(38,2))) || ' |' AS line
FROM (SELECT config, count, el,""", 1).replace(
    "FROM delivery_reports GROUP BY config) t", "FROM delivery_reports GROUP BY config) t) u", 1)

# ------------------------------------------------------------------- serde
ORACLE["decode_best_effort"] = with_views("""
SELECT off,
       CASE WHEN is_bytes THEN 'bytes' WHEN text IS NULL THEN 'null'
            WHEN json_valid(text) THEN 'json' ELSE 'text' END AS kind,
       CASE WHEN is_bytes THEN NULL ELSE text END AS text,
       CASE WHEN NOT is_bytes AND json_valid(text) THEN
         CASE json_type(text) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
              WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null'
              ELSE 'number' END END AS json_kind
FROM raw_messages""", "raw_messages")

ORACLE["encode_json"] = with_views("""
SELECT txn_id, to_json({'txn_id': txn_id, 'amount': amount, 'event_epoch': event_epoch})::VARCHAR
         AS value
FROM transactions""", "transactions")

ORACLE["field_defaults"] = with_views("""
SELECT off,
       CASE WHEN list_contains(json_keys(value), 'order_id')
            THEN json_extract_string(value, '$.order_id') ELSE 'recovered' END AS order_id,
       CASE WHEN list_contains(json_keys(value), 'customer')
            THEN json_extract_string(value, '$.customer') ELSE 'unknown' END AS customer,
       CASE WHEN list_contains(json_keys(value), 'amount')
            THEN TRY_CAST(json_extract_string(value, '$.amount') AS DOUBLE) ELSE 0.0 END AS amount
FROM raw_orders WHERE json_valid(value) AND json_type(value) = 'OBJECT'""", "raw_orders")

ORACLE["type_projection"] = with_views("""
SELECT CAST(aggregate_id AS VARCHAR) AS aggregate_id, seq, event_type,
       CASE WHEN event_type = 'OrderCreated' THEN customer END AS customer,
       CASE WHEN event_type IN ('OrderCreated', 'PaymentReceived') THEN amount END AS amount,
       CASE WHEN event_type = 'PaymentReceived' THEN method END AS method,
       CASE WHEN event_type = 'OrderShipped' THEN carrier END AS carrier,
       CASE WHEN event_type = 'OrderShipped' THEN tracking END AS tracking,
       CASE WHEN event_type = 'OrderCancelled' THEN reason END AS reason
FROM order_log""", "order_log")

_PYTYPE = """CASE json_type(value, '{p}') WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list'
  WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType'
  WHEN 'DOUBLE' THEN 'float' ELSE 'int' END"""

ORACLE["schema_errors"] = with_views(f"""
SELECT off, CAST(len(errs) AS BIGINT) AS n_errors, array_to_string(errs, '; ') AS errors
FROM (
  SELECT off,
    CASE WHEN json_type(value) <> 'OBJECT'
         THEN ['$: expected object, got ' || {_PYTYPE.format(p='$')}]
    ELSE list_filter([
      CASE WHEN NOT list_contains(json_keys(value), 'order_id')
           THEN '$: missing required property ''order_id''' END,
      CASE WHEN NOT list_contains(json_keys(value), 'customer')
           THEN '$: missing required property ''customer''' END,
      CASE WHEN NOT list_contains(json_keys(value), 'amount')
           THEN '$: missing required property ''amount''' END,
      CASE WHEN list_contains(json_keys(value), 'order_id')
            AND json_type(value, '$.order_id') <> 'VARCHAR'
           THEN '$.order_id: expected string, got ' || {_PYTYPE.format(p='$.order_id')} END,
      CASE WHEN list_contains(json_keys(value), 'customer')
            AND json_type(value, '$.customer') <> 'VARCHAR'
           THEN '$.customer: expected string, got ' || {_PYTYPE.format(p='$.customer')} END,
      CASE WHEN list_contains(json_keys(value), 'amount')
            AND json_type(value, '$.amount') = 'BOOLEAN'
           THEN '$.amount: expected number, got boolean'
           WHEN list_contains(json_keys(value), 'amount')
            AND json_type(value, '$.amount') NOT IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE')
           THEN '$.amount: expected number, got ' || {_PYTYPE.format(p='$.amount')} END
    ], lambda x: x IS NOT NULL) END AS errs
  FROM raw_orders WHERE json_valid(value)
) t""", "raw_orders")

# --------------------------------------------------------------- log table
_TXN_LOG = """
SELECT txn_id AS key, CAST(CAST(txn_id AS BIGINT) % 3 AS INTEGER) AS "partition",
       row_number() OVER (PARTITION BY CAST(txn_id AS BIGINT) % 3
                          ORDER BY event_epoch, txn_id) - 1 AS "offset",
       event_epoch, amount, txn_id
FROM transactions"""

ORACLE["message_metadata"] = with_views(f"""
SELECT key, "partition", "offset", CAST(event_epoch AS DOUBLE) AS ts, txn_id, amount
FROM ({_TXN_LOG}) l""", "transactions")
ORACLE["consume_first_n"] = with_views(f"""
SELECT key, "partition", "offset" FROM ({_TXN_LOG}) l
ORDER BY event_epoch, "partition", "offset" LIMIT 100""", "transactions")
ORACLE["log_write_read"] = ORACLE["message_metadata"]
ORACLE["consume_from_latest"] = with_views(f"""
SELECT key, "partition", "offset" FROM ({_TXN_LOG}) l
WHERE event_epoch >= 946684800""", "transactions")
ORACLE["topic_union"] = with_views("""
SELECT 'stream.order_events.v1' AS topic, order_id AS key, amount, order_epoch AS event_epoch
FROM order_events
UNION ALL
SELECT 'stream.payment_events.v1', order_id, amount, payment_epoch FROM payment_events""",
                                   "order_events", "payment_events")

# --------------------------------------------------------------- streaming
# Append mode emits a window once the watermark (max event time in ms minus
# the 2 s grace) reaches its end; the last open window stays in state.
ORACLE["stream_kpi"] = ORACLE["kpi_1m"].replace(
    "ORDER BY window_start", """WHERE (window_start + 60) * 1000 <=
      (SELECT max(epoch_us(ts)) // 1000 FROM events) - 2000
ORDER BY window_start""")
ORACLE["stream_rolling"] = with_views("""
SELECT window_start, count(*) AS window_count,
       count(*) FILTER (WHERE type = 'page_view') AS page_views,
       count(*) FILTER (WHERE type = 'purchase') AS purchases
FROM (SELECT type, CAST(floor(event_epoch / 10) AS BIGINT) * 10
                   - 10 * unnest(range(6)) AS window_start
      FROM analytics_events) x
WHERE (window_start + 60) * 1000 <= (SELECT max(epoch_us(ts)) // 1000 FROM events) - 2000
GROUP BY window_start""", "analytics_events")
ORACLE["stream_subscribe"] = ORACLE["topic_union"]
ORACLE["stream_fanout"] = with_views("""
SELECT 'audit' AS grp, 'stream.order_events.v1' AS topic, count(*) AS n FROM order_events
UNION ALL SELECT 'audit', 'stream.payment_events.v1', count(*) FROM payment_events
UNION ALL SELECT 'billing', 'stream.payment_events.v1', count(*) FROM payment_events""",
                                     "order_events", "payment_events")
ORACLE["log_key_routing"] = with_views("""
SELECT key, CAST(1 AS BIGINT) AS n_partitions, count(*) AS n_records
FROM (SELECT order_id AS key FROM order_events
      UNION ALL SELECT order_id FROM payment_events) u GROUP BY key""",
                                       "order_events", "payment_events")
ORACLE["stream_join"] = ORACLE["order_payment_join"]
ORACLE["stream_dedup"] = ORACLE["dedup_first"]
ORACLE["stream_cdc"] = ORACLE["cdc_apply"]
ORACLE["stream_dlq"] = ORACLE["dlq_route"]
ORACLE["stream_dedup_restart"] = ORACLE["dedup_first"]
ORACLE["stream_cdc_restart"] = ORACLE["cdc_apply"]
ORACLE["publish_atomic_retry"] = with_views("""
SELECT off % 2 AS txn_id, transfer_id, seq, amount, off FROM transfers_staged""",
                                            "transfers_staged")

_ARRIVING = """
SELECT event_id, CASE WHEN event_id % 50 <> 7 THEN event_epoch END AS event_epoch,
       least(3, CAST(floor(4 * (event_epoch - lo) / (hi - lo + 1)) AS INTEGER)
                + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END) AS arrival
FROM analytics_events, (SELECT min(event_epoch) AS lo, max(event_epoch) AS hi FROM analytics_events) s"""
# The watermark of a batch: the highest time of those before it, less 2 s.
ORACLE["stream_late_split"] = with_views(f"""
SELECT event_id, event_epoch,
       coalesce((CAST(floor(event_epoch / 60) AS BIGINT) + 1) * 60000 <= wm, FALSE) AS late
FROM ({_ARRIVING}) a LEFT JOIN (
  SELECT b.arrival, CAST(floor(max(p.event_epoch) * 1000) AS BIGINT) - 2000 AS wm
  FROM (SELECT DISTINCT arrival FROM ({_ARRIVING}) x) b JOIN ({_ARRIVING}) p ON p.arrival < b.arrival
  GROUP BY b.arrival) w USING (arrival)""", "analytics_events")
ORACLE["stream_cdc_bucketed"] = ORACLE["cdc_apply"]
ORACLE["stream_consume"] = ORACLE["order_payment_consume"]
# An order expires when the final watermark, 600 s behind the last event, has passed the bound
# after the newest record of its key.
ORACLE["stream_expiry"] = with_views("""
SELECT o.order_id, o.amount, o.order_epoch
FROM order_events o LEFT JOIN payment_events p ON p.order_id = o.order_id
WHERE (p.order_id IS NULL OR abs(p.payment_epoch - o.order_epoch) > 300)
  AND greatest(o.order_epoch, coalesce(p.payment_epoch, o.order_epoch)) + 300 <
      greatest((SELECT max(order_epoch) FROM order_events),
               (SELECT max(payment_epoch) FROM payment_events)) - 600""",
                                     "order_events", "payment_events")
ORACLE["stream_fold"] = ORACLE["fold_all"]
ORACLE["ledger_indexed"] = ORACLE["dedup_first"]
ORACLE["stream_from_latest"] = ORACLE["consume_from_latest"]
ORACLE["stream_dlq_recover"] = _dlq("""
SELECT r.key, r.value, CAST(CAST(r.key AS BIGINT) % 3 AS INTEGER) AS "partition",
       coalesce(b.n, 0) + row_number() OVER (PARTITION BY CAST(r.key AS BIGINT) % 3
           ORDER BY 2 * CAST(r.key AS BIGINT) > top, r.key, r.value) - 1 AS "offset"
FROM recovered r CROSS JOIN (SELECT max(off) AS top FROM dead) t
LEFT JOIN (SELECT off % 3 AS part, count(*) AS n FROM classified WHERE error IS NULL GROUP BY 1) b
  ON b.part = CAST(r.key AS BIGINT) % 3""")
ORACLE["stream_poison"] = ORACLE["dlq_poison"]
ORACLE["stream_counters"] = _dlq("""
SELECT CASE WHEN error IS NULL THEN 'ok' ELSE 'routed' END AS counter, count(*) AS value
FROM classified GROUP BY 1""")
ORACLE["publish_fenced"] = with_views("""
SELECT off % 2 AS txn_id, off % 2 + 1 AS epoch, transfer_id, seq, amount, off
FROM transfers_staged""", "transfers_staged")
ORACLE["bench_report_full"] = with_views(f"""
SELECT row_number() OVER (ORDER BY sec, pos) AS line_no, line FROM (
  SELECT 0 AS sec, unnest(range(2)) AS pos, unnest(['# Benchmark Report', '']) AS line
  UNION ALL
  SELECT 1, unnest(range(4)), unnest(['## Producer throughput (sweep)', '',
    '| Config | Messages | Elapsed (s) | msg/s | MB/s |', '|---|---:|---:|---:|---:|'])
  UNION ALL
  SELECT 2, row_number() OVER (ORDER BY config), '| ' || config || ' | ' || format('{{:,}}', count)
         || ' | ' || CAST(elapsed_s AS VARCHAR) || ' | '
         || format('{{:,}}', CAST(round_even(msg_per_s, 0) AS BIGINT)) || ' | '
         || CAST(CAST(mb_per_s AS DECIMAL(38,2)) AS VARCHAR) || ' |'
  FROM ({ORACLE["throughput_by_config"]}) t
  UNION ALL
  SELECT 3, unnest(range(5)), unnest(['', '## End-to-end latency', '', '| Metric | Value (ms) |',
    '|---|---:|'])
  UNION ALL
  SELECT 4, unnest(range(5)), unnest([
    '| measured | ' || CAST(n AS VARCHAR) || ' |',
    '| P50 | ' || CAST(p50 AS VARCHAR) || ' |', '| P95 | ' || CAST(p95 AS VARCHAR) || ' |',
    '| P99 | ' || CAST(p99 AS VARCHAR) || ' |', '| max | ' || CAST(mx AS VARCHAR) || ' |'])
  FROM (SELECT n, {", ".join(
      f"CAST(round(CAST({v} AS DECIMAL(38,10)), 3) AS DOUBLE) AS {c}" for c, v in (
          [(f"p{p}", f"l[CAST(round_even({p / 100} * (n - 1), 0) AS BIGINT) + 1]") for p in (50, 95, 99)]
          + [("mx", "l[n]")]))}
        FROM (SELECT count(*) AS n, list_sort(list(latency_ms)) AS l FROM delivery_reports
              WHERE latency_ms IS NOT NULL) a) b
  UNION ALL SELECT 5, 0, '') d""", "delivery_reports")

# The messages of ``fixtures.nested_orders`` by their kind.
_NESTED_KIND = "CAST(floor(o_orderkey / 4) AS BIGINT) % 8"
ORACLE["nested_fields"] = f"""
SELECT off, CASE WHEN has THEN 'SKU-' || CAST(off % 20 AS VARCHAR) END AS product,
       CASE WHEN has THEN CASE WHEN m = 2 THEN 3 ELSE off % 7 + 1 END END AS quantity,
       CASE WHEN has THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount
FROM (SELECT o_orderkey AS off, o_totalprice, {_NESTED_KIND} AS m, {_NESTED_KIND} NOT IN (1, 6) AS has
      FROM orders) t"""
ORACLE["schema_errors_nested"] = f"""
SELECT o_orderkey AS off, CASE {_NESTED_KIND}
         WHEN 1 THEN '$: missing required property ''payload'''
         WHEN 2 THEN '$.payload.quantity: expected integer, got str'
         WHEN 3 THEN '$.lines[1].qty: expected integer, got boolean'
         WHEN 4 THEN '$.lines[0]: missing required property ''sku''; $.lines[1].qty: expected integer, got str'
         WHEN 5 THEN '$.lines: expected array, got dict'
         WHEN 6 THEN '$.payload: expected object, got NoneType'
         ELSE '' END AS errors
FROM orders"""
ORACLE["tax_inclusive"] = with_views("""
SELECT txn_id, amount,
       CAST(round(CAST(amount AS DECIMAL(22,6)) * CAST(1.19 AS DECIMAL(12,8)), 2) AS DOUBLE)
         AS amount_incl
FROM transactions""", "transactions")
