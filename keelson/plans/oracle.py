"""DuckDB SQL oracles, one per query key.  Written independently of the
Spark code: each computes the expected rows straight from the test tables
(views ``events``, ``orders``, ``lineitem``, ``customer``, ``supplier``,
``part``, ``nation``, ``region``)."""

# The change log of plans.fixtures.cdc_raw, restated in SQL: one row per
# delivered message (copies), with the parse outcome.
EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS status,
         CASE WHEN event_id % 17 = 0 THEN -value ELSE value END AS amount,
         props AS note,
         epoch_us(ts) // 1000 AS source_ts_ms,
         event_id // 3 AS source_tx_id,
         event_id % 97 = 0 AS is_cut,
         CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END AS copies
  FROM events),
msgs AS (SELECT *, unnest(range(copies)) AS copy FROM ev),
bronze AS (
  SELECT user_id AS entity_id, status, amount,
         CAST(CAST(CAST(round(amount * 100) AS BIGINT) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS amount_dec,
         note, op AS cdc_operation, source_ts_ms, 'false' AS is_snapshot, source_tx_id,
         event_id AS source_lsn, ts AS kafka_ts, 'shop' AS _source_system
  FROM msgs WHERE NOT is_cut AND op <> 'd'),
changes AS (
  SELECT DISTINCT user_id AS entity_id,
         CASE WHEN op = 'd' THEN NULL ELSE status END AS status,
         CASE WHEN op = 'd' THEN NULL ELSE amount END AS amount,
         CASE WHEN op = 'd' THEN NULL ELSE
           CAST(CAST(CAST(round(amount * 100) AS BIGINT) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS amount_dec,
         CASE WHEN op = 'd' THEN NULL ELSE note END AS note,
         op AS cdc_operation, source_ts_ms, source_tx_id, event_id AS source_lsn, ts AS kafka_ts,
         CASE WHEN event_id % 3 = 0 THEN status ELSE 'view' END AS b_status,
         CASE WHEN event_id % 5 = 0 THEN value + 1 ELSE value END AS b_amount
  FROM msgs WHERE NOT is_cut),
ledger AS (SELECT DISTINCT * FROM bronze)"""

SILVER_FLAGS = """
  coalesce(status IN ('signup','view','click','purchase'), false) AS has_valid_status,
  coalesce(amount > 0, false) AS has_valid_amount,
  coalesce(note IS NOT NULL, false) AS has_note"""

REASON = """
  CASE WHEN NOT has_valid_status THEN 'invalid status value'
       WHEN NOT has_valid_amount THEN 'non-positive amount'
       WHEN NOT has_note THEN 'missing note' END AS quarantine_reason,
  concat_ws(',', CASE WHEN NOT has_valid_status THEN 'has_valid_status' END,
                 CASE WHEN NOT has_valid_amount THEN 'has_valid_amount' END,
                 CASE WHEN NOT has_note THEN 'has_note' END) AS failed_rules"""

CURRENT = """
current AS (
  SELECT * FROM ledger
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_ts_ms DESC, source_lsn DESC) = 1),
checked AS (SELECT *, """ + SILVER_FLAGS + """ FROM current)"""

SQL: dict[str, str] = {}

SQL["cdc_parse_envelope"] = f"WITH {EV} SELECT * FROM bronze"

SQL["cdc_current_state"] = f"""WITH {EV}, {CURRENT.strip()}
SELECT entity_id, status, amount, amount_dec, note, cdc_operation, source_ts_ms, source_lsn FROM current"""

SQL["cdc_current_state_agg"] = SQL["cdc_current_state"]

SQL["quality_split_valid"] = f"""WITH {EV}, {CURRENT.strip()}
SELECT entity_id, status, amount, amount_dec, note, source_ts_ms,
       TIMESTAMP '2024-02-01 00:00:00' AS _silver_processed_at
FROM checked WHERE has_valid_status AND has_valid_amount AND has_note"""

SQL["quality_split_quarantine"] = f"""WITH {EV}, {CURRENT.strip()}
SELECT entity_id, status, amount, note, source_ts_ms, source_lsn,
       has_valid_status, has_valid_amount, has_note, {REASON}
FROM checked WHERE NOT (has_valid_status AND has_valid_amount AND has_note)"""

# Customer dimension: dense key by business key.
DIM_CUSTOMER = """
dim_customer AS (
  SELECT CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS customer_key, c_custkey, c_name, c_nationkey, c_mktsegment
  FROM customer)"""

SQL["fact_lookup"] = f"""WITH {DIM_CUSTOMER.strip()}
SELECT o.o_orderkey, d.customer_key, o.o_orderstatus, o.o_totalprice, o.o_orderdate
FROM orders o LEFT JOIN dim_customer d ON o.o_custkey = d.c_custkey"""

SQL["cdc_parse_stats"] = f"""WITH {EV}
SELECT CASE WHEN is_cut THEN NULL ELSE op END AS cdc_operation, count(*) AS n_messages,
       count(*) FILTER (WHERE NOT is_cut) AS n_parsed,
       count(*) FILTER (WHERE NOT is_cut AND op <> 'd') AS n_with_after_key
FROM msgs GROUP BY 1"""

SQL["cdc_sample"] = f"""WITH {EV}
SELECT source_lsn, entity_id, cdc_operation, status, substr(note, 1, 6) AS note
FROM bronze ORDER BY source_lsn LIMIT 5"""

SQL["cdc_decode_decimal"] = f"WITH {EV} SELECT source_lsn, amount, amount_dec FROM ledger"

SQL["cdc_current_state_deletes"] = f"""WITH {EV}
SELECT entity_id, status, amount, amount_dec, note, cdc_operation, source_ts_ms, source_lsn FROM (
  SELECT * FROM changes
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_ts_ms DESC, source_lsn DESC) = 1)
WHERE cdc_operation <> 'd'"""

SQL["cdc_change_diff"] = f"""WITH {EV},
img AS (
  SELECT *,
    CASE WHEN cdc_operation = 'c' THEN NULL ELSE b_status END AS bs,
    CASE WHEN cdc_operation = 'c' THEN NULL ELSE b_amount END AS ba,
    CASE WHEN cdc_operation = 'c' THEN NULL ELSE
      CAST(CAST(CAST(round(b_amount * 100) AS BIGINT) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS bd,
    CASE WHEN cdc_operation = 'c' THEN NULL ELSE n0 END AS bn
  FROM (SELECT c.*, e.props AS n0 FROM changes c JOIN events e ON e.event_id = c.source_lsn))
SELECT source_lsn, entity_id, cdc_operation,
  concat_ws(',', CASE WHEN ba IS DISTINCT FROM amount THEN 'amount' END,
                 CASE WHEN bd IS DISTINCT FROM amount_dec THEN 'amount_dec' END,
                 CASE WHEN bn IS DISTINCT FROM note THEN 'note' END,
                 CASE WHEN bs IS DISTINCT FROM status THEN 'status' END) AS changed_columns
FROM img"""

LEDGER_CHECKED = "lc AS (SELECT *, " + SILVER_FLAGS + " FROM ledger)"

SQL["quality_flags"] = f"""WITH {EV}, {LEDGER_CHECKED}
SELECT source_lsn, entity_id, has_valid_status, has_valid_amount, has_note FROM lc"""

SQL["rule_accepted_values"] = f"""WITH {EV}
SELECT source_lsn, coalesce(status IN ('signup','view','click','purchase'), false) AS has_valid_status FROM ledger"""

SQL["rule_positive"] = f"""WITH {EV}
SELECT source_lsn, coalesce(amount > 0, false) AS has_valid_amount FROM ledger"""

SQL["rule_required"] = f"""WITH {EV}
SELECT source_lsn, note IS NOT NULL AS has_note FROM ledger"""

SQL["rule_null_or_nonneg"] = f"""WITH {EV}
SELECT source_lsn, cdc_operation, coalesce(amount_dec IS NULL OR amount_dec >= 0, false) AS has_nonneg_amount FROM changes"""

SQL["rule_implication"] = """
SELECT o_orderkey, o_orderstatus = 'F' AS is_final,
       coalesce(NOT (o_orderstatus = 'F') OR o_orderpriority IN ('1-URGENT', '2-HIGH'), false) AS has_valid_final
FROM orders"""

SQL["rule_distinct_pair"] = """
SELECT l.l_orderkey, l.l_linenumber,
       coalesce(c.c_nationkey IS NOT NULL AND s.s_nationkey IS NOT NULL AND c.c_nationkey <> s.s_nationkey, false)
         AS has_distinct_nations
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey"""

SQL["ledger_quality_split"] = f"""WITH {EV}, {LEDGER_CHECKED}
SELECT source_lsn, entity_id, status, amount, source_ts_ms FROM lc
WHERE has_valid_status AND has_valid_amount AND has_note"""

SQL["quarantine_reason"] = f"""WITH {EV}, {LEDGER_CHECKED}
SELECT source_lsn, {REASON} FROM lc
WHERE NOT (has_valid_status AND has_valid_amount AND has_note)"""

SQL["quality_reconcile"] = f"""WITH {EV}, {LEDGER_CHECKED}
SELECT count(*) AS n_input,
       count(*) FILTER (WHERE has_valid_status AND has_valid_amount AND has_note) AS n_valid,
       count(*) FILTER (WHERE NOT (has_valid_status AND has_valid_amount AND has_note)) AS n_quarantine,
       CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra
FROM lc"""

SQL["stamp_processed_at"] = f"""WITH {EV}, {LEDGER_CHECKED}
SELECT source_lsn, TIMESTAMP '2024-02-01 00:00:00' AS _silver_processed_at FROM lc
WHERE has_valid_status AND has_valid_amount AND has_note"""

SQL["stage_row_counts"] = f"""WITH {EV}, {CURRENT.strip()}
SELECT 'raw_messages' AS stage, count(*) AS n_rows FROM msgs
UNION ALL SELECT 'bronze_rows', count(*) FROM bronze
UNION ALL SELECT 'changes', count(*) FROM ledger
UNION ALL SELECT 'current_state', count(*) FROM current
UNION ALL SELECT 'silver_valid', count(*) FROM checked WHERE has_valid_status AND has_valid_amount AND has_note
UNION ALL SELECT 'quarantine', count(*) FROM checked WHERE NOT (has_valid_status AND has_valid_amount AND has_note)"""

SQL["dim_date"] = """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
d AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
       CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%B') AS month_name,
       strftime(date, '%A') AS day_name
FROM d"""

SQL["dim_surrogate_key"] = f"WITH {DIM_CUSTOMER.strip()} SELECT * FROM dim_customer"

SQL["dim_enriched"] = """
SELECT CAST(row_number() OVER (ORDER BY n.n_nationkey) - 1 AS BIGINT) AS nation_key,
       n.n_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

SQL["dim_renamed_key"] = "SELECT r_regionkey AS region_key, r_name FROM region"

SQL["dim_denormalized"] = """
SELECT s.s_suppkey, s.s_name, s.s_acctbal, s.s_nationkey, n.n_name
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""

SQL["dim_scd2"] = f"""WITH {EV},
v AS (SELECT entity_id, status, source_ts_ms, source_lsn, cdc_operation = 'd' AS gone,
             lag(status) OVER w AS prev, lag(cdc_operation = 'd') OVER w AS prev_gone, row_number() OVER w AS rn
      FROM changes WINDOW w AS (PARTITION BY entity_id ORDER BY source_ts_ms, source_lsn)),
c AS (SELECT * FROM v WHERE rn = 1 OR gone <> prev_gone OR (NOT gone AND prev IS DISTINCT FROM status)),
n AS (SELECT *, lead(source_ts_ms) OVER (PARTITION BY entity_id ORDER BY source_ts_ms, source_lsn) AS nxt FROM c)
SELECT entity_id, status, source_lsn, source_ts_ms AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current
FROM n WHERE NOT gone"""

SQL["dim_scd2_incremental"] = SQL["dim_scd2"]

SQL["fact_as_of_version"] = f"""WITH h AS ({SQL["dim_scd2"]}),
f AS (SELECT event_id, user_id, epoch_us(ts) // 1000 - 21600000 AS as_of_ms FROM events)
SELECT f.event_id, f.user_id, f.as_of_ms, h.status, h.source_lsn AS version_lsn
FROM f LEFT JOIN h ON h.entity_id = f.user_id AND h.valid_from <= f.as_of_ms AND (h.valid_to IS NULL OR f.as_of_ms < h.valid_to)"""

SQL["cdc_schema_drift"] = f"""WITH {EV}, i AS (SELECT * FROM msgs WHERE NOT is_cut AND op <> 'd')
SELECT 'events_cdc' AS table_name, 'note' AS column_name, 'undeclared' AS issue, 'string' AS observed, count(*) AS n_rows FROM i WHERE note IS NOT NULL
UNION ALL SELECT 'events_cdc', 'amount_dec', 'undeclared', 'string', count(*) FROM i WHERE amount IS NOT NULL
UNION ALL SELECT 'events_cdc', 'amount', 'retyped', 'number', count(*) FROM i WHERE amount IS NOT NULL
UNION ALL SELECT 'events_cdc', 'channel', 'vanished', NULL, 0"""

SQL["cascade_references"] = """
WITH r AS (SELECT r_regionkey AS k FROM region WHERE r_regionkey = 0), n AS (SELECT n_nationkey AS k FROM nation WHERE n_regionkey IN (SELECT k FROM r)),
c AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey IN (SELECT k FROM n)), s AS (SELECT s_suppkey AS k FROM supplier WHERE s_nationkey IN (SELECT k FROM n)),
o AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT k FROM c)),
l AS (SELECT l_orderkey || '-' || l_linenumber AS k, min(CASE WHEN l_suppkey IN (SELECT k FROM s) THEN 3 ELSE 4 END) AS level FROM lineitem
      WHERE l_suppkey IN (SELECT k FROM s) OR l_orderkey IN (SELECT k FROM o) GROUP BY 1)
SELECT 'region' AS table_name, CAST(k AS VARCHAR) AS row_key, 0 AS level FROM r UNION ALL SELECT 'nation', CAST(k AS VARCHAR), 1 FROM n
UNION ALL SELECT 'customer', CAST(k AS VARCHAR), 2 FROM c UNION ALL SELECT 'supplier', CAST(k AS VARCHAR), 2 FROM s
UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 3 FROM o UNION ALL SELECT 'lineitem', k, level FROM l"""

SQL["mart_month_end_balance"] = """
WITH m AS (SELECT unnest(generate_series(DATE '1990-01-01', DATE '1998-12-01', INTERVAL 1 MONTH)) AS s), e AS (SELECT CAST(s + INTERVAL 1 MONTH AS DATE) AS nxt FROM m),
b AS (SELECT c_nationkey, o_custkey, nxt, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS balance FROM e JOIN orders ON o_orderdate < nxt JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
SELECT c_nationkey, CAST(nxt - INTERVAL 1 DAY AS DATE) AS period_end, count(*) AS n_accounts, CAST(sum(balance) AS DECIMAL(18,2)) AS balance FROM b GROUP BY ALL"""

SQL["fact_bucketed_join"] = """
SELECT l_orderkey AS orderkey, l_linenumber, l_suppkey, o_custkey FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey"""

SQL["lifecycle_paths"] = """
WITH RECURSIVE legal(f, t) AS (VALUES ('', 'signup'), ('signup', 'view'), ('view', 'view'), ('view', 'click'), ('click', 'view'), ('click', 'purchase'), ('purchase', 'view')),
s AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
r AS (SELECT event_id, user_id, k, event_type = 'signup' AS ok, CASE WHEN event_type = 'signup' THEN 'signup' ELSE '' END AS state FROM s WHERE k = 1
      UNION ALL
      SELECT s.event_id, s.user_id, s.k, l.t IS NOT NULL, CASE WHEN l.t IS NOT NULL THEN s.event_type ELSE r.state END
      FROM r JOIN s ON s.user_id = r.user_id AND s.k = r.k + 1 LEFT JOIN legal l ON l.f = r.state AND l.t = s.event_type)
SELECT user_id, count(*) AS n_events, count(*) FILTER (WHERE NOT ok) AS n_illegal, arg_min(event_id, k) FILTER (WHERE NOT ok) AS first_illegal,
  nullif(arg_max(state, k), '') AS final_state FROM r GROUP BY user_id"""

SQL["dq_profile_merged"] = """
SELECT 'user_id' AS column_name, count(*) AS n_rows, count(*) - count(user_id) AS n_nulls, true AS distinct_ok FROM events
UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), true FROM events
UNION ALL SELECT 'value', count(*), count(*) - count(value), true FROM events
UNION ALL SELECT 'props', count(*), count(*) - count(props), true FROM events"""

SQL["ledger_refusals"] = """
WITH RECURSIVE s AS (SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS points,
       CASE event_type WHEN 'purchase' THEN CAST(value AS DECIMAL(12,2)) WHEN 'click' THEN -CAST(value AS DECIMAL(12,2)) ELSE 0 END AS x,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
r AS (SELECT event_id, user_id, event_type, points, k, x >= 0 AS accepted, CAST(CASE WHEN x >= 0 THEN x ELSE 0 END AS DECIMAL(18,2)) AS available FROM s WHERE k = 1
      UNION ALL
      SELECT s.event_id, s.user_id, s.event_type, s.points, s.k, s.x >= 0 OR r.available + s.x >= 0,
        CAST(CASE WHEN s.x >= 0 OR r.available + s.x >= 0 THEN r.available + s.x ELSE r.available END AS DECIMAL(18,2))
      FROM r JOIN s ON s.user_id = r.user_id AND s.k = r.k + 1)
SELECT event_id, user_id, event_type, points, accepted, available FROM r"""

SQL["table_atomic_replace"] = """
SELECT o_orderstatus, count(*) AS n_rows, CASE WHEN coalesce(o_orderstatus IN ('F', 'O'), false) THEN 'valid' ELSE 'quarantine' END AS side FROM orders GROUP BY ALL
UNION ALL SELECT NULL, count(*), 'valid before' FROM orders WHERE o_orderstatus = 'O'"""

SQL["cdc_dead_letters"] = f"""WITH {EV}
SELECT 'unparsable' AS reason, ts AS kafka_ts, count(*) AS n_messages FROM msgs WHERE is_cut GROUP BY ts"""

SQL["ledger_delete_state"] = f"""WITH {EV},
last AS (SELECT entity_id, max((source_ts_ms, source_lsn)) AS d FROM changes WHERE cdc_operation = 'd' GROUP BY entity_id)
SELECT c.entity_id, c.source_lsn, c.cdc_operation, c.amount_dec FROM changes c LEFT JOIN last l ON l.entity_id = c.entity_id
WHERE c.cdc_operation <> 'd' AND (l.d IS NULL OR (c.source_ts_ms, c.source_lsn) > l.d)"""

SQL["fact_unmatched_keys"] = """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE c.c_custkey IS NULL) AS n_unmatched
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal >= 0"""

SQL["fact_role_playing"] = """
WITH dn AS (SELECT n_nationkey, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS nation_key FROM nation)
SELECT l.l_orderkey, l.l_linenumber, o1.nation_key AS origin_nation_key,
       o2.nation_key AS destination_nation_key, s.s_name AS supplier_name
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN dn o1 ON c.c_nationkey = o1.n_nationkey
LEFT JOIN dn o2 ON s.s_nationkey = o2.n_nationkey"""

SQL["fact_ledger"] = f"""WITH {EV}, {LEDGER_CHECKED}
SELECT source_lsn AS transaction_id, entity_id, status, amount_dec, source_ts_ms FROM lc
WHERE has_valid_status AND has_valid_amount AND has_note"""

SQL["cross_domain_lookup"] = """
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_ref, c.c_name, CAST(count(o.o_orderkey) AS BIGINT) AS n_orders
FROM customer c LEFT JOIN orders o ON CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)
GROUP BY 1, 2 ORDER BY 1"""

SQL["referential_orphans"] = """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)"""

SQL["cascade_semi_join"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
            THEN 'CANCELLED' ELSE 'ISSUED' END AS ticket_status
FROM lineitem"""

SQL["refund_candidates"] = """
SELECT o.o_orderkey, l.l_linenumber, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS refund_amount,
       CASE WHEN l.l_returnflag = 'R' THEN 'PROCESSED' ELSE 'PENDING' END AS refund_status,
       CASE WHEN l.l_returnflag = 'R' THEN l.l_shipdate END AS processed_at
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE o.o_orderstatus = 'P'"""

SQL["lookup_pick_one"] = """
WITH g AS (SELECT s_nationkey, min(s_suppkey) AS gate_suppkey FROM supplier GROUP BY 1)
SELECT c.c_custkey, g.gate_suppkey, s.s_name AS gate_name
FROM customer c LEFT JOIN g ON c.c_nationkey = g.s_nationkey
LEFT JOIN supplier s ON s.s_suppkey = g.gate_suppkey"""

LINE_AMOUNT = """round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                   * (1 + CAST(l_tax AS DECIMAL(4,2))), 2)"""

SQL["header_rollup"] = f"""
WITH per AS (SELECT l_orderkey, count(*) AS n_items, CAST(sum({LINE_AMOUNT}) AS DECIMAL(18,2)) AS items_total
             FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, CAST(coalesce(p.n_items, 0) AS BIGINT) AS n_items,
       coalesce(p.items_total, CAST(0 AS DECIMAL(18,2))) AS items_total,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS header_total,
       coalesce(p.items_total, CAST(0 AS DECIMAL(18,2))) = CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_matches
FROM orders o LEFT JOIN per p ON o.o_orderkey = p.l_orderkey"""

SQL["ledger_balance"] = """
SELECT user_id,
  CAST(coalesce(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE event_type = 'purchase'), 0) AS DECIMAL(18,2)) AS earned,
  CAST(coalesce(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE event_type = 'click'), 0) AS DECIMAL(18,2)) AS redeemed,
  count(*) AS n_transactions,
  CAST(coalesce(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE event_type = 'purchase'), 0)
     - coalesce(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE event_type = 'click'), 0) AS DECIMAL(18,2)) AS balance
FROM events GROUP BY user_id"""

SQL["ledger_running_balance"] = """
WITH s AS (SELECT event_id, user_id, ts,
             CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2))
                  WHEN event_type = 'click' THEN -CAST(value AS DECIMAL(12,2)) ELSE 0 END AS signed
           FROM events),
r AS (SELECT event_id, user_id,
        sum(signed) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rb
      FROM s)
SELECT event_id, user_id, CAST(rb AS DECIMAL(18,2)) AS running_balance, rb < 0 AS is_overdrawn FROM r"""

TIERS_SQL = """
tiers AS (SELECT * FROM (VALUES (1, 'Bronze', 0), (2, 'Silver', 25000), (3, 'Gold', 75000), (4, 'Platinum', 150000))
          t(tier_id, tier_name, min_miles)),
miles AS (SELECT c.c_custkey,
            CAST(CAST(coalesce(sum(CAST(o.o_totalprice AS DECIMAL(18,2))), 0) * 100 AS BIGINT) // 10000 AS BIGINT) AS miles
          FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1),
assigned AS (SELECT m.c_custkey, m.miles,
               (SELECT max(tier_id) FROM tiers t WHERE t.min_miles <= m.miles) AS tier_id FROM miles m)"""

SQL["tier_assignment"] = f"""WITH {TIERS_SQL.strip()}
SELECT a.c_custkey, a.miles, t.tier_id, t.tier_name FROM assigned a LEFT JOIN tiers t ON a.tier_id = t.tier_id"""

SQL["tier_distribution"] = f"""WITH {TIERS_SQL.strip()}
SELECT t.tier_name, count(*) AS n_members FROM assigned a LEFT JOIN tiers t ON a.tier_id = t.tier_id GROUP BY 1"""

SQL["status_counts"] = """
WITH last AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS s FROM events GROUP BY 1)
SELECT count(*) AS n_entities,
  count(*) FILTER (WHERE s = 'signup') AS n_signup, count(*) FILTER (WHERE s = 'view') AS n_view,
  count(*) FILTER (WHERE s = 'click') AS n_click, count(*) FILTER (WHERE s = 'purchase') AS n_purchase,
  count(*) FILTER (WHERE s = 'error') AS n_error
FROM last"""

SQL["status_transitions"] = """
WITH tr AS (SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_status,
                   event_type AS to_status FROM events),
allowed AS (SELECT * FROM (VALUES (NULL, 'signup'), ('signup', 'view'), ('view', 'view'), ('view', 'click'),
                                  ('click', 'view'), ('click', 'purchase'), ('purchase', 'view')) a(f, t))
SELECT from_status, to_status, count(*) AS n_transitions,
       EXISTS (SELECT 1 FROM allowed a WHERE a.f IS NOT DISTINCT FROM tr.from_status AND a.t = tr.to_status) AS is_allowed
FROM tr GROUP BY from_status, to_status"""

FLIGHTS_SQL = """
sched AS (SELECT s_suppkey AS schedule_id, 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS code,
            CASE s_suppkey % 3 WHEN 0 THEN 'MON,WED,FRI' WHEN 1 THEN 'TUE,THU,SAT,SUN'
                 ELSE 'MON,TUE,WED,THU,FRI,SAT,SUN' END AS days_of_week,
            CAST((s_suppkey * 37) % 1440 AS INTEGER) AS dep_minute,
            CAST(((s_suppkey * 37) % 1440 + 60 + (s_suppkey * 11) % 600) % 1440 AS INTEGER) AS arr_minute
          FROM supplier),
inst AS (SELECT *, CAST(unnest(generate_series(DATE '1998-08-02' - INTERVAL 14 DAY, DATE '1998-08-02' + INTERVAL 3 DAY,
                                               INTERVAL 1 DAY)) AS DATE) AS flight_date FROM sched),
flights AS (
  SELECT code || CAST(schedule_id + 100 AS VARCHAR) || strftime(flight_date, '%m%d') AS flight_id,
         schedule_id, flight_date,
         CAST(flight_date AS TIMESTAMP) + to_minutes(dep_minute) AS scheduled_departure,
         CAST(CASE WHEN arr_minute < dep_minute THEN flight_date + 1 ELSE flight_date END AS TIMESTAMP)
           + to_minutes(arr_minute) AS scheduled_arrival
  FROM inst
  WHERE flight_date <= DATE '1998-08-02'
    AND list_contains(string_split(days_of_week, ','), upper(strftime(flight_date, '%a'))))"""

SQL["schedule_expand"] = f"WITH {FLIGHTS_SQL.strip()} SELECT * FROM flights"

SQL["delay_adjusted_times"] = f"""WITH {FLIGHTS_SQL.strip()},
delays AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, CAST(max(l_quantity) AS INTEGER) AS delay_minutes
           FROM lineitem GROUP BY 1, 2)
SELECT f.flight_id, coalesce(d.delay_minutes, 0) AS delay_minutes,
       f.scheduled_departure + to_minutes(coalesce(d.delay_minutes, 0)) AS actual_departure,
       f.scheduled_arrival + to_minutes(coalesce(d.delay_minutes, 0)) AS actual_arrival
FROM flights f LEFT JOIN delays d ON d.l_suppkey = f.schedule_id AND d.d = f.flight_date"""

SQL["usage_due_events"] = """
WITH usage AS (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) * 10 AS hours, count(*) * 20 AS cycles
               FROM lineitem GROUP BY 1),
types AS (SELECT * FROM (VALUES ('A_CHECK', 600, 400), ('B_CHECK', 2000, 1200), ('C_CHECK', 6000, 4000),
                                ('D_CHECK', 24000, 16000)) t(maintenance_type, ih, ic)),
due AS (SELECT p.p_partkey, t.maintenance_type,
          CAST(least(greatest(floor(u.hours / t.ih), floor(u.cycles / t.ic)), 5) AS INTEGER) AS n
        FROM usage u JOIN part p ON u.l_partkey = p.p_partkey, types t)
SELECT p_partkey, maintenance_type, CAST(unnest(generate_series(1, n)) AS INTEGER) AS occurrence FROM due WHERE n >= 1"""

SQL["flag_from_events"] = """
SELECT c_custkey, EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'error' AND e.value > 400)
       AS is_flagged
FROM customer c"""

SQL["hash_sample"] = """
SELECT c_custkey, c_name FROM customer WHERE substr(md5(CAST(c_custkey AS VARCHAR)), 1, 15) < 'b33333333333300'"""

SQL["entity_age"] = """
SELECT o_orderkey, CAST(datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS age_days,
       CAST(floor(datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 365) AS INTEGER) AS age_years
FROM orders"""

SQL["case_rules"] = """
WITH x AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN 'F' WHEN p_size > 25 THEN 'J' ELSE 'Y' END AS class_code FROM part)
SELECT p_partkey, class_code, class_code = 'F' AS refundable,
       CAST(CASE class_code WHEN 'F' THEN 0 WHEN 'J' THEN 5000 ELSE 2000 END AS DECIMAL(10,2)) AS change_fee,
       CASE class_code WHEN 'F' THEN 40 WHEN 'J' THEN 32 ELSE 23 END AS baggage_allowance_kg
FROM x"""

SQL["dq_report"] = """
SELECT 'orders' AS table_name, 'not_null' AS test_name, 'o_custkey' AS column_name,
       count(*) FILTER (WHERE o_custkey IS NULL) AS failures FROM orders
UNION ALL SELECT 'orders', 'not_null', 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'orders', 'accepted_values', 'o_orderstatus',
       count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
UNION ALL SELECT 'orders', 'unique', 'o_orderkey', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
       (SELECT count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'relationships', 'o_custkey', count(*) FROM orders o
       WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)
UNION ALL SELECT 'customer', 'not_null', 'c_name', count(*) FILTER (WHERE c_name IS NULL) FROM customer
UNION ALL SELECT 'customer', 'accepted_values', 'c_mktsegment',
       count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN
                        ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) FROM customer
UNION ALL SELECT 'customer', 'unique', 'c_custkey', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
       (SELECT count(*) AS n FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING count(*) > 1)"""

SQL["incremental_upsert"] = SQL["cdc_current_state_deletes"]

SQL["mart_daily_rollup"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_price
FROM orders GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate))"""

SQL["stream_bronze_ingest"] = f"WITH {EV} SELECT * FROM ledger"

SQL["stream_dedupe_change"] = f"WITH {EV} SELECT entity_id, source_lsn, cdc_operation FROM ledger"

SQL["stream_dedupe_first"] = f"""WITH {EV}
SELECT entity_id, source_lsn, status FROM ledger
QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_lsn) = 1"""

SQL["stream_early_facts"] = """
SELECT event_id, user_id, user_id IN (SELECT user_id FROM events WHERE event_type = 'signup') AS has_parent FROM events WHERE event_type = 'purchase'"""

SQL["stream_window_counts"] = """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, value FROM events),
m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM events)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total_value
FROM w, m WHERE window_start + INTERVAL 1 HOUR <= m.wm
GROUP BY window_start, event_type"""

SQL["window_sliding_counts"] = """
WITH b AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS b FROM events),
w AS (SELECT b AS window_start FROM b UNION ALL SELECT b - INTERVAL 30 MINUTE FROM b)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n_events FROM w GROUP BY 1"""

SQL["session_counts"] = """
WITH g AS (SELECT user_id, ts,
             CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                    OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                  THEN 1 ELSE 0 END AS is_new, event_id FROM events),
s AS (SELECT user_id, ts, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events
FROM s GROUP BY user_id, sid"""

SQL["stream_late_rows"] = f"""WITH {EV} SELECT * FROM ledger WHERE kafka_ts >= TIMESTAMP '2024-01-15 00:00:00'"""

SQL["stream_restart"] = f"WITH {EV} SELECT * FROM ledger"

SQL["stream_multi_table"] = f"""WITH {EV}
SELECT 'events' AS table_name, entity_id AS entity_key, source_lsn, cdc_operation FROM changes
UNION ALL SELECT 'orders', o_orderkey, o_orderkey, 'r' FROM orders
UNION ALL SELECT 'shop.unheard', NULL, NULL, NULL FROM msgs WHERE op = 'c' AND NOT is_cut"""

SQL["end_to_end_star"] = f"""WITH {EV}, {DIM_CUSTOMER.strip()},
cur AS (SELECT * FROM (SELECT * FROM changes
        QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY source_ts_ms DESC, source_lsn DESC, kafka_ts DESC) = 1)
        WHERE cdc_operation <> 'd'),
chk AS (SELECT *, {SILVER_FLAGS} FROM cur)
SELECT c.entity_id, d.customer_key, c.status, c.amount_dec, c.source_ts_ms
FROM chk c LEFT JOIN dim_customer d ON c.entity_id = d.c_custkey
WHERE has_valid_status AND has_valid_amount AND has_note"""

SQL["table_overwrite_roundtrip"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'"

SQL["stream_late_side_table"] = f"""WITH {EV} SELECT * FROM ledger WHERE kafka_ts < TIMESTAMP '2024-01-15 00:00:00'"""

SQL["silver_referential_split"] = """
WITH x AS (SELECT o_orderkey, coalesce(o_orderstatus IN ('F', 'O'), false) AS s,
             o_custkey IS NULL OR EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey) AS k FROM orders o)
SELECT o_orderkey, s AND k AS _valid,
       CASE WHEN NOT s THEN 'invalid o_orderstatus value' WHEN NOT k THEN 'o_custkey without a match' END AS quarantine_reason,
       concat_ws(',', CASE WHEN NOT s THEN 'has_final_status' END, CASE WHEN NOT k THEN 'has_customer' END) AS failed_rules
FROM x"""

SQL["dim_key_stability"] = """
SELECT c_custkey, c_name, CAST(row_number() OVER (ORDER BY c_custkey % 2 = 0, c_custkey) - 1 AS BIGINT) AS customer_key FROM customer"""
