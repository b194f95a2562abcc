"""Independent SQL (DuckDB dialect) for every registered query.

Each string re-derives its inputs from the given tables with plain SQL
(CASE, window functions, joins), so it checks the DataFrame code rather than
repeating it.
"""

from __future__ import annotations

OLD_STAMP = "TIMESTAMP '2000-01-01 00:00:00'"
RUN_STAMP = "TIMESTAMP '2030-01-01 00:00:00'"
CUTOFF_TARGET = "TIMESTAMP '1998-07-01 00:00:00'"
#: Refunds of the moved-sale query take over the order of the event so many ids later.
MOVED_BY = 12
CUTOFF_CHANGES = "TIMESTAMP '1998-01-01 00:00:00'"

# View A, typed: one dirty kind per residue of event_id % 50.
VIEW_A = """
a AS (
  SELECT event_id AS bronze_id, event_id % 50 AS kind,
    CASE event_id % 50 WHEN 2 THEN '' WHEN 4 THEN NULL ELSE 'E' || CAST(event_id AS VARCHAR) END AS order_id,
    CASE event_id % 50 WHEN 0 THEN NULL WHEN 11 THEN '' ELSE CAST(user_id AS VARCHAR) END AS customer_id,
    CASE event_id % 50 WHEN 5 THEN '  '
      WHEN 6 THEN '  ' || json_extract_string(props, '$.k') || '  '
      WHEN 10 THEN NULL ELSE json_extract_string(props, '$.k') END AS product_id,
    CAST(CASE event_id % 50 WHEN 1 THEN -99.99 WHEN 3 THEN NULL WHEN 9 THEN 0 WHEN 10 THEN -5
      ELSE CAST(value AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS amount,
    CASE event_id % 50 WHEN 7 THEN 'not a date' WHEN 16 THEN CAST(ts AS VARCHAR) || '+07:00'
      ELSE CAST(ts AS VARCHAR) END AS order_date
  FROM events)"""

# Payload path: a truncated payload (kind 8) parses to all NULL fields.
PARSED_A = VIEW_A + """,
p AS (
  SELECT bronze_id, kind,
    CASE WHEN kind = 8 THEN NULL ELSE order_id END AS order_id,
    CASE WHEN kind = 8 THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN kind = 8 THEN NULL ELSE product_id END AS product_id,
    CASE WHEN kind = 8 THEN NULL ELSE amount END AS amount,
    CASE WHEN kind = 8 THEN NULL ELSE order_date END AS order_date
  FROM a)"""


def routed(src: str = "p", policy: str = "code", source_type: str = "Batch") -> str:
    if policy == "code":
        amount_bad, order_bad = "amount <= 0", "order_id = ''"
    else:
        amount_bad = "amount IS NULL OR amount <= 0"
        order_bad = "order_id IS NULL OR order_id = ''"
    return f""",
r AS (
  SELECT bronze_id, kind, order_id, customer_id, product_id, amount,
    CASE WHEN order_date LIKE '%+07:00' THEN CAST(left(order_date, -6) AS TIMESTAMP) - INTERVAL 7 HOUR
      ELSE TRY_CAST(order_date AS TIMESTAMP) END AS order_date,
    CASE WHEN customer_id IS NULL OR amount IS NULL OR amount <= 0 OR order_id IS NULL
              OR order_id = '' OR product_id IS NULL OR product_id = ''
      THEN CASE WHEN customer_id IS NULL THEN 'Missing Customer ID'
                WHEN {amount_bad} THEN 'Invalid Amount'
                WHEN {order_bad} THEN 'Missing Order ID'
                WHEN product_id IS NULL OR product_id = '' THEN 'Missing Product ID'
                ELSE 'Schema Mismatch Exception' END
    END AS error_reason,
    '{source_type}' AS source_type
  FROM (SELECT bronze_id, kind, order_id, customer_id, trim(product_id) AS product_id, amount,
               order_date FROM {src}) x)"""


ROUTED_A = PARSED_A + routed()
CLEAN_A = ROUTED_A + """,
clean AS (SELECT bronze_id, order_id, customer_id, product_id, amount, order_date
          FROM r WHERE error_reason IS NULL)"""

# View B: lineitem x orders with natural duplicate order ids.
VIEW_B = """
b AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, CAST(l_shipdate AS TIMESTAMP) AS order_date,
    l_suppkey, l_quantity, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
B_ORDER_ASC = ("order_date, amount, product_id, customer_id, l_suppkey, l_quantity, "
               "l_discount, l_tax")
B_ORDER_DESC = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in B_ORDER_ASC.split(","))
B_TARGET = VIEW_B + f""",
tgt AS (
  SELECT order_id, customer_id, product_id, amount, order_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {B_ORDER_ASC}) AS rn
    FROM b WHERE order_date < {CUTOFF_TARGET}) WHERE rn = 1),
chg_all AS (SELECT * FROM b WHERE order_date >= {CUTOFF_CHANGES})"""

CATALOG = """
cat AS (
  SELECT product_id, product_name, category FROM (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
      row_number() OVER (PARTITION BY p_partkey ORDER BY p_name NULLS FIRST, p_type NULLS FIRST) AS rn
    FROM part) WHERE rn = 1)"""

MINUTE = """
  SELECT CAST(date_trunc('minute', order_date) AS TIMESTAMP) AS window_start,
    CAST(date_trunc('minute', order_date) + INTERVAL 1 MINUTE AS TIMESTAMP) AS window_end,
    product_id, CAST(sum(amount) AS DECIMAL(12,2)) AS total_revenue
  FROM {src} WHERE order_date IS NOT NULL GROUP BY 1, 2, 3"""

DAILY = """
  SELECT CAST(order_date AS DATE) AS report_date, product_id,
    CAST(sum(amount) AS DECIMAL(12,2)) AS total_revenue
  FROM {src} GROUP BY 1, 2"""

# DLQ rows from view A errors, and the recovery chain over them.
RECOVERY = CLEAN_A + f""",
dlq AS (
  SELECT bronze_id AS id, order_id, customer_id, product_id, amount, order_date, error_reason,
    source_type, 'unprocessed' AS status, {OLD_STAMP} AS created_at
  FROM r WHERE error_reason IS NOT NULL),
rec_rows AS (
  SELECT * FROM dlq WHERE status = 'unprocessed' AND error_reason = 'Invalid Amount'
    AND order_id IS NOT NULL AND order_id <> '' AND product_id IS NOT NULL AND trim(product_id) <> ''),
rec AS (
  SELECT order_id, customer_id, product_id, amount, order_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY created_at DESC NULLS LAST,
      id DESC NULLS LAST) AS rn FROM rec_rows) WHERE rn = 1),
silver0 AS (SELECT order_id, customer_id, product_id, amount, order_date, {OLD_STAMP} AS processed_at
            FROM clean),
silver1 AS (
  SELECT * FROM silver0 s WHERE NOT EXISTS (SELECT 1 FROM rec WHERE rec.order_id = s.order_id)
  UNION ALL
  SELECT rec.order_id, rec.customer_id, rec.product_id, rec.amount, rec.order_date,
    COALESCE(s.processed_at, {RUN_STAMP}) AS processed_at
  FROM rec LEFT JOIN silver0 s ON s.order_id = rec.order_id),
minute0 AS ({MINUTE.format(src='clean')})"""


def _minute_upsert_sql(target: str, changes: str) -> str:
    return f"""
  SELECT t.* FROM {target} t
  WHERE NOT EXISTS (SELECT 1 FROM {changes} c
                    WHERE c.window_start = t.window_start AND c.product_id = t.product_id)
  UNION ALL
  SELECT c.window_start, c.window_end, c.product_id, c.total_revenue,
    COALESCE(t.created_at, {RUN_STAMP}) AS created_at
  FROM {changes} c LEFT JOIN {target} t
    ON c.window_start = t.window_start AND c.product_id = t.product_id"""


DIGEST_LINE = ("'Order: ' || COALESCE(order_id, '') || ' | Product: ' || "
               "COALESCE(NULLIF(product_name, ''), 'Unknown Product') || ' | Amount: $' || "
               "format('{:,.2f}', CAST(amount AS DOUBLE))")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_pack_parse"] = f"WITH {PARSED_A} SELECT bronze_id, order_id, customer_id, product_id, amount, order_date FROM p"
    q["parse_malformed"] = f"""WITH {ROUTED_A}
SELECT CASE kind WHEN 0 THEN 'customer NULL' WHEN 1 THEN 'amount -99.99' WHEN 2 THEN 'order empty'
  WHEN 3 THEN 'amount NULL' WHEN 4 THEN 'order NULL' WHEN 5 THEN 'product blank'
  WHEN 6 THEN 'product padded' WHEN 7 THEN 'date unparseable' WHEN 8 THEN 'payload truncated'
  WHEN 9 THEN 'amount zero' WHEN 10 THEN 'amount -5, product NULL' WHEN 11 THEN 'customer empty'
  WHEN 16 THEN 'date with offset' ELSE 'none' END AS dirty_kind,
  COALESCE(error_reason, 'clean') AS route, count(*) AS n_rows
FROM r GROUP BY 1, 2"""
    q["quality_clean"] = f"WITH {CLEAN_A} SELECT * FROM clean"
    q["quality_errors"] = f"""WITH {ROUTED_A}
SELECT bronze_id, order_id, customer_id, product_id, amount, order_date, error_reason, source_type
FROM r WHERE error_reason IS NOT NULL"""
    for name, policy in (("error_reason_counts", "code"), ("error_reason_counts_documented", "documented")):
        q[name] = f"""WITH {PARSED_A}{routed(policy=policy)}
SELECT error_reason, count(*) AS n_rows, CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount
FROM r WHERE error_reason IS NOT NULL GROUP BY 1"""
    q["daily_revenue"] = f"WITH {CLEAN_A} {DAILY.format(src='clean')}"
    q["minute_revenue"] = f"WITH {CLEAN_A} {MINUTE.format(src='clean')}"
    q["silver_insert_if_absent"] = f"""WITH {B_TARGET},
firsts AS (
  SELECT order_id, customer_id, product_id, amount, order_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {B_ORDER_ASC}) AS rn FROM chg_all)
  WHERE rn = 1)
SELECT *, 'existing' AS origin FROM tgt
UNION ALL
SELECT f.*, 'inserted' AS origin FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.order_id = f.order_id)"""
    q["silver_upsert"] = f"""WITH {B_TARGET},
chg AS (
  SELECT order_id, customer_id, product_id, amount, order_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {B_ORDER_DESC}) AS rn FROM chg_all)
  WHERE rn = 1)
SELECT t.*, {OLD_STAMP} AS processed_at FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM chg c WHERE c.order_id = t.order_id)
UNION ALL
SELECT c.*, CASE WHEN t.order_id IS NOT NULL THEN {OLD_STAMP} ELSE {RUN_STAMP} END AS processed_at
FROM chg c LEFT JOIN tgt t ON t.order_id = c.order_id"""
    q["minute_upsert"] = f"""WITH {VIEW_B},
mt AS (SELECT *, {OLD_STAMP} AS created_at FROM ({MINUTE.format(src=f"(SELECT * FROM b WHERE order_date < {CUTOFF_TARGET})")})),
mc AS ({MINUTE.format(src=f"(SELECT * FROM b WHERE order_date >= {CUTOFF_CHANGES})")})
{_minute_upsert_sql('mt', 'mc')}"""
    daily_pub = f"""WITH {CLEAN_A}
SELECT * FROM ({DAILY.format(src='clean')}) WHERE report_date IS NOT NULL"""
    q["gold_swap"] = daily_pub
    q["gold_swap_empty_guard"] = daily_pub
    beyond = "amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(12,2)) IS NULL"
    rules = [*(("not_null", c, f"{c} IS NULL") for c in ("order_id", "customer_id", "product_id", "amount", "order_date")),
             *(("max_length_255", c, f"length({c}) > 255") for c in ("order_id", "customer_id", "product_id")),
             ("money_range", "amount", beyond)]

    def example(test: str) -> str:
        return f"""min(CASE WHEN {test} THEN '{{"order_id":"' || order_id || '"}}' END) AS example"""
    counted = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{c}' AS column_name, count(*) FILTER (WHERE {test}) AS n_violations, {example(test)} FROM s"
        for rule, c, test in rules)
    q["constraint_violations"] = f"""WITH {VIEW_B},
s AS (SELECT order_id, customer_id, product_id, CAST(amount AS DOUBLE) * l_quantity * 2500 AS amount, order_date FROM b)
SELECT 'silver_candidates' AS table_name, rule, column_name, CAST(n_violations AS BIGINT) AS n_violations, example FROM (
  {counted}
  UNION ALL SELECT 'unique_key', 'order_id', COALESCE(sum(n - 1), 0), {example("n > 1")}
    FROM (SELECT order_id, count(*) AS n FROM s GROUP BY order_id)
)"""
    q["type_migration"] = """
SELECT 'events' AS table_name, 'value' AS column_name, count(*) AS n_rows,
  count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS DECIMAL(12,2)) IS NOT NULL
                   AND CAST(TRY_CAST(value AS DECIMAL(12,2)) AS DOUBLE) <> value) AS n_rounded,
  count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS DECIMAL(12,2)) IS NULL) AS n_nulled
FROM events
UNION ALL
SELECT 'lineitem', 'l_extendedprice', count(*),
  count(*) FILTER (WHERE l_extendedprice IS NOT NULL AND TRY_CAST(l_extendedprice AS DECIMAL(12,2)) IS NOT NULL
                   AND CAST(TRY_CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) <> l_extendedprice),
  count(*) FILTER (WHERE l_extendedprice IS NOT NULL AND TRY_CAST(l_extendedprice AS DECIMAL(12,2)) IS NULL)
FROM lineitem
UNION ALL
SELECT 'lineitem', 'l_quantity', count(*),
  count(*) FILTER (WHERE l_quantity IS NOT NULL AND TRY_CAST(l_quantity AS DECIMAL(12,2)) IS NOT NULL
                   AND CAST(TRY_CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) <> l_quantity),
  count(*) FILTER (WHERE l_quantity IS NOT NULL AND TRY_CAST(l_quantity AS DECIMAL(12,2)) IS NULL)
FROM lineitem"""
    new = "TRY_CAST(v AS DECIMAL(12,2))"
    sources = {
        ("silver", "amount"): "SELECT l_extendedprice / 7 AS v, l_orderkey % 3 = 0 AS newer FROM lineitem",
        ("dlq", "amount"): "SELECT value / 7 AS v, event_id % 3 = 0 AS newer FROM events",
        ("gold_minute", "total_revenue"): """SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / 7 AS v,
            minute(date_trunc('minute', ts)) % 3 = 0 AS newer FROM events GROUP BY date_trunc('minute', ts)"""}
    for table in ("gold_daily", "gold_daily_staging"):
        sources[table, "total_revenue"] = """SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 7 AS v,
            day(CAST(l_shipdate AS DATE)) % 3 = 0 AS newer FROM lineitem GROUP BY CAST(l_shipdate AS DATE)"""
    q["type_migration_executed"] = " UNION ALL ".join(f"""
SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) FILTER (WHERE NOT newer) AS n_migrated,
  count(*) FILTER (WHERE NOT newer AND CAST({new} AS DOUBLE) <> v) AS n_rounded, 'decimal(12,2)' AS data_type,
  count(*) FILTER (WHERE newer IS NOT NULL) AS n_held, CAST(sum({new}) FILTER (WHERE newer IS NOT NULL) AS DECIMAL(38,2)) AS total FROM ({source})""" for (table, column), source in sources.items())
    q["catalog_create_once"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category FROM part"""
    q["enrich_left"] = f"""WITH {CLEAN_A}, {CATALOG}
SELECT c.bronze_id, c.order_id, c.product_id, c.amount, cat.product_name, cat.category
FROM clean c LEFT JOIN cat ON cat.product_id = c.product_id"""
    q["unknown_products"] = f"""WITH {CLEAN_A}, {CATALOG},
e AS (SELECT c.product_id, COALESCE(NULLIF(cat.product_name, ''), 'Unknown Product') = 'Unknown Product' AS unknown
      FROM clean c LEFT JOIN cat ON cat.product_id = c.product_id)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE unknown) AS n_unknown,
  count(DISTINCT CASE WHEN unknown THEN product_id END) AS n_unknown_products FROM e"""
    hv = f"""WITH {VIEW_B}, {CATALOG},
hv AS (SELECT b.order_id, b.customer_id, b.product_id, b.amount, b.order_date, cat.product_name
       FROM b LEFT JOIN cat ON cat.product_id = b.product_id WHERE b.amount > 1000)"""
    q["high_value_orders"] = f"{hv} SELECT * FROM hv"
    q["alert_digest"] = f"""{hv},
lined AS (SELECT CAST(order_date AS DATE) AS report_date, amount, order_id, product_id, {DIGEST_LINE} AS line FROM hv),
ranked AS (SELECT *, row_number() OVER (PARTITION BY report_date
             ORDER BY amount DESC NULLS LAST, order_id NULLS FIRST, product_id NULLS FIRST, line NULLS FIRST) AS rn FROM lined),
agg AS (
  SELECT report_date, count(*) AS n_orders, count(*) FILTER (WHERE rn <= 15) AS n_listed,
    string_agg(line, chr(10) ORDER BY rn) FILTER (WHERE rn <= 15) AS lines
  FROM ranked GROUP BY report_date)
SELECT report_date, n_orders, n_listed, n_orders - n_listed AS n_more, lines,
  concat_ws(chr(10), '[SYSTEM ALERT - HIGH VALUE TRANSACTIONS]', '----------------------------------------',
    'Batch: ' || CAST(report_date AS VARCHAR), 'Orders: ' || CAST(n_orders AS VARCHAR),
    '----------------------------------------', lines,
    CASE WHEN n_orders - n_listed > 0 THEN '... and ' || CAST(n_orders - n_listed AS VARCHAR)
         || ' more high-value orders in this batch.' END,
    '----------------------------------------') AS message
FROM agg"""
    q["dlq_append"] = f"WITH {RECOVERY} SELECT * FROM dlq"
    q["dlq_lifecycle"] = f"""WITH {RECOVERY}
SELECT id, error_reason, CASE WHEN id IN (SELECT id FROM rec_rows) THEN 'processed' ELSE status END AS status
FROM dlq"""
    q["dlq_lookup"] = f"""WITH {RECOVERY},
now AS (SELECT dlq.* REPLACE (CASE WHEN id IN (SELECT id FROM rec_rows) THEN 'processed' ELSE status END AS status) FROM dlq)
SELECT *, 'increments' AS phase FROM now UNION ALL SELECT *, 'compacted' FROM now"""
    q["dlq_recoverable"] = f"WITH {RECOVERY} SELECT * FROM rec_rows"
    q["dlq_review_queue"] = f"""WITH {RECOVERY}
SELECT error_reason, source_type, count(*) AS n_rows, min(created_at) AS oldest_created_at
FROM dlq WHERE status = 'unprocessed' AND id NOT IN (SELECT id FROM rec_rows)
GROUP BY 1, 2"""
    q["recovery_silver"] = f"WITH {RECOVERY} SELECT * FROM silver1"
    q["recovery_minute_replace"] = f"""WITH {RECOVERY},
mt AS (SELECT *, {OLD_STAMP} AS created_at FROM minute0),
mc AS ({MINUTE.format(src='rec')})
{_minute_upsert_sql('mt', 'mc')}"""
    q["recovery_minute_recompute"] = f"""WITH {RECOVERY},
mt AS (SELECT *, {OLD_STAMP} AS created_at FROM minute0),
keys AS (SELECT DISTINCT date_trunc('minute', order_date) AS window_start, product_id
         FROM rec WHERE order_date IS NOT NULL),
hit AS (SELECT s.* FROM silver1 s WHERE EXISTS (SELECT 1 FROM keys k
          WHERE k.window_start = date_trunc('minute', s.order_date) AND k.product_id = s.product_id)),
mc AS ({MINUTE.format(src='hit')})
{_minute_upsert_sql('mt', 'mc')}"""
    # From scratch: Silver with the replaced sales exchanged, summed anew.
    q["recovery_minute_moved"] = f"""WITH {RECOVERY},
moved AS (
  SELECT order_id, product_id, amount, order_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST) AS rn
    FROM (SELECT id, created_at, 'E' || CAST(id + {MOVED_BY} AS VARCHAR) AS order_id, product_id, amount, order_date FROM rec_rows))
  WHERE rn = 1),
after AS (
  SELECT product_id, amount, order_date FROM silver0 s WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.order_id = s.order_id)
  UNION ALL SELECT product_id, amount, order_date FROM moved)
SELECT m.*, n.n_orders, CASE WHEN EXISTS (SELECT 1 FROM minute0 o WHERE o.window_start = m.window_start AND o.product_id = m.product_id)
    THEN {OLD_STAMP} ELSE {RUN_STAMP} END AS created_at
FROM ({MINUTE.format(src='after')}) m
JOIN (SELECT CAST(date_trunc('minute', order_date) AS TIMESTAMP) AS window_start, product_id, count(*) AS n_orders
      FROM after WHERE order_date IS NOT NULL GROUP BY 1, 2) n USING (window_start, product_id)"""
    q["refund_daily"] = f"""WITH {RECOVERY}
SELECT * FROM ({DAILY.format(src='silver1')}) WHERE report_date IS NOT NULL"""
    q["lambda_reconcile"] = f"""WITH {RECOVERY},
speed AS (SELECT CAST(window_start AS DATE) AS report_date, product_id,
            CAST(sum(total_revenue) AS DECIMAL(38,2)) AS speed_revenue FROM minute0 GROUP BY 1, 2),
batch AS (SELECT report_date, product_id, CAST(total_revenue AS DECIMAL(38,2)) AS batch_revenue
          FROM ({DAILY.format(src='silver1')}) WHERE report_date IS NOT NULL)
SELECT COALESCE(s.report_date, b.report_date) AS report_date, COALESCE(s.product_id, b.product_id) AS product_id,
  s.speed_revenue, b.batch_revenue,
  CAST(COALESCE(b.batch_revenue, 0) - COALESCE(s.speed_revenue, 0) AS DECIMAL(38,2)) AS delta
FROM speed s FULL OUTER JOIN batch b ON s.report_date = b.report_date AND s.product_id = b.product_id"""
    q["run_report"] = f"""WITH {CLEAN_A},
d AS ({DAILY.format(src='clean')})
SELECT (SELECT count(*) FROM r) AS bronze_rows,
  (SELECT count(*) FROM r WHERE error_reason IS NULL) AS clean_rows,
  (SELECT count(*) FROM r WHERE error_reason IS NOT NULL) AS dlq_rows,
  (SELECT count(*) FROM d WHERE report_date IS NOT NULL) AS gold_rows,
  (SELECT count(*) FROM d WHERE report_date IS NULL) AS null_date_groups,
  (SELECT CAST(sum(total_revenue) AS DECIMAL(38,2)) FROM d WHERE report_date IS NULL) AS null_date_revenue"""
    q.update(batch_job_sql())
    q["silver_merge_on_read"] = q["recovery_silver"]
    q["silver_upsert_bucketed"], q["minute_upsert_bucketed"] = q["silver_upsert"], q["minute_upsert"]
    q["silver_upsert_keeps_audit"] = f"""WITH {B_TARGET},
chg AS (
  SELECT order_id, amount FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {B_ORDER_DESC}) AS rn FROM chg_all)
  WHERE rn = 1)
SELECT t.order_id, t.amount AS amount_before, c.amount AS amount_after, {OLD_STAMP} AS processed_at
FROM tgt t JOIN chg c ON c.order_id = t.order_id"""
    return q


# Landing CSV round trip: empty strings read back as NULL.
LANDING_A = VIEW_A + """,
l AS (SELECT bronze_id, kind, NULLIF(order_id, '') AS order_id, NULLIF(customer_id, '') AS customer_id,
        NULLIF(product_id, '') AS product_id, amount, order_date FROM a)"""
BATCH_JOB = LANDING_A + routed(src="l") + """,
clean AS (SELECT order_id, customer_id, product_id, amount, order_date FROM r WHERE error_reason IS NULL),
d AS (""" + DAILY.format(src="clean") + """),
rec_rows AS (SELECT * FROM r WHERE error_reason = 'Invalid Amount' AND order_id IS NOT NULL
               AND order_id <> '' AND product_id IS NOT NULL AND trim(product_id) <> '')"""


def batch_job_sql() -> dict[str, str]:
    q = {}
    q["landing_to_bronze"] = f"WITH {LANDING_A} SELECT order_id, customer_id, product_id, amount, order_date FROM l"
    report = """SELECT (SELECT count(*) FROM r) AS bronze_rows,
  {silver} AS silver_new_rows, {dlq} AS dlq_new_rows,
  (SELECT count(*) FROM d WHERE report_date IS NOT NULL) AS gold_rows,
  (SELECT count(*) FROM d WHERE report_date IS NULL) AS null_date_groups"""
    q["batch_job_report"] = f"WITH {BATCH_JOB} " + report.format(
        silver="(SELECT count(DISTINCT order_id) FROM clean)",
        dlq="(SELECT count(*) FROM r WHERE error_reason IS NOT NULL)")
    q["batch_job_rerun_report"] = f"WITH {BATCH_JOB} " + report.format(
        silver="CAST(0 AS BIGINT)", dlq="CAST(0 AS BIGINT)")
    q["batch_job_daily"] = f"WITH {BATCH_JOB} SELECT * FROM d WHERE report_date IS NOT NULL"
    q["reload_corrected"] = f"""WITH {BATCH_JOB},
fixed AS (SELECT l.order_id, customer_id, trim(product_id) AS product_id, CAST(value AS DECIMAL(12,2)) AS amount,
            CAST(l.order_date AS TIMESTAMP) AS order_date
          FROM l JOIN events ON event_id = bronze_id WHERE kind = 3),
modes AS (SELECT unnest(['incremental', 'full', 'compacted']) AS mode)
SELECT s.*, mode FROM (SELECT * FROM clean UNION ALL SELECT * FROM fixed) s, modes"""
    q["recovery_job_silver"] = f"""WITH {BATCH_JOB}
SELECT * FROM clean
UNION ALL SELECT order_id, customer_id, product_id, amount, order_date FROM rec_rows"""
    q["recovery_job_dlq"] = f"""WITH {BATCH_JOB}
SELECT order_id, customer_id, product_id, amount, order_date, error_reason, source_type,
  CASE WHEN error_reason = 'Invalid Amount' AND order_id IS NOT NULL AND order_id <> ''
            AND product_id IS NOT NULL AND trim(product_id) <> '' THEN 'processed' ELSE 'unprocessed' END AS status
FROM r WHERE error_reason IS NOT NULL"""
    q["recovery_job_report"] = f"""WITH {BATCH_JOB}
SELECT (SELECT count(DISTINCT order_id) FROM rec_rows) AS silver_rows,
  (SELECT count(*) FROM (SELECT DISTINCT date_trunc('minute', order_date), product_id FROM rec_rows
                         WHERE order_date IS NOT NULL)) AS minute_rows,
  (SELECT count(*) FROM rec_rows) AS dlq_marked"""
    return q
