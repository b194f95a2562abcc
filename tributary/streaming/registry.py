"""Registered streaming queries: bounded runs (``availableNow``) over the
given ``events`` table, returning what the sinks committed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.gold import daily_revenue, publishable_daily, reconcile
from tributary.plans import oracle as O
from tributary.plans.store import Store
from tributary.schemas import MINUTE_COLUMNS, SILVER_COLUMNS
from tributary.session import scratch_path, session_key
from tributary.sources.readers import read_table
from tributary.streaming.gold import clean_stream, minute_stream, start_minute_query
from tributary.streaming.progress import Progress
from tributary.streaming.router import start_router
from tributary.streaming.runner import start_speed_layer
from tributary.streaming.sources import events_payload_stream, events_payloads
from tributary.streaming.state import open_minutes

LATE_KIND = 12      # residue of event_id % 50 whose rows arrive one phase late
PHASES = 3

_router_runs: dict[tuple, str] = {}


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read_table(spark, sf_dir, "events").schema
    return events_payload_stream(spark, sf_dir, schema, glob="events.parquet")


def run_router(spark: SparkSession, sf_dir: str, *, replays: int = 1) -> Store:
    """Route the whole ``events`` table through the speed layer once per
    replay (each replay = a new checkpoint, i.e. a re-read from the start)."""
    key = (session_key(spark), sf_dir, replays)
    if key in _router_runs:
        return Store(spark, _router_runs[key])
    root = scratch_path(spark, "router")
    store = Store(spark, f"{root}/tables")
    for i in range(replays):
        q = start_router(_events_stream(spark, sf_dir), store, f"{root}/checkpoint-{i}",
                         run_tag=f"run{i}", available_now=True)
        q.awaitTermination()
    _router_runs[key] = store.root
    return store


def q_stream_bronze(spark, d):
    return run_router(spark, d).bronze_state().select("source", "bronze_id", "payload")


def q_stream_silver(spark, d):
    return run_router(spark, d).silver_state().select(*SILVER_COLUMNS)


def q_stream_dlq(spark, d):
    return run_router(spark, d).dlq_state().drop("created_at")


def q_stream_replay_idempotent(spark, d):
    store = run_router(spark, d, replays=2)
    silver = store.silver_state().select(*SILVER_COLUMNS)
    # Replays must not multiply Bronze either: one row per source position.
    bronze_dups = store.bronze.versions().groupBy("source", "bronze_id").agg(
        F.count_distinct("payload").alias("n_payloads"))
    bad = bronze_dups.filter(F.col("n_payloads") > 1).limit(1).count()
    assert bad == 0, "replay produced differing payloads for one source position"
    return silver


def _minute_run(spark, d, mode: str) -> DataFrame:
    root = scratch_path(spark, f"minute-{mode}")
    store = Store(spark, f"{root}/tables")
    minutes = minute_stream(clean_stream(_events_stream(spark, d)))
    q = start_minute_query(minutes, store, f"{root}/checkpoint", "run0", output_mode=mode,
                           available_now=True)
    q.awaitTermination()
    return store.minute_state().select(*MINUTE_COLUMNS)


def q_stream_minute_append(spark, d):
    return _minute_run(spark, d, "append")


def q_stream_minute_update(spark, d):
    return _minute_run(spark, d, "update")


def arrival_phase(events: DataFrame, lo: int, hi: int) -> F.Column:
    """Arrival phase 1..3 by event id; residue ``LATE_KIND`` rows arrive one
    phase after their neighbours (capped at the last phase)."""
    base = F.expr(f"1 + (3 * (event_id - {lo})) div ({hi - lo + 1})")
    late = F.when(F.pmod(F.col("event_id"), F.lit(50)) == LATE_KIND, 1).otherwise(0)
    return F.least(F.lit(PHASES), base + late)


def run_late(spark: SparkSession, d: str) -> tuple[Store, str]:
    """Minute gold (append mode) of events that arrive in three runs, a share of them one run
    late; returns its store and the query's checkpoint."""
    events = read_table(spark, d, "events")
    bounds = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    root = scratch_path(spark, "late")
    inbox, checkpoint = f"{root}/inbox", f"{root}/checkpoint"
    store = Store(spark, f"{root}/tables")
    phased = events.withColumn("_phase", arrival_phase(events, bounds["lo"], bounds["hi"]))
    for p in range(1, PHASES + 1):
        phased.filter(F.col("_phase") == p).drop("_phase").write.mode("append").parquet(inbox)
        stream = events_payload_stream(spark, inbox, events.schema)
        minutes = minute_stream(clean_stream(stream))
        q = start_minute_query(minutes, store, checkpoint, "late", output_mode="append",
                               available_now=True)
        q.awaitTermination()
    return store, checkpoint


def q_stream_late_drop(spark, d):
    """Events arrive in three runs; a share of rows arrives one run late.

    Late rows whose window ended before the previous run's watermark are
    dropped from minute gold (append mode), the rest are counted.
    """
    return run_late(spark, d)[0].minute_state().select(*MINUTE_COLUMNS)


def q_stream_progress(spark, d):
    """The speed layer under a running trigger, events arriving in three phases: the rows that
    each query reports for the batches of a phase, by its listener."""
    events = read_table(spark, d, "events")
    bounds = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    root = scratch_path(spark, "progress")
    inbox, store, progress = f"{root}/inbox", Store(spark, f"{root}/tables"), Progress()
    phased = events.withColumn("_phase", arrival_phase(events, bounds["lo"], bounds["hi"]))

    def arrive(phase: int) -> None:
        phased.filter(F.col("_phase") == phase).drop("_phase").write.mode("append").parquet(inbox)
    spark.streams.addListener(progress)
    queries, reported = [], []
    try:
        arrive(1)
        queries = start_speed_layer(spark, events_payload_stream(spark, inbox, events.schema), store, f"{root}/checkpoint",
                                    processing_time="1 second", names=("progress-router", "progress-gold"))
        for phase in range(1, PHASES + 1):
            if phase > 1:
                arrive(phase)
            for query in queries:
                before = sum(n for _, name, n in reported if name == query.name)
                query.processAllAvailable()
                reported.append((phase, query.name, progress.seen(query) - before))
    finally:
        for query in queries:
            query.stop()
        spark.streams.removeListener(progress)
    # a row per phase and query
    return spark.createDataFrame(reported, "phase int, query string, n_rows long")


def q_lambda_reconcile_open(spark, d):
    """Speed against batch view before the watermark has closed every window: emitted minutes
    and those still in state, against daily gold of all clean rows.  What differs is the
    revenue of rows that came too late."""
    store, checkpoint = run_late(spark, d)
    speed = store.minute_state().select(*MINUTE_COLUMNS).unionByName(open_minutes(spark, checkpoint))
    batch = publishable_daily(daily_revenue(clean_stream(events_payloads(read_table(spark, d, "events")))))
    return reconcile(speed, batch)


def q_stream_alert_digest(spark, d):
    """High-value sales (view B) through the router with the part catalog:
    the digest the router committed for the micro-batch."""
    from tributary.functions.payload import pack
    from tributary.sources.fixtures import catalog_from_part, sales_view_b

    root = scratch_path(spark, "alerts")
    b = sales_view_b(read_table(spark, d, "lineitem"), read_table(spark, d, "orders"))
    payloads = b.select(
        F.lit("sales").alias("source"), F.monotonically_increasing_id().alias("bronze_id"),
        pack(["order_id", "customer_id", "product_id", "amount", "order_date"]).alias("payload"))
    payloads.write.parquet(f"{root}/inbox")
    store = Store(spark, f"{root}/tables")
    stream = spark.readStream.schema("source string, bronze_id long, payload string") \
        .parquet(f"{root}/inbox")
    start_router(stream, store, f"{root}/checkpoint", "alerts",
                 catalog=catalog_from_part(read_table(spark, d, "part")),
                 available_now=True, alert_time=F.expr(O.RUN_STAMP)).awaitTermination()
    return store.alerts.read().select("n_orders", "n_listed", "n_more", "lines", "message", "local_time")


def q_stream_decode(spark, d):
    """Messages as bytes, some of them broken or null, through the router to Bronze."""
    from tributary.sources.readers import file_value_stream, payload_stream
    root = scratch_path(spark, "decode")
    kind = F.pmod("bronze_id", F.lit(50))
    data = F.encode("payload", "utf-8")
    value = (F.when(kind == 13, F.concat(data, F.lit(b"\xc3"))).when(kind == 14, F.lit(None).cast("binary"))
             .when(kind == 15, F.concat(F.lit(b"\xff"), data)).otherwise(data))
    events_payloads(read_table(spark, d, "events")).select("source", "bronze_id", value.alias("value")).write.parquet(f"{root}/inbox")
    store = Store(spark, f"{root}/tables")
    start_router(payload_stream(file_value_stream(spark, f"{root}/inbox")), store, f"{root}/checkpoint", "decode",
                 available_now=True).awaitTermination()
    bronze = store.bronze_state().select("source", "bronze_id", "payload")
    queued = store.dlq_state().select("source", F.col("id").alias("bronze_id"), "error_reason")
    return bronze.join(queued, ["source", "bronze_id"], "left")


STREAM_QUERIES = {
    "stream_decode": q_stream_decode,
    "stream_alert_digest": q_stream_alert_digest,
    "stream_bronze": q_stream_bronze,
    "stream_silver": q_stream_silver,
    "stream_dlq": q_stream_dlq,
    "stream_replay_idempotent": q_stream_replay_idempotent,
    "stream_minute_append": q_stream_minute_append,
    "stream_minute_update": q_stream_minute_update,
    "stream_late_drop": q_stream_late_drop,
    "stream_progress": q_stream_progress,
    "lambda_reconcile_open": q_lambda_reconcile_open,
}


def stream_oracle_sql() -> dict[str, str]:
    routed_s = O.PARSED_A + O.routed(source_type="Streaming")
    clean_s = routed_s + """,
clean AS (SELECT bronze_id, order_id, customer_id, product_id, amount, order_date
          FROM r WHERE error_reason IS NULL)"""
    q = {}
    q["stream_bronze"] = f"""WITH {O.VIEW_A},
j AS (SELECT bronze_id, kind, '{{' || concat_ws(',',
    CASE WHEN order_id IS NOT NULL THEN '"order_id":' || CAST(to_json(order_id) AS VARCHAR) END,
    CASE WHEN customer_id IS NOT NULL THEN '"customer_id":' || CAST(to_json(customer_id) AS VARCHAR) END,
    CASE WHEN product_id IS NOT NULL THEN '"product_id":' || CAST(to_json(product_id) AS VARCHAR) END,
    CASE WHEN amount IS NOT NULL THEN '"amount":' || CAST(amount AS VARCHAR) END,
    CASE WHEN order_date IS NOT NULL THEN '"order_date":' || CAST(to_json(order_date) AS VARCHAR) END
  ) || '}}' AS full_json FROM a)
SELECT 'events' AS source, bronze_id,
  CASE WHEN kind = 8 THEN substring(full_json, 1, 20) ELSE full_json END AS payload FROM j"""
    # A lone first byte of a character, a null, and a byte that no text has.
    q["stream_decode"] = f"""WITH {routed_s},
b AS ({q["stream_bronze"].replace("WITH", "WITH RECURSIVE", 1)})
SELECT b.source, b.bronze_id,
  CASE b.bronze_id % 50 WHEN 13 THEN b.payload || chr(65533) WHEN 14 THEN '' WHEN 15 THEN chr(65533) || b.payload ELSE b.payload END AS payload,
  CASE WHEN b.bronze_id % 50 IN (14, 15) THEN 'Missing Customer ID' ELSE r.error_reason END AS error_reason
FROM b JOIN r USING (bronze_id)"""
    silver = f"WITH {clean_s} SELECT order_id, customer_id, product_id, amount, order_date FROM clean"
    q["stream_silver"] = silver
    q["stream_replay_idempotent"] = silver
    q["stream_dlq"] = f"""WITH {routed_s}
SELECT 'events' AS source, bronze_id AS id, order_id, customer_id, product_id, amount, order_date,
  error_reason, source_type, 'unprocessed' AS status
FROM r WHERE error_reason IS NOT NULL"""
    q["stream_minute_update"] = f"WITH {clean_s} {O.MINUTE.format(src='clean')}"
    q["stream_minute_append"] = f"""WITH {clean_s}, m AS ({O.MINUTE.format(src='clean')})
SELECT * FROM m WHERE window_end <= (SELECT max(order_date) FROM clean) - INTERVAL 5 MINUTE"""
    kept = f"""{clean_s},
ids AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
ph AS (SELECT c.*, LEAST({PHASES}, 1 + (3 * (c.bronze_id - ids.lo)) // (ids.hi - ids.lo + 1)
          + CASE WHEN c.bronze_id % 50 = {LATE_KIND} THEN 1 ELSE 0 END) AS phase
       FROM clean c, ids),
prev AS (SELECT p.phase, (SELECT max(order_date) FROM ph q WHERE q.phase < p.phase) AS prev_max
         FROM (SELECT DISTINCT phase FROM ph) p),
kept AS (SELECT ph.* FROM ph JOIN prev USING (phase)
         WHERE prev.prev_max IS NULL
            OR date_trunc('minute', ph.order_date) + INTERVAL 1 MINUTE > prev.prev_max - INTERVAL 5 MINUTE)"""
    q["lambda_reconcile_open"] = f"""WITH {kept},
speed AS (SELECT CAST(order_date AS DATE) AS report_date, product_id, CAST(sum(amount) AS DECIMAL(38,2)) AS speed_revenue
          FROM kept WHERE order_date IS NOT NULL GROUP BY 1, 2),
batch AS (SELECT report_date, product_id, CAST(total_revenue AS DECIMAL(38,2)) AS batch_revenue
          FROM ({O.DAILY.format(src='clean')}) WHERE report_date IS NOT NULL)
SELECT b.report_date, b.product_id, s.speed_revenue, b.batch_revenue,
  CAST(b.batch_revenue - COALESCE(s.speed_revenue, 0) AS DECIMAL(38,2)) AS delta
FROM batch b LEFT JOIN speed s ON s.report_date = b.report_date AND s.product_id = b.product_id"""
    q["stream_progress"] = f"""
SELECT CAST(least({PHASES}, 1 + (3 * (event_id - lo)) // (hi - lo + 1) + CASE WHEN event_id % 50 = {LATE_KIND} THEN 1 ELSE 0 END) AS INTEGER) AS phase,
  query, count(*) AS n_rows
FROM events, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events), (VALUES ('progress-router'), ('progress-gold')) AS v(query)
GROUP BY ALL"""
    q["stream_late_drop"] = f"""WITH {kept},
m AS ({O.MINUTE.format(src='kept')})
SELECT * FROM m WHERE window_end <= (SELECT max(order_date) FROM ph) - INTERVAL 5 MINUTE"""
    q["stream_alert_digest"] = f"""WITH {O.VIEW_B}, {O.CATALOG},
hv AS (SELECT b.order_id, b.product_id, b.amount, {O.DIGEST_LINE.replace('product_name', 'cat.product_name')} AS line
       FROM b LEFT JOIN cat ON cat.product_id = b.product_id WHERE b.amount > 1000),
ranked AS (SELECT *, row_number() OVER (ORDER BY amount DESC NULLS LAST, order_id NULLS FIRST,
             product_id NULLS FIRST, line NULLS FIRST) AS rn FROM hv),
agg AS (SELECT count(*) AS n_orders, count(*) FILTER (WHERE rn <= 15) AS n_listed,
          string_agg(line, chr(10) ORDER BY rn) FILTER (WHERE rn <= 15) AS lines FROM ranked)
SELECT n_orders, n_listed, n_orders - n_listed AS n_more, lines,
  concat_ws(chr(10), '[SYSTEM ALERT - HIGH VALUE TRANSACTIONS]', '----------------------------------------',
    'Batch: 0', 'Time: 2030-01-01 07:00:00', 'Orders: ' || CAST(n_orders AS VARCHAR), '----------------------------------------',
    lines, CASE WHEN n_orders - n_listed > 0 THEN '... and ' || CAST(n_orders - n_listed AS VARCHAR)
      || ' more high-value orders in this batch.' END,
    '----------------------------------------') AS message, '2030-01-01 07:00:00' AS local_time
FROM agg"""
    return q
