"""Speed layer router (T6, T7, K1, K3, K6, T10): one stateless query fans out
each micro-batch to Bronze, Silver, DLQ and the alert digest.

The micro-batch is read from the source once and persisted; every sink write
goes to an increment tagged ``<run_tag>-<batch_id>``.  A retried batch commits the same
rows again, and a replay under a new run tag does too; both converge because the tables are keyed (Bronze by source position,
Silver by order id, DLQ by source position).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.payload import parse_columns
from tributary.functions.quality import SOURCE_STREAMING
from tributary.functions.text import local_time_text
from tributary.operators import alerts
from tributary.operators.dlq import dlq_rows
from tributary.operators.merge import bounded, latest_per_key
from tributary.operators.quality import route_quality
from tributary.plans.store import Store
from tributary.schemas import SILVER_COLUMNS

CATALOG_BROADCAST_ROWS = 1_000_000
ALERT_ZONE = "Asia/Ho_Chi_Minh"  # wall-clock zone of the alert text


def stream_tag(run_tag: str, checkpoint: str) -> str:
    """Increment tag prefix of a streaming query.

    Batch ids restart at 0 under a new checkpoint, so the checkpoint location
    is part of the tag: a retried batch (same checkpoint) has its own tag again,
    a replay under a new checkpoint has others.
    """
    return f"{run_tag}-{hashlib.sha1(checkpoint.encode()).hexdigest()[:10]}"


def _now():
    return F.current_timestamp().cast("timestamp_ntz")


def route_batch(batch: DataFrame, store: Store, tag: str, *, catalog: DataFrame | None = None,
                broadcast_catalog: bool = False, threshold: float = alerts.HIGH_VALUE_THRESHOLD,
                alert_zone: str = ALERT_ZONE, batch_id: int | None = None, alert_time: Column | None = None) -> None:
    """Write one micro-batch of ``(source, bronze_id, payload)`` rows.

    The digest names ``batch_id`` (else the tag) and the time (``alert_time``, else now) in
    ``alert_zone``."""
    b = batch.persist()
    try:
        if b.isEmpty():
            return
        routed = route_quality(parse_columns(b, ["source", "bronze_id"]), SOURCE_STREAMING).persist()
        try:
            # All sinks of one micro-batch become visible together.
            with store.transaction() as tx:
                store.bronze.append(
                    b.select("source", "bronze_id", "payload", _now().alias("ingested_at")),
                    tag=tag, tx=tx)
                clean = routed.filter(F.col("error_reason").isNull())
                # Within one batch the later source position wins (arrival order).
                latest = latest_per_key(clean.select(*SILVER_COLUMNS, "source", "bronze_id"),
                                        ["order_id"], ["source", "bronze_id"])
                store.silver.append(
                    latest.select(*SILVER_COLUMNS).withColumn("processed_at", _now()),
                    tag=tag, tx=tx)
                store.dlq.append(dlq_rows(routed.filter(F.col("error_reason").isNotNull())),
                                 tag=tag, tx=tx)
                if catalog is not None:
                    high = alerts.high_value(clean, threshold)
                    local = local_time_text(alert_time if alert_time is not None else F.current_timestamp(), alert_zone)
                    digest = alerts.alert_digest(
                        high, catalog=catalog, broadcast_catalog=broadcast_catalog, catalog_is_unique=True,
                        batch=F.lit(tag if batch_id is None else batch_id), at=local)
                    store.alerts.append(
                        digest.withColumn("batch", F.lit(tag)).withColumn("local_time", local),
                        tag=tag, tx=tx)
        finally:
            routed.unpersist()
    finally:
        b.unpersist()


def start_router(payloads: DataFrame, store: Store, checkpoint: str, run_tag: str, *,
                 catalog: DataFrame | None = None, available_now: bool = False,
                 processing_time: str = "10 seconds", query_name: str | None = None,
                 alert_time: Column | None = None):
    """Start the router query over a stream of ``(source, bronze_id, payload)``."""
    broadcast_catalog = False
    if catalog is not None:
        # Static side: dedupe once; keep it cached only when provably small
        # (then it is also broadcast to every micro-batch).
        catalog = alerts.unique_catalog(catalog)
        broadcast_catalog = bounded(catalog, CATALOG_BROADCAST_ROWS)
        if broadcast_catalog:
            catalog = catalog.persist()

    prefix = stream_tag(run_tag, checkpoint)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        route_batch(batch_df, store, f"{prefix}-{batch_id}", catalog=catalog,
                    broadcast_catalog=broadcast_catalog, batch_id=batch_id, alert_time=alert_time)

    writer = payloads.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()
