"""DLQ recovery job (X4, X8): replay refunds into Silver and minute gold.

The DLQ state is read once (a fixed set of committed files), so the rows
replayed, the gold refresh and the ids marked are the same rows.  Copies of
one order collapse to one event before anything is summed.  Order of
commits: Silver, minute gold, then status; a crash before the status commit
replays into the same keys (idempotent), never into sums twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.quality import INVALID_AMOUNT, STATUS_PROCESSED, recoverable
from tributary.operators.deltas import change_feed, touched_minutes
from tributary.operators.dlq import (
    recompute_minutes, recoverable_rows, recovered_events, recovered_minute,
)
from tributary.operators.gold import minute_start
from tributary.plans.store import SILVER_SCHEMA, Store


def recover_dlq(spark: SparkSession, store: Store, run_id: str, *, mode: str = "recompute",
                reasons: tuple[str, ...] = (INVALID_AMOUNT,), stamp: Column | None = None
                ) -> DataFrame:
    """Run one recovery pass; returns a one-row report.

    ``mode='replace'`` upserts minute sums of the recovered rows only (the
    window total is replaced, as the original job did); ``'recompute'``
    recomputes every touched (minute, product) from Silver: those the recovered
    rows fall in and those that the rows they replace leave, so a refund that
    moves a sale to another minute leaves nothing behind.
    """
    if mode not in ("replace", "recompute"):
        raise ValueError(f"unknown refresh mode {mode!r}")
    stamp = stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz")
    # Only DLQ keys with a version that looks recoverable are merged (their
    # merged status then decides); the rest of the DLQ is not shuffled.
    touched = store.dlq.read_touching(recoverable(reasons))
    if touched is None:
        return _report(spark, 0, 0, 0)
    # Replayed, compared and marked: read and merged once.
    rows = recoverable_rows(touched, reasons).persist()
    try:
        if rows.isEmpty():
            return _report(spark, 0, 0, 0)
        recovered = recovered_events(rows)
        # The rows to be replaced, as committed now (the files read are fixed here).
        feed = change_feed(store.silver.read_or_empty(SILVER_SCHEMA, only=recovered.select("order_id")),
                           recovered, ["order_id"], ["order_date"])
        silver_rows = store.silver.append(recovered.withColumn("processed_at", stamp),
                                          tag=f"recovery-{run_id}", unique=True)
        return _refresh(spark, store, run_id, mode, stamp, rows, recovered, touched_minutes(feed).persist(), silver_rows)
    finally:
        rows.unpersist()


def _refresh(spark: SparkSession, store: Store, run_id: str, mode: str, stamp: Column, rows: DataFrame,
             recovered: DataFrame, keys: DataFrame, silver_rows: int) -> DataFrame:
    """Minute gold and status of the recovered ``rows``; ``keys`` are the touched minutes (persisted)."""
    try:
        if mode == "replace":
            minutes = recovered_minute(recovered)
        else:
            def in_affected(raw):
                tagged = raw.withColumn("window_start", minute_start(F.col("order_date")))
                return tagged.join(keys, ["window_start", "product_id"], "left_semi")

            # Only orders that ever had a version in a touched (minute, product)
            # are merged; the rest of Silver is not shuffled.
            minutes = recompute_minutes(store.silver.read_touching(in_affected), keys)
        # The gold refresh and the status change commit together.
        with store.transaction() as tx:
            minute_rows = store.minute.append(minutes.withColumn("created_at", stamp),
                                              tag=f"recovery-{run_id}", tx=tx)
            marked = store.dlq.append(rows.withColumn("status", F.lit(STATUS_PROCESSED)),
                                      tag=f"recovery-{run_id}", tx=tx)
    finally:
        keys.unpersist()
    return _report(spark, silver_rows, minute_rows, marked)


def _report(spark, silver_rows, minute_rows, marked):
    return spark.createDataFrame([(int(silver_rows), int(minute_rows), int(marked))],
                                 "silver_rows long, minute_rows long, dlq_marked long")
