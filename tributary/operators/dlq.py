"""Dead-letter queue (K6, F-5, F-6, X4 pieces): rows, lifecycle, recovery frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.quality import INVALID_AMOUNT, STATUS_UNPROCESSED, recoverable
from tributary.operators.gold import minute_revenue, minute_start
from tributary.operators.merge import latest_per_key
from tributary.schemas import DLQ_COLUMNS, MONEY_SQL, SILVER_COLUMNS


def dlq_rows(errors: DataFrame, *, id_col: str = "bronze_id", created_at: Column | None = None
             ) -> DataFrame:
    """Error rows as DLQ records with status ``unprocessed``.

    The id is the row's Bronze id (its source position), so re-running a
    load rewrites the same ids instead of adding copies.
    """
    created_at = created_at if created_at is not None else F.current_timestamp().cast("timestamp_ntz")
    source = [F.col("source")] if "source" in errors.columns else []
    cols = (["source"] if source else []) + DLQ_COLUMNS
    return errors.select(
        *source,
        F.col(id_col).cast("long").alias("id"),
        "order_id", "customer_id", "product_id", "amount", "order_date",
        "error_reason", "source_type",
        F.lit(STATUS_UNPROCESSED).alias("status"),
        created_at.alias("created_at"),
    ).select(*cols)


def _replayable(reasons: tuple[str, ...], require_product: bool) -> Column:
    usable = F.trim("product_id") != "" if require_product else F.lit(True)
    return recoverable(reasons) & usable


def recoverable_rows(dlq: DataFrame, reasons: tuple[str, ...] = (INVALID_AMOUNT,), *,
                     require_product: bool = True) -> DataFrame:
    """Rows a replay may fix.  ``require_product`` keeps rows without a usable
    product key in the review queue (minute gold needs the key NOT NULL)."""
    return dlq.filter(_replayable(reasons, require_product))


def review_queue(dlq: DataFrame, reasons: tuple[str, ...] = (INVALID_AMOUNT,), *,
                 require_product: bool = True) -> DataFrame:
    """Unprocessed rows that need a person: the recoverable test negated, row by row."""
    return dlq.filter((F.col("status") == STATUS_UNPROCESSED)
                      & ~F.coalesce(_replayable(reasons, require_product), F.lit(False)))


def review_report(queue: DataFrame) -> DataFrame:
    """Work-queue summary per reason and source."""
    return queue.groupBy("error_reason", "source_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("created_at").alias("oldest_created_at"),
    )


def recovered_events(rows: DataFrame) -> DataFrame:
    """One event per order id (F3): several DLQ copies of one order (stream +
    each batch run) collapse to the latest copy, so a refund is counted once.
    Amount keeps its sign (a negative amount is a refund)."""
    latest = latest_per_key(rows.select("order_id", "customer_id", "product_id", "amount",
                                        "order_date", "created_at", "id"),
                            ["order_id"], ["created_at", "id"])
    return latest.select(*SILVER_COLUMNS)


def recovered_minute(recovered: DataFrame) -> DataFrame:
    """Minute sums over the recovered rows only (``replace`` refresh mode)."""
    return minute_revenue(recovered)


def recompute_minutes(silver: DataFrame, keys: DataFrame) -> DataFrame:
    """Minute gold for the given keys recomputed from Silver (``recompute`` mode).

    Keys whose window holds no sales any more come back as an empty interval,
    ``window_end = window_start``, with total 0: a retraction (see :func:`live_minutes`)."""
    tagged = silver.withColumn("window_start", minute_start(F.col("order_date")))
    hit = tagged.join(keys, ["window_start", "product_id"], "left_semi").drop("window_start")
    fresh = minute_revenue(hit)
    gone = keys.join(fresh.select("window_start", "product_id"), ["window_start", "product_id"], "left_anti")
    return fresh.unionByName(gone.select("window_start", F.col("window_start").alias("window_end"), "product_id",
                                         F.lit(0).cast(MONEY_SQL).alias("total_revenue")))


def live_minutes(minutes: DataFrame) -> DataFrame:
    """Minute gold without retracted windows."""
    return minutes.filter(F.col("window_end") > F.col("window_start"))
