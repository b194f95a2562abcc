"""Gold aggregates (A1, A2, A6) and the lambda reconciliation (X7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.quality import money
from tributary.schemas import MONEY_SQL, TOTAL_SQL

MINUTE = "1 minute"


def minute_start(time: Column) -> Column:
    """The start of the minute window that a wall-clock time lies in."""
    return F.date_trunc("minute", time).cast("timestamp_ntz")


def minute_revenue(clean: DataFrame, *, time_col: str = "order_date", counted: bool = False) -> DataFrame:
    """Tumbling 1-minute x product revenue, windows ``[start, end)``.

    Rows with a NULL event time fall out (as ``window()`` does).  Partial
    aggregation happens map-side, so a hot (minute, product) costs one row
    per input partition in the shuffle.  ``counted`` adds ``n_orders``, which
    incremental upkeep needs to know when a window has become empty.
    """
    count = [F.count(F.lit(1)).alias("n_orders")] if counted else []
    return (
        clean.groupBy(F.window(F.col(time_col), MINUTE).alias("window"), F.col("product_id"))
        .agg(F.sum("amount").alias("total_revenue"), *count)
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            F.col("product_id"),
            money("total_revenue").alias("total_revenue"),
            *(["n_orders"] if counted else []),
        )
    )


def daily_revenue(clean: DataFrame, *, time_col: str = "order_date") -> DataFrame:
    """(day, product) revenue; a NULL event time forms its own NULL-date group."""
    return (
        clean.groupBy(F.to_date(F.col(time_col)).alias("report_date"), F.col("product_id"))
        .agg(money(F.sum("amount")).alias("total_revenue"))
    )


def publishable_daily(daily: DataFrame) -> DataFrame:
    """Rows the daily table accepts: NOT NULL date and product.  A total past the money type
    fails the publish (the old version stays live); it is never left out."""
    total = F.coalesce("total_revenue", F.raise_error(F.concat(
        F.lit("daily total out of range: "), F.col("report_date").cast("string"), F.lit(" "), F.col("product_id"))).cast(MONEY_SQL))
    return daily.filter(
        F.col("report_date").isNotNull() & F.col("product_id").isNotNull()
    ).withColumn("total_revenue", total)


def reconcile(minute: DataFrame, daily: DataFrame) -> DataFrame:
    """Speed view rolled up to days, full-outer joined with the batch view.

    ``delta = batch - speed`` (missing side counts as 0); both inputs are
    already aggregates, so the join is small relative to the event volume.
    """
    speed = (
        minute.groupBy(F.to_date("window_start").alias("report_date"), "product_id")
        .agg(F.sum("total_revenue").cast(TOTAL_SQL).alias("speed_revenue"))
    )
    batch = daily.select("report_date", "product_id",
                         F.col("total_revenue").cast(TOTAL_SQL).alias("batch_revenue"))
    j = speed.join(batch, ["report_date", "product_id"], "full_outer")
    return j.select(
        "report_date", "product_id", "speed_revenue", "batch_revenue",
        (F.coalesce("batch_revenue", F.lit(0)) - F.coalesce("speed_revenue", F.lit(0)))
        .cast(TOTAL_SQL).alias("delta"),
    )
