"""Gold kept up to date by signed deltas (A6, X4).

A keyed change has an old image (the row it replaces, if any) and a new one.  The old image
leaves the window it was summed in, the new one enters its own: so a refund that moves a sale
to another minute or product is taken out of the first and added to the second.  Windows that
hold no sales any more are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.quality import money
from tributary.operators.gold import minute_start
from tributary.operators.merge import latest_per_key
from tributary.schemas import TOTAL_SQL


def change_feed(target: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(key, old, new): one row per changed key; ``old`` is null for an insert.

    The latest change of a key counts.  Only the changes are aggregated; the target streams
    past them (it is neither aggregated nor sorted, and not moved if it is bucketed by key).
    """
    values = [c for c in target.columns if c not in key and c in changes.columns]
    carried = list(dict.fromkeys([*values, *(o for o in order if o not in key)]))
    new = latest_per_key(changes.select(*key, *carried), key, order).select(*key, F.struct(*values).alias("new"))
    old = target.select(*key, F.struct(*values).alias("old"))
    return old.join(new.hint("shuffle_hash"), list(key), "right")


def minute_deltas(feed: DataFrame, *, time_col: str = "order_date") -> DataFrame:
    """(window_start, product_id, d_revenue, d_orders): what the feed changes, summed.

    Images without an event time are in no window.  A change that leaves its window's sum and
    count as they are cancels out."""
    def side(image: str, sign: int) -> Column:
        row = F.col(image)
        return F.when(row.isNotNull(), F.struct(
            minute_start(row[time_col]).alias("window_start"), row["product_id"].alias("product_id"),
            (row["amount"] * sign).cast(TOTAL_SQL).alias("d_revenue"), F.lit(sign).cast("long").alias("d_orders")))
    return (feed.select(F.explode(F.array(side("old", -1), side("new", 1))).alias("side")).select("side.*")
            .filter(F.col("window_start").isNotNull()).groupBy("window_start", "product_id")
            .agg(F.sum("d_revenue").cast(TOTAL_SQL).alias("d_revenue"), F.sum("d_orders").alias("d_orders"))
            .filter((F.col("d_revenue") != 0) | (F.col("d_orders") != 0)))


def touched_minutes(feed: DataFrame, *, time_col: str = "order_date") -> DataFrame:
    """(window_start, product_id) of every window an old or a new image lies in."""
    images = F.explode(F.array(F.col("old"), F.col("new"))).alias("image")
    return (feed.select(images).filter(F.col(f"image.{time_col}").isNotNull())
            .select(minute_start(F.col(f"image.{time_col}")).alias("window_start"), F.col("image.product_id")).distinct())


def apply_minute_deltas(minutes: DataFrame, deltas: DataFrame, *, stamp: Column | None = None) -> DataFrame:
    """Counted minute gold (``gold.minute_revenue(..., counted=True)``) after the deltas.

    One keyed aggregation over ``minutes UNION deltas``; windows left without sales are gone.
    With a ``created_at`` column the first stamp stays and new windows get ``stamp``."""
    stamped = "created_at" in minutes.columns
    audit = [F.col("created_at")] if stamped else []
    none = [F.lit(None).cast("timestamp_ntz").alias("created_at")] if stamped else []
    both = minutes.select("window_start", "product_id", F.col("total_revenue").cast(TOTAL_SQL).alias("revenue"), "n_orders", *audit).unionByName(
        deltas.select("window_start", "product_id", F.col("d_revenue").alias("revenue"), F.col("d_orders").alias("n_orders"), *none))
    sums = [F.sum("revenue").alias("revenue"), F.sum("n_orders").alias("n_orders")]
    after = both.groupBy("window_start", "product_id").agg(*sums, *([F.min("created_at").alias("created_at")] if stamped else []))
    return after.filter(F.col("n_orders") > 0).select(
        "window_start", (F.col("window_start") + F.expr("INTERVAL 1 MINUTE")).alias("window_end"), "product_id",
        money("revenue").alias("total_revenue"), "n_orders",
        *([F.coalesce(F.col("created_at"), stamp).alias("created_at")] if stamped else []))
