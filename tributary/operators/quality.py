"""Quality routing (F-1..F-3, P4, P5): one predicate, two disjoint outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.quality import (
    INVALID_DATE, error_reason, event_time, money, normalized_product,
)


def route_quality(parsed: DataFrame, source_type: str, *, reason_policy: str = "code",
                  date_col: str = "order_date", reject_null_date: bool = False,
                  max_future: str | None = None, now: Column | None = None) -> DataFrame:
    """Tag every parsed row: ``error_reason`` is NULL for clean rows.

    The predicate runs on the raw amount and the cast follows it (as in the
    original: a double 0.004 is clean and becomes 0.00).  Other columns pass
    through, so Bronze ids and source positions survive routing.

    Optional date rules, both off by default (original behaviour): with
    ``reject_null_date`` a missing/unparseable time is an error (it would
    otherwise form a NULL-date daily group); with ``max_future`` (an interval
    such as ``"1 day"``) a time beyond ``now + max_future`` is an error, so a
    bogus future event cannot drag the stream watermark forward.  The other
    rules keep precedence.
    """
    dtype = parsed.schema[date_col].dataType
    normalized = (parsed.withColumn("product_id", normalized_product("product_id"))
                  .withColumn(date_col, event_time(date_col, dtype)))
    reason = error_reason(reason_policy)
    t = F.col(date_col)
    if reject_null_date:
        reason = F.coalesce(reason, F.when(t.isNull(), F.lit(INVALID_DATE)))
    if max_future:
        now = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
        reason = F.coalesce(reason, F.when(t > now + F.expr(f"INTERVAL {max_future}"), F.lit(INVALID_DATE)))
    return (
        normalized
        .withColumn("error_reason", reason)
        .withColumn("source_type", F.lit(source_type))
        .withColumn("amount", money("amount"))
    )


def split_quality(parsed: DataFrame, source_type: str, *, reason_policy: str = "code"
                  ) -> tuple[DataFrame, DataFrame]:
    """``(clean, error)``: disjoint, and together exactly the input rows.

    ``clean`` drops the routing columns; ``error`` keeps ``error_reason`` and
    ``source_type``.  Persist the input first when both sides are consumed.
    """
    routed = route_quality(parsed, source_type, reason_policy=reason_policy)
    clean = routed.filter(F.col("error_reason").isNull()).drop("error_reason", "source_type")
    error = routed.filter(F.col("error_reason").isNotNull())
    return clean, error
