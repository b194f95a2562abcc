"""Column expressions of the quality rules (all JVM-side, codegen'd).

One ordered rule list gives both the routing and the label: a row with a label is an
error, a row without one is clean, so the two partition the input exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tributary.schemas import MONEY_SQL

# Error reasons and source tags must equal the original labels.
MISSING_CUSTOMER = "Missing Customer ID"
INVALID_AMOUNT = "Invalid Amount"
MISSING_ORDER = "Missing Order ID"
MISSING_PRODUCT = "Missing Product ID"
SCHEMA_MISMATCH = "Schema Mismatch Exception"
# Optional rule (off by default): an event time that is missing, unparseable
# or too far in the future.
INVALID_DATE = "Invalid Order Date"
SOURCE_STREAMING = "Streaming"
SOURCE_BATCH = "Batch"
STATUS_UNPROCESSED = "unprocessed"
STATUS_PROCESSED = "processed"


def normalized_product(col: str | Column = "product_id") -> Column:
    """Product keys are compared after trimming spaces (not tabs)."""
    return F.trim(F.col(col) if isinstance(col, str) else col)


def quality_rules(policy: str = "code") -> list[tuple[str, Column]]:
    """Ordered (error label, failing test) pairs over a parsed row with a trimmed product key.

    ``code``: the behaviour of the original job (a NULL amount or order id has no label of
    its own and falls through to the schema-mismatch label, which comes last).
    ``documented``: the labels its documentation promises for those two cases.
    """
    absent = {c: F.col(c).isNull() for c in ("order_id", "customer_id", "product_id", "amount")}
    not_positive = F.col("amount") <= 0
    empty = {c: F.col(c) == "" for c in ("order_id", "product_id")}
    without_product = absent["product_id"] | empty["product_id"]
    if policy == "code":
        return [(MISSING_CUSTOMER, absent["customer_id"]), (INVALID_AMOUNT, not_positive),
                (MISSING_ORDER, empty["order_id"]), (MISSING_PRODUCT, without_product),
                (SCHEMA_MISMATCH, absent["amount"] | absent["order_id"])]
    if policy == "documented":
        return [(MISSING_CUSTOMER, absent["customer_id"]), (INVALID_AMOUNT, absent["amount"] | not_positive),
                (MISSING_ORDER, absent["order_id"] | empty["order_id"]), (MISSING_PRODUCT, without_product)]
    raise ValueError(f"unknown reason policy {policy!r}")


def error_reason(policy: str = "code") -> Column:
    """The label of the first rule a row fails; NULL for a clean row.  A test that is NULL
    does not fail its row (the NULL itself is a rule of its own)."""
    return F.coalesce(*(F.when(failed, F.lit(label)) for label, failed in quality_rules(policy)))


def money(col: str | Column) -> Column:
    """DECIMAL(12,2) cast that yields NULL on overflow or NaN, ANSI on or off."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(MONEY_SQL)


#: Fixed value: what a time's text holds from its hour on if it names a zone or an offset.
ZONE_MARK = "[A-Za-z+-]"


def event_time(col: str | Column, dtype=None) -> Column:
    """Event time as ``timestamp_ntz``; unparseable text becomes NULL.

    Text without a zone is parsed as the wall clock it shows, text with one (``+07:00``, ``Z``,
    a region) as the UTC wall clock of that instant, so neither depends on the session time
    zone.  Zoned timestamp columns keep their wall clock in the session zone.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        return c.cast("timestamp_ntz")
    shown = c.cast("string")
    since = F.unix_micros(shown.try_cast("timestamp"))
    instant = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(since / F.expr("1000000BD")).cast("decimal(18,6)"))
    return F.when(F.substring(shown, 12, 64).rlike(ZONE_MARK), instant).otherwise(shown.try_cast("timestamp_ntz"))


def recoverable(reasons: tuple[str, ...] = (INVALID_AMOUNT,)) -> Column:
    """DLQ rows a replay may fix: unprocessed, recoverable reason, usable key."""
    o = F.col("order_id")
    return (
        (F.col("status") == STATUS_UNPROCESSED)
        & F.col("error_reason").isin(*reasons)
        & o.isNotNull() & (o != "")
    )
