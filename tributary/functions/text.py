"""Text of the high-value alert digest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the digest format.
UNKNOWN_PRODUCT = "Unknown Product"
DIGEST_LIMIT = 15
DIGEST_HEADER = "[SYSTEM ALERT - HIGH VALUE TRANSACTIONS]"
DIGEST_RULE = "----------------------------------------"


def product_label(name: str | Column = "product_name") -> Column:
    """Catalog name, or the unknown label for NULL and empty names."""
    c = F.col(name) if isinstance(name, str) else name
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(UNKNOWN_PRODUCT))


def money_text(amount: str | Column = "amount") -> Column:
    """``1234.5`` -> ``1,234.50`` (grouped thousands, two decimals)."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.format_number(c, 2)


def alert_line() -> Column:
    """One digest line: ``Order: <id> | Product: <name> | Amount: $<money>``."""
    return F.concat(
        F.lit("Order: "), F.coalesce(F.col("order_id"), F.lit("")),
        F.lit(" | Product: "), product_label(),
        F.lit(" | Amount: $"), money_text(),
    )


def overflow_line(n_more: Column) -> Column:
    return F.when(
        n_more > 0,
        F.concat(F.lit("... and "), n_more.cast("string"),
                 F.lit(" more high-value orders in this batch.")),
    )


def local_time_text(ts: Column, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """Wall-clock text of a UTC instant in the alert's zone."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss")
