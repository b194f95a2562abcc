"""Sales views derived by Spark from the given tables.

View A (minute grain, stream, quality) comes from ``events``; every row is
kept and a deterministic residue of ``event_id`` injects one dirty kind per
residue, so the view exercises every quality rule at any scale.
View B (natural duplicate keys, high values) comes from ``lineitem`` joined to
``orders``.  The catalog comes from ``part``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.payload import pack
from tributary.schemas import MONEY_SQL

# Residue of event_id % 50 -> dirty kind of view A.
DIRTY_KINDS = {
    0: "customer NULL",
    1: "amount -99.99",
    2: "order empty",
    3: "amount NULL",
    4: "order NULL",
    5: "product blank",
    6: "product padded",
    7: "date unparseable",
    8: "payload truncated",
    9: "amount zero",
    10: "amount -5, product NULL",
    11: "customer empty",
    16: "date with offset",
}
DIRTY_MODULUS = 50


def _kind(event_id: Column) -> Column:
    return F.pmod(event_id, F.lit(DIRTY_MODULUS))


def sales_view_a(events: DataFrame) -> DataFrame:
    """events -> bronze_id, order_id, customer_id, product_id, amount, order_date (text), kind."""
    m = _kind(F.col("event_id"))
    k = F.get_json_object(F.col("props"), "$.k")
    order_id = (F.when(m == 2, F.lit("")).when(m == 4, F.lit(None).cast("string"))
                .otherwise(F.concat(F.lit("E"), F.col("event_id").cast("string"))))
    customer_id = (F.when(m == 0, F.lit(None).cast("string")).when(m == 11, F.lit(""))
                   .otherwise(F.col("user_id").cast("string")))
    product_id = (F.when(m == 5, F.lit("  "))
                  .when(m == 6, F.concat(F.lit("  "), k, F.lit("  ")))
                  .when(m == 10, F.lit(None).cast("string"))
                  .otherwise(k))
    amount = (F.when(m == 1, F.lit(-99.99).cast(MONEY_SQL))
              .when(m == 3, F.lit(None).cast(MONEY_SQL))
              .when(m == 9, F.lit(0).cast(MONEY_SQL))
              .when(m == 10, F.lit(-5).cast(MONEY_SQL))
              .otherwise(F.col("value").try_cast(MONEY_SQL)))
    # Zone-free text: a timestamp_ntz cast to string is its wall clock
    # ('yyyy-MM-dd HH:mm:ss[.ffffff]').
    shown = F.col("ts").cast("timestamp_ntz").cast("string")
    order_date = (F.when(m == 7, F.lit("not a date")).when(m == 16, F.concat(shown, F.lit("+07:00")))
                  .otherwise(shown))
    return events.select(
        F.col("event_id").alias("bronze_id"),
        order_id.alias("order_id"),
        customer_id.alias("customer_id"),
        product_id.alias("product_id"),
        amount.alias("amount"),
        order_date.alias("order_date"),
        m.alias("kind"),
    )


def bronze_view_a(events: DataFrame, *, keep_kind: bool = False) -> DataFrame:
    """View A as Bronze rows: bronze_id, payload (JSON text; kind 8 truncated)."""
    view = sales_view_a(events)
    full = pack()
    # A 20-character prefix of a record is never a complete JSON object.
    payload = F.when(F.col("kind") == 8, F.substring(full, 1, 20)).otherwise(full)
    return view.select("bronze_id", payload.alias("payload"), *(["kind"] if keep_kind else []))


def sales_view_b(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """lineitem x orders -> typed sales rows with natural duplicate order ids.

    Keeps every lineitem row (inner join on the order key; each lineitem has
    its order).  ``order_date`` is a ``timestamp_ntz``.
    """
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(od, "l_orderkey", "inner")
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").try_cast(MONEY_SQL).alias("amount"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("order_date"),
        "l_suppkey", "l_quantity", "l_discount", "l_tax",
    )


# Total order of view B versions: later date, then the remaining values.
VIEW_B_ORDER = ["order_date", "amount", "product_id", "customer_id",
                "l_suppkey", "l_quantity", "l_discount", "l_tax"]


def catalog_from_part(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


LANDING_COLUMNS = ["order_id", "product_id", "customer_id", "amount", "timestamp"]


def write_landing_csv(view_a: DataFrame, path: str) -> None:
    """Write view A as landing CSV files (header, landing column order).

    Whitespace is written as is, so padded and blank product ids survive the
    round trip; empty strings and NULLs both read back as NULL.
    """
    (view_a.select("order_id", "product_id", "customer_id", "amount",
                   F.col("order_date").alias("timestamp"))
     .write.mode("overwrite")
     .option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
