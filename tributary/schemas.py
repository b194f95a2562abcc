"""Fixed schemas of the medallion tables.

Money is DECIMAL(12,2) everywhere; event time is TIMESTAMP without zone
(``timestamp_ntz``) so results do not depend on the session time zone.
"""

from pyspark.sql.types import (
    DecimalType, StringType, StructField, StructType,
)

MONEY = DecimalType(12, 2)
MONEY_SQL = "decimal(12,2)"
# Totals over whole tables can exceed 10 integer digits.
TOTAL_SQL = "decimal(38,2)"

# Typed event as carried in the JSON payload (dates still text).
EVENT_SCHEMA = StructType([
    StructField("order_id", StringType(), True),
    StructField("customer_id", StringType(), True),
    StructField("product_id", StringType(), True),
    StructField("amount", MONEY, True),
    StructField("order_date", StringType(), True),
])
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# Landing CSV: this column order, header required, matched by name.
LANDING_SCHEMA = StructType([
    StructField("order_id", StringType(), True),
    StructField("product_id", StringType(), True),
    StructField("customer_id", StringType(), True),
    StructField("amount", MONEY, True),
    StructField("timestamp", StringType(), True),
])

CATALOG_SCHEMA = StructType([
    StructField("product_id", StringType(), True),
    StructField("product_name", StringType(), True),
    StructField("category", StringType(), True),
])

SILVER_KEY = ["order_id"]
SILVER_COLUMNS = ["order_id", "customer_id", "product_id", "amount", "order_date"]
MINUTE_KEY = ["window_start", "product_id"]
MINUTE_COLUMNS = ["window_start", "window_end", "product_id", "total_revenue"]
DAILY_KEY = ["report_date", "product_id"]
DAILY_COLUMNS = ["report_date", "product_id", "total_revenue"]
DLQ_COLUMNS = ["id", "order_id", "customer_id", "product_id", "amount", "order_date",
               "error_reason", "source_type", "status", "created_at"]

# Declared limits of the original tables (VARCHAR lengths, NOT NULL columns).
VARCHAR_LIMITS = {
    "silver": {"order_id": 255, "customer_id": 255, "product_id": 255},
    "minute": {"product_id": 255},
    "daily": {"product_id": 255},
    "dlq": {"order_id": 255, "customer_id": 255, "product_id": 255,
            "error_reason": 255, "source_type": 50, "status": 20},
}
NOT_NULL = {
    "silver": ["order_id"],
    "minute": ["window_start", "window_end", "product_id", "total_revenue"],
    "daily": ["report_date", "product_id", "total_revenue"],
    "dlq": ["id"],
}
MONEY_COLUMNS = {"silver": ["amount"], "minute": ["total_revenue"], "daily": ["total_revenue"], "dlq": ["amount"]}
KEYS = {"silver": SILVER_KEY, "minute": MINUTE_KEY, "daily": DAILY_KEY, "dlq": ["id"]}
