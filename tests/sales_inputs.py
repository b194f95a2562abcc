"""Schemas and folders the sales tests share."""

from pyspark.sql.types import DecimalType, DoubleType, StringType, StructField, StructType

SF_SMALL = "/root/testdata/sf0.001"


def event_schema(amount_type):
    return StructType([
        StructField("order_id", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("product_id", StringType(), True),
        StructField("amount", amount_type, True),
        StructField("order_date", StringType(), True),
    ])


DOUBLE_EVENTS = event_schema(DoubleType())
DECIMAL_EVENTS = event_schema(DecimalType(12, 2))
