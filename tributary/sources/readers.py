"""Sources: payload streams, landing CSV, catalog CSV, tables (parquet | jdbc)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.payload import decode_value
from tributary.functions.quality import normalized_product
from tributary.schemas import CATALOG_SCHEMA, LANDING_SCHEMA


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables (column pruning / pushdown by Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- message streams: every source gives (source, bronze_id, value BINARY) ------------------
def kafka_values(messages: DataFrame) -> DataFrame:
    """Kafka rows in the contract of all message sources.

    The topic and partition are the source, the offset is the Bronze id: a replay from a new
    checkpoint has the same ids, and Bronze keeps one row of each."""
    return messages.select(F.concat_ws(":", "topic", F.col("partition").cast("string")).alias("source"),
                           F.col("offset").cast("long").alias("bronze_id"), F.col("value").cast("binary").alias("value"))


def kafka_value_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                       max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Messages of a Kafka topic.  Needs the spark-sql-kafka package on the classpath (not
    bundled here)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return kafka_values(reader.load())


VALUE_SCHEMA = "source string, bronze_id long, value binary"


def file_value_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None,
                      glob: str | None = None) -> DataFrame:
    """Messages in Parquet files of ``VALUE_SCHEMA``: the same contract without a broker."""
    reader = spark.readStream.format("parquet").schema(VALUE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def payload_stream(values: DataFrame) -> DataFrame:
    """Messages as the router and minute gold take them: (source, bronze_id, payload)."""
    return values.select("source", "bronze_id", decode_value("value").alias("payload"))


def read_landing_csv(spark: SparkSession, path: str) -> DataFrame:
    """Landing CSV with an explicit schema whose header must match by name.

    ``enforceSchema=false`` makes a reordered or renamed header raise instead
    of silently binding columns by position.
    """
    return (
        spark.read.format("csv")
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("mode", "PERMISSIVE")
        .schema(LANDING_SCHEMA)
        .load(path)
    )


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Product catalog CSV; the key is trimmed like the event key."""
    return (
        spark.read.format("csv").option("header", "true").schema(CATALOG_SCHEMA)
        .load(path)
        .withColumn("product_id", normalized_product("product_id"))
    )


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """JDBC table scan, optionally split on a numeric column (e.g. the id)."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict,
               mode: str = "append") -> None:
    """JDBC write; ``overwrite`` truncates instead of dropping the table."""
    writer = df.write
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.jdbc(url, table, mode=mode, properties=properties)
