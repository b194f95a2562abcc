"""Payload streams derived from the given tables (bounded, file based)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources.fixtures import bronze_view_a


def events_schema(spark: SparkSession, sf_dir: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema


def events_payload_stream(spark: SparkSession, path: str, schema, *, glob: str | None = None,
                          max_files_per_trigger: int | None = None, source: str = "events"
                          ) -> DataFrame:
    """``events`` parquet files as a stream of Bronze payloads (view A).

    The event id stands in for the source offset.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return events_payloads(reader.parquet(path), source)


def events_payloads(events: DataFrame, source: str = "events") -> DataFrame:
    """``events`` rows, streamed or not, as Bronze payloads (view A)."""
    return bronze_view_a(events).select(F.lit(source).alias("source"), "bronze_id", "payload")
