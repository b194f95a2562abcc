"""What the minute query holds in its state: windows that are still open (T2, X7).

In append mode a window is emitted, and leaves the state, once the watermark has passed its
end.  The batch reader of the state store gives the others as rows, so speed and batch views
can be compared at any time without waiting for the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.quality import money
from tributary.schemas import MINUTE_COLUMNS


def open_minutes(spark: SparkSession, checkpoint: str, *, batch_id: int | None = None) -> DataFrame:
    """Minute gold of the windows in the state of a minute query, after its last committed
    batch (or ``batch_id``).  One task reads one state partition; the session needs the state
    store provider that the query ran with."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    state = reader.load(checkpoint)
    key = {f.name: F.col(f"key.{f.name}") for f in state.schema["key"].dataType.fields}
    window = next(c for name, c in key.items() if name.startswith("window"))
    total = F.col(f"value.{state.schema['value'].dataType.fields[0].name}")
    return state.select(
        window["start"].cast("timestamp_ntz").alias("window_start"), window["end"].cast("timestamp_ntz").alias("window_end"),
        key["product_id"].alias("product_id"), money(total).alias("total_revenue")).select(*MINUTE_COLUMNS)
