"""Speed layer minute gold (T1, T2, T3, K4): watermark + tumbling windows.

The stateful query is separate from the router; its output is written to
the keyed minute table, so ``update`` mode (rows re-emitted as windows grow)
converges by key, and ``append`` mode writes each window once, after the
watermark passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.payload import parse_columns
from tributary.functions.quality import SOURCE_STREAMING
from tributary.operators.gold import minute_revenue
from tributary.operators.quality import route_quality
from tributary.plans.store import Store
from tributary.streaming.router import stream_tag

WATERMARK = "5 minutes"


def clean_stream(payloads: DataFrame) -> DataFrame:
    routed = route_quality(parse_columns(payloads, ["source", "bronze_id"]), SOURCE_STREAMING)
    return routed.filter(F.col("error_reason").isNull())


def minute_stream(clean: DataFrame, *, watermark: str = WATERMARK) -> DataFrame:
    """Windowed revenue of a clean event stream.

    Watermarks need a zoned timestamp: the wall-clock ``order_date`` is cast
    to TIMESTAMP in the session zone (UTC in our sessions) and the window
    bounds are cast back, so the output wall clock equals the input's.
    """
    ev = clean.withColumn("event_ts", F.col("order_date").cast("timestamp"))
    return minute_revenue(ev.withWatermark("event_ts", watermark), time_col="event_ts")


def start_minute_query(minutes: DataFrame, store: Store, checkpoint: str, run_tag: str, *,
                       output_mode: str = "append", available_now: bool = False,
                       processing_time: str = "10 seconds", query_name: str | None = None):
    prefix = stream_tag(run_tag, checkpoint)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        # the batch runs once: a test for rows before it would run its state a second time
        store.minute.append(
            batch_df.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz")),
            tag=f"{prefix}-{batch_id}", skip_empty=True)

    writer = (minutes.writeStream.outputMode(output_mode).foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()


def dropped_by_watermark(query) -> int:
    """Rows the stateful operator dropped as late, over the query's recent
    progress reports (``numRowsDroppedByWatermark``)."""
    total = 0
    for progress in query.recentProgress:
        for op in progress.get("stateOperators", []) if isinstance(progress, dict) else \
                progress.stateOperators:
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else \
                op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total
