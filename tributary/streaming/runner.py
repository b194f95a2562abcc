"""Start the whole speed layer: router + minute gold over one payload source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.plans.store import Store
from tributary.streaming.gold import clean_stream, minute_stream, start_minute_query
from tributary.streaming.router import start_router


def start_speed_layer(spark: SparkSession, payloads: DataFrame, store: Store, checkpoint_root: str,
                      *, catalog: DataFrame | None = None, run_tag: str = "speed",
                      gold_mode: str = "append", processing_time: str = "10 seconds",
                      available_now: bool = False, names: tuple[str, str] = (None, None)):
    """Two queries: the stateless router (Bronze/Silver/DLQ/alerts) and the
    stateful minute gold.  Each has its own checkpoint; they may be at
    different offsets after a restart (each sink converges by key)."""
    router = start_router(payloads, store, f"{checkpoint_root}/router", run_tag, catalog=catalog,
                          available_now=available_now, processing_time=processing_time, query_name=names[0])
    gold = start_minute_query(minute_stream(clean_stream(payloads)), store,
                              f"{checkpoint_root}/gold_minute", f"{run_tag}-gold",
                              output_mode=gold_mode, available_now=available_now,
                              processing_time=processing_time, query_name=names[1])
    return router, gold


def run_to_the_end(queries) -> None:
    """Wait for queries that end by themselves (``available_now``).  If one fails the others
    are stopped and its error is raised."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
