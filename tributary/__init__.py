"""tributary: a Spark-native medallion / lambda sales analytics engine.

Raw JSON events (stream) and landing CSV files (batch) land in an immutable
Bronze log; a null-safe quality split routes rows to a keyed Silver table or a
dead-letter queue with a status lifecycle; Gold revenue is kept by minute
(Structured Streaming, event-time windows + watermark) and by day (batch
recompute, atomic snapshot publish).  Everything is DataFrame code.
"""

__all__ = ["session", "schemas"]
