"""The medallion tables of one deployment, under one shared root folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tributary.functions.quality import STATUS_PROCESSED
from tributary.operators.dlq import live_minutes
from tributary.plans.tables import CommitLog, KeyedTable, SnapshotTable, Transaction
from tributary.schemas import (
    DAILY_KEY, DLQ_COLUMNS, MINUTE_COLUMNS, MINUTE_KEY, MONEY_COLUMNS, NOT_NULL, SILVER_COLUMNS,
    SILVER_KEY, VARCHAR_LIMITS,
)

#: Orders that the Bloom filter of a queue file is sized for.
DLQ_ORDERS_A_FILE = 1_000_000
#: Tags of landing loads; their row ids are positions, drawn by the write itself.
LANDING_TAG = "landing-"
BRONZE_COLUMNS = ["source", "bronze_id", "payload", "ingested_at"]
SILVER_TABLE_COLUMNS = [*SILVER_COLUMNS, "processed_at"]
MINUTE_TABLE_COLUMNS = [*MINUTE_COLUMNS, "created_at"]
DLQ_TABLE_COLUMNS = ["source", *DLQ_COLUMNS]
ALERT_COLUMNS = ["batch", "n_orders", "n_listed", "n_more", "lines", "message", "local_time"]

SILVER_SCHEMA = ("order_id string, customer_id string, product_id string, amount decimal(12,2), "
                 "order_date timestamp_ntz, processed_at timestamp_ntz")
DLQ_SCHEMA = ("source string, id long, order_id string, customer_id string, product_id string, "
              "amount decimal(12,2), order_date timestamp_ntz, error_reason string, "
              "source_type string, status string, created_at timestamp_ntz")
MINUTE_SCHEMA = ("window_start timestamp_ntz, window_end timestamp_ntz, product_id string, "
                 "total_revenue decimal(12,2), created_at timestamp_ntz")
BRONZE_SCHEMA = "source string, bronze_id long, payload string, ingested_at timestamp_ntz"


@dataclass
class Store:
    spark: SparkSession
    root: str

    def __post_init__(self):
        r = self.root.rstrip("/")
        s = self.spark
        # One commit log for every table: a transaction makes the increments of
        # several tables visible together.
        self.log = CommitLog(s, f"{r}/commits")
        log = self.log
        # Bronze: a replay of a source position is the same message again; a corrected load of
        # the same id supersedes the first (in every way of reading Bronze).
        self.bronze = KeyedTable(s, f"{r}/bronze", ["source", "bronze_id"], BRONZE_COLUMNS,
                                 policies={"ingested_at": "min"},
                                 name="bronze", log=log, unique_tags=LANDING_TAG)
        # Silver: last write wins on values, the first insert keeps its stamp.
        self.silver = KeyedTable(s, f"{r}/silver", SILVER_KEY, SILVER_TABLE_COLUMNS,
                                 policies={"processed_at": "min"}, name="silver", log=log,
                                 not_null=NOT_NULL["silver"], varchar=VARCHAR_LIMITS["silver"],
                                 money=MONEY_COLUMNS["silver"])
        self.minute = KeyedTable(s, f"{r}/gold_minute", MINUTE_KEY, MINUTE_TABLE_COLUMNS,
                                 policies={"created_at": "min"}, name="gold_minute", log=log,
                                 not_null=NOT_NULL["minute"], varchar=VARCHAR_LIMITS["minute"],
                                 money=MONEY_COLUMNS["minute"])
        # DLQ: a record never changes once written, except its status, which
        # only moves forward ('processed' < 'unprocessed', so min wins).
        self.dlq = KeyedTable(
            s, f"{r}/dlq", ["source", "id"], DLQ_TABLE_COLUMNS,
            policies={**{c: "first" for c in DLQ_TABLE_COLUMNS if c not in ("source", "id")},
                      "status": "min", "created_at": "min"},
            name="dlq", log=log, not_null=NOT_NULL["dlq"], varchar=VARCHAR_LIMITS["dlq"],
            money=MONEY_COLUMNS["dlq"],
            partition_by=["status"], bloom={"error_reason": 64, "order_id": DLQ_ORDERS_A_FILE})
        self.daily = SnapshotTable(s, f"{r}/gold_daily", key=DAILY_KEY,
                                   not_null=NOT_NULL["daily"], varchar=VARCHAR_LIMITS["daily"],
                                   name="gold_daily", log=log)
        self.catalog = SnapshotTable(s, f"{r}/catalog", key=["product_id"], name="catalog", log=log)
        self.alerts = KeyedTable(s, f"{r}/alerts", ["batch"], ALERT_COLUMNS, name="alerts", log=log)
        # Progress of the batch job: the Bronze / Silver commits it has taken in.
        self.batch_state = SnapshotTable(s, f"{r}/batch_state", name="batch_state", log=log)

    def transaction(self) -> Transaction:
        """``with store.transaction() as tx: table.append(df, tag, tx=tx)``"""
        return Transaction(self.log)

    def dlq_lookup(self, status: str, *, reason: str | None = None, order_id: str | None = None):
        """Queue records whose status now is ``status``, by reason or order (K16).

        Only the partition of that status is read for them, and Bloom filters skip its files
        without the reason or order.  Unprocessed records are those that no later version
        closed: of the other partition only the keys are read.  A compacted queue is one scan.
        """
        raw = self.dlq.versions()
        if raw is None:
            return self.dlq_state()
        hit = raw.filter(F.col("status") == status)
        for name, value in (("error_reason", reason), ("order_id", order_id)):
            if value is not None:
                hit = hit.filter(F.col(name) == value)
        if self.dlq.is_one_base():
            return hit.select(*DLQ_TABLE_COLUMNS)
        if status != STATUS_PROCESSED:
            closed = raw.filter(F.col("status") == STATUS_PROCESSED).select(*self.dlq.key).distinct()
            hit = hit.join(closed, self.dlq.key, "left_anti")
        return self.dlq.merge(hit)

    def silver_state(self):
        return self.silver.read_or_empty(SILVER_SCHEMA)

    def dlq_state(self):
        return self.dlq.read_or_empty(DLQ_SCHEMA)

    def minute_state(self):
        return live_minutes(self.minute.read_or_empty(MINUTE_SCHEMA))

    def bronze_state(self):
        return self.bronze.read_or_empty(BRONZE_SCHEMA)
