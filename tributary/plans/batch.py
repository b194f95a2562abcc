"""Batch layer jobs: landing ingest (X1), medallion batch (X2), report (X5), chain (X6).

Every job raises on failure (a scheduler must see it) and can be re-run with
the same ``run_id``: each attempt writes to a folder of its own, and a re-run
finds the keys that the first one committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.payload import pack, parse_columns
from tributary.functions.quality import SOURCE_BATCH
from tributary.operators.dlq import dlq_rows
from tributary.plans.daily import refresh_daily
from tributary.operators.merge import first_per_key, insert_if_absent
from tributary.operators.quality import route_quality
from tributary.plans.store import LANDING_TAG, Store
from tributary.schemas import EVENT_COLUMNS, SILVER_COLUMNS
from tributary.sources.readers import read_catalog_csv, read_landing_csv


# Largest run (rows) whose keys are broadcast for the membership tests.
BROADCAST_RUN_ROWS = 2_000_000


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def landing_payloads(landing: DataFrame) -> DataFrame:
    """Landing rows -> payload text in the event shape (``timestamp`` renamed)."""
    events = landing.withColumnRenamed("timestamp", "order_date")
    return events.select(pack(EVENT_COLUMNS).alias("payload"))


def ingest_landing(spark: SparkSession, store: Store, csv_path: str, load_id: str) -> int:
    """Landing CSV -> Bronze rows tagged ``landing:<load_id>``; returns rows written.

    Row ids are positions in the load, fixed by the write.  Re-running the same ``load_id``
    commits the same keys again, merged on read: a corrected file with the rows in their
    places supersedes them, whether Bronze is read by increment, in full or compacted.
    """
    payloads = landing_payloads(read_landing_csv(spark, csv_path))
    rows = payloads.select(
        F.lit(f"landing:{load_id}").alias("source"),
        F.monotonically_increasing_id().alias("bronze_id"),
        "payload",
        _now().alias("ingested_at"),
    )
    return store.bronze.append(rows, tag=f"{LANDING_TAG}{load_id}")


def parse_bronze(bronze: DataFrame) -> DataFrame:
    """Bronze rows -> source, bronze_id, five typed fields (dates still text)."""
    return parse_columns(bronze, ["source", "bronze_id"])


def run_batch(spark: SparkSession, store: Store, run_id: str, *,
              stamp: Column | None = None, incremental: bool = True,
              dlq_mode: str = "dedup") -> DataFrame:
    """Bronze -> Silver (insert-if-absent) + DLQ -> daily gold (atomic publish).

    ``incremental`` reads only Bronze increments that no successful run has
    taken in (the original re-read all of Bronze every run; pass
    ``incremental=False`` for that).  Existing Silver/DLQ keys are checked
    against the raw committed keys, so no merge shuffle is needed for the
    membership test.  ``dlq_mode="append_all"`` reproduces the original's
    DLQ behaviour (every error is appended again on every run, as a new
    record); the default inserts each error once.  Returns a one-row report.  No new Bronze leaves every
    table as it is; an empty aggregate does not replace the published gold.
    """
    stamp = stamp if stamp is not None else _now()
    state = _batch_state(store) if incremental else None
    bronze, bronze_seen = store.bronze.state_since(state["bronze_seen"] if state else [])
    if bronze is None:
        return _report(spark, 0, 0, 0, None, 0, 0)
    routed = route_quality(parse_bronze(bronze), SOURCE_BATCH).persist()
    try:
        counts = routed.agg(F.count(F.lit(1)).alias("bronze_rows")).first()
        bronze_rows = counts["bronze_rows"]
        if bronze_rows == 0:
            return _report(spark, 0, 0, 0, None, 0, 0)
        clean = routed.filter(F.col("error_reason").isNull())
        errors = routed.filter(F.col("error_reason").isNotNull())

        # A run's rows are usually few next to the tables: then their keys are
        # broadcast and the tables' keys filtered map-side (no table shuffle).
        small = bronze_rows <= BROADCAST_RUN_ROWS
        silver_keys = store.silver.keys()
        candidates = clean.select(*SILVER_COLUMNS, "source", "bronze_id")
        if silver_keys is None:
            new = first_per_key(candidates, ["order_id"], ["source", "bronze_id"])
        else:
            new = insert_if_absent(silver_keys, candidates, ["order_id"], ["source", "bronze_id"],
                                   broadcast_batch_keys=small)
        if dlq_mode not in ("dedup", "append_all"):
            raise ValueError(f"unknown dlq_mode {dlq_mode!r}")
        fresh = dlq_rows(errors, created_at=stamp)
        dlq_keys = store.dlq.keys()
        if dlq_mode == "append_all":
            # Parity mode: the record key carries the run, so each run adds copies.
            fresh = fresh.withColumn("source", F.concat_ws("@", "source", F.lit(run_id)))
            dlq_keys = None
        if dlq_keys is not None:
            # Insert-if-absent on (source, id): a re-run never resets a status.
            if small:
                dlq_keys = dlq_keys.join(F.broadcast(fresh.select("source", "id")),
                                         ["source", "id"], "left_semi")
            fresh = fresh.join(dlq_keys, ["source", "id"], "left_anti")
        # Silver and DLQ rows of this run become visible together.
        with store.transaction() as tx:
            new_rows = store.silver.append(
                new.select(*SILVER_COLUMNS).withColumn("processed_at", stamp),
                tag=f"batch-{run_id}", tx=tx, unique=True)
            # One error per Bronze key at most.
            dlq_rows_written = store.dlq.append(fresh, tag=f"batch-{run_id}", tx=tx,
                                                unique=dlq_mode == "dedup")

        # NULL-date rows never reach the daily table; report how many
        # (NULL date, product) groups Silver holds.  Only keys that ever had a
        # NULL date are merged for this.
        null_rows = store.silver.read_touching(F.col("order_date").isNull())
        dropped = null_rows.filter(F.col("order_date").isNull()).select("product_id").distinct() \
            .agg(F.count(F.lit(1)).alias("n")).first()
        # What daily gold has taken in: listed before it reads, so that a commit in
        # between is taken in again by the next run, never passed over.
        silver_seen = store.silver.live()
        # The daily publish and the job's progress marker commit together.
        with store.transaction() as tx:
            version = refresh_daily(spark, store, f"batch-{run_id}",
                                    seen=state["silver_seen"] if state else None, tx=tx)
            store.batch_state.publish(
                spark.createDataFrame([(bronze_seen, silver_seen, run_id)],
                                      "bronze_seen array<string>, silver_seen array<string>, run_id string"),
                tag=f"batch-{run_id}", tx=tx)
        gold_rows = store.daily.read(version).count() if version else 0
        return _report(spark, bronze_rows, new_rows, dlq_rows_written, version, gold_rows,
                       dropped["n"] or 0)
    finally:
        routed.unpersist()


def _batch_state(store: Store):
    if store.batch_state.version() is None:
        return None
    return store.batch_state.read().first()


def _report(spark, bronze_rows, new_rows, dlq_rows_written, version, gold_rows, null_date_groups):
    return spark.createDataFrame(
        [(int(bronze_rows), int(new_rows), int(dlq_rows_written), version, int(gold_rows),
          int(null_date_groups))],
        "bronze_rows long, silver_new_rows long, dlq_new_rows long, gold_version long, "
        "gold_rows long, null_date_groups long")


def run_chain(spark: SparkSession, store: Store, csv_path: str, run_id: str, *,
              catalog_csv: str | None = None) -> DataFrame:
    """Catalog (created once) -> landing -> Bronze -> batch medallion, in that order."""
    if catalog_csv:
        store.catalog.create_once(read_catalog_csv(spark, catalog_csv))
    ingest_landing(spark, store, csv_path, load_id=run_id)
    return run_batch(spark, store, run_id)
