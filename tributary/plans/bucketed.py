"""Keyed tables in hash buckets: an upsert rewrites the buckets of its change set alone.

A table is a Parquet table partitioned by ``bucket`` (Spark's own hash of the key) and bucketed
by the key into as many buckets, so each partition folder holds one bucket.  A merge

* reads only the folders of the buckets that the changes fall in (partition pruning);
* joins them with the changes by a shuffled hash join built on the changes: the table side is
  scanned in its buckets, with no exchange, sort or aggregation; only the changes move;
* overwrites those folders (dynamic partition overwrite); all other files stay as they are.

A key that holds a third of the changes is folded before the shuffle (one latest row a key).
One writer at a time; a reader that lists files while folders are swapped may have to retry,
and a merge that dies between its swaps is simply run again: it converges by key.  Where Delta
or Iceberg is present, ``MERGE INTO`` takes this place; the operators do not change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.merge import latest_per_key

BUCKET = "bucket"


class BucketedTable:
    """One row per key, of the columns of ``schema`` (a DDL string)."""

    def __init__(self, spark: SparkSession, name: str, path: str, schema: str, key: Sequence[str], buckets: int):
        self.spark, self.name, self.path, self.key, self.buckets = spark, name, path, list(key), buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                  f"CLUSTERED BY ({', '.join(key)}) INTO {buckets} BUCKETS LOCATION '{path}'")
        self.columns = [c for c in spark.table(name).columns if c != BUCKET]

    def attach(self) -> "BucketedTable":
        """Declare the buckets that a folder written by another session already holds."""
        self.spark.catalog.recoverPartitions(self.name)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns)

    def bucket_of(self) -> Column:
        """The bucket that Spark itself puts a row in."""
        return F.pmod(F.hash(*self.key), F.lit(self.buckets)).cast("int")

    def load(self, rows: DataFrame) -> None:
        """The first content: one row per key, dealt to its buckets once."""
        self._overwrite(rows.select(*self.columns, self.bucket_of().alias(BUCKET)).repartition(self.buckets, *self.key))

    def _overwrite(self, rows: DataFrame) -> None:
        # A task holds whole buckets and few of them: their files are written side by side, unsorted.
        wanted = {"spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.maxConcurrentOutputFileWriters": "16"}
        conf = self.spark.conf
        before = {name: conf.get(name) for name in wanted}
        try:
            for name, value in wanted.items():
                conf.set(name, value)
            rows.select(*self.columns, BUCKET).write.mode("overwrite").insertInto(self.name)
        finally:
            for name, value in before.items():
                conf.set(name, value)
        self.spark.catalog.refreshTable(self.name)

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets of the changes: at most ``buckets`` numbers."""
        return sorted(r[0] for r in changes.select(self.bucket_of()).distinct().collect())

    def merged(self, changes: DataFrame, order: Sequence[str], touched: Sequence[int], *,
               audit_col: str | None = None, stamp: Column | None = None) -> DataFrame:
        """The touched buckets after the changes: the latest change of a key replaces its row.

        ``audit_col`` keeps the first insert's value; a new key gets ``stamp``."""
        values = [c for c in self.columns if c not in self.key and c != audit_col]
        carried = list(dict.fromkeys([*values, *(o for o in order if o not in self.key)]))
        latest = latest_per_key(changes.select(*self.key, *carried), self.key, order)
        new = latest.select(*self.key, F.struct(*values).alias("_new")).repartition(self.buckets, *self.key)
        audit = [F.col(audit_col).alias("_audit")] if audit_col else []
        old = (self.spark.table(self.name).filter(F.col(BUCKET).isin(*touched))
               .select(*self.key, F.struct(*values).alias("_old"), *audit))
        both = old.join(new.hint("shuffle_hash"), self.key, "full")
        out = {c: F.coalesce(F.col("_new"), F.col("_old"))[c] for c in values}
        if audit_col:
            out[audit_col] = F.coalesce(F.col("_audit"), stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz"))
        return both.select(*[(F.col(c) if c in self.key else out[c]).alias(c) for c in self.columns],
                           self.bucket_of().alias(BUCKET))

    def upsert(self, changes: DataFrame, order: Sequence[str], *, audit_col: str | None = None,
               stamp: Column | None = None) -> list[int]:
        """Merge the changes in; returns the buckets rewritten (none for no changes)."""
        touched = self.touched(changes)
        if touched:
            self._overwrite(self.merged(changes, order, touched, audit_col=audit_col, stamp=stamp))
        return touched
