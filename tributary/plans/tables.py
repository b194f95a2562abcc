"""File tables standing in for the original database tables.

No table-format jar (Delta/Iceberg/Hudi) is assumed.  Two shapes:

* :class:`SnapshotTable` -- full-replace table (daily gold, catalog).  Each
  publish writes an immutable ``data/v<n>-<attempt>`` folder; it becomes visible only
  when its commit record is written afterwards, so readers never see a
  half-written table and a failed publish leaves the old version in place
  (the atomic swap).
* :class:`KeyedTable` -- keyed table fed by increments (Silver, minute gold,
  DLQ, Bronze).  Writers write an increment, in a folder of its own each
  attempt, and then commit it.  Readers merge the committed increments per
  key with per-column policies: ``latest`` (highest number wins), ``first``,
  ``min``, ``max``.  ``compact`` folds what is committed into a base whose
  record names the folded folders; anything not named stays live.

Commit records live in a small parquet :class:`CommitLog`, which a whole
:class:`~tributary.plans.store.Store` can share: a :class:`Transaction`
commits the increments of several tables with one record write, so they
become visible together.  Readers only ever see committed data.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tributary.operators.checks import ConstraintViolation, assert_valid, row_rules
from tributary.schemas import MONEY_SQL

COMMIT_SCHEMA = ("table_name string, seq long, kind string, tag string, path string, "
                 "n_rows long, committed_ms long")


def _write_counted(df: DataFrame, path: str, *, not_null: Sequence[str] = (),
                   varchar: Mapping[str, int] | None = None, money: Sequence[str] = (), table: str = "",
                   partition_by: Sequence[str] = (), bloom: Mapping[str, int] | None = None) -> int:
    """Overwrite ``path`` with ``df`` and return the row count.

    The count and the NOT NULL / length / money range violations are observed during the
    The count and the NOT NULL / length / money range violations are observed during the
    write itself (no second pass), the range before the cast to DECIMAL(12,2). a violation the written files are left
    uncommitted (invisible) and :class:`ConstraintViolation` is raised.
    """
    rules = row_rules(not_null, varchar, money)
    labels = [f"{rule}({c})" for rule, c, _ in rules]
    metrics = [F.count(F.lit(1)).alias("n_rows"),
               *[F.count(F.when(broken, 1)).alias(f"v{i}") for i, (_, _, broken) in enumerate(rules)]]
    obs = Observation()
    checked = df.observe(obs, *metrics).withColumns({c: F.col(c).try_cast(MONEY_SQL) for c in money})
    writer = checked.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for c, distinct in (bloom or {}).items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct)))
    writer.parquet(path)
    got = obs.get
    bad = [f"{label}={got[f'v{i}']}" for i, label in enumerate(labels) if got[f"v{i}"]]
    if bad:
        raise ConstraintViolation(f"{table}: {'; '.join(bad)} (increment {path} not committed)")
    return int(got["n_rows"])


class CommitLog:
    """Append-only log of commit records.

    Layout (all written by Spark jobs, never modified):
    ``<path>/h=<hour>/<ms>-<uuid>/`` one folder per commit, bucketed by the
    epoch hour it was written in; ``<path>_checkpoints/<ms>-<uuid>/`` periodic
    checkpoints holding every still-live record (increments folded into a
    base and replaced snapshot versions are pruned) and the last *settled*
    hour they include.  A reader takes the newest checkpoint and only the
    hour folders after its settled hour, so a read costs O(live tables +
    recent commits), not O(history).  An hour is settled once it ended more
    than ``SETTLE_MS`` ago (no commit write takes that long).
    """

    HOUR_MS = 3_600_000
    SETTLE_MS = 3_600_000
    CHECKPOINT_AFTER = 200   # recent commit records that trigger a checkpoint

    CACHE_SECONDS = 5.0      # other processes' commits become visible within this

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ckpt_path = f"{self.path}_checkpoints"
        self._cache: tuple[float, list] | None = None
        self._commits = 0
        self._has_checkpoint = False

    def _read(self, path: str) -> DataFrame | None:
        try:
            return (self.spark.read.schema(COMMIT_SCHEMA)
                    .option("recursiveFileLookup", "true").parquet(path))
        except AnalysisException:
            return None

    def _latest_checkpoint(self) -> tuple[list, int, set, bool]:
        """(live records, settled hour, recent commit folders absorbed, found)."""
        try:
            files = (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                     .option("recursiveFileLookup", "true").load(self.ckpt_path)
                     .select("path").collect())
        except AnalysisException:
            return [], -1, set(), False
        if not files:
            return [], -1, set(), False
        folder = max(r["path"] for r in files).rsplit("/", 1)[0]
        rows = self.spark.read.schema(CHECKPOINT_SCHEMA).parquet(folder).collect()
        settled = rows[0]["settled_hour"] if rows else -1
        absorbed = {r["absorbed"] for r in rows if r["absorbed"] is not None}
        live = [tuple(r[c] for c in COMMIT_COLUMNS) for r in rows if r["table_name"] is not None]
        self._has_checkpoint = True
        return live, settled, absorbed, True

    def _recent(self, settled: int, absorbed: set) -> list[tuple]:
        """(record, commit folder) of commits after the settled hour, minus
        the folders the checkpoint already absorbed."""
        now_hour = int(time.time() * 1000) // self.HOUR_MS
        if settled < 0:
            path = self.path
        else:
            # One glob over the unsettled hours (+1 for writer clock skew);
            # hours without commits are simply not matched.
            hours = ",".join(str(h) for h in range(settled + 1, now_hour + 2))
            path = f"{self.path}/h={{{hours}}}"
        df = self._read(path)
        if df is None:
            return []
        out = []
        rows = df.select(*COMMIT_COLUMNS, F.col("_metadata.file_path").alias("_file")).collect()
        for r in rows:
            folder = r["_file"].rsplit("/", 1)[0]
            if folder not in absorbed:
                out.append((tuple(r[c] for c in COMMIT_COLUMNS), folder))
        return out

    def all_records(self, *, auto_checkpoint: bool = True) -> list:
        """Every live record of every table (checkpoint + recent commits).

        Cached for ``CACHE_SECONDS``; this instance's own commits invalidate it.
        """
        if self._cache is not None and time.monotonic() - self._cache[0] < self.CACHE_SECONDS:
            return self._cache[1]
        before = self._commits
        rows = self._load(auto_checkpoint)
        if before == self._commits:  # else another thread's commit may be missing from them
            self._cache = (time.monotonic(), rows)
        return rows

    def _load(self, auto_checkpoint: bool) -> list:
        live, settled, absorbed, _ = self._latest_checkpoint()
        recent = self._recent(settled, absorbed)
        rows = live + [r for r, _ in recent]
        if auto_checkpoint and len(recent) > self.CHECKPOINT_AFTER:
            self._write_checkpoint(rows, absorbed | {f for _, f in recent})
        return rows

    def records(self, table: str) -> list:
        rows = [dict(zip(COMMIT_COLUMNS, r)) for r in self.all_records() if r[0] == table]
        return sorted(rows, key=lambda r: r["seq"])

    def commit(self, records: list[tuple]) -> None:
        if not records:
            return
        self._cache = None
        if not self._has_checkpoint:
            # An empty first checkpoint, so readers never look for a missing folder.
            if not self._latest_checkpoint()[3]:
                self._write_checkpoint([], set(), settled=-1)
            self._has_checkpoint = True
        ms = int(time.time() * 1000)
        rec = self.spark.createDataFrame([(*r, ms) for r in records], COMMIT_SCHEMA)
        # Each commit gets its own folder: concurrent writers (e.g. the router
        # and the gold query) never share an output path or its temp files.
        rec.coalesce(1).write.mode("errorifexists").parquet(
            f"{self.path}/h={ms // self.HOUR_MS}/{ms:013d}-{uuid.uuid4().hex}")
        self._commits += 1
        self._cache = None

    def checkpoint(self) -> None:
        """Write the live records as a new checkpoint (safe to run any time)."""
        live, settled, absorbed, _ = self._latest_checkpoint()
        recent = self._recent(settled, absorbed)
        self._write_checkpoint(live + [r for r, _ in recent], absorbed | {f for _, f in recent})

    def _write_checkpoint(self, rows: list, absorbed: set, settled: int | None = None) -> None:
        self._cache = None
        now = int(time.time() * 1000)
        if settled is None:
            settled = (now - self.SETTLE_MS) // self.HOUR_MS - 1
        # Folders of settled hours are covered by the hour bound; keep only
        # the names of absorbed folders in hours readers still scan.
        keep = {f for f in absorbed if _folder_hour(f) > settled}
        width = len(COMMIT_COLUMNS)
        data = [(*r, settled, None) for r in _prune(rows)]
        data += [(None,) * width + (settled, f) for f in sorted(keep)]
        data = data or [(None,) * width + (settled, None)]
        (self.spark.createDataFrame(data, CHECKPOINT_SCHEMA).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.ckpt_path}/{now:013d}-{uuid.uuid4().hex}"))


def _folder_hour(folder: str) -> int:
    part = folder.rstrip("/").rsplit("/", 2)[-2]      # ".../h=<hour>/<commit folder>"
    return int(part.split("=", 1)[1]) if part.startswith("h=") else -1


COMMIT_COLUMNS = ["table_name", "seq", "kind", "tag", "path", "n_rows", "committed_ms"]
CHECKPOINT_SCHEMA = COMMIT_SCHEMA + ", settled_hour long, absorbed string"


def _folded(rows: list) -> set:
    """(table, path) of every increment and base that some base record names as folded."""
    return {(r[0], path) for r in rows if r[2] == "base" for path in json.loads(r[3])}


def _prune(rows: list) -> list:
    """Drop records no reader needs: increments and bases named as folded by
    a base, and snapshot versions older than the newest (per table)."""
    folded, newest = _folded(rows), {}
    for r in rows:
        if r[2] == "snapshot":
            newest[r[0]] = max(newest.get(r[0], -1), r[1])
    return [r for r in rows
            if ((r[0], r[4]) not in folded if r[2] != "snapshot" else r[1] >= newest[r[0]])]


class Transaction:
    """Collects commit records and writes them at once on success."""

    def __init__(self, log: CommitLog):
        self.log, self.pending = log, []

    def add(self, record: tuple) -> None:
        self.pending.append(record)

    def pending_seq(self, table: str) -> int:
        return max((r[1] for r in self.pending if r[0] == table), default=0)

    def __enter__(self) -> "Transaction":
        return self

    def __exit__(self, exc_type, exc, tb) -> None:
        if exc_type is None:
            self.log.commit(self.pending)
        self.pending = []


#: Kind of an increment that holds each of its keys once.
UNIQUE = "unique increment"


class _Table:
    def __init__(self, spark: SparkSession, root: str, name: str | None, log: CommitLog | None):
        self.spark, self.root = spark, root.rstrip("/")
        self.name = name or "table"
        self.log = log or CommitLog(spark, f"{self.root}/commits")

    def records(self) -> list:
        return self.log.records(self.name)

    def _next_seq(self, recs: list, tx: Transaction | None) -> int:
        top = max((r["seq"] for r in recs), default=0)
        return max(top, tx.pending_seq(self.name) if tx else 0) + 1

    def _commit(self, record: tuple, tx: Transaction | None) -> None:
        if tx is not None:
            tx.add(record)
        else:
            self.log.commit([record])


class SnapshotTable(_Table):
    """Full-replace table with atomic publish."""

    def __init__(self, spark: SparkSession, root: str, *, key: Sequence[str] = (),
                 not_null: Sequence[str] = (), varchar: Mapping[str, int] | None = None,
                 name: str | None = None, log: CommitLog | None = None):
        super().__init__(spark, root, name, log)
        self.key, self.not_null, self.varchar = list(key), list(not_null), dict(varchar or {})
        self.last_n_rows: int | None = None

    def version(self) -> int | None:
        recs = self.records()
        return recs[-1]["seq"] if recs else None

    def read(self, version: int | None = None) -> DataFrame:
        recs = self.records()
        if version is None:
            if not recs:
                raise FileNotFoundError(f"table {self.root} has no committed version")
            rec = recs[-1]
        else:
            rec = next(r for r in recs if r["seq"] == version)
        return self.spark.read.parquet(rec["path"])

    def publish(self, df: DataFrame, *, allow_empty: bool = False, tag: str = "publish",
                tx: Transaction | None = None) -> int | None:
        """Write a new version, check it, then commit it.

        Returns the new version, or None when the new data is empty and
        ``allow_empty`` is False (the old version stays published).  A failed
        constraint check raises before the commit: nothing changes.
        """
        seq = self._next_seq(self.records(), tx)
        path = f"{self.root}/data/v{seq}-{uuid.uuid4().hex[:8]}"
        n_rows = _write_counted(df, path)
        if n_rows == 0 and not allow_empty:
            return None
        if self.key or self.not_null or self.varchar:
            assert_valid(self.spark.read.parquet(path), self.name, key=self.key,
                         not_null=self.not_null, varchar=self.varchar)
        self._commit((self.name, seq, "snapshot", tag, path, n_rows), tx)
        self.last_n_rows = n_rows
        return seq

    def stage(self, df: DataFrame, tag: str) -> tuple:
        """Write a new version without committing; returns its commit record."""
        seq = self._next_seq(self.records(), None)
        path = f"{self.root}/data/v{seq}-{uuid.uuid4().hex[:8]}"
        n_rows = _write_counted(df, path)
        return (self.name, seq, "snapshot", tag, path, n_rows)

    def create_once(self, df: DataFrame) -> bool:
        """Write only if no version exists (keeps an existing table as is)."""
        if self.version() is not None:
            return False
        self.publish(df, allow_empty=True, tag="create")
        return True


def _whole_state(recs: list, paths: list[str]) -> bool:
    """Whether all rows of ``paths`` are in one base or one unique increment."""
    filled = [r for r in recs if r["path"] in paths and r["n_rows"]]
    return len(filled) <= 1 and all(r["kind"] in ("base", UNIQUE) for r in filled)


class KeyedTable(_Table):
    """Keyed table: committed increments merged per key on read."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str],
                 columns: Sequence[str], *, policies: Mapping[str, str] | None = None,
                 name: str | None = None, log: CommitLog | None = None,
                 not_null: Sequence[str] = (), varchar: Mapping[str, int] | None = None,
                 money: Sequence[str] = (), partition_by: Sequence[str] = (), bloom: Mapping[str, int] | None = None,
                 unique_tags: str | None = None):
        super().__init__(spark, root, name, log)
        # What the tags of increments that are always ``unique`` (see append) begin with.
        self.unique_tags = unique_tags
        self.not_null, self.varchar = list(not_null), dict(varchar or {})
        self.money = list(money)  # checked before the cast to DECIMAL(12,2)
        # Partition columns: increments and bases are then partitions of one folder, too
        # (``part=<name>/<column>=<value>``), so all are one scan that prunes both.
        self.partition_by = list(partition_by)
        # Columns with a Bloom filter in each file: about how many values a file holds.
        self.bloom = dict(bloom or {})
        self.key = list(key)
        self.columns = list(columns)
        self.policies = {c: "latest" for c in self.columns if c not in self.key}
        self.policies.update(policies or {})

    # -- writing --------------------------------------------------------------------------
    def _next_seq(self, recs: list, tx: Transaction | None) -> int:
        """Commit-ordered and unique across concurrent writers: the commit
        time in microsecond-sized steps (ms * 1000 + random), but always above
        every sequence already seen."""
        floor = super()._next_seq(recs, tx)
        return max(floor, int(time.time() * 1000) * 1000 + random.randrange(1000))

    def append(self, df: DataFrame, tag: str, tx: Transaction | None = None, skip_empty: bool = False,
               unique: bool = False) -> int:
        """Write an increment and commit it (now, or with ``tx``); with ``skip_empty`` only if it has rows.

        ``unique`` is for rows whose keys cannot repeat (grouped by key, or ids drawn by the
        write itself): read alone, such an increment is the merged state and is only scanned.

        Every attempt has a folder and a number of its own: a committed folder is never
        written again.  A retry with the same rows converges when keys are merged on read,
        a corrected re-load supersedes its keys and is seen by incremental readers, and a
        retry that finds nothing left to do (no rows) takes nothing back.
        Returns the number of rows written.
        """
        recs = self.records()
        unique = unique or self.unique_tags is not None and tag.startswith(self.unique_tags)
        prior = [r for r in recs if r["tag"] == tag]
        seq = self._next_seq(recs, tx)
        # Plain folder names (not key=value): several increments are read
        # together and only their own partition folders may look like k=v.
        path = self._path("increments", f"{tag}-{uuid.uuid4().hex[:8]}")
        n_rows = _write_counted(
            df.select(*self.columns).withColumn("_seq", F.lit(seq).cast("long")), path,
            not_null=self.not_null, varchar=self.varchar, money=self._wider(df), table=self.name,
            partition_by=self.partition_by, bloom=self.bloom)
        if n_rows or not (prior or skip_empty):
            self._commit((self.name, seq, UNIQUE if unique else "increment", tag, path, n_rows), tx)
        return n_rows

    def _wider(self, df: DataFrame) -> list[str]:
        """Money columns of ``df`` whose type holds values that DECIMAL(12,2) does not."""
        return [c for c in self.money if dict(df.dtypes)[c] != MONEY_SQL]

    def _path(self, kind: str, name: str) -> str:
        return f"{self.root}/data/part={name}" if self.partition_by else f"{self.root}/{kind}/{name}"

    # -- reading --------------------------------------------------------------------------
    def live(self) -> list[str]:
        """Paths of the committed increments and bases that no base has folded.

        A base names what it folded, so an increment that commits late, under
        a lower number than a base's, stays live until a compaction names it.
        """
        recs = self.records()
        gone = {path for r in recs if r["kind"] == "base" for path in json.loads(r["tag"])}
        # Without rows a partitioned increment has no folder.
        return list(dict.fromkeys(r["path"] for r in recs if r["path"] not in gone
                                  and (r["n_rows"] or not self.partition_by)))

    def is_one_base(self) -> bool:
        """Whether the table is one base: then each key has one row version."""
        live = self.live()
        return any(r["kind"] == "base" and [r["path"]] == live for r in self.records())

    def _load(self, paths: list[str]) -> DataFrame | None:
        reader = self.spark.read
        if self.partition_by:
            reader = reader.option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*self.columns, "_seq")

    def versions(self) -> DataFrame | None:
        """All committed row versions (with ``_seq``), unmerged."""
        paths = self.live()
        return self._load(paths) if paths else None

    def versions_since(self, seen: Iterable[str]) -> tuple[DataFrame | None, list[str]]:
        """Row versions committed outside ``seen`` (paths an earlier call
        returned), and all live paths now: what the next call passes as ``seen``.

        A set, not a highest number: a slow writer that commits under a lower
        number than others is read by the next call.  A base is new only if it
        folds something unseen; then it is returned whole (a full pass;
        consumers must be idempotent, ours are)."""
        seen, recs, live = set(seen), self.records(), self.live()
        for r in recs:  # in the order of numbers, so a base comes after the bases it folds
            if r["kind"] == "base" and (folds := json.loads(r["tag"])) and seen.issuperset(folds):
                seen.add(r["path"])
        new = [path for path in live if path not in seen]
        return (self._load(new) if new else None), live

    def state_since(self, seen: Iterable[str]) -> tuple[DataFrame | None, list[str]]:
        """Like ``versions_since``, with the row versions merged: one row per key."""
        seen, recs = set(seen), self.records()
        raw, live = self.versions_since(seen)
        if raw is None:
            return None, live
        return (raw.select(*self.columns) if _whole_state(recs, [p for p in live if p not in seen]) else self.merge(raw)), live

    def keys(self) -> DataFrame | None:
        """Every committed key once, without merging row versions: enough for
        membership tests such as anti-joins.  ``distinct`` runs with partial
        aggregation, so a key with very many versions collapses map-side and
        cannot skew the join that follows (AQE cannot split a skewed build side
        of an anti-join)."""
        recs, live = self.records(), self.live()
        if not live:
            return None
        keys = self._load(live).select(*self.key)
        return keys if _whole_state(recs, live) else keys.distinct()

    def read(self) -> DataFrame:
        """Current state: one row per key.

        One aggregation by key over the committed versions; the set of files
        is fixed when this is called, so the result is a stable snapshot even
        while writers keep committing.
        """
        recs, live = self.records(), self.live()
        if not live:
            raise FileNotFoundError(f"table {self.root} has no committed data")
        return self._state(recs, live)

    def read_touching(self, row_filter) -> DataFrame | None:
        """Current rows of every key that has *some* committed version
        matching ``row_filter`` -- a Column, or a function from the raw
        versions to the matching versions (callers then filter the current rows).

        The filter runs map-side on the raw versions (and prunes files by
        min/max when it is a range), so only the touched keys are shuffled
        for the merge instead of the whole table.
        """
        recs, live = self.records(), self.live()
        if not live:
            return None
        raw = self._load(live)
        hit = row_filter(raw) if callable(row_filter) else raw.filter(row_filter)
        if _whole_state(recs, live):
            return hit.select(*self.columns)
        keys = hit.select(*self.key).distinct()
        return self.merge(raw.join(keys, self.key, "left_semi"))

    def read_or_empty(self, schema: str, only: DataFrame | None = None) -> DataFrame:
        """Current state, or no rows of ``schema``; with ``only``, of these keys (the rest is not merged)."""
        recs, live = self.records(), self.live()
        if not live:
            return self.spark.createDataFrame([], schema)
        if only is not None:
            raw = self._load(live).join(only, self.key, "left_semi")
            return raw.select(*self.columns) if _whole_state(recs, live) else self.merge(raw)
        return self._state(recs, live)

    def _state(self, recs: list, live: list[str]) -> DataFrame:
        """The merged rows of ``live``; a base or a unique increment alone holds one row per key
        and is only scanned."""
        raw = self._load(live)
        if _whole_state(recs, live):
            return raw.select(*self.columns)
        return self.merge(raw)

    def merge(self, raw: DataFrame, *, with_seq: bool = False) -> DataFrame:
        """One row per key; ``with_seq`` keeps the number of the version that won."""
        latest = [c for c, p in self.policies.items() if p == "latest"]
        first = [c for c, p in self.policies.items() if p == "first"]
        aggs, outs = [], []
        if latest:
            aggs.append(F.max(F.struct(F.col("_seq"), *[F.col(c) for c in latest])).alias("_latest"))
            outs += [F.col(f"_latest.{c}").alias(c) for c in latest]
        if first:
            aggs.append(F.min(F.struct(F.col("_seq"), *[F.col(c) for c in first])).alias("_first"))
            outs += [F.col(f"_first.{c}").alias(c) for c in first]
        for c, p in self.policies.items():
            if p == "min":
                aggs.append(F.min(c).alias(c))
                outs.append(F.col(c))
            elif p == "max":
                aggs.append(F.max(c).alias(c))
                outs.append(F.col(c))
        seq = []
        if with_seq:
            if latest or first:
                seq = [F.col("_latest._seq" if latest else "_first._seq").alias("_seq")]
            else:
                aggs.append(F.max("_seq").alias("_seq"))
                seq = [F.col("_seq")]
        return raw.groupBy(*self.key).agg(*aggs).select(*self.key, *outs, *seq).select(
            *self.columns, *(["_seq"] if with_seq else []))

    def compact(self) -> int:
        """Fold all live increments and bases into one base, which names them.

        Rows keep the number of the version that won, so an increment that
        commits later under a lower number still merges as its number says,
        and two compactions at once only hold the same rows twice.  (A table
        with both ``latest`` and ``first`` columns keeps the latest's number.)
        """
        recs, folds = self.records(), self.live()
        if not folds or (len(folds) == 1 and recs[-1]["kind"] == "base"):
            return 0
        state = self.merge(self._load(folds), with_seq=True)
        seq = max(r["seq"] for r in recs)
        path = self._path("base", f"{seq:012d}-{uuid.uuid4().hex[:8]}")
        n_rows = _write_counted(state, path, partition_by=self.partition_by, bloom=self.bloom)
        self._commit((self.name, seq, "base", json.dumps(folds), path, n_rows), None)
        # The folded increments are now prunable from the log.
        self.log.checkpoint()
        return n_rows
