"""Set-based table merges (K3, K4, K5, K10, A3) as pure DataFrame functions.

Each takes the current table state and a change set and returns the new
state; nothing is collected to the driver.  Dedup uses an aggregate (partial
aggregation map-side), never a full sort of one key's rows in one task, so a
key that holds a third of the rows still spreads over all input partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.quality import STATUS_PROCESSED


def _pick(df: DataFrame, key: Sequence[str], order: Sequence[str], newest: bool) -> DataFrame:
    value_cols = [c for c in df.columns if c not in key]
    ties = [c for c in value_cols if c not in order]
    # The struct carries the order columns first and every other value as a
    # final tie-break: the survivor is fully determined by the data.
    ordered = F.struct(*[F.col(c) for c in list(order) + ties])
    best = (F.max(ordered) if newest else F.min(ordered)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_best.{c}").alias(c) for c in value_cols])


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last version of each key (largest ``order``, NULLs lowest)."""
    return _pick(df, key, order, newest=True)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First version of each key (smallest ``order``, NULLs lowest)."""
    return _pick(df, key, order, newest=False)


def _keys(df: DataFrame, key: Sequence[str], broadcast: bool) -> DataFrame:
    ks = df.select(*key)
    return F.broadcast(ks) if broadcast else ks


def upsert(target: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str], *,
           audit_col: str | None = None, stamp: Column | None = None,
           broadcast_changes: bool = False) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE of every value column.

    Changes are reduced to their latest version per key (largest ``order``);
    target rows whose key is not changed pass through untouched.
    ``audit_col`` (e.g. ``processed_at``) keeps the value of the first insert:
    a conflict keeps the target's stamp, a new key gets ``stamp``.

    Default shape: one keyed aggregation over ``target UNION changes`` -- each
    input is scanned once and shuffled once, and partial aggregation folds a
    hot key map-side.  With ``broadcast_changes`` (the caller has checked the
    change set is small, see :func:`bounded`) the target is never shuffled:
    an anti-join against the broadcast keys keeps unchanged rows and a
    semi-join fetches the old stamps.
    """
    if broadcast_changes:
        return _upsert_broadcast(target, changes, key, order, audit_col, stamp)
    value_cols = [c for c in target.columns if c not in key and c != audit_col]
    stamp = stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz")
    audit_type = dict(target.dtypes)[audit_col] if audit_col else None

    def side(df: DataFrame, src: int) -> DataFrame:
        cols = [F.col(c) for c in key]
        cols += [F.lit(src).alias("_src")]
        # Order-only columns exist on the change side; the target side never
        # wins over a change (``_src`` sorts first), so NULL is enough there.
        cols += [(F.col(o) if src or o in value_cols else F.lit(None).cast(dict(changes.dtypes)[o]))
                 .alias(o) for o in order if o not in key]
        cols += [F.col(c) for c in value_cols if c not in order]
        if audit_col:
            cols.append((F.col(audit_col) if src == 0 else F.lit(None).cast(audit_type)).alias(audit_col))
        return df.select(*cols)

    both = side(target, 0).unionByName(side(changes, 1))
    ordered = ["_src", *[o for o in order if o not in key],
               *[c for c in value_cols if c not in order]]
    aggs = [F.max(F.struct(*[F.col(c) for c in ordered])).alias("_best")]
    if audit_col:
        aggs.append(F.min(audit_col).alias(audit_col))
    out = both.groupBy(*key).agg(*aggs)
    cols = [F.col(c) for c in key] + [F.col(f"_best.{c}").alias(c) for c in value_cols]
    if audit_col:
        cols.append(F.coalesce(F.col(audit_col), stamp).alias(audit_col))
    return out.select(*cols).select(*target.columns)


def _upsert_broadcast(target, changes, key, order, audit_col, stamp):
    value_cols = [c for c in target.columns if c not in key and c != audit_col]
    carried = list(dict.fromkeys([*value_cols, *[o for o in order if o not in key]]))
    latest = latest_per_key(changes.select(*key, *carried), key, order).select(*key, *value_cols)
    kept = target.join(_keys(latest, key, True), list(key), "left_anti")
    if audit_col is None:
        return kept.unionByName(latest)
    prev = target.select(*key, audit_col).join(_keys(latest, key, True), list(key), "left_semi")
    stamp = stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz")
    updated = (latest.join(F.broadcast(prev), list(key), "left")
               .withColumn(audit_col, F.coalesce(F.col(audit_col), stamp)))
    return kept.unionByName(updated.select(*target.columns))


def insert_if_absent(existing: DataFrame, batch: DataFrame, key: Sequence[str],
                     order: Sequence[str], *, broadcast_batch_keys: bool = False) -> DataFrame:
    """Rows of ``batch`` to append: first version per key, key not in ``existing``.

    Deterministic replacement for an arbitrary ``dropDuplicates`` survivor.
    With ``broadcast_batch_keys`` (the caller checked the batch is small) the
    existing keys are first filtered map-side against the broadcast batch
    keys, so the large table is never shuffled.
    """
    first = first_per_key(batch, key, order)
    existing_keys = existing.select(*key)
    if broadcast_batch_keys:
        existing_keys = existing_keys.join(F.broadcast(first.select(*key)), list(key), "left_semi")
    return first.join(existing_keys, list(key), "left_anti")


def mark_processed(dlq: DataFrame, ids: DataFrame, *, key: Sequence[str] | None = None,
                   broadcast_ids: bool = False) -> DataFrame:
    """``UPDATE dlq SET status='processed' WHERE key IN ids`` as a new state.

    The key is (source, id) where the queue has a source (ids repeat across sources), else
    id.  Exactly the keys given are touched; an empty set changes nothing.
    """
    key = list(key) if key else [c for c in ("source", "id") if c in dlq.columns]
    hit = ids.select(*key).distinct().withColumn("_hit", F.lit(True))
    if broadcast_ids:
        hit = F.broadcast(hit)
    return (
        dlq.join(hit, key, "left")
        .withColumn("status", F.when(F.col("_hit"), F.lit(STATUS_PROCESSED)).otherwise(F.col("status")))
        .select(*dlq.columns)
    )


def bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` provably has at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows, so the check itself stays cheap; use
    it to gate ``broadcast_*`` flags.
    """
    return df.limit(max_rows + 1).count() <= max_rows
