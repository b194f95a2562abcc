"""Daily gold refresh: full recompute or only the days Silver changes touched."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tributary.operators.gold import daily_revenue, publishable_daily
from tributary.operators.merge import bounded
from tributary.plans.store import Store
from tributary.plans.tables import Transaction

MAX_TOUCHED_DAYS = 100_000


def touched_days(store: Store, seen: Iterable[str]) -> list[dt.date] | None:
    """Days whose daily totals may change because of Silver increments
    committed outside ``seen``: the days of the new versions *and* of the
    versions they supersede (a key can move between days).  None means
    "too many to list" (the caller recomputes everything)."""
    incs, _ = store.silver.versions_since(seen)
    if incs is None:
        return []
    changed = incs.select("order_id").distinct()
    versions = store.silver.versions()
    days = (versions.join(changed, "order_id", "left_semi")
            .select(F.to_date("order_date").alias("d")).filter(F.col("d").isNotNull()).distinct())
    if not bounded(days, MAX_TOUCHED_DAYS):
        return None
    return sorted(r["d"] for r in days.collect())


def refresh_daily(spark: SparkSession, store: Store, tag: str, *, seen: Iterable[str] | None = None,
                  tx: Transaction | None = None) -> int | None:
    """Publish a new daily gold version; returns it (None when nothing to publish).

    ``seen`` (paths of Silver taken in before) None, or no published daily yet: recompute from all of
    Silver.  Otherwise recompute only the touched days from the keys that
    have a version on those days, and carry the other days over from the
    published version.
    """
    previous = store.daily.version()
    days = None if seen is None or previous is None else touched_days(store, seen)
    if days is None:
        return store.daily.publish(publishable_daily(daily_revenue(store.silver.read())), tag=tag,
                                   tx=tx)
    if not days:
        return previous
    lo, hi = days[0], days[-1] + dt.timedelta(days=1)
    t = F.col("order_date")
    in_range = (t >= F.lit(dt.datetime.combine(lo, dt.time())).cast("timestamp_ntz")) & \
               (t < F.lit(dt.datetime.combine(hi, dt.time())).cast("timestamp_ntz"))
    on_days = F.to_date(t).isin(days)
    current = store.silver.read_touching(in_range & on_days)
    fresh = publishable_daily(daily_revenue(current.filter(on_days)))
    kept = store.daily.read(previous).filter(~F.col("report_date").isin(days))
    return store.daily.publish(kept.unionByName(fresh), tag=tag, allow_empty=True, tx=tx)
