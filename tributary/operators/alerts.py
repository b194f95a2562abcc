"""High-value alerts (F-4, J1, W1, T10): filter, catalog enrichment, digest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tributary.functions import text
from tributary.operators.merge import first_per_key
from tributary.schemas import MONEY_SQL

HIGH_VALUE_THRESHOLD = 1000


def high_value(clean: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Strict ``amount > threshold``."""
    return clean.filter(F.col("amount") > F.lit(threshold))


def unique_catalog(catalog: DataFrame) -> DataFrame:
    """One row per product id, so a duplicated catalog entry cannot fan out
    (and double) the rows it is joined to.  Survivor: smallest (name, category)."""
    return first_per_key(catalog.select("product_id", "product_name", "category"),
                         ["product_id"], ["product_name", "category"])


def enrich(events: DataFrame, catalog: DataFrame, *, broadcast_catalog: bool = False,
           catalog_is_unique: bool = False) -> DataFrame:
    """Left equi-join on the trimmed product id; unmatched rows keep NULL names.

    ``broadcast_catalog`` is for callers that checked the catalog's size
    (``merge.bounded``); otherwise Catalyst/AQE choose from statistics.
    ``catalog_is_unique`` skips the dedup for a catalog already passed
    through :func:`unique_catalog`.
    """
    cat = catalog if catalog_is_unique else unique_catalog(catalog)
    if broadcast_catalog:
        cat = F.broadcast(cat)
    return events.join(cat, "product_id", "left")


#: Rows that a task holds of its groups' largest before it gives them on.
HELD_ROWS = 200_000


def _largest(limit: int):
    """A task's part of a bounded top-k: of each group its ``limit`` largest rows, and the
    number of its rows on the first of them.  Parts merge: the largest of parts are the
    largest of all, and the numbers add up."""
    order = [("group_key", "ascending"), ("amount", "descending"), ("order_key", "ascending"),
             ("product_key", "ascending"), ("name_key", "ascending")]

    def ranked(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
        t = t.take(pc.sort_indices(t, sort_keys=order))
        group = t.column("group_key").combine_chunks().dictionary_encode().indices.to_numpy()
        at = np.arange(len(group))
        first = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, at, 0))
        return t, at - first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = None, Counter()

        def given() -> Iterator[pa.RecordBatch]:
            t, rank = ranked(held)
            n = np.where(rank == 0, [counts[g] for g in t.column("group_key").to_pylist()], 0)
            yield from t.append_column("n", pa.array(n, pa.int64())).to_batches()
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            for v in pc.value_counts(t.column("group_key")):
                counts[v["values"].as_py()] += v["counts"].as_py()
            t, rank = ranked(t if held is None else pa.concat_tables([held, t]))
            held = t.filter(pa.array(rank < limit))
            if held.num_rows >= HELD_ROWS:
                yield from given()
                held, counts = None, Counter()
        if held is not None:
            yield from given()
    return run


def alert_digest(high: DataFrame, group_cols: Sequence[str] = (), *, limit: int = text.DIGEST_LIMIT,
                 catalog: DataFrame | None = None, broadcast_catalog: bool = False, catalog_is_unique: bool = False,
                 batch: Column | None = None, at: Column | None = None) -> DataFrame:
    """One row per group (a micro-batch, or a day): count, top lines, message.

    Lines are the ``limit`` largest amounts (ties by order id, product id, name); the rest is
    summarised by an overflow line.  One pass over the rows: each task reduces its rows to the
    ``limit`` largest and a count per group, so a hot group ships that many rows a task, and
    the catalog is joined to the listed rows alone.  ``high`` may bring ``product_name``
    itself.  The message names the group or ``batch``, and the time ``at`` if given.
    """
    groups = list(group_cols)
    text_or_none = lambda c: F.col(c) if c in high.columns else F.lit(None).cast("string")
    blank = lambda c: F.coalesce(c, F.lit(""))
    name = text_or_none("product_name")
    rows = high.select(
        *groups, (F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}) if groups else F.lit("")).alias("group_key"),
        F.col("amount").cast(MONEY_SQL).alias("amount"), blank(F.col("order_id")).alias("order_key"),
        blank(text_or_none("product_id")).alias("product_key"), blank(name).alias("name_key"),
        "order_id", text_or_none("product_id").alias("product_id"), name.alias("product_name"))
    out = StructType([*rows.schema.fields, StructField("n", LongType())])
    parts = rows.mapInArrow(_largest(limit), out)
    in_group = Window.partitionBy("group_key")
    best = in_group.orderBy(F.col("amount").desc_nulls_last(), "order_key", "product_key", "name_key")
    top = (parts.withColumn("n_orders", F.sum("n").over(in_group)).withColumn("rn", F.row_number().over(best))
           .filter(F.col("rn") <= limit))
    if catalog is not None:
        top = enrich(top.drop("product_name"), catalog, broadcast_catalog=broadcast_catalog, catalog_is_unique=catalog_is_unique)
    j = top.groupBy("group_key", *groups).agg(
        F.first("n_orders").alias("n_orders"),
        F.collect_list(F.struct("rn", text.alert_line().alias("line"))).alias("items")).select(
        *groups, "n_orders",
        F.array_join(F.transform(F.array_sort("items"), lambda s: s["line"]), "\n").alias("lines"),
        F.size("items").cast("long").alias("n_listed"))
    n_more = F.col("n_orders") - F.col("n_listed")
    label = (F.concat_ws(" ", *[F.col(c).cast("string") for c in groups]) if groups
             else batch.cast("string") if batch is not None else F.lit("batch"))
    message = F.concat_ws(
        "\n",
        F.lit(text.DIGEST_HEADER), F.lit(text.DIGEST_RULE),
        F.concat(F.lit("Batch: "), label), *([F.concat(F.lit("Time: "), at)] if at is not None else []),
        F.concat(F.lit("Orders: "), F.col("n_orders").cast("string")),
        F.lit(text.DIGEST_RULE), F.col("lines"), text.overflow_line(n_more), F.lit(text.DIGEST_RULE),
    )
    return j.select(*groups, "n_orders", "n_listed", n_more.alias("n_more"), "lines",
                    message.alias("message"))
