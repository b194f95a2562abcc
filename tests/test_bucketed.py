import datetime as dt
import random
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from tributary.operators import merge
from tributary.plans.bucketed import BucketedTable
from tributary.plans.store import SILVER_SCHEMA
from tributary.session import scratch_path

STAMP, LATER = dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1)


def _table(spark, buckets=8):
    path = scratch_path(spark, "bucketed")
    return BucketedTable(spark, f"silver_{uuid.uuid4().hex[:8]}", path, SILVER_SCHEMA, ["order_id"], buckets)


def _sales(spark, keys, seed, stamp=STAMP):
    rng = random.Random(seed)
    rows = [(k, "C", rng.choice("pq"), Decimal(rng.randrange(1, 999)), dt.datetime(2024, 1, rng.randrange(1, 28)), stamp) for k in keys]
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def _files(spark, table):
    return {r[0] for r in spark.table(table.name).select(F.col("_metadata.file_path")).distinct().collect()}


def test_upsert_equals_the_aggregate_merge(spark):
    table, target = _table(spark), _sales(spark, [f"k{i}" for i in range(200)], 1)
    changes = _sales(spark, [f"k{i % 260}" for i in range(0, 500, 3)], 2).drop("processed_at")
    table.load(target)
    stamp = F.lit(LATER).cast("timestamp_ntz")
    order = ["order_date", "amount", "product_id"]
    table.upsert(changes, order, audit_col="processed_at", stamp=stamp)
    wanted = merge.upsert(target, changes, ["order_id"], order, audit_col="processed_at", stamp=stamp)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, wanted.collect()))
    # A second application of the same changes alters nothing.
    table.upsert(changes, order, audit_col="processed_at", stamp=stamp)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, wanted.collect()))


def test_only_touched_buckets_are_rewritten_and_the_target_is_not_moved(spark):
    table = _table(spark, 16)
    table.load(_sales(spark, [f"k{i}" for i in range(400)], 3))
    before = _files(spark, table)
    assert len(before) == 16            # one file a bucket
    changes = _sales(spark, ["k1", "k1", "new"], 4).drop("processed_at")
    plan = table.merged(changes, ["order_date"], table.touched(changes), audit_col="processed_at")._jdf.queryExecution().executedPlan().toString()
    target = plan[:plan.index("SelectedBucketsCount")].rsplit("ShuffledHashJoin", 1)[1]
    assert "Exchange" not in target and "Sort" not in target and "Aggregate" not in target, plan
    touched = table.upsert(changes, ["order_date"], audit_col="processed_at")
    assert 1 <= len(touched) <= 2
    after = _files(spark, table)
    assert len(before - after) <= len(touched) and len(after & before) >= 14
    assert table.read().count() == 401


def test_no_changes_and_an_empty_table(spark):
    table = _table(spark)
    none = _sales(spark, [], 1).drop("processed_at")
    assert table.upsert(none, ["order_date"]) == [] and table.read().count() == 0
    table.upsert(_sales(spark, ["a", "b"], 1).drop("processed_at"), ["order_date"], audit_col="processed_at")
    assert table.read().count() == 2
    # Another session's view of the same folder: the layout is in the folder and its declaration.
    again = BucketedTable(spark, f"again_{uuid.uuid4().hex[:8]}", table.path, SILVER_SCHEMA, ["order_id"], 8).attach()
    assert sorted(r["order_id"] for r in again.read().collect()) == ["a", "b"]
