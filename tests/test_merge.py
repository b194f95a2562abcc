import datetime as dt

from pyspark.sql import functions as F

from tributary.operators.merge import (
    bounded, first_per_key, insert_if_absent, latest_per_key, mark_processed, upsert,
)

T0 = dt.datetime(2000, 1, 1)
T1 = dt.datetime(2030, 1, 1)
SCHEMA = "order_id string, amount int, v int, processed_at timestamp_ntz"


def test_upsert_replaces_values_and_keeps_first_stamp(spark):
    target = spark.createDataFrame([("a", 1, 1, T0), ("b", 2, 1, T0)], SCHEMA)
    changes = spark.createDataFrame([("a", 10, 2), ("a", 11, 3), ("c", 5, 1)],
                                    "order_id string, amount int, v int")
    got = {r["order_id"]: (r["amount"], r["processed_at"]) for r in
           upsert(target, changes, ["order_id"], ["v"], audit_col="processed_at",
                  stamp=F.lit(T1).cast("timestamp_ntz")).collect()}
    assert got == {"a": (11, T0), "b": (2, T0), "c": (5, T1)}


def test_upsert_with_broadcast_changes_is_same(spark):
    target = spark.createDataFrame([("a", 1, 1, T0), ("b", 2, 1, T0)], SCHEMA)
    changes = spark.createDataFrame([("b", 7, 9)], "order_id string, amount int, v int")
    assert bounded(changes, 10)
    out = upsert(target, changes, ["order_id"], ["v"], audit_col="processed_at",
                 stamp=F.lit(T1).cast("timestamp_ntz"), broadcast_changes=True)
    assert "Broadcast" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["order_id"], r["amount"]) for r in out.collect()) == [("a", 1), ("b", 7)]


def test_insert_if_absent_keeps_first_version_of_new_keys(spark):
    existing = spark.createDataFrame([("a",)], "order_id string")
    batch = spark.createDataFrame([("a", 1), ("b", 5), ("b", 3)], "order_id string, v int")
    assert [tuple(r) for r in insert_if_absent(existing, batch, ["order_id"], ["v"]).collect()] == [("b", 3)]


def test_hot_key_dedup_is_deterministic(spark):
    # One key holds a third of the rows; every other key is unique.
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"), (F.col("id") * 7 % 11).alias("w")).repartition(16)
    latest = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["w", "v"]).collect()}
    first = {r["k"]: r["v"] for r in first_per_key(df, ["k"], ["w", "v"]).collect()}
    hot = [(i * 7 % 11, i) for i in range(0, n, 3)]
    assert latest["hot"] == max(hot)[1] and first["hot"] == min(hot)[1]
    assert len(latest) == 1 + (n - n // 3)


def test_mark_processed_touches_exactly_the_ids(spark):
    dlq = spark.createDataFrame([(1, "unprocessed"), (2, "unprocessed"), (3, "processed")],
                                "id long, status string")
    ids = spark.createDataFrame([(2,), (2,)], "id long")
    assert {r["id"]: r["status"] for r in mark_processed(dlq, ids).collect()} == \
        {1: "unprocessed", 2: "processed", 3: "processed"}
    empty = spark.createDataFrame([], "id long")
    assert {r["id"]: r["status"] for r in mark_processed(dlq, empty).collect()} == \
        {1: "unprocessed", 2: "unprocessed", 3: "processed"}


def test_insert_if_absent_broadcast_keys_same_result(spark):
    existing = spark.range(1000).select(F.col("id").cast("string").alias("order_id"))
    batch = spark.createDataFrame([("5", 2), ("5", 1), ("2000", 7)], "order_id string, v int")
    plain = insert_if_absent(existing, batch, ["order_id"], ["v"]).collect()
    fast = insert_if_absent(existing, batch, ["order_id"], ["v"], broadcast_batch_keys=True)
    assert "BroadcastHashJoin" in fast._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in fast.collect()] == [tuple(r) for r in plain] == [("2000", 7)]
