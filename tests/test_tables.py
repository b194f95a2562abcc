import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tributary.operators.checks import ConstraintViolation, violations
from tributary.plans.store import SILVER_SCHEMA, Store
from tributary.plans.tables import KeyedTable, SnapshotTable
from tributary.session import scratch_path

DAILY = "report_date date, product_id string, total_revenue decimal(12,2)"


def test_snapshot_publish_swap_and_guards(spark):
    t = SnapshotTable(spark, scratch_path(spark, "t"), key=["report_date", "product_id"],
                      not_null=["report_date", "product_id", "total_revenue"])
    d = dt.date(2024, 1, 1)
    assert t.publish(spark.createDataFrame([(d, "1", Decimal("1.00"))], DAILY)) == 1
    # Empty aggregate: nothing is replaced.
    assert t.publish(spark.createDataFrame([], DAILY)) is None
    # NULL date (F1) or duplicate key: the publish fails and the old version stays.
    with pytest.raises(ConstraintViolation):
        t.publish(spark.createDataFrame([(None, "1", Decimal("2.00"))], DAILY))
    with pytest.raises(ConstraintViolation):
        t.publish(spark.createDataFrame([(d, "1", Decimal("2.00")), (d, "1", Decimal("3.00"))], DAILY))
    assert [r["total_revenue"] for r in t.read().collect()] == [Decimal("1.00")]
    assert t.publish(spark.createDataFrame([(d, "2", Decimal("5.00"))], DAILY)) is not None
    assert [r["product_id"] for r in t.read().collect()] == ["2"]


def test_create_once_keeps_first(spark):
    t = SnapshotTable(spark, scratch_path(spark, "cat"))
    assert t.create_once(spark.createDataFrame([("1", "a")], "product_id string, product_name string"))
    assert not t.create_once(spark.createDataFrame([("1", "b")], "product_id string, product_name string"))
    assert t.read().first()["product_name"] == "a"


def test_keyed_table_append_is_idempotent_per_tag(spark):
    t = KeyedTable(spark, scratch_path(spark, "k"), ["k"], ["k", "v", "stamp"],
                   policies={"stamp": "min"})
    t.append(spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, stamp int"), "t1")
    t.append(spark.createDataFrame([("a", 2, 5)], "k string, v int, stamp int"), "t2")
    t.append(spark.createDataFrame([("a", 2, 5)], "k string, v int, stamp int"), "t2")  # retry
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 2, 1), ("b", 1, 1)]
    assert t.versions().count() == 4  # the retry is an increment of its own, merged on read
    before = sorted(tuple(r) for r in t.read().collect())
    t.compact()
    t.append(spark.createDataFrame([("b", 9, 0)], "k string, v int, stamp int"), "t3")
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 2, 1), ("b", 9, 0)]
    assert before == [("a", 2, 1), ("b", 1, 1)]


def test_dlq_status_only_moves_forward(spark):
    store = Store(spark, scratch_path(spark, "store"))
    row = [("s", 1, "O1", "C", "1", Decimal("-1.00"), None, "Invalid Amount", "Batch", "unprocessed",
            dt.datetime(2024, 1, 1))]
    schema = ("source string, id long, order_id string, customer_id string, product_id string, "
              "amount decimal(12,2), order_date timestamp_ntz, error_reason string, "
              "source_type string, status string, created_at timestamp_ntz")
    df = spark.createDataFrame(row, schema)
    store.dlq.append(df, "b1")
    store.dlq.append(df.withColumn("status", F.lit("processed")), "rec")
    store.dlq.append(df, "b2")  # a later re-run re-adds the error
    assert store.dlq_state().first()["status"] == "processed"


def test_violations_counts(spark):
    df = spark.createDataFrame([("a", "x" * 300), ("a", None), (None, "y")], "k string, s string")
    got = {(r["rule"], r["column_name"]): r["n_violations"] for r in
           violations(df, "t", key=["k"], not_null=["k", "s"], varchar={"s": 255}).collect()}
    assert got == {("not_null", "k"): 1, ("not_null", "s"): 1, ("max_length_255", "s"): 1,
                   ("unique_key", "k"): 1}


def test_violations_in_one_scan_with_examples(spark):
    rows = [("a", 1.0, "x"), ("b", 9_999_999_999.99, "x"), ("b", 1e10, "x"), ("c", float("nan"), "x"), (None, None, "y" * 9), ("c", -1e10, "x")]
    df = spark.createDataFrame(rows, "key string, v0 double, b0 string")  # names of the counters
    rules = dict(key=["key"], not_null=["v0"], varchar={"b0": 8}, money=["v0"])
    got = violations(df, "t", examples=True, **rules)
    assert {(r["rule"], r["column_name"]): (r["n_violations"], r["example"]) for r in got.collect()} == {
        ("not_null", "v0"): (1, "{}"), ("max_length_8", "b0"): (1, "{}"), ("money_range", "v0"): (3, '{"key":"b"}'),
        ("unique_key", "key"): (2, '{"key":"b"}')}
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    plan = violations(spark.read.parquet(path), "t", **rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert {r["n_violations"] for r in violations(df.limit(0), "t", examples=True, **rules).collect()} == {0}


def test_keyed_write_checks_the_money_range_before_the_cast(spark):
    store = Store(spark, scratch_path(spark, "range"))
    row = spark.createDataFrame([("o", "c", "p", 12.345, None, None)], SILVER_SCHEMA.replace("decimal(12,2)", "double"))
    store.silver.append(row, "good")
    assert store.silver.read().first()["amount"] == Decimal("12.35")
    with pytest.raises(ConstraintViolation, match=r"money_range\(amount\)=1"):
        store.silver.append(row.withColumn("amount", F.lit(1e10)), "bad")
    assert store.silver.read().count() == 1 and dict(store.silver.read().dtypes)["amount"] == "decimal(12,2)"


def test_money_migration_is_all_or_nothing(spark):
    from tributary.plans.migration import migrate_tables
    a = SnapshotTable(spark, scratch_path(spark, "ma"))
    b = SnapshotTable(spark, scratch_path(spark, "mb"))
    a.publish(spark.createDataFrame([(1.005,), (2.5,)], "amount double"))
    b.publish(spark.createDataFrame([(1e13,), (3.0,)], "total_revenue double"))
    both = {"a": (a, ["amount"]), "b": (b, ["total_revenue"])}
    with pytest.raises(Exception, match="out of range"):
        migrate_tables(spark, both)
    assert dict(a.read().dtypes)["amount"] == dict(b.read().dtypes)["total_revenue"] == "double"
    assert sorted(r["total_revenue"] for r in b.read().collect()) == [3.0, 1e13]
    b.publish(spark.createDataFrame([(7.777,), (3.0,)], "total_revenue double"))
    rep = {r["table_name"]: (r["n_rows"], r["n_rounded"], r["n_nulled"])
           for r in migrate_tables(spark, both).collect()}
    assert rep == {"a": (2, 1, 0), "b": (2, 1, 0)}
    assert sorted(r["total_revenue"] for r in b.read().collect()) == [Decimal("3.00"), Decimal("7.78")]


def test_old_and_new_money_files_are_one_table_and_migrate_together(spark):
    from tributary.plans.migration import MoneyTables
    rules = {"a": {"money": ["amount"], "key": ["k"], "not_null": ["k"]}, "b": {"money": ["net", "tax"]}}
    t = MoneyTables(spark, scratch_path(spark, "money"), rules)
    old_a = spark.createDataFrame([(1, 1.006), (2, None)], "k int, amount double")
    old_b = spark.createDataFrame([("x", 7.777, 3.0), ("y", 1.0, 1e13)], "s string, net double, tax double")
    t.append({"a": old_a, "b": old_b})
    t.append({"a": spark.createDataFrame([(3, Decimal("5.00"))], "k int, amount decimal(12,2)")})
    with pytest.raises(TypeError, match="double"):
        t.append({"b": spark.createDataFrame([("z", 1.0, Decimal("1.00"))], "s string, net double, tax decimal(12,2)")})

    def held(name):
        return sorted(map(tuple, t.read(name).collect()), key=str)
    as_one = [(1, Decimal("1.01")), (2, None), (3, Decimal("5.00"))]
    assert held("a") == as_one and dict(t.read("a").dtypes)["amount"] == "decimal(12,2)"
    before = t._folders()
    with pytest.raises(ConstraintViolation, match="b.tax=1"):  # one bad value: all stay as they were
        t.migrate()
    assert t._folders() == before and held("a") == as_one
    with pytest.raises(Exception, match="out of range"):
        held("b")
    t = MoneyTables(spark, scratch_path(spark, "money"), rules)
    t.append({"a": old_a, "b": old_b.filter("tax < 1e9")})
    t.append({"a": spark.createDataFrame([(2, Decimal("5.00"))], "k int, amount decimal(12,2)")})
    before = t._folders()
    with pytest.raises(ConstraintViolation, match="unique_key"):  # a broken rule: likewise
        t.migrate()
    assert t._folders() == before
    t = MoneyTables(spark, scratch_path(spark, "money"), rules)
    t.append({"a": old_a, "b": old_b.filter("tax < 1e9")})
    kept = spark.createDataFrame([(3, Decimal("5.00"))], "k int, amount decimal(12,2)")
    t.append({"a": kept})
    new_files = {path for _, path, is_old in t._folders() if not is_old}
    assert {(r["table_name"], r["column_name"]): (r["n_rows"], r["n_rounded"], r["n_nulled"]) for r in t.migrate().collect()} == {
        ("a", "amount"): (2, 1, 0), ("b", "net"): (1, 1, 0), ("b", "tax"): (1, 0, 0)}
    assert held("a") == as_one and held("b") == [("x", Decimal("7.78"), Decimal("3.00"))]
    assert not any(is_old for _, _, is_old in t._folders()) and new_files < {path for _, path, _ in t._folders()}
    assert t.migrate().count() == 0  # nothing old is left


def test_catalog_csv_key_is_trimmed(spark):
    from tributary.sources.readers import read_catalog_csv
    path = scratch_path(spark, "catalog")
    spark.createDataFrame([("product_id,product_name,category",), (" 7 ,Lamp,Home",)], "value string") \
        .coalesce(1).write.text(path)
    assert read_catalog_csv(spark, path).first()["product_id"] == "7"


def test_speed_layer_runs_both_queries(spark):
    import json
    from tributary.streaming.runner import start_speed_layer
    root = scratch_path(spark, "speed")
    rows = [("t", i, json.dumps({"order_id": f"O{i}", "customer_id": "C", "product_id": "p",
                                  "amount": 1, "order_date": f"2024-01-01 10:0{i}:00"}))
            for i in range(3)]
    spark.createDataFrame(rows, "source string, bronze_id long, payload string").write.json(f"{root}/in")
    store = Store(spark, f"{root}/tables")
    stream = spark.readStream.schema("source string, bronze_id long, payload string").json(f"{root}/in")
    for q in start_speed_layer(spark, stream, store, f"{root}/ck", gold_mode="update",
                               available_now=True):
        q.awaitTermination()
    assert store.silver_state().count() == 3
    assert store.minute_state().count() == 3


def test_concurrent_commits_are_all_kept(spark):
    from concurrent.futures import ThreadPoolExecutor
    from tributary.plans.tables import CommitLog
    log = CommitLog(spark, scratch_path(spark, "log"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: log.commit([("t", i, "increment", f"tag{i}", f"p{i}", 1)]), range(8)))
    assert [r["seq"] for r in log.records("t")] == list(range(8))


def test_commit_log_checkpoint_bounds_reads(spark):
    from tributary.plans.tables import CommitLog
    store = Store(spark, scratch_path(spark, "ckpt"))
    store.log.CHECKPOINT_AFTER = 5
    schema = "k string, v int, stamp int"
    for i in range(8):
        t = KeyedTable(spark, f"{store.root}/t", ["k"], ["k", "v", "stamp"], name="t", log=store.log)
        t.append(spark.createDataFrame([("a", i, i), (f"k{i}", i, i)], schema), f"tag{i}")
    before = sorted(tuple(r) for r in t.read().collect())
    t.compact()
    for _ in range(2):          # a read after >5 recent commits writes a checkpoint
        after = sorted(tuple(r) for r in t.read().collect())
    assert after == before and ("a", 7, 7) in after
    fresh = CommitLog(spark, store.log.path)
    recs = fresh.records("t")
    # Increments folded into the base were pruned from the checkpoint.
    assert [r["kind"] for r in recs] == ["base"]
    t.append(spark.createDataFrame([("a", 99, 99)], schema), "late")
    assert ("a", 99, 99) in [tuple(r) for r in t.read().collect()]


def test_keyed_append_checks_limits_before_commit(spark):
    from tributary.operators.checks import ConstraintViolation
    store = Store(spark, scratch_path(spark, "limits"))
    row = ("x" * 300, "C", "1", Decimal("1.00"), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))
    from tributary.plans.store import SILVER_SCHEMA
    with pytest.raises(ConstraintViolation):
        store.silver.append(spark.createDataFrame([row], SILVER_SCHEMA), "too-long")
    assert store.silver.versions() is None           # nothing became visible
    ok = ("O1",) + row[1:]
    assert store.silver.append(spark.createDataFrame([ok], SILVER_SCHEMA), "ok") == 1


def test_partitioned_keyed_table_and_status_pushdown(spark):
    t = KeyedTable(spark, scratch_path(spark, "part"), ["k"], ["k", "status", "v"],
                   policies={"status": "min"}, partition_by=["status"])
    schema = "k string, status string, v int"
    t.append(spark.createDataFrame([("a", "unprocessed", 1), ("b", "unprocessed", 2)], schema), "i1")
    t.append(spark.createDataFrame([("a", "processed", 1)], schema), "i2")
    t.append(spark.createDataFrame([], schema), "empty")
    got = {r["k"]: r["status"] for r in t.read().collect()}
    assert got == {"a": "processed", "b": "unprocessed"}
    plan = t.versions().filter("status = 'unprocessed'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan
    # The queue is partitioned by status: the filter prunes folders before any file is opened.
    store = Store(spark, scratch_path(spark, "dlqpush"))
    row = [("s", 1, "O1", "C", "1", Decimal("-1.00"), None, "Invalid Amount", "Batch", "unprocessed",
            dt.datetime(2024, 1, 1))]
    from tributary.plans.store import DLQ_SCHEMA
    store.dlq.append(spark.createDataFrame(row, DLQ_SCHEMA), "b1")
    plan = store.dlq.versions().filter("status = 'unprocessed'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan


def test_queue_lookups_prune_partitions_and_files(spark):
    import datetime as dt
    from decimal import Decimal

    from tributary.plans.store import DLQ_SCHEMA, Store
    from tributary.session import scratch_path
    store = Store(spark, scratch_path(spark, "lookup"))
    stamp = dt.datetime(2024, 1, 1)
    assert store.dlq_lookup("unprocessed").count() == 0

    def rows(ids, status, reason="Invalid Amount"):
        return spark.createDataFrame([("s", i, f"O{i}", "C", "1", Decimal(-1), stamp, reason, "Batch", status, stamp) for i in ids], DLQ_SCHEMA)
    store.dlq.append(rows(range(0, 200, 2), "unprocessed"), "a")
    store.dlq.append(rows([], "unprocessed"), "none")
    store.dlq.append(rows([1], "unprocessed", "Missing Order ID"), "b")
    store.dlq.append(rows([4, 8], "processed"), "c")

    def scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.split("\n") if "FileScan" in line]
    for compacted in (False, True):
        if compacted:
            store.dlq.compact()
        assert store.dlq_lookup("unprocessed").count() == 99
        assert sorted(r["id"] for r in store.dlq_lookup("processed").collect()) == [4, 8]
        assert store.dlq_lookup("unprocessed", reason="Missing Order ID").count() == 1
        assert store.dlq_lookup("unprocessed", order_id="O4").count() == 0
        looked = store.dlq_lookup("unprocessed", reason="Invalid Amount")
        assert all("status" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans(looked))
        assert any("EqualTo(error_reason,Invalid Amount)" in line for line in scans(looked))
    # Within the range of the file's order ids, but not in it: the Bloom filter skips the file.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lone = store.dlq.versions().filter("status = 'unprocessed' and order_id = 'O101'")
        qe = lone._jdf.queryExecution()
        assert qe.toRdd().count() == 0
        leaf = qe.executedPlan().collectLeaves().head()
        assert leaf.metrics().apply("numOutputRows").value() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
