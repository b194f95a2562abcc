import datetime as dt
from decimal import Decimal

import pytest

from pyspark.sql import functions as F
from tributary.plans.batch import ingest_landing, run_batch
from tributary.plans.recovery import recover_dlq
from tributary.plans.store import DLQ_SCHEMA, MINUTE_SCHEMA, SILVER_SCHEMA, Store
from tributary.session import scratch_path
from tributary.sources.readers import read_landing_csv

T = dt.datetime(2024, 1, 1, 10, 0, 10)
STAMP = dt.datetime(2000, 1, 1)


def _csv(spark, header, rows):
    path = scratch_path(spark, "landing")
    lines = [header] + rows
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.text(path)
    return path


def test_landing_header_is_matched_by_name(spark):
    good = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                ["O1,5,C1,10.50,2024-01-01 10:00:00"])
    assert read_landing_csv(spark, good).first()["customer_id"] == "C1"
    swapped = _csv(spark, "order_id,customer_id,product_id,amount,timestamp",
                   ["O1,C1,5,10.50,2024-01-01 10:00:00"])
    with pytest.raises(Exception):
        read_landing_csv(spark, swapped).collect()


def test_batch_job_is_rerunnable(spark):
    path = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                ["O1,5,C1,10.50,2024-01-01 10:00:00", "O1,5,C1,99.00,2024-01-01 11:00:00",
                 "O2,6,,3.00,2024-01-01 10:00:00", "O3,7,C3,-2.00,2024-01-02 10:00:00",
                 "O4,8,C4,1.00,not a date"])
    store = Store(spark, scratch_path(spark, "store"))
    ingest_landing(spark, store, path, "l1")
    first = run_batch(spark, store, "r1").first()
    assert (first["bronze_rows"], first["silver_new_rows"], first["dlq_new_rows"]) == (5, 2, 2)
    assert first["null_date_groups"] == 1
    second = run_batch(spark, store, "r2").first()
    assert (second["silver_new_rows"], second["dlq_new_rows"]) == (0, 0)
    # In-batch duplicate: the first source position wins (insert-if-absent).
    assert store.silver_state().filter("order_id = 'O1'").first()["amount"] == Decimal("10.50")
    daily = {(r["report_date"], r["product_id"]): r["total_revenue"] for r in store.daily.read().collect()}
    assert daily == {(dt.date(2024, 1, 1), "5"): Decimal("10.50")}


def _recovery_store(spark):
    store = Store(spark, scratch_path(spark, "rec"))
    store.silver.append(spark.createDataFrame(
        [("O1", "C1", "1", Decimal("100.00"), T, STAMP)], SILVER_SCHEMA), "seed")
    store.minute.append(spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 1), "1", Decimal("100.00"), STAMP)],
        MINUTE_SCHEMA), "seed")
    refund = ("O2", "C2", "1", Decimal("-20.00"), T.replace(second=30), "Invalid Amount")
    no_product = ("O3", "C3", None, Decimal("-5.00"), T, "Invalid Amount")
    rows = [("stream", 1, *refund, "Streaming", "unprocessed", STAMP),
            ("landing:x", 7, *refund, "Batch", "unprocessed", STAMP),      # F3: second copy
            ("stream", 2, *no_product, "Streaming", "unprocessed", STAMP),  # F2
            ("stream", 3, "O4", None, "1", Decimal("1.00"), T, "Missing Customer ID", "Streaming",
             "unprocessed", STAMP)]
    store.dlq.append(spark.createDataFrame(rows, DLQ_SCHEMA), "seed")
    return store


@pytest.mark.parametrize("mode,total", [("recompute", Decimal("80.00")), ("replace", Decimal("-20.00"))])
def test_recovery_modes(spark, mode, total):
    store = _recovery_store(spark)
    report = recover_dlq(spark, store, "r1", mode=mode).first()
    assert report["dlq_marked"] == 2 and report["silver_rows"] == 1
    minute = store.minute_state().first()
    assert minute["total_revenue"] == total and minute["created_at"] == STAMP
    status = {(r["source"], r["id"]): r["status"] for r in store.dlq_state().collect()}
    assert status == {("stream", 1): "processed", ("landing:x", 7): "processed",
                      ("stream", 2): "unprocessed", ("stream", 3): "unprocessed"}
    # A second pass finds nothing left to replay.
    assert recover_dlq(spark, store, "r2", mode=mode).first()["dlq_marked"] == 0
    assert store.silver_state().count() == 2


def test_incremental_batch_reads_only_new_bronze(spark):
    path1 = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                 ["O1,5,C1,10.00,2024-01-01 10:00:00"])
    path2 = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                 ["O2,5,C2,5.00,2024-01-01 11:00:00", "O1,5,C1,77.00,2024-01-01 12:00:00"])
    store = Store(spark, scratch_path(spark, "inc"))
    ingest_landing(spark, store, path1, "l1")
    assert run_batch(spark, store, "r1").first()["bronze_rows"] == 1
    assert run_batch(spark, store, "r2").first()["bronze_rows"] == 0      # nothing new
    ingest_landing(spark, store, path2, "l2")
    rep = run_batch(spark, store, "r3").first()
    assert (rep["bronze_rows"], rep["silver_new_rows"]) == (2, 1)         # O1 already in Silver
    daily = store.daily.read().first()
    assert daily["total_revenue"] == Decimal("15.00")


def test_incremental_daily_equals_full_recompute(spark):
    from tributary.operators.gold import daily_revenue, publishable_daily
    from tributary.plans.daily import refresh_daily
    store = Store(spark, scratch_path(spark, "daily"))
    d1, d2, d3 = (dt.datetime(2024, 1, d, 10) for d in (1, 2, 3))
    rows = [("O1", "C", "1", Decimal("10.00"), d1, STAMP), ("O2", "C", "1", Decimal("5.00"), d2, STAMP),
            ("O3", "C", "2", Decimal("7.00"), d3, STAMP), ("O4", "C", "2", Decimal("1.00"), None, STAMP)]
    store.silver.append(spark.createDataFrame(rows, SILVER_SCHEMA), "s1")
    refresh_daily(spark, store, "v1")
    seen = store.silver.live()
    # O1 moves from day 1 to day 3 with a new amount; O5 is new on day 2.
    store.silver.append(spark.createDataFrame(
        [("O1", "C", "2", Decimal("3.00"), d3, STAMP), ("O5", "C", "1", Decimal("2.00"), d2, STAMP)],
        SILVER_SCHEMA), "s2")
    refresh_daily(spark, store, "v2", seen=seen)
    got = sorted(tuple(r) for r in store.daily.read().collect())
    full = sorted(tuple(r) for r in publishable_daily(daily_revenue(store.silver.read())).collect())
    assert got == full
    assert (dt.date(2024, 1, 1), "1", Decimal("10.00")) not in got
    # Nothing new: the published version stays.
    v = store.daily.version()
    assert refresh_daily(spark, store, "v3", seen=store.silver.live()) == v


def test_landing_reingest_same_load_is_idempotent(spark):
    path = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                ["O1,5,C1,10.00,2024-01-01 10:00:00", "O2,5,C1,1.00,2024-01-01 10:00:00"])
    store = Store(spark, scratch_path(spark, "reingest"))
    assert ingest_landing(spark, store, path, "l1") == 2
    assert ingest_landing(spark, store, path, "l1") == 2     # retry of the same load
    assert store.bronze_state().count() == 2


def test_append_all_dlq_copies_are_recovered_once(spark):
    path = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                ["O1,5,C1,-7.00,2024-01-01 10:00:00", "O2,5,C1,3.00,2024-01-01 10:00:30"])
    store = Store(spark, scratch_path(spark, "appendall"))
    ingest_landing(spark, store, path, "l1")
    run_batch(spark, store, "r1", dlq_mode="append_all", incremental=False)
    run_batch(spark, store, "r2", dlq_mode="append_all", incremental=False)
    assert store.dlq_state().count() == 2                       # the same error twice (D3)
    rep = recover_dlq(spark, store, "rec", mode="recompute").first()
    assert (rep["silver_rows"], rep["dlq_marked"]) == (1, 2)     # one refund, both copies closed
    assert store.minute_state().first()["total_revenue"] == Decimal("-4.00")   # 3 - 7, not 3 - 14


def test_chain_creates_catalog_once(spark):
    from tributary.plans.batch import run_chain
    sales = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                 ["O1,5,C1,10.00,2024-01-01 10:00:00"])
    cat1 = _csv(spark, "product_id,product_name,category", ["5,Lamp,Home"])
    cat2 = _csv(spark, "product_id,product_name,category", ["5,Other,Home"])
    store = Store(spark, scratch_path(spark, "chain"))
    run_chain(spark, store, sales, "r1", catalog_csv=cat1)
    run_chain(spark, store, sales, "r2", catalog_csv=cat2)
    assert [r["product_name"] for r in store.catalog.read().collect()] == ["Lamp"]


def test_jobs_raise_instead_of_swallowing(spark):
    # F8: a scheduler must see failures, so bad input or settings raise.
    store = Store(spark, scratch_path(spark, "raise"))
    with pytest.raises(ValueError):
        recover_dlq(spark, store, "r", mode="bogus")
    path = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                ["O1,5,C1,1.00,2024-01-01 10:00:00"])
    ingest_landing(spark, store, path, "l1")
    with pytest.raises(ValueError):
        run_batch(spark, store, "r1", dlq_mode="bogus")
    bad_header = _csv(spark, "id,product_id,customer_id,amount,timestamp", ["O1,5,C1,1.00,x"])
    with pytest.raises(Exception):
        ingest_landing(spark, store, bad_header, "l2")


def test_cli_runs_the_scheduled_jobs(spark, tmp_path):
    import subprocess
    import sys
    from pathlib import Path
    repo = Path(__file__).resolve().parents[1]
    csv = _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
               ["O1,5,C1,10.00,2024-01-01 10:00:00", "O2,5,C1,-2.00,2024-01-01 10:00:30"])
    root = str(tmp_path / "store")

    def cli(*args):
        out = subprocess.run([sys.executable, "-m", "tributary.cli", *args, "--root", root],
                             cwd=repo, capture_output=True, text=True, timeout=600)
        assert out.returncode == 0, out.stderr[-2000:]
        return out.stdout

    assert cli("ingest", "--csv", csv, "--load-id", "l1").strip().endswith("2")
    assert "silver_new_rows" in cli("batch", "--run-id", "r1")
    assert "dlq_marked" in cli("recover", "--run-id", "x1")
    bad = subprocess.run([sys.executable, "-m", "tributary.cli", "recover", "--run-id", "x2",
                          "--mode", "bogus", "--root", root], cwd=repo, capture_output=True,
                         text=True, timeout=600)
    assert bad.returncode != 0
    store = Store(spark, root)
    assert store.silver_state().count() == 2          # O1 clean + O2 recovered refund


def test_review_queue_and_marks_use_source_and_id(spark):
    from tributary.functions.quality import INVALID_AMOUNT, MISSING_CUSTOMER
    from tributary.operators.dlq import recoverable_rows, review_queue
    from tributary.operators.merge import mark_processed
    dlq = spark.createDataFrame(
        [("north", 4, "x1", "p", INVALID_AMOUNT, "unprocessed"), ("south", 4, "x2", "p", MISSING_CUSTOMER, "unprocessed"),
         ("south", 5, "x3", None, INVALID_AMOUNT, "unprocessed"), ("south", 6, "x4", "p", None, "processed")],
        "source string, id long, order_id string, product_id string, error_reason string, status string")
    assert {(r["source"], r["id"]) for r in review_queue(dlq).collect()} == {("south", 4), ("south", 5)}
    marked = mark_processed(dlq, recoverable_rows(dlq)).collect()
    assert {(r["source"], r["id"]) for r in marked if r["status"] == "processed"} == {("north", 4), ("south", 6)}


def test_an_empty_retry_takes_nothing_back_and_a_corrected_one_counts(spark):
    from tributary.plans.tables import KeyedTable
    from tributary.session import scratch_path
    t = KeyedTable(spark, scratch_path(spark, "retry"), ["k"], ["k", "v"])
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v long")
    t.append(rows(("a", 1), ("b", 2)), tag="run-1")
    seen = t.live()
    assert t.append(rows(), tag="run-1") == 0
    assert {tuple(r) for r in t.read().select("k", "v").collect()} == {("a", 1), ("b", 2)}
    t.append(rows(("a", 10)), tag="run-1")
    assert {tuple(r) for r in t.read().select("k", "v").collect()} == {("a", 10), ("b", 2)}
    assert t.versions_since(seen)[0].count() == 1


def _kv_table(spark, name):
    from tributary.plans.tables import KeyedTable
    from tributary.session import scratch_path
    return KeyedTable(spark, scratch_path(spark, name), ["k"], ["k", "v"])


def _kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v long")


def test_a_commit_left_open_over_a_compaction_is_kept(spark):
    from tributary.plans.tables import Transaction
    t = _kv_table(spark, "open")
    t.append(_kv(spark, ("a", 1)), tag="one")
    with Transaction(t.log) as slow:
        t.append(_kv(spark, ("slow", 7), ("a", 2), ("b", 2)), tag="slow", tx=slow)   # lower number
        t.append(_kv(spark, ("b", 3)), tag="two")
        seen = t.live()
        assert t.compact() == 2
    state = {("a", 2), ("b", 3), ("slow", 7)}
    assert {tuple(r) for r in t.read().collect()} == state
    new, now = t.versions_since(seen)
    assert {r["k"] for r in new.collect()} == {"a", "b", "slow"}     # the late commit alone, no base
    t.compact()
    assert len(t.live()) == 1 and {tuple(r) for r in t.read().collect()} == state
    assert t.versions_since(now)[0] is None
    assert t.compact() == 0
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan        # a lone base is only scanned


def test_two_compactions_at_once_hold_each_row(spark):
    t = _kv_table(spark, "twice")
    t.append(_kv(spark, ("a", 1)), tag="one")
    t.append(_kv(spark, ("a", 2)), tag="two")
    live = t.live
    before = live()
    t.compact()
    t.live = lambda: before          # the second compaction listed before the first committed
    t.compact()
    t.live = live
    assert [tuple(r) for r in t.read().collect()] == [("a", 2)]


def test_late_bronze_commit_reaches_silver_and_daily_gold(spark):
    csv = lambda key, day: _csv(spark, "order_id,product_id,customer_id,amount,timestamp",
                                [f"{key},5,C1,10.00,2024-01-{day} 10:00:00"])
    store = Store(spark, scratch_path(spark, "late"))
    ingest_landing(spark, store, csv("FIRST", "01"), "l0")
    run_batch(spark, store, "r0")
    with store.transaction() as slow:
        append = store.bronze.append
        store.bronze.append = lambda df, tag: append(df, tag, tx=slow)
        ingest_landing(spark, store, csv("SLOW", "02"), "l1")
        store.bronze.append = append
        ingest_landing(spark, store, csv("FAST", "03"), "l2")
        assert run_batch(spark, store, "r1").first()["silver_new_rows"] == 1
    assert run_batch(spark, store, "r2").first()["silver_new_rows"] == 1
    assert {r["order_id"] for r in store.silver_state().collect()} == {"FIRST", "SLOW", "FAST"}
    assert store.daily.read().count() == 3


@pytest.mark.parametrize("mode", ["recompute", "replace"])
def test_refund_that_moves_a_sale_leaves_its_minute(spark, mode):
    """The refund of O1 lies in a later minute: the old window is emptied, and that of the
    moved refund of O5 keeps its other sale."""
    from tributary.operators.gold import minute_revenue
    store = Store(spark, scratch_path(spark, "moved"))
    later = T.replace(minute=7)
    sales = [("O1", "C1", "1", Decimal("100.00"), T, STAMP), ("O5", "C1", "2", Decimal("8.00"), T, STAMP),
             ("O6", "C1", "2", Decimal("5.00"), T, STAMP)]
    store.silver.append(spark.createDataFrame(sales, SILVER_SCHEMA), "seed")
    store.minute.append(minute_revenue(store.silver_state()).withColumn("created_at", F.lit(STAMP).cast("timestamp_ntz")), "seed")
    refunds = [("stream", 1, "O1", "C1", "1", Decimal("-99.99"), later, "Invalid Amount", "Streaming", "unprocessed", STAMP),
               ("stream", 2, "O5", "C1", "3", Decimal("-8.00"), None, "Invalid Amount", "Streaming", "unprocessed", STAMP)]
    store.dlq.append(spark.createDataFrame(refunds, DLQ_SCHEMA), "seed")
    recover_dlq(spark, store, "r1", mode=mode)
    got = {(r["window_start"], r["product_id"]): r["total_revenue"] for r in store.minute_state().collect()}
    fresh = {(r["window_start"], r["product_id"]): r["total_revenue"] for r in minute_revenue(store.silver_state()).collect()}
    if mode == "recompute":
        assert got == fresh == {(later.replace(second=0), "1"): Decimal("-99.99"), (T.replace(second=0), "2"): Decimal("5.00")}
    store.minute.compact()      # a retraction survives compaction
    assert got == {(r["window_start"], r["product_id"]): r["total_revenue"] for r in store.minute_state().collect()}


def test_signed_deltas_equal_a_recompute(spark):
    """Random inserts, updates, moves and repeated changes; deltas applied to gold equal gold of the new state."""
    import random

    from tributary.operators import deltas, merge
    from tributary.operators.gold import minute_revenue
    rng = random.Random(11)
    schema = "order_id string, customer_id string, product_id string, amount decimal(12,2), order_date timestamp_ntz"

    def sale(key):
        time = None if rng.random() < .1 else T.replace(minute=rng.randrange(4), second=rng.randrange(60))
        return (key, "c", rng.choice("pq"), Decimal(rng.randrange(-300, 300)) / 100, time)
    target = spark.createDataFrame([sale(f"k{i}") for i in range(40)], schema)
    changes = spark.createDataFrame([sale(f"k{rng.randrange(60)}") for _ in range(50)], schema)
    feed = deltas.change_feed(target, changes, ["order_id"], ["order_date"])
    after = deltas.apply_minute_deltas(minute_revenue(target, counted=True), deltas.minute_deltas(feed))
    wanted = minute_revenue(merge.upsert(target, changes, ["order_id"], ["order_date"]), counted=True)
    assert sorted(map(str, after.collect())) == sorted(map(str, wanted.collect()))
    assert deltas.minute_deltas(deltas.change_feed(target, target, ["order_id"], ["order_date"])).count() == 0


def test_one_landing_load_is_scanned_and_a_second_is_merged(spark):
    """Rows whose keys cannot repeat are not grouped by them again (F2)."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    csv = lambda *rows: _csv(spark, "order_id,product_id,customer_id,amount,timestamp", list(rows))
    store = Store(spark, scratch_path(spark, "unique"))
    ingest_landing(spark, store, csv("O1,5,C1,-7.00,2024-01-01 10:00:00", "O2,5,C1,3.00,2024-01-01 10:00:30",
                                     "O2,5,C1,4.00,2024-01-01 10:00:40"), "l1")
    assert "Aggregate" not in plan(store.bronze_state()) and store.bronze_state().count() == 3
    run_batch(spark, store, "r1")
    assert run_batch(spark, store, "r2", incremental=False).first()["silver_new_rows"] == 0
    # an empty increment takes nothing away
    for state in (store.silver_state(), store.dlq_state(), store.silver.keys(), store.silver.read_touching(F.lit(True))):
        assert "Aggregate" not in plan(state) and state.count() == 1
    ingest_landing(spark, store, csv("O1,5,C1,-7.00,2024-01-01 10:00:00", "O2,5,C1,9.00,2024-01-01 10:00:30",
                                     "O2,5,C1,4.00,2024-01-01 10:00:40"), "l1")
    assert store.bronze_state().count() == 3
    assert store.bronze_state().filter("payload LIKE '%9.00%'").count() == 1
    assert recover_dlq(spark, store, "rec").first()["silver_rows"] == 1
    assert {r["order_id"]: r["amount"] for r in store.silver_state().collect()} == {"O1": Decimal("-7.00"), "O2": Decimal("3.00")}
    assert [r["status"] for r in store.dlq_state().collect()] == ["processed"]
