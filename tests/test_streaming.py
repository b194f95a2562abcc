import json
from decimal import Decimal

from tributary.plans.store import Store
from tributary.session import scratch_path
from tributary.streaming.gold import clean_stream, minute_stream, start_minute_query
from tributary.streaming.router import start_router

PAYLOAD_SCHEMA = "source string, bronze_id long, payload string"


def _write(spark, inbox, rows, start_id):
    data = [("test", start_id + i,
             json.dumps({"order_id": f"O{start_id + i}", "customer_id": "C", "product_id": p,
                         "amount": a, "order_date": t}))
            for i, (t, p, a) in enumerate(rows)]
    spark.createDataFrame(data, PAYLOAD_SCHEMA).coalesce(1).write.mode("append").json(inbox)


def _minutes(store):
    return {(r["window_start"].strftime("%H:%M"), r["product_id"]): r["total_revenue"]
            for r in store.minute_state().collect()}


def test_late_data_append_mode(spark):
    """Five-minute watermark, one run per file: a row late against the previous
    batch's watermark is dropped from minute gold."""
    root = scratch_path(spark, "late")
    inbox, store = f"{root}/in", Store(spark, f"{root}/tables")
    files = [[("2024-01-01 10:00:10", "p1", 100)],
             [("2024-01-01 10:20:00", "p1", 1)],
             [("2024-01-01 10:21:00", "p1", 5)],
             [("2024-01-01 10:00:50", "p1", 9), ("2024-01-01 10:40:00", "p3", 3)]]
    seen = []
    for i, rows in enumerate(files):
        _write(spark, inbox, rows, 10 * i)
        stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(inbox)
        q = start_minute_query(minute_stream(clean_stream(stream)), store, f"{root}/ck", "late",
                               available_now=True)
        q.awaitTermination()
        seen.append(_minutes(store))
    # Each run ends with a no-data batch once the watermark moved, so the
    # 10:00 window is emitted as soon as file 2 moves the watermark to 10:15.
    assert seen[0] == {}
    assert seen[1] == seen[2] == {("10:00", "p1"): Decimal("100.00")}
    # The 10:00:50 row arrives after the window closed: dropped, not added.
    assert seen[3] == {("10:00", "p1"): Decimal("100.00"), ("10:20", "p1"): Decimal("1.00"),
                       ("10:21", "p1"): Decimal("5.00")}


def test_router_replay_converges(spark, tmp_path):
    root = scratch_path(spark, "router")
    inbox, store = f"{root}/in", Store(spark, f"{root}/tables")
    _write(spark, inbox, [("2024-01-01 10:00:10", "p1", 1500), ("2024-01-01 10:00:20", "p2", -3)], 0)
    cat = spark.createDataFrame([("p1", "Lamp", "Home")], "product_id string, product_name string, category string")
    for i in range(2):  # second run = new checkpoint = full replay
        stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(inbox)
        start_router(stream, store, f"{root}/ck{i}", f"run{i}", catalog=cat,
                     available_now=True).awaitTermination()
    assert store.bronze_state().count() == 2
    assert [r["order_id"] for r in store.silver_state().collect()] == ["O0"]
    assert [r["error_reason"] for r in store.dlq_state().collect()] == ["Invalid Amount"]
    digests = store.alerts.read().collect()
    assert {d["n_orders"] for d in digests} == {1}
    assert "Product: Lamp | Amount: $1,500.00" in digests[0]["lines"]
    assert all(d["local_time"] for d in digests)


def test_update_mode_converges_by_key(spark):
    root = scratch_path(spark, "upd")
    inbox, store = f"{root}/in", Store(spark, f"{root}/tables")
    for i, rows in enumerate([[("2024-01-01 10:00:10", "p1", 1)], [("2024-01-01 10:00:20", "p1", 2)]]):
        _write(spark, inbox, rows, 10 * i)
        stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(inbox)
        start_minute_query(minute_stream(clean_stream(stream)), store, f"{root}/ck", "upd",
                           output_mode="update", available_now=True).awaitTermination()
    assert _minutes(store) == {("10:00", "p1"): Decimal("3.00")}


def test_late_filter_uses_previous_batch_watermark(spark):
    """One run, one file per micro-batch: late rows are judged against the
    watermark of the batch before, so a row two files after its window's
    watermark moved is still counted; three files after, it is dropped."""
    import glob
    import os
    root = scratch_path(spark, "late1")
    inbox, store = f"{root}/in", Store(spark, f"{root}/tables")
    files = [[("2024-01-01 10:00:10", "p1", 100)],
             [("2024-01-01 10:20:00", "p1", 1)],
             [("2024-01-01 10:21:00", "p1", 5), ("2024-01-01 10:00:50", "p1", 9)],
             [("2024-01-01 10:00:55", "p1", 1000), ("2024-01-01 10:40:00", "p3", 3)]]
    for i, rows in enumerate(files):
        _write(spark, f"{inbox}/f{i}", rows, 10 * i)
    # Explicit, increasing modification times fix the file order.
    for i in range(len(files)):
        for f in glob.glob(f"{inbox}/f{i}/*.json"):
            os.utime(f, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    stream = (spark.readStream.schema(PAYLOAD_SCHEMA).option("maxFilesPerTrigger", "1")
              .option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").json(inbox))
    q = start_minute_query(minute_stream(clean_stream(stream)), store, f"{root}/ck", "late1",
                           available_now=True)
    q.awaitTermination()
    assert _minutes(store) == {("10:00", "p1"): Decimal("109.00"), ("10:20", "p1"): Decimal("1.00"),
                               ("10:21", "p1"): Decimal("5.00")}
    from tributary.streaming.gold import dropped_by_watermark
    assert dropped_by_watermark(q) == 1


def test_new_checkpoint_same_run_tag_does_not_overwrite(spark):
    root = scratch_path(spark, "tags")
    store = Store(spark, f"{root}/tables")
    for i in range(2):
        inbox = f"{root}/in{i}"
        _write(spark, inbox, [("2024-01-01 10:00:10", "p1", 1 + i)], 100 * i)
        stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(inbox)
        start_router(stream, store, f"{root}/ck{i}", "same", available_now=True).awaitTermination()
    assert sorted(r["order_id"] for r in store.silver_state().collect()) == ["O0", "O100"]


def test_open_windows_are_read_from_the_state(spark):
    """Emitted minutes and those in state are all minutes; the state holds no emitted one."""
    from tributary.streaming.state import open_minutes
    root = scratch_path(spark, "open")
    inbox, store = f"{root}/in", Store(spark, f"{root}/tables")
    _write(spark, inbox, [("2024-01-01 10:00:10", "p1", 100), ("2024-01-01 10:00:40", "p1", 1)], 0)
    _write(spark, inbox, [("2024-01-01 10:20:00", "p1", 7), ("2024-01-01 10:19:00", "p2", 9)], 10)
    stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(inbox)
    start_minute_query(minute_stream(clean_stream(stream)), store, f"{root}/ck", "open", available_now=True).awaitTermination()
    held = {(r["window_start"].strftime("%H:%M"), r["product_id"]): r["total_revenue"] for r in open_minutes(spark, f"{root}/ck").collect()}
    assert _minutes(store) == {("10:00", "p1"): Decimal("101.00")}
    assert held == {("10:20", "p1"): Decimal("7.00"), ("10:19", "p2"): Decimal("9.00")}


def _messages(spark, path, rows):
    spark.createDataFrame(rows, "source string, bronze_id long, value binary").write.mode("append").parquet(path)


def test_every_message_source_fits_the_router(spark):
    """Kafka's own row schema and message files give the same contract, with checked decoding."""
    from tributary.sources.readers import VALUE_SCHEMA, file_value_stream, kafka_values, payload_stream
    root = scratch_path(spark, "contract")
    sale = json.dumps({"order_id": "K1", "customer_id": "C", "product_id": "p", "amount": 5, "order_date": "2024-01-01 10:00:00"}).encode()
    kafka = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    spark.createDataFrame([(None, sale, "sales", 3, 7, None, 0), (None, None, "sales", 3, 8, None, 0),
                           (None, sale[:-1] + b"\xc3", "sales", 4, 7, None, 0)], kafka).write.parquet(f"{root}/k")
    values = kafka_values(spark.readStream.schema(kafka).parquet(f"{root}/k"))
    _messages(spark, f"{root}/f", [("sales:3", 7, sale)])
    assert values.schema.simpleString() == file_value_stream(spark, f"{root}/f").schema.simpleString() == "struct<source:string,bronze_id:bigint,value:binary>"
    assert VALUE_SCHEMA == "source string, bronze_id long, value binary"
    store = Store(spark, f"{root}/tables")
    for i, stream in enumerate((values, file_value_stream(spark, f"{root}/f"))):  # the file holds a replay of one message
        start_router(payload_stream(stream), store, f"{root}/ck{i}", f"r{i}", available_now=True).awaitTermination()
    got = {(r["source"], r["bronze_id"]): r["payload"] for r in store.bronze_state().collect()}
    assert got == {("sales:3", 7): sale.decode(), ("sales:3", 8): "", ("sales:4", 7): sale[:-1].decode() + "�"}
    assert [r["order_id"] for r in store.silver_state().collect()] == ["K1"]
    assert store.dlq_state().count() == 2


def test_cli_runs_the_speed_layer(spark):
    from tributary.cli import main
    root = scratch_path(spark, "cli-stream")
    sale = {"order_id": "S1", "customer_id": "C", "product_id": "p", "amount": 5000, "order_date": "2024-01-01 10:00:00"}
    _messages(spark, f"{root}/in", [("m", 1, json.dumps(sale).encode()),
                                    ("m", 2, json.dumps({**sale, "order_id": "S2", "order_date": "2024-01-01 11:00:00"}).encode())])
    spark.createDataFrame([("product_id,product_name,category",), ("p,Lamp,Home",)], "value string").coalesce(1).write.text(f"{root}/cat")
    for _ in range(2):   # a second run finds nothing new
        main(["stream", "--root", f"{root}/tables", "--messages", f"{root}/in", "--catalog", f"{root}/cat", "--once"])
    store = Store(spark, f"{root}/tables")
    assert sorted(r["order_id"] for r in store.silver_state().collect()) == ["S1", "S2"]
    assert _minutes(store) == {("10:00", "p"): Decimal("5000.00")}
    alert = store.alerts.read().first()
    assert alert["n_orders"] == 2 and "Batch: 0\nTime: " in alert["message"] and "Lamp" in alert["message"]


def test_a_failing_query_ends_the_run_with_its_error(spark):
    import pytest
    from tributary.streaming.runner import run_to_the_end
    root = scratch_path(spark, "failing")
    _write(spark, f"{root}/in", [("2024-01-01 10:00:10", "p1", 1)], 0)
    stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(f"{root}/in")

    def bad(batch, batch_id):
        raise RuntimeError("sink is down")
    fails = stream.writeStream.foreachBatch(bad).option("checkpointLocation", f"{root}/a").start()
    goes_on = stream.writeStream.foreachBatch(lambda b, i: None).option("checkpointLocation", f"{root}/b").start()
    with pytest.raises(Exception, match="sink is down"):
        run_to_the_end([fails, goes_on])
    assert not goes_on.isActive


def test_a_failing_query_ends_the_application_and_is_reported(spark):
    """Two queries under a running trigger, the second fails on its second file."""
    import pytest
    from pyspark.errors import StreamingQueryException
    from tributary.streaming.progress import Progress, supervise
    root, progress = scratch_path(spark, "supervised"), Progress(keep=3)
    inbox, store = f"{root}/in", Store(spark, f"{root}/tables")
    _write(spark, inbox, [("2024-01-01 10:00:10", "p1", 1), ("2024-01-01 10:00:20", "p1", 2)], 0)
    stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(inbox)

    def fails_later(batch, batch_id):
        if batch_id:
            raise ValueError("sink is gone")
        batch.write.mode("append").parquet(f"{root}/out")
    spark.streams.addListener(progress)
    try:
        good = start_minute_query(minute_stream(clean_stream(stream)), store, f"{root}/ck", "good",
                                  processing_time="200 milliseconds", query_name="good")
        bad = (stream.writeStream.foreachBatch(fails_later).option("checkpointLocation", f"{root}/ck2")
               .trigger(processingTime="200 milliseconds").queryName("bad").start())
        for query in (good, bad):
            query.processAllAvailable()
            assert progress.seen(query) == 2
        _write(spark, inbox, [("2024-01-01 10:01:10", "p1", 3)], 10)
        with pytest.raises(StreamingQueryException, match="sink is gone"):
            supervise([good, bad], poll=0.1)
        assert not good.isActive and not bad.isActive
        with progress._changed:
            assert progress._changed.wait_for(lambda: "bad" in progress.failures, 30)
        assert "sink is gone" in progress.failures["bad"] and "good" not in progress.failures
        assert len(progress.batches) <= 3 and progress.rows["bad"] == 2
    finally:
        spark.streams.removeListener(progress)


def test_alert_inbox_is_smaller_than_its_payloads(spark, monkeypatch, tmp_path):
    """What arrives is written compressed (F3)."""
    import os

    from tributary.streaming import registry
    spark.range(300).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id % 7 AS l_partkey", "1 AS l_suppkey", "1.0D AS l_quantity", "0.0D AS l_discount",
        "0.0D AS l_tax", "CAST(900 + id AS DOUBLE) AS l_extendedprice", "DATE '2024-01-01' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(300).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(7).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "'t' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    row = registry.q_stream_alert_digest(spark, str(tmp_path)).first()
    assert (row["n_orders"], row["n_listed"], row["n_more"]) == (199, 15, 184)
    inbox = [os.path.join(folder, f) for folder, _, files in os.walk(f"{tmp_path}/alerts/inbox") for f in files if f.startswith("part-")]
    bronze = spark.read.parquet(*[folder for folder, _, files in os.walk(f"{tmp_path}/alerts/tables/bronze") if any(f.endswith(".parquet") for f in files)])
    assert bronze.count() == 300
    assert sum(map(os.path.getsize, inbox)) < bronze.selectExpr("sum(length(payload))").first()[0]
