import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tributary.operators.alerts import alert_digest, enrich, high_value

SCHEMA = "order_id string, product_id string, amount decimal(12,2), order_date timestamp_ntz"


def test_digest_lists_top_15_and_counts_the_rest(spark):
    rows = [(f"O{i:02d}", "1", Decimal(1000 + i), dt.datetime(2024, 1, 1)) for i in range(1, 21)]
    rows.append(("O99", "1", Decimal("1000.00"), dt.datetime(2024, 1, 1)))  # not > 1000
    cat = spark.createDataFrame([("1", "Lamp", "Home")], "product_id string, product_name string, category string")
    hv = enrich(high_value(spark.createDataFrame(rows, SCHEMA)), cat)
    d = alert_digest(hv).first()
    assert (d["n_orders"], d["n_listed"], d["n_more"]) == (20, 15, 5)
    lines = d["lines"].split("\n")
    assert lines[0] == "Order: O20 | Product: Lamp | Amount: $1,020.00"
    assert len(lines) == 15
    assert "... and 5 more high-value orders in this batch." in d["message"]


def test_unknown_and_duplicated_catalog(spark):
    events = spark.createDataFrame([("O1", "1", Decimal("1.00"), None), ("O2", "2", Decimal("2.00"), None)], SCHEMA)
    cat = spark.createDataFrame([("1", "A", "x"), ("1", "B", "y"), ("2", "", "z")],
                                "product_id string, product_name string, category string")
    out = enrich(events, cat)
    assert out.count() == 2  # a duplicated catalog key does not fan out
    assert out.agg(F.sum("amount")).first()[0] == Decimal("3.00")
    d = alert_digest(out.withColumn("d", F.lit(1)), ["d"]).first()
    assert "Product: Unknown Product" in d["lines"]


def test_empty_batch_has_no_digest(spark):
    empty = spark.createDataFrame([], SCHEMA + ", product_name string")
    assert alert_digest(empty).count() == 0


def test_top_k_parts_merge_to_the_whole(spark, monkeypatch):
    """Small parts, a hot group, ties and nulls: the same digest as sorting every row."""
    import random

    from tributary.operators import alerts
    monkeypatch.setattr(alerts, "HELD_ROWS", 4)
    rng = random.Random(2)
    rows = [(rng.choice([None, "O1", "O2", f"O{i}"]), rng.choice(["1", "2", None]), Decimal(rng.randrange(1, 30)), dt.datetime(2024, 1, rng.choice([1, 1, 1, 2, 3])))
            for i in range(300)]
    events = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("d", F.to_date("order_date"))
    cat = spark.createDataFrame([("1", "Lamp", "Home")], "product_id string, product_name string, category string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = {r["d"].day: r for r in alert_digest(events, ["d"], limit=4, catalog=cat).collect()}
        whole = alert_digest(events, limit=4, catalog=cat, batch=F.lit(7), at=F.lit("noon")).first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

    def lines(mine):
        best = sorted(mine, key=lambda r: (-r[2], r[0] or "", r[1] or ""))[:4]
        return "\n".join(f"Order: {o or ''} | Product: {'Lamp' if p == '1' else 'Unknown Product'} | Amount: ${a:.2f}" for o, p, a, _ in best)
    for day in (1, 2, 3):
        mine = [r for r in rows if r[3].day == day]
        assert (got[day]["n_orders"], got[day]["lines"]) == (len(mine), lines(mine))
    assert (whole["n_orders"], whole["lines"]) == (300, lines(rows))
    assert "Batch: 7\nTime: noon\nOrders: 300" in whole["message"]
    plan = alert_digest(events, ["d"], catalog=cat)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
