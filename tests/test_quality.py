from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions.payload import parse_columns
from tributary.functions.quality import (
    INVALID_AMOUNT, MISSING_CUSTOMER, MISSING_ORDER, MISSING_PRODUCT, SCHEMA_MISMATCH,
)
from tributary.operators.quality import split_quality


def reasons(error):
    return [r["error_reason"] for r in error.collect()]


GOOD = {"order_id": "ord-7f", "customer_id": "buyer-12", "product_id": "sku-3", "amount": 18.25,
        "order_date": "2021-03-04 17:45:09"}
#: What differs from GOOD, the label the original gives, the label its documentation promises.
CASES = [
    ({}, None, None),
    ({"customer_id": ""}, None, None),
    ({"order_date": "4 March"}, None, None),
    ({"order_date": None}, None, None),
    ({"product_id": "\t"}, None, None),
    ({"product_id": "  sku-3   "}, None, None),
    ({"customer_id": None}, MISSING_CUSTOMER, MISSING_CUSTOMER),
    ({"customer_id": None, "amount": -1.0, "order_id": "", "product_id": None}, MISSING_CUSTOMER, MISSING_CUSTOMER),
    ({"amount": 0.0}, INVALID_AMOUNT, INVALID_AMOUNT),
    ({"amount": -0.5, "order_id": ""}, INVALID_AMOUNT, INVALID_AMOUNT),
    ({"order_id": "", "product_id": ""}, MISSING_ORDER, MISSING_ORDER),
    ({"product_id": None}, MISSING_PRODUCT, MISSING_PRODUCT),
    ({"product_id": "    "}, MISSING_PRODUCT, MISSING_PRODUCT),
    ({"product_id": "", "amount": None}, MISSING_PRODUCT, INVALID_AMOUNT),
    ({"amount": None}, SCHEMA_MISMATCH, INVALID_AMOUNT),
    ({"order_id": None}, SCHEMA_MISMATCH, MISSING_ORDER),
    ({"order_id": None, "amount": None}, SCHEMA_MISMATCH, INVALID_AMOUNT),
]


def case_rows(make_events):
    return make_events([tuple({**GOOD, **change}.values()) for change, _, _ in CASES])


def test_every_rule_and_its_precedence(make_events):
    for policy, at in (("code", 1), ("documented", 2)):
        clean, error = split_quality(case_rows(make_events), "Batch", reason_policy=policy)
        assert Counter(reasons(error)) == Counter(c[at] for c in CASES if c[at])
        assert clean.count() == sum(c[at] is None for c in CASES)


def test_rows_are_routed_one_by_one(make_events):
    for change, code, documented in CASES:
        row = make_events([tuple({**GOOD, **change}.values())])
        for policy, label in (("code", code), ("documented", documented)):
            clean, error = split_quality(row, "Streaming", reason_policy=policy)
            got = [(r["error_reason"], r["source_type"]) for r in error.collect()]
            assert got == ([(label, "Streaming")] if label else [])
            if policy == "code" and not label:
                kept = clean.first()
                assert kept["product_id"] == (change.get("product_id") or "sku-3").strip(" ")
                assert kept["amount"] == Decimal("18.25")
                assert (kept["order_date"] is None) == ("order_date" in change)


def test_money_type_on_both_sides(make_events):
    for df in split_quality(case_rows(make_events), "Batch"):
        assert dict(df.dtypes)["amount"] == "decimal(12,2)"


def test_double_rounding_happens_after_the_check(spark):
    from sales_inputs import DOUBLE_EVENTS
    df = spark.createDataFrame([("ord-1", "buyer-1", "sku-1", 0.004, "2021-03-04 00:00:00")], DOUBLE_EVENTS)
    clean, error = split_quality(df, "Batch")
    assert error.count() == 0 and clean.first()["amount"] == Decimal("0.00")


def test_payload_parse_semantics(spark):
    rows = [(1, '{"order_id":"O1","customer_id":"C","product_id":5,"amount":"12.5","order_date":"2024-01-01 00:00:00"}'),
            (2, '{"order_id":"O2","customer_id":"C","product_id":"5","amount":"abc"}'),
            (3, '{"order_id":"O3","cust'),
            (4, None),
            (5, '{"ORDER_ID":"O5","customer_id":"C","product_id":"5","amount":1}')]
    parsed = parse_columns(spark.createDataFrame(rows, "bronze_id long, payload string"), ["bronze_id"])
    clean, error = split_quality(parsed, "Batch")
    assert [(r["bronze_id"], r["amount"], r["product_id"]) for r in clean.collect()] == \
        [(1, Decimal("12.50"), "5")]
    got = {r["bronze_id"]: r["error_reason"] for r in error.collect()}
    assert got == {2: SCHEMA_MISMATCH, 3: MISSING_CUSTOMER, 4: MISSING_CUSTOMER, 5: SCHEMA_MISMATCH}


text = st.one_of(st.none(), st.sampled_from(["", " ", "  ", "a", " b ", "\t"]))
amount = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.004, 1.5, 1e13, float("nan")]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(text, text, text, amount), min_size=1, max_size=30))
def test_split_is_a_partition(spark, rows):
    from sales_inputs import DOUBLE_EVENTS
    data = [(o, c, p, a, "2024-01-01 00:00:00") for o, c, p, a in rows]
    df = spark.createDataFrame(data, DOUBLE_EVENTS).withColumn("rid", F.monotonically_increasing_id())
    clean, error = split_quality(df, "Batch")
    c_ids = {r["rid"] for r in clean.select("rid").collect()}
    e_ids = {r["rid"] for r in error.select("rid").collect()}
    assert not (c_ids & e_ids)
    assert len(c_ids) + len(e_ids) == len(data)


def test_optional_date_rules(make_events):
    import datetime as dt
    from tributary.functions.quality import INVALID_DATE
    from tributary.operators.quality import route_quality
    df = make_events([("no-date", "b", "s", 3.5, "soon"), ("far", "b", "s", 3.5, "2150-06-01 00:00:00"),
                      ("far-anonymous", None, "s", 3.5, "2150-06-01 00:00:00"),
                      ("today", "b", "s", 3.5, "2024-01-01 08:00:00")])
    now = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")
    off = {r["order_id"]: r["error_reason"] for r in route_quality(df, "Batch").collect()}
    assert off == {"no-date": None, "far": None, "far-anonymous": MISSING_CUSTOMER, "today": None}
    on = {r["order_id"]: r["error_reason"] for r in
          route_quality(df, "Batch", reject_null_date=True, max_future="1 day", now=now).collect()}
    assert on == {"no-date": INVALID_DATE, "far": INVALID_DATE, "far-anonymous": MISSING_CUSTOMER, "today": None}


def test_null_payload_goes_to_dlq_not_lost(spark):
    # A tombstone (NULL payload) is kept in Bronze and routed to the DLQ.
    parsed = parse_columns(spark.createDataFrame([(1, None)], "bronze_id long, payload string"),
                           ["bronze_id"])
    clean, error = split_quality(parsed, "Streaming")
    assert clean.count() == 0 and reasons(error) == [MISSING_CUSTOMER]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_event_times_with_a_zone_are_instants(spark, zone):
    import datetime as dt

    from tributary.functions.quality import event_time
    cases = {"2024-01-01T10:00:00+07:00": dt.datetime(2024, 1, 1, 3), "2024-01-01 10:00:00.25Z": dt.datetime(2024, 1, 1, 10, 0, 0, 250000),
             "2024-01-01T10:00Z": None, "2024-06-01 10:00:00 Europe/Paris": dt.datetime(2024, 6, 1, 8),
             "2024-1-1 1:0:0-02:00": dt.datetime(2024, 1, 1, 3), "1969-12-31T23:59:59.5+00:00": dt.datetime(1969, 12, 31, 23, 59, 59, 500000),
             "2024-01-01 10:00:00": dt.datetime(2024, 1, 1, 10), "2024-01-01": dt.datetime(2024, 1, 1), "2024-01-01T10:00:00.123456": dt.datetime(2024, 1, 1, 10, 0, 0, 123456),
             "not a date, surely": None, "not a date": None, "": None, None: None}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", event_time("t").alias("e")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r["t"]: r["e"] for r in rows} == cases
