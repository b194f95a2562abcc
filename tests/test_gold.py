import datetime as dt
from decimal import Decimal

import pytest

from tributary.operators.gold import daily_revenue, minute_revenue, publishable_daily, reconcile
from tributary.operators.quality import split_quality


#: Two products around a midnight and around a minute's end: time, product, cents.
SALES = [("2019-12-31 23:58:59", "tea", 199), ("2019-12-31 23:58:59.9", "tea", 1), ("2019-12-31 23:59:00", "tea", 350),
         ("2019-12-31 23:59:59", "cup", 1275), ("2020-01-01 00:00:00", "cup", 425), ("2020-01-01 00:00:30", "cup", 75),
         ("2020-01-01 00:00:59", "tea", 600)]


def sales(make_events):
    rows = [(f"s{i}", f"buyer{i % 3}", p, cents / 100, t) for i, (t, p, cents) in enumerate(SALES)]
    return split_quality(make_events(rows), "Batch")[0]


def test_daily_sums_per_day_and_product(make_events):
    got = {(str(r["report_date"]), r["product_id"]): r["total_revenue"] for r in daily_revenue(sales(make_events)).collect()}
    assert got == {("2019-12-31", "tea"): Decimal("5.50"), ("2019-12-31", "cup"): Decimal("12.75"),
                   ("2020-01-01", "cup"): Decimal("5.00"), ("2020-01-01", "tea"): Decimal("6.00")}


def test_minute_windows_are_half_open_per_product(make_events):
    got = {(r["window_start"], r["product_id"]): (r["window_end"] - r["window_start"], r["total_revenue"])
           for r in minute_revenue(sales(make_events)).collect()}
    minute, night = dt.timedelta(minutes=1), dt.datetime(2020, 1, 1)
    assert got == {(night - 2 * minute, "tea"): (minute, Decimal("2.00")), (night - minute, "tea"): (minute, Decimal("3.50")),
                   (night - minute, "cup"): (minute, Decimal("12.75")), (night, "cup"): (minute, Decimal("5.00")),
                   (night, "tea"): (minute, Decimal("6.00"))}


def test_a_total_past_the_money_type_fails_the_publish(spark):
    big = spark.createDataFrame([(dt.datetime(2020, 1, 1), "gold", Decimal("5000000000.00"))] * 3,
                                "order_date timestamp_ntz, product_id string, amount decimal(12,2)")
    with pytest.raises(Exception, match="out of range: 2020-01-01 gold"):
        publishable_daily(daily_revenue(big)).collect()


def test_null_time_groups(make_events):
    rows = [("lost", "b", "tea", 4.0, "yesterday"), ("dated", "b", "tea", 6.5, "2020-02-29 12:30:00")]
    clean, _ = split_quality(make_events(rows), "Batch")
    daily = daily_revenue(clean)
    assert daily.filter("report_date IS NULL").count() == 1       # F1: own group
    assert publishable_daily(daily).count() == 1                   # never published
    assert minute_revenue(clean).count() == 1                      # window() drops it


def test_reconcile_reports_delta(spark):
    minute = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 1), "1", Decimal("10.00"))],
        "window_start timestamp_ntz, window_end timestamp_ntz, product_id string, total_revenue decimal(12,2)")
    daily = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "1", Decimal("7.00")), (dt.date(2024, 1, 2), "2", Decimal("3.00"))],
        "report_date date, product_id string, total_revenue decimal(12,2)")
    got = {(r["report_date"], r["product_id"]): r["delta"] for r in reconcile(minute, daily).collect()}
    assert got == {(dt.date(2024, 1, 1), "1"): Decimal("-3.00"), (dt.date(2024, 1, 2), "2"): Decimal("3.00")}
