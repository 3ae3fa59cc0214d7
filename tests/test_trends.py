from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, dicts, order, orders
from tillstream.operators import trends
from tillstream.operators.sales import category_sales
from tillstream.operators.serving import kpi_status

TIMES = [
    "2024-05-01T09:59:59.999999",
    "2024-05-01T10:00:00",
    "2024-05-01T10:00:30.5",
    "2024-05-01T10:01:00",
    "2024-05-02T10:00:00",
    "unknown",
]


def feed(spark, times=TIMES):
    return orders(spark, *(order(str(i), price=i + 0.5, timestamp=t) for i, t in enumerate(times)))


def test_last_minute(spark):
    first_four = feed(spark, TIMES[:4])
    assert dicts(trends.orders_last_minute(first_four)) == [{"orders_per_minute": 3}]
    assert dicts(trends.orders_last_minute(feed(spark))) == [{"orders_per_minute": 1}]
    as_of = F.to_timestamp(F.lit("2024-05-01T10:00:30"))
    assert dicts(trends.orders_last_minute(feed(spark), as_of)) == [{"orders_per_minute": 2}]
    assert dicts(trends.orders_last_minute(feed(spark).limit(0))) == [{"orders_per_minute": 0}]


def brute_force_hops(times):
    counts = {}
    for text in times:
        moment = at(text).timestamp()
        start = (moment // 10) * 10
        for _ in range(6):
            if start <= moment < start + 60:
                counts[start] = counts.get(start, 0) + 1
            start -= 10
    return counts


def test_hopping_windows(spark):
    want = brute_force_hops(TIMES[:5])
    for count in (trends.orders_per_minute, trends.hopping_counts):
        got = {r.window_start.timestamp(): r.order_count for r in count(feed(spark)).collect()}
        assert got == want
    with pytest.raises(ValueError):
        trends.orders_per_minute(feed(spark), 60, 25)


def test_trend(spark):
    got = {r.period_start: (r.order_count, r.total_revenue) for r in trends.trend(feed(spark)).collect()}
    assert got == {
        at("2024-05-01T09:00:00"): (1, 0.5),
        at("2024-05-01T10:00:00"): (3, 7.5),
        at("2024-05-02T10:00:00"): (1, 4.5),
    }
    daily = trends.trend(feed(spark), "1 day", "category")
    assert daily.columns == ["period_start", "category", "order_count", "total_revenue"]
    assert sorted(r.order_count for r in daily.collect()) == [1, 4]


def test_hour_of_day(spark):
    got = {r.hour: r.order_count for r in trends.hour_of_day(feed(spark)).collect()}
    assert got == {9: 1, 10: 4}
    # The order without a time is in no hour, and told apart.
    assert trends.untimed(feed(spark)).first().order_count == 1


def test_running_revenue(spark):
    got = [tuple(r) for r in trends.running_revenue(feed(spark)).orderBy("day").collect()]
    assert got == [(date(2024, 5, 1), 8.0, 8.0), (date(2024, 5, 2), 4.5, 12.5)]


def test_running_revenue_does_not_gather_error(spark):
    days = [f"2024-01-{d:02d}T00:00:00" for d in range(1, 32)]
    rows = orders(spark, *(order(t, price=0.1, quantity=1, timestamp=t) for t in days))
    last = trends.running_revenue(rows).orderBy(F.desc("day")).first()
    assert last.running_revenue == 3.1


def test_throughput(spark):
    got = {r.minute: r.order_count for r in trends.throughput(feed(spark)).collect()}
    assert got[at("2024-05-01T10:00:00")] == 2
    assert len(got) == 4
    assert dicts(trends.throughput_summary(feed(spark))) == [
        {"minutes": 4, "min_orders": 1, "mean_orders": 1.25, "max_orders": 2}
    ]


def test_kpi_status(spark):
    (row,) = dicts(kpi_status(feed(spark)))
    assert row == {"total_orders": 6, "total_revenue": 18.0, "orders_per_minute": 1}
    (row,) = dicts(kpi_status(feed(spark).limit(0)))
    assert row == {"total_orders": 0, "total_revenue": 0.0, "orders_per_minute": 0}


def test_last_minute_filter_reaches_the_scan(spark, tmp_path):
    feed(spark).write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    as_of = F.to_timestamp(F.lit("2024-05-01T10:00:30"))
    plan = trends.orders_last_minute(stored, as_of)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp_parsed" in plan
    assert category_sales(stored).count() == 1
