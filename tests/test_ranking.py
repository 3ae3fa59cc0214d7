import random

from pyspark.sql import functions as F

from tests.helpers import at, dicts, order, orders
from tillstream.operators import ranking

SALES = "product_id string, product_name string, category string, order_count long, total_quantity long, total_revenue double"
CATEGORIES = "category string, order_count long, total_revenue double"


def sales(spark, *rows):
    return spark.createDataFrame([(p, p, "c", n, q, r) for p, n, q, r in rows], SALES)


def ids(rows, column="product_id"):
    return [r[column] for r in rows.collect()]


def test_top_products_and_ties(spark):
    rows = sales(
        spark,
        ("d", 5, 1, 10.0),
        ("c", 5, 1, 10.0),
        ("b", 5, 1, 20.0),
        ("a", 4, 99, 99.0),
        ("e", 5, 1, None),
    )
    assert ids(ranking.top_products(rows)) == ["b", "c", "d", "e", "a"]
    assert ids(ranking.top_products(rows, 2)) == ["b", "c"]
    plan = ranking.top_products(rows)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_top_sellers_rank_only_the_leaderboard(spark):
    rows = sales(spark, *((f"p{i:02d}", 100 - i, i, 1.0) for i in range(12)))
    # p10 and p11 sold most, but are not among the ten with the most orders.
    assert ids(ranking.top_sellers(rows)) == [f"p{i:02d}" for i in range(9, 1, -1)]


def categories(spark, *rows):
    return spark.createDataFrame(list(rows), CATEGORIES)


def test_category_orders(spark):
    rows = categories(spark, *((c, n, r) for c, n, r in [("b", 1, 5.0), ("a", 9, 5.0), ("z", 9, 7.0)]))
    assert ids(ranking.categories_by_revenue(rows), "category") == ["z", "a", "b"]
    many = categories(spark, *((f"c{i}", 10 - i, 0.0) for i in range(9)))
    assert ids(ranking.busiest_categories(many), "category") == [f"c{i}" for i in range(6)]


def test_category_rank(spark):
    rows = categories(spark, ("a", 1, 50.0), ("b", 1, 70.0), ("c", 1, 50.0), ("d", 1, 0.2), ("e", 1, None))
    got = {r.category: r.revenue_rank for r in ranking.category_rank(rows).collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "d": 4, "e": 5}


def test_positions_are_those_of_one_sort(spark):
    chance = random.Random(5)
    amounts = [None, 0.0, -3.0, -3.5, 0.99, 1.0, 1e15, 1.1] + [
        round(10 ** chance.uniform(-2, 9), chance.choice([0, 2])) for _ in range(3000)
    ]
    amounts += [9.99] * 1500  # and one amount with a third of the rows
    rows = spark.createDataFrame([(f"c{i:05d}", 1, a) for i, a in enumerate(amounts)], CATEGORIES)
    place = ranking.with_position(rows.repartition(7), "total_revenue", ["category"])
    got = {r.category: r.position for r in place.collect()}
    order_ = sorted(
        range(len(amounts)),
        key=lambda i: (amounts[i] is None, -(amounts[i] or 0.0), f"c{i:05d}"),
    )
    assert got == {f"c{i:05d}": place for place, i in enumerate(order_, 1)}
    ranks = {r.category: r.revenue_rank for r in ranking.category_rank(rows).collect()}
    for i in range(0, len(amounts), 97):
        if amounts[i] is not None:
            assert ranks[f"c{i:05d}"] == 1 + sum(a is not None and a > amounts[i] for a in amounts)


def test_few_and_no_rows_are_numbered(spark):
    rows = categories(spark, ("b", 1, 5.0), ("a", 1, 5.0), ("c", 1, None), ("d", 1, 8.0))
    placed = sorted(map(tuple, ranking.with_position(rows, "total_revenue", ["category"]).collect()))
    assert [r[1] for r in placed] == ["d", "a", "b", "c"]
    assert ranking.with_position(rows.limit(0), "total_revenue", ["category"]).collect() == []
    assert ranking.category_rank(rows.limit(0)).collect() == []


def test_ranks_of_amounts_that_span_ranges(spark):
    rows = spark.range(20_000).selectExpr(
        "concat('c', lpad(id, 6, '0')) category", "1L order_count",
        "case when id % 2 = 0 then 7d when id % 5 = 0 then null else double(id % 40) end total_revenue",
    )
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # so that one amount fills ranges
    try:
        got = ranking.category_rank(rows).collect()
    finally:
        spark.conf.unset(setting)
    amounts = sorted((r.total_revenue for r in got), key=lambda a: (a is None, -(a or 0.0)))
    first = {}
    for place, amount in enumerate(amounts, 1):
        first.setdefault(amount, place)
    assert all(r.revenue_rank == first[r.total_revenue] for r in got) and len(got) == 20_000


def test_equal_amounts_are_spread_over_tasks(spark):
    rows = spark.range(40_000).selectExpr(
        "concat('c', id) category", "1L order_count", "if(id % 3 = 0, 9.99d, double(id)) total_revenue"
    )
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # or it would make one task of so few rows
    try:
        placed = ranking.with_position(rows, "total_revenue", ["category"])
    finally:
        spark.conf.unset(setting)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 20_000
    assert placed.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()[:] == (1, 40_000, 40_000)


def test_latest_orders(spark):
    rows = orders(
        spark,
        order("old", timestamp="2024-01-01T00:00:00"),
        order("b", timestamp="2024-01-02T00:00:00"),
        order("a", timestamp="2024-01-02T00:00:00"),
        order("never", timestamp="?"),
        order("new", timestamp="2024-01-02T00:00:00.000001"),
    )
    assert ids(ranking.latest_orders(rows), "order_id") == ["new", "a", "b", "old", "never"]
    assert ids(ranking.latest_orders(rows, 2), "order_id") == ["new", "a"]
    merged = ranking.merge_latest(ranking.latest_orders(rows, 3), orders(spark, order("late", timestamp="2024-01-01T12:00:00")), 4)
    assert ids(merged, "order_id") == ["new", "a", "b", "late"]
    assert dicts(merged)[0]["timestamp_parsed"] == at("2024-01-02T00:00:00.000001")
