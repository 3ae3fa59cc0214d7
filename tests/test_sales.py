from tests.helpers import at, dicts, messages, order, orders
from tillstream.operators.parse import parse_orders
from tillstream.operators.sales import (
    avg_order_value,
    category_sales,
    category_sales_of_products,
    order_totals,
    product_sales,
    rollup_columns,
    totals_of_sales,
)


def feed(spark):
    return orders(
        spark,
        order("1", price=10.0, quantity=2, timestamp="2024-05-01T10:00:00"),
        order("2", price=20.0, quantity=1, timestamp="2024-05-01T12:00:00"),
        order("3", price=30.0, quantity=None, timestamp="bad"),
        order(None, price=None, quantity=5, timestamp=None),
        order("5", product_id="PROD-002", product_name="Lamp", category="Home", price=0.1, quantity=3),
        order("6", product_id="PROD-003", product_name="Novel", category="Books", price=0.2, quantity=1),
        order("7", product_name="Kettle XL", price=7.0),
    )


def by(rows, *keys):
    return {tuple(r[k] for k in keys): r for r in dicts(rows)}


def test_product_sales(spark):
    got = by(product_sales(feed(spark)), "product_id", "product_name")
    assert set(got) == {
        ("PROD-001", "Kettle"),
        ("PROD-001", "Kettle XL"),  # renamed: counted apart
        ("PROD-002", "Lamp"),
        ("PROD-003", "Novel"),
    }
    assert got["PROD-001", "Kettle"] == {
        "product_id": "PROD-001",
        "product_name": "Kettle",
        "category": "Home",
        "order_count": 3,  # the order without an id is not counted
        "total_quantity": 8,
        "total_revenue": 40.0,
        "avg_price": 20.0,  # a mean over orders, not weighted by quantity
        "last_order_time": at("2024-05-01T12:00:00"),
    }
    assert got["PROD-002", "Lamp"]["total_revenue"] == 0.3


def test_group_of_nulls(spark):
    (row,) = dicts(product_sales(parse_orders(messages(spark, "junk", None))))
    assert row["order_count"] == 0
    assert row["total_quantity"] is row["total_revenue"] is row["avg_price"] is None
    assert row["last_order_time"] is None
    (row,) = dicts(category_sales(parse_orders(messages(spark, "junk"))))
    assert (row["category"], row["order_count"], row["unique_products"]) == (None, 0, 0)


def test_category_sales(spark):
    for exact in (False, True):
        got = by(category_sales(feed(spark), exact), "category")
        assert set(got) == {("Home",), ("Books",)}
        home = got[("Home",)]
        assert (home["order_count"], home["total_quantity"], home["unique_products"]) == (5, 12, 2)
        assert home["total_revenue"] == 47.3


def test_estimate_of_distinct_products(spark):
    rows = spark.range(20_000).selectExpr(
        "'c' category", "cast(id as string) order_id", "1 quantity", "1.0d total_value",
        "concat('PROD-', id % 5000) product_id", "timestamp '2024-01-01' timestamp_parsed",
    )
    estimate = category_sales(rows).first().unique_products
    assert abs(estimate - 5000) <= 0.15 * 5000
    assert category_sales(rows, exact=True).first().unique_products == 5000


def test_totals_count_every_order(spark):
    assert dicts(order_totals(feed(spark))) == [{"total_orders": 7, "total_revenue": 47.5}]
    assert dicts(order_totals(feed(spark).limit(0))) == [{"total_orders": 0, "total_revenue": None}]


def test_coarser_results_from_finer_ones(spark):
    rows = feed(spark)
    products = product_sales(rows, *rollup_columns())
    for exact in (False, True):
        got = by(category_sales_of_products(products, exact), "category")
        assert got == by(category_sales(rows, exact), "category")
    categories = category_sales(rows, False, *rollup_columns())
    for finer in (products, categories):
        assert dicts(totals_of_sales(finer)) == dicts(order_totals(rows))
    assert dicts(totals_of_sales(products.limit(0))) == dicts(order_totals(rows.limit(0)))


def test_avg_order_value(spark):
    got = by(avg_order_value(feed(spark), "category"), "category")
    assert got[("Books",)]["avg_order_value"] == 0.2
    assert got[("Home",)]["avg_order_value"] == 47.3 / 5
    (overall,) = dicts(avg_order_value(feed(spark)))
    assert overall == {"transactions": 6, "total_revenue": 47.5, "avg_order_value": 47.5 / 6}
    (none,) = dicts(avg_order_value(feed(spark).limit(0)))
    assert none == {"transactions": 0, "total_revenue": None, "avg_order_value": None}
