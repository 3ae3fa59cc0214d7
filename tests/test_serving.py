import json

from pyspark.sql import functions as F

from tests.helpers import dicts, order, orders
from tillstream.operators import ranking, serving
from tillstream.operators.sales import category_sales, product_sales
from tillstream.schema import CATEGORY_ROW, ORDER_ROW, PRODUCT_ROW


def feed(spark):
    return orders(
        spark,
        order("1", quantity=2, timestamp="2024-05-01T10:00:00"),
        order("2", timestamp="2024-05-01T10:00:20.25"),
        order("3", product_id="PROD-002", product_name="Lamp", price=99.0, timestamp="at noon"),
        order("4", product_id="PROD-003", product_name="Novel", category="Books", price=5.0),
    )


def as_json(document):
    return [json.loads(line) for line in document.toJSON().collect()]


def test_product_payload(spark):
    rows = serving.product_rows(ranking.top_products(product_sales(feed(spark))))
    (document,) = as_json(serving.payload(rows, "products", 7, F.lit("2024-05-01T11:00:00")))
    assert (document["batch_id"], document["timestamp"], document["part"]) == (7, "2024-05-01T11:00:00", 0)
    assert document["parts"] == 1
    first, second, third = document["products"]
    assert list(first) == PRODUCT_ROW
    assert first == {
        "product_id": "PROD-001",
        "product_name": "Kettle",
        "category": "Home",
        "order_count": 2,
        "total_quantity": 3,
        "total_revenue": 30.0,
        "avg_price": 10.0,
        "window_start": "2024-05-01T10:00:20.250000",
    }
    assert second["product_id"] == "PROD-002" and "window_start" not in second
    assert third["product_id"] == "PROD-003"


def test_category_payload(spark):
    rows = serving.category_rows(category_sales(feed(spark)))
    (document,) = as_json(serving.payload(rows, "categories", 0))
    assert [c["category"] for c in document["categories"]] == ["Home", "Books"]
    assert list(document["categories"][0]) == CATEGORY_ROW


def test_order_payload(spark):
    rows = serving.order_rows(ranking.latest_orders(feed(spark)))
    (document,) = as_json(serving.payload(rows, "orders", 0))
    assert [o["order_id"] for o in document["orders"]] == ["2", "1", "4", "3"]
    assert [o["timestamp"] for o in document["orders"]][-1] == "at noon"
    assert list(document["orders"][0]) == ORDER_ROW


def test_long_lists_are_published_in_parts(spark):
    many = spark.range(2500).selectExpr(
        "concat('c', lpad(id, 5, '0')) category", "1L order_count", "1L total_quantity",
        "cast(id % 40 as double) total_revenue", "1L unique_products",
        "timestamp '2024-01-01' last_order_time",
    )
    parts = serving.payload(serving.category_rows(many), "categories", 1).orderBy("part").collect()
    assert [(p.part, len(p.categories)) for p in parts] == [(0, 1000), (1, 1000), (2, 500)]
    assert {p.parts for p in parts} == {3}
    published = [c.category for p in parts for c in p.categories]
    assert published == [r.category for r in ranking.categories_by_revenue(many).collect()]


def test_status_and_shown_metrics(spark):
    kpis = serving.kpi_status(feed(spark))
    (status,) = dicts(serving.status_document(kpis, F.lit("now")))
    assert status == {
        "status": "running",
        "timestamp": "now",
        "total_orders": 4,
        "total_revenue": 134.0,
        "orders_per_minute": 3,
    }
    empty = kpis.select(*(F.lit(None).cast("double").alias(c) for c in kpis.columns))
    assert dicts(serving.shown_metrics(empty)) == [dict.fromkeys(kpis.columns, 0)]


def test_category_details(spark):
    details = dicts(serving.category_details(category_sales(feed(spark))))
    assert details[0] == {
        "category": "Home",
        "order_count": 3,
        "total_quantity": 4,
        "total_revenue": 129.0,
        "unique_products": 2,
    }


def test_snapshot_is_one_document(spark):
    (document,) = as_json(serving.snapshot_of_orders(feed(spark)))
    assert [p["product_id"] for p in document["top_products"]] == ["PROD-001", "PROD-002", "PROD-003"]
    assert [c["category"] for c in document["categories"]] == ["Home", "Books"]
    assert [o["order_id"] for o in document["recent_orders"]] == ["2", "1", "4", "3"]
    assert document["metrics"] == {"total_orders": 4, "total_revenue": 134.0, "orders_per_minute": 3}
    assert list(document["categories"][0]) == CATEGORY_ROW


def test_update_document(spark):
    latest = serving.order_rows(ranking.latest_orders(feed(spark), 2))
    (document,) = as_json(serving.update_document(latest, serving.kpi_status(feed(spark)), F.lit("now")))
    assert [o["order_id"] for o in document["recent_orders"]] == ["2", "1"]
    assert (document["timestamp"], document["total_orders"], document["total_revenue"]) == ("now", 4, 134.0)


def test_snapshot_before_the_first_order(spark):
    (document,) = as_json(serving.snapshot_of_orders(feed(spark).limit(0)))
    assert document["metrics"] == {"total_orders": 0, "total_revenue": 0.0, "orders_per_minute": 0}
    assert "top_products" not in document


def test_long_lists_make_further_parts_of_a_snapshot(spark):
    rows = feed(spark)
    parts = serving.snapshot(
        serving.product_rows(ranking.top_products(product_sales(rows))),
        serving.category_rows(category_sales(rows)),
        serving.order_rows(ranking.latest_orders(rows)),
        serving.kpi_status(rows),
        part_rows=3,
    ).orderBy("part")
    first, second = as_json(parts)
    assert len(first["recent_orders"]) == 3 and "metrics" in first
    assert [o["order_id"] for o in second["recent_orders"]] == ["3"] and "metrics" not in second


def test_no_cross_join(spark):
    execution = serving.snapshot_of_orders(feed(spark))._jdf.queryExecution()
    assert "Cross" not in execution.optimizedPlan().toString()
    plan = execution.executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
