import json
import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, dicts, messages, order, orders
from tillstream.operators import serving, trends
from tillstream.operators.parse import accepted, judge_orders, parse_orders, rejected
from tillstream.operators.ranking import latest_orders
from tillstream.operators.sales import product_sales
from tillstream.schema import ORDER_FIELDS, order_schema
from tillstream.sources.messages import encode_orders

PARSED = [*ORDER_FIELDS, "timestamp_parsed", "total_value"]


def parsed(spark, value):
    (row,) = dicts(parse_orders(messages(spark, value)))
    return row


def test_whole_order(spark):
    row = parsed(spark, order(price=79.99, quantity=2, timestamp="2025-09-06T14:30:00.123456"))
    assert list(row) == PARSED
    assert row["timestamp_parsed"] == at("2025-09-06T14:30:00.123456")
    assert row["total_value"] == 79.99 * 2
    assert row["timestamp"] == "2025-09-06T14:30:00.123456"


@pytest.mark.parametrize(
    "value", ["not json", '{"order_id": "ORD', "[1, 2]", "null", "", None]
)
def test_unreadable_message_is_a_row_of_nulls(spark, value):
    assert parsed(spark, value) == dict.fromkeys(PARSED)


@pytest.mark.parametrize(
    "change, field",
    [({"price": "12.5"}, "price"), ({"quantity": 2.5}, "quantity"), ({"quantity": 3_000_000_000}, "quantity")],
)
def test_value_of_the_wrong_type_is_null_alone(spark, change, field):
    row = parsed(spark, order(**change))
    assert row[field] is None
    assert row["total_value"] is None
    assert row["order_id"] == "ORDER-000001"


def test_missing_and_extra_fields(spark):
    body = order(colour="red")
    del body["customer_id"]
    row = parsed(spark, body)
    assert row["customer_id"] is None
    assert list(row) == PARSED


def test_number_as_order_id_becomes_text(spark):
    assert parsed(spark, order(order_id=7))["order_id"] == "7"


def test_field_names_are_case_sensitive(spark):
    body = {name.upper(): value for name, value in order().items()}
    assert parsed(spark, body)["order_id"] is None


def test_nan_price_and_repeated_key(spark):
    row = parsed(spark, '{"order_id":"a","price":NaN,"quantity":1,"order_id":"b"}')
    assert math.isnan(row["price"])
    assert row["order_id"] == "b"


@pytest.mark.parametrize(
    "text, moment",
    [
        ("bad", None),
        ("", None),
        ("2024-13-01T00:00:00", None),
        ("2024-05-01T10:00:00+02:00", "2024-05-01T08:00:00"),
        ("2024-05-01T10:00:00", "2024-05-01T10:00:00"),
        ("+294247-01-10T04:00:54.775807", None),
        ("-290308-12-21T19:59:05.224192", None),
        ("+10000-01-01T00:00:00", None),
        ("9999-12-31T23:59:59.999999", "9999-12-31T23:59:59.999999"),
        ("2024-05-01T10:00:00.123456789", "2024-05-01T10:00:00.123456"),
    ],
)
def test_times(spark, text, moment):
    row = parsed(spark, order(timestamp=text))
    assert row["timestamp_parsed"] == (at(moment) if moment else None)
    assert row["timestamp"] == text


def test_only_the_named_fields_are_decoded(spark):
    rows = parse_orders(messages(spark, order()), ["quantity", "price"])
    assert rows.columns == ["price", "quantity", "total_value"]
    assert parse_orders(messages(spark, order()), ["category"]).columns == ["category"]
    with pytest.raises(ValueError, match="colour"):
        order_schema(["colour"])


def test_encoding_and_parsing_gives_the_same_orders(spark):
    feed = orders(
        spark,
        order("A", product_name='Say "hi"\n\\ ü 漢', price=0.1, quantity=3),
        order("B", price=1e300, timestamp="nonsense"),
        order("C", **dict.fromkeys(["product_id", "price", "quantity", "timestamp"])),
        order("D", price=-5.25, quantity=-2),
    )
    encoded = encode_orders(feed)
    assert [r.key.decode() for r in encoded.collect()] == ["A", "B", "C", "D"]
    assert json.loads(encoded.first().value)["product_name"] == 'Say "hi"\n\\ ü 漢'
    assert dicts(parse_orders(encoded)) == dicts(feed)


def test_rejections(spark):
    cases = [
        (None, "null_value"),
        ("", "null_value"),
        ("  ", "null_value"),
        ("not json", "missing_key"),
        ("null", "missing_key"),
        (order(order_id=None), "missing_key"),
        (order(product_id=None), "missing_key"),
        (order(category=None), "missing_key"),
        (order(price=None), "bad_number"),
        (order(price="12.5"), "bad_number"),
        (order(quantity=None), "bad_number"),
        (order(price=math.inf), "bad_number"),
        (order(price=1e308, quantity=1000), "bad_number"),
        (order(price=1e15), None),
        (order(price=math.nan), "nan_price"),
        (order(), None),
        (order(timestamp="nonsense"), None),
        (order(timestamp=None), None),
        (order(product_name=None, customer_id=None), None),
        (order(price=-1.0, quantity=-3), None),
        (order(price=0.0, quantity=0), None),
    ]
    judged = judge_orders(messages(spark, *(value for value, _ in cases)))
    reasons = {r.key.decode(): r.reject_reason for r in judged.collect()}
    assert reasons == {f"key-{i}": reason for i, (_, reason) in enumerate(cases)}

    bad = rejected(judged).collect()
    assert len(bad) == sum(reason is not None for _, reason in cases)
    assert {bytes(r.value) if r.value is not None else None for r in bad} >= {None, b"not json"}
    good = accepted(judged)
    assert good.columns == PARSED
    assert good.count() == len(cases) - len(bad)


def test_filtering_decodes_each_message_once(spark):
    judged = accepted(judge_orders(messages(spark, order())))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_pruned_judging_sees_the_same(spark):
    feed = messages(spark, order(), order(price=None), None, order(order_id=None))
    narrow = judge_orders(feed, ["order_id", "product_id", "category", "price", "quantity"])
    wide = judge_orders(feed)
    key = F.col("key").cast("string")
    assert narrow.select(key, "reject_reason").collect() == wide.select(key, "reject_reason").collect()


def test_no_message_stops_a_query(spark):
    whole = json.dumps(order("Z")).encode()
    hostile = [
        b"\xff\xfe" + whole,
        json.dumps(order(category="QQ")).encode().replace(b"QQ", b"\xff\xc3"),
        b"[" * 3000,
        b'{"order_id":' + b'{"a":' * 3000,
        whole.replace(b"10.0", b"9" * 2000),
        whole.replace(b"10.0", b"1e400"),
        json.dumps(order(timestamp="+294247-01-10T04:00:54.775807")),
        json.dumps(order(timestamp="-290308-12-21T19:59:05.224192")),
        json.dumps(order(quantity=2**31 - 1, price=1e5)),
        json.dumps(order(product_name="a\0b", order_id="\ud800")),
        '{"order_id":"A"}'.encode("utf-16"),
        b"[" + whole + b"]",
        whole + b" and more",
    ]
    judged = judge_orders(messages(spark, *hostile))
    assert accepted(judged).count() + rejected(judged).count() == len(hostile)
    for rows in (parse_orders(messages(spark, *hostile)), accepted(judged)):
        product_sales(rows).collect()
        trends.orders_per_minute(rows).collect()
        trends.hopping_counts(rows).collect()
        trends.running_revenue(rows).collect()
        serving.kpi_status(rows).collect()
        serving.payload(serving.order_rows(latest_orders(rows)), "orders", 0).toJSON().collect()
