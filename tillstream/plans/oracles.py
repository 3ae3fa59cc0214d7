"""The same queries as SQL over the tables, for an engine that is not Spark.

Money is summed as doubles and rounded to whole cents, which drops the dependence on the
order of addition; the amounts of the tables have two decimals.
"""

from __future__ import annotations

# One order per lineitem, and one per event.
LINEITEM = """(
  select printf('ORDER-%06d', l_orderkey) order_id, printf('PROD-%03d', p_partkey) product_id,
         p_name product_name, p_type category, p_retailprice price,
         cast(l_quantity as int) quantity, printf('CUST-%04d', o_custkey) customer_id,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') "timestamp", o_orderdate timestamp_parsed,
         p_retailprice * cast(l_quantity as int) total_value
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)"""

EVENTS = """(
  select printf('ORDER-%06d', event_id) order_id,
         printf('PROD-%03d', cast(json_extract_string(props, '$.k') as int)) product_id,
         'Product ' || json_extract_string(props, '$.k') product_name, event_type category,
         value price, 1 quantity, printf('CUST-%04d', user_id) customer_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') "timestamp", ts timestamp_parsed,
         value * 1 total_value, cast(json_extract_string(props, '$.k') as int) product_number
  from events)"""

# Columns in the order of a parsed order.
PARSED = """order_id, product_id, product_name, category, price, quantity, customer_id,
  "timestamp", timestamp_parsed, total_value"""


def money(column: str) -> str:
    return f"cast(round(sum({column}) * 100) as bigint) / 100.0"


def iso(column: str) -> str:
    return (
        f"case when epoch_us({column}) % 1000000 = 0 then strftime({column}, '%Y-%m-%dT%H:%M:%S') "
        f"else strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') end"
    )


def product_sales(source: str) -> str:
    return f"""select product_id, product_name, category, count(order_id) order_count,
  cast(sum(quantity) as bigint) total_quantity, {money("total_value")} total_revenue,
  {money("price")} / count(price) avg_price, max(timestamp_parsed) last_order_time
  from {source} group by 1, 2, 3"""


def category_sales(source: str) -> str:
    return f"""select category, count(order_id) order_count,
  cast(sum(quantity) as bigint) total_quantity, {money("total_value")} total_revenue,
  count(distinct product_id) unique_products, max(timestamp_parsed) last_order_time
  from {source} group by 1"""


def within_bound(categories: str) -> str:
    """Categories whose count of distinct products the other side has only estimated."""
    return f"select * exclude (unique_products), true distinct_within_bound from ({categories})"


BY_ORDERS = "order_count desc, total_revenue desc, product_id, product_name, category"
TOP_10 = "({}) order by " + BY_ORDERS + " limit 10"
NEWEST = "order by timestamp_parsed desc, order_id, product_id, quantity, customer_id"


def published_products(source: str) -> str:
    return f"""select row_number() over (order by {BY_ORDERS}) "position", product_id, product_name,
  category, order_count, total_quantity, total_revenue, avg_price,
  {iso("last_order_time")} window_start
  from (select * from {TOP_10.format(product_sales(source))})"""


def published_categories(source: str) -> str:
    return f"""select row_number() over (order by total_revenue desc, category) "position", category,
  order_count, total_quantity, total_revenue, unique_products,
  {iso("last_order_time")} last_order_time from ({category_sales(source)})"""


def published_orders(source: str, k: int) -> str:
    return f"""select row_number() over ({NEWEST}) "position", order_id, product_id, product_name,
  category, price, quantity, total_value, customer_id, {iso("timestamp_parsed")} "timestamp"
  from (select * from {source} {NEWEST} limit {k})"""


LAST_MINUTE = f"""select count(*) from {EVENTS}
  where timestamp_parsed >= (select max(ts) from events) - interval 60 second"""
KPI_STATUS = f"""select count(*) total_orders, {money("total_value")} total_revenue,
  ({LAST_MINUTE}) orders_per_minute from {EVENTS}"""

# Rows of the hopping windows: six copies of every order, one for each window it is in.
HOPS = """(select time_bucket(interval 10 second, ts) - i * interval 10 second window_start, ts
  from events, range(6) steps(i)
  where ts < time_bucket(interval 10 second, ts) - i * interval 10 second + interval 60 second)"""
HOPPING = f"""select window_start, window_start + interval 60 second window_end, count(*) order_count
  from {HOPS} group by 1"""

# Prices turned tiny, huge or NaN by product. Sums of each kind are exact or rounded alike.
EDGES = f"""select product_id, category, count(*) order_count,
  case when product_number < 10 then round(count(*) * 4.0) / 1e5
    when product_number < 20 then count(*) * 1e15
    when product_number < 30 and bool_or(order_id like '%1') then 'NaN'::double
    else {money("total_value")} end total_revenue,
  case when product_number < 10 then round(count(*) * 4.0) / 1e5
    when product_number < 20 then count(*) * 1e15
    when product_number < 30 and bool_or(order_id like '%1') then 'NaN'::double
    else {money("price")} end / count(*) avg_price
  from {EVENTS} group by product_id, category, product_number"""

# What becomes of the messages of a product in the spoiled feed.
REASON = """case when product_number < 10 then 'null_value'
  when product_number < 25 then 'missing_key'
  when product_number < 35 then 'bad_number'
  when product_number < 40 then 'nan_price'
  when product_number < 45 then 'bad_number'
  when product_number < 50 then 'missing_key' end"""
REJECTED = f"""select order_id message_key, {REASON} reject_reason from {EVENTS}
  where {REASON} is not null"""
# The accepted part of it: product 50 to 59 have times that cannot be read.
ACCEPTED = f"""(select * replace (case when product_number < 60 then null else timestamp_parsed end
  as timestamp_parsed) from {EVENTS} where product_number >= 50)"""

AVG_VALUE = f"""count(order_id) transactions, {money("total_value")} total_revenue,
  {money("total_value")} / count(order_id) avg_order_value"""

TREND_HOURLY = f"""select date_trunc('hour', timestamp_parsed) period_start, category,
  count(order_id) order_count, {money("total_value")} total_revenue from {EVENTS} group by 1, 2"""

# The first of five spans of time of equal length, which arrives last.
FIRST_FIFTH = """epoch_us(timestamp_parsed) < (select min(epoch_us(ts))
  + cast(round_even((max(epoch_us(ts)) - min(epoch_us(ts))) / 5.0, 0) as bigint) from events)"""

THROUGHPUT = """select date_trunc('minute', ts) "minute", count(*) order_count from events group by 1"""

# The position of the metrics row stands for orders_per_minute.
SNAPSHOT_SECTIONS = """select 'top_products' section, "position", product_id id, total_revenue amount
  from ({products})
  union all select 'categories', "position", category, total_revenue from ({categories})
  union all select 'recent_orders', "position", order_id, total_value from ({orders})
  union all select 'metrics', {tempo}, cast(total_orders as varchar), total_revenue from ({kpis})"""

def enveloped(rows: str, batch_id: int) -> str:
    """Published rows with what the payload's envelope says."""
    return f"select {batch_id} batch_id, '2024-02-01T00:00:00' published_at, 1 parts, * from ({rows})"


def snapshot() -> str:
    return SNAPSHOT_SECTIONS.format(
        products=published_products(EVENTS),
        categories=published_categories(EVENTS),
        orders=published_orders(EVENTS, 20),
        kpis=KPI_STATUS,
        tempo="orders_per_minute",
    )


ORACLES: dict[str, str] = {
    "parse_roundtrip": f"select {PARSED} from {LINEITEM}",
    "parse_roundtrip_events": f"select {PARSED} from {EVENTS}",
    "encoded_messages": f"""select order_id message_key, order_id, product_name, quantity,
  "timestamp", 8 field_count from {EVENTS}""",
    "wire_product_sales": product_sales(LINEITEM),
    "wire_top_products": f"select * from {TOP_10.format(product_sales(LINEITEM))}",
    "wire_category_sales": category_sales(LINEITEM),
    "wire_latest_orders": published_orders(LINEITEM, 50),
    "batch_row_count": f"select count(*) row_count from {LINEITEM}",
    "order_time_texts": f"""select order_id,
  case when product_number >= 60 then {iso("timestamp_parsed")} end iso_time,
  case when product_number >= 60 then {iso("timestamp_parsed")} else 'at ' || "timestamp" end "timestamp"
  from {EVENTS} where product_number >= 50""",
    "rejected_orders": REJECTED,
    "rejected_counts": f"select reject_reason, count(*) messages from ({REJECTED}) group by 1",
    "accepted_sales": product_sales(ACCEPTED),
    "money_edges": EDGES,
    "product_sales": product_sales(LINEITEM),
    "product_sales_table": product_sales(EVENTS),
    "top_products": f"select * from {TOP_10.format(product_sales(LINEITEM))}",
    "top8_of_top10": f"""select * from (select * from {TOP_10.format(product_sales(LINEITEM))})
  order by total_quantity desc, product_id, product_name, category limit 8""",
    "category_sales_exact": category_sales(LINEITEM),
    "category_sales_approx": within_bound(category_sales(EVENTS)),
    "category_distinct_bound": f"select distinct category, true distinct_within_bound from {LINEITEM}",
    "categories_by_revenue": f"""select row_number() over (order by total_revenue desc, category) "position",
  category, order_count, total_quantity, total_revenue from ({category_sales(LINEITEM)})""",
    "category_rank": f"""select rank() over (order by total_revenue desc) revenue_rank, category,
  total_revenue from ({category_sales(LINEITEM)})""",
    "product_rank": f"""select row_number() over (
    order by total_revenue desc, product_id, product_name, category) "position",
  product_id, product_name, category, total_revenue from ({product_sales(LINEITEM)})""",
    "top6_categories": f"""select category, order_count, total_quantity, total_revenue
  from ({category_sales(LINEITEM)}) order by order_count desc, category limit 6""",
    "category_details": f"""select category, order_count, total_quantity, total_revenue, unique_products
  from ({category_sales(EVENTS)}) order by order_count desc, category limit 6""",
    "latest_orders": published_orders(LINEITEM, 50),
    "recent_20": f"select {PARSED} from {EVENTS} {NEWEST} limit 20",
    "recent_10": f"select {PARSED} from {EVENTS} {NEWEST} limit 10",
    "kpi_totals": f"select count(*) total_orders, {money('total_value')} total_revenue from {EVENTS}",
    "kpi_totals_lineitem": f"select count(*) total_orders, {money('total_value')} total_revenue from {LINEITEM}",
    "orders_last_minute": f"select ({LAST_MINUTE}) orders_per_minute",
    "orders_per_minute_hopping": HOPPING,
    "trend_hourly": TREND_HOURLY,
    "trend_daily": f"""select date_trunc('day', timestamp_parsed)::timestamp period_start,
  count(order_id) order_count, {money("total_value")} total_revenue from {EVENTS} group by 1""",
    "hour_of_day": f"""select cast(hour(timestamp_parsed) as int) "hour", category,
  count(order_id) order_count, {money("total_value")} total_revenue from {EVENTS} group by 1, 2""",
    "avg_order_value": f"select category, {AVG_VALUE} from {EVENTS} group by 1",
    "avg_order_value_overall": f"select {AVG_VALUE} from {EVENTS}",
    "running_revenue": f"""select "day"::timestamp "day", cents / 100.0 revenue,
  cast(sum(cents) over (order by "day") as bigint) / 100.0 running_revenue
  from (select cast(timestamp_parsed as date) "day", cast(round(sum(total_value) * 100) as bigint) cents
    from {EVENTS} group by 1)""",
    "throughput_minute": THROUGHPUT,
    "throughput_summary": f"""select count(*) "minutes", min(order_count) min_orders,
  sum(order_count) / count(*) mean_orders, max(order_count) max_orders from ({THROUGHPUT})""",
    "kpi_status": KPI_STATUS,
    "shown_metrics": KPI_STATUS,
    "payload_products": enveloped(published_products(LINEITEM), 7),
    "payload_categories": enveloped(published_categories(EVENTS), 8),
    "payload_orders": enveloped(published_orders(EVENTS, 50), 9),
    "dashboard_snapshot": snapshot(),
    "stream_top_products": published_products(EVENTS),
    "stream_categories": within_bound(published_categories(EVENTS)),
    "stream_recent_20": f"select {PARSED} from {EVENTS} {NEWEST} limit 20",
    "stream_totals": f"select count(*) total_orders, {money('total_value')} total_revenue from {EVENTS}",
    "stream_tempo": f"select ({LAST_MINUTE}) orders_per_minute",
    "stream_rejected": REJECTED,
    "stream_deduplicated": f"select {PARSED} from {EVENTS}",
    "landed_product_sales": product_sales(ACCEPTED),
    "landed_reject_counts": f"select reject_reason, count(*) messages from ({REJECTED}) group by 1",
    "stream_orders_per_minute": HOPPING,
    "stream_trend_hourly": TREND_HOURLY,
    "stream_throughput": THROUGHPUT,
    "stream_snapshot": snapshot(),
    "stream_committed_snapshot": snapshot(),
    "stream_committed_products": product_sales(EVENTS),
    "stream_reconciled": f"""select count(*) accepted, count(*) filter (not {FIRST_FIFTH}) in_windows,
  count(*) filter ({FIRST_FIFTH}) late, 0 ahead, 0 untimed, true balanced from {EVENTS}""",
    "stream_late_orders": f"select {PARSED} from {EVENTS} where {FIRST_FIFTH}",
    "stream_committed_trends": TREND_HOURLY,
    "stream_restarted_totals": f"select count(*) total_orders, {money('total_value')} total_revenue from {EVENTS}",
    "stream_category_rank": f"""select rank() over (order by total_revenue desc) revenue_rank, category,
  total_revenue from ({category_sales(EVENTS)})""",
    "stream_avg_order_value": f"select category, {AVG_VALUE} from {EVENTS} group by 1",
    "message_roundtrip": f"select {PARSED} from {EVENTS}",
    "stream_distinct_products": f"""select strftime(timestamp_parsed, '%Y-%m-%d') "day", category,
  count(*) order_count, true distinct_within_bound from {EVENTS} group by 1, 2""",
    # Five files, a micro-batch each, in order of time.
    "stream_batch_ledger": f"""select stream, 5 batches, count(*) messages, 0 late_rows
  from {EVENTS}, (values ('categories'), ('throughput')) s(stream) group by 1""",
}
