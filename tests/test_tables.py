"""Lines are dealt to more tasks as the table grows."""

from datetime import datetime, timedelta

from tillstream.sources import tables

START = datetime(2024, 1, 1)


def spark_rows(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_lines_are_joined_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    lines = [(n % 100, n % 10, 2.0) for n in range(400)] + [(None, 1, 1.0), (5, None, 1.0)]
    spark_rows(spark, tmp_path, "lineitem", lines, "l_orderkey long, l_partkey long, l_quantity double")
    parts = [(n, f"part {n}", "kind", 10.0 + n) for n in range(10)]
    spark_rows(
        spark, tmp_path, "part", parts, "p_partkey long, p_name string, p_type string, p_retailprice double"
    )
    made = [(n, n, START + timedelta(days=n)) for n in range(100)]
    spark_rows(
        spark, tmp_path, "orders", made, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"
    )
    small = tables.lineitem_orders(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" not in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tables, "TASK_LINES", 20)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = tables.lineitem_orders(spark, str(tmp_path))
        plan = large._jdf.queryExecution().executedPlan().toString()
        both = sorted(large.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # 402 lines; the orders are dealt to the same tasks, above the four partitions of the session.
    assert plan.count(", 21)") == 2 and "REPARTITION_BY_NUM" in plan
    assert both == sorted(small.collect()) and len(both) == 400
