"""Plans have the shape they need at scale, and hot keys do not gather in one task."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemill.operators import aggregates, columns, joins, versions
from tidemill.plans import customers, sales
from tidemill.sources.tables import since

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


LIGHT = ["spend_tiers", "sales_hourly", "product_performance_daily", "zone_stats", "event_summary", "region_category_sales",
         "top_products", "star_enrich", "enrich_rejects", "upsert_latest", "argmax_customer_order", "agg_dict", "daily_digest",
         "retention_risk", "record_quality", "std_values", "counter_rate", "exact_quantiles", "bucket_quantile", "resample_1m"]


@pytest.mark.parametrize("name", LIGHT)
def test_no_python_and_no_product(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert not re.search(r"EvalPython|InPandas|CartesianProduct|BroadcastNestedLoopJoin", text)
    # A window without keys would pull everything into one task.
    assert not re.search(r"Window [^\n]*\n\W*Sort [^\n]*\n\W*Exchange SinglePartition", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(since(table(spark, "orders"), "o_orderdate", "2000-01-01 00:00:00").select("o_orderkey"))
    assert "GreaterThan(o_orderdate" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    text = plan(entry.queries()["day_rows"](spark, SMALL))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    text = plan(entry.queries()["top_products"](spark, SMALL))
    assert "TakeOrderedAndProject" in text and "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in text


def test_lookups_are_broadcast_by_size(spark):
    lookup = table(spark, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    joined = joins.star_join(table(spark, "customer"), [(lookup, "c_nationkey")])
    assert "BroadcastHashJoin" in plan(joined)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(joins.star_join(table(spark, "customer"), [(lookup, "c_nationkey")]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_top_rows_are_limited_before_the_shuffle(spark):
    text = plan(columns.top_per_group(table(spark, "orders"), ["o_custkey"], [F.desc("o_totalprice")], 3))
    assert "row_number(), 3, Partial" in text
    assert "row_number(), 1, Partial" in plan(versions.latest_per_key(table(spark, "orders"), ["o_custkey"], ["o_orderdate"]))


def shuffled_rows(spark, df):
    """Rows written by the exchanges of the executed plan."""
    df.collect()
    found = []
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return found


def hot(spark, n=40_000):
    """A third of the rows share one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), (F.xxhash64("id") % 1000).cast("double").alias("v"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), F.col("id"),
    ).repartition(4)


def test_a_hot_key_sends_one_row_per_task(spark):
    df = hot(spark).withColumn("k", F.when(F.col("k") == -1, F.lit(-1)).otherwise(F.lit(0)))
    best = aggregates.argmax(df, ["k"], ["id"], ["v", "id"])
    assert min(shuffled_rows(spark, best)) <= 2 * 4
    latest = versions.latest_per_key(df, ["k"], ["ts", "id"])
    assert min(shuffled_rows(spark, latest)) <= 2 * 4


def test_hot_series_is_cut_into_chunks(spark):
    from tidemill.operators import rates

    df = hot(spark, 6000).filter("k = -1")
    whole = rates.counter_deltas(df, ["k"], "ts", "v", "id", chunk="100 days").agg(F.sum("delta")).first()[0]
    cut = rates.counter_deltas(df, ["k"], "ts", "v", "id", chunk="1 hour").agg(F.sum("delta")).first()[0]
    assert whole == cut


def test_totals_do_not_depend_on_partitions(spark):
    orders = table(spark, "orders")
    one = sales.spend_by_customer(orders.coalesce(1), ["o_orderstatus"], "o_totalprice")
    many = sales.spend_by_customer(orders.repartition(7), ["o_orderstatus"], "o_totalprice")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_risk_rules(spark):
    rows = [(1, "a", 4, 100.0, "2024-01-14", "VIP"), (2, "b", 0, 10.0, "2024-01-07", "VIP"), (3, "c", 3, 10.0, "2024-01-07", "B"),
            (4, "d", 1, 5.0, "2024-01-20", "VIP"), (5, "e", 1, 900.0, "2023-11-01", "VIP")]
    df = spark.createDataFrame(rows, "customer_id int, customer_name string, total_orders int, total_spent double, d string, customer_segment string")
    df = df.withColumn("last_order_date", F.col("d").cast("timestamp_ntz"))
    got = {r["customer_id"]: (r["risk_level"], r["avg_order_value"], r["days_since_last_order"]) for r in customers.retention_risk(df, "2024-01-29 12:00:00").collect()}
    assert got == {1: ("HIGH", 25.0, 15), 2: ("HIGH", None, 22), 3: ("MEDIUM", 3.33, 22), 4: ("LOW", 5.0, 9)}
    assert [r["customer_id"] for r in customers.retention_risk(df, "2024-01-29 12:00:00", intake=1).collect()] == [1]


def test_strategies_fall_back(spark):
    high = spark.createDataFrame([(1, 9.0), (2, 8.0), (3, 7.0)], "customer_id int, total_spent double")
    answer = spark.createDataFrame([("Plan:\n1. Call\n2. Write",)], "content string")
    got = customers.strategies_by_position(high, answer, [F.desc("total_spent"), F.asc("customer_id")])
    assert {r["customer_id"]: r["ai_strategy"] for r in got.collect()} == {1: "Call", 2: "Write", 3: customers.NO_STRATEGY}


def test_digest(spark):
    rows = [(1, "Down", "x" * 150, "high", "2024-01-01 08:00:00"), (2, "Slow", "y", "low", "2024-01-01 09:00:00"), (3, "Old", "z", "high", "2024-01-02 09:00:00")]
    df = spark.createDataFrame(rows, "id int, title string, description string, priority string, c string").withColumn("created_at", F.col("c").cast("timestamp_ntz"))
    out = customers.daily_digest(df, F.to_date("created_at"), ["high", "medium", "low"], {"high": ["high"], "low": ["low"]})
    first = out.orderBy("day").first()
    assert (first["tickets"], first["high"], first["low"]) == (2, 1, 1)
    assert first["issues"] == "- [high] Down: " + "x" * 100 + "...\n- [low] Slow: y..."
