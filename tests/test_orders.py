from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.operators import buckets, registry, versions
from tidemill.plans import orders, sales
from tidemill.session import fresh_dir
from tidemill.sources import synthetic
from tidemill.streaming import intake


@pytest.fixture(scope="module")
def lookups(spark):
    products = spark.createDataFrame([(f"PROD-{i:03d}", f"Thing {i}", "home" if i % 2 else "toys") for i in range(1, 15)], "product_id string, product_name string, category string")
    rates = spark.createDataFrame([("USD", "1"), ("EUR", "0.92"), ("GBP", "0.79"), ("JPY", "149.5"), ("CAD", "1.36"), ("AUD", "1.52")], "currency string, r string")
    zips = spark.createDataFrame([(f"{10000 + i}", "c", "s", "US", i % 3) for i in range(10)], "zip_code string, city string, state string, country string, shipping_zone int")
    return orders.Lookups(products, rates.select("currency", F.col("r").cast("decimal(10,6)").alias("rate_to_usd")), zips)


def batch(spark, n=300, seed=1):
    return synthetic.orders(spark, n, seed, "2024-01-01 00:00:00", 7200).withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))


def test_amount(spark, lookups):
    row = spark.createDataFrame([("o", "c", "PROD-001", 3, "10.05", "EUR", "10001", "2024-01-01")],
                                "order_id string, customer_id string, product_id string, quantity int, p string, currency string, zip_code string, t string")
    row = row.withColumn("unit_price", F.col("p").cast("decimal(10,2)"))
    got = orders.enrich_orders(row, lookups).first()
    assert got["total_amount_usd"] == Decimal("27.74") and got["missing"] == []


def test_flow(spark, lookups):
    flow = orders.OrderFlow(spark, fresh_dir(spark, "flow"), lookups)
    data = batch(spark)
    flow.run(data.filter("order_timestamp < TIMESTAMP_NTZ '2024-01-01 00:40:00'"), "1")
    first = flow.production.read().count()
    flow.run(data.filter("order_timestamp < TIMESTAMP_NTZ '2024-01-01 00:40:00'"), "1")
    assert flow.production.read().count() == first
    flow.run(data, "2")
    ids = data.select("order_id").distinct().count()
    good, bad = flow.production.read(), flow.rejects.read()
    assert good.count() + bad.count() == ids and good.select("order_id").distinct().count() == good.count()
    # Currency CHF and the fifteenth product have no lookup row.
    assert {r["missing"] for r in bad.select("missing").distinct().collect()} <= {"currency", "product", "product|currency"} and bad.count() > 0
    want = sales.hourly_sales(good, "order_timestamp", "category", "quantity", "total_amount_usd", "customer_id")
    assert sorted(map(tuple, flow.hourly.read().select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    zones = sales.zone_totals(good, "shipping_zone", "country", "total_amount_usd", "customer_id")
    days = sales.daily_products(good, "order_timestamp", "product_id", "product_name", "category", "quantity", "total_amount_usd")
    for view in (zones, days):
        assert view.agg(F.sum("order_count")).first()[0] == good.count()


def test_stream_to_flow(spark, lookups):
    root = fresh_dir(spark, "flow")
    data = batch(spark, 200, 2).withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp"))
    data.repartition(3).write.parquet(f"{root}/in")
    stream = intake.file_stream(spark, f"{root}/in", data.schema, files_per_batch=1)
    intake.drain(stream, f"{root}/cp", intake.ingest_unique(root, "order_id", "order_timestamp", 10_000))
    accepted = spark.read.parquet(f"{root}/accepted")
    assert accepted.count() == data.select("order_id").distinct().count()


def test_a_month_is_read_alone(spark, lookups):
    flow = orders.OrderFlow(spark, fresh_dir(spark, "flow"), lookups)
    month2 = batch(spark, 50, 3).withColumns({"order_id": F.concat(F.lit("m2-"), "order_id"), "order_timestamp": F.col("order_timestamp") + F.expr("INTERVAL 1 MONTH")})
    flow.run(batch(spark, 50, 3), "1")
    flow.run(month2, "2")
    both = flow.production.read()
    assert flow.production.read(["2024-02"]).count() * 2 == both.count() > 0
    plan = flow.production.read(["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_sql_tool(spark):
    root = fresh_dir(spark, "sql")
    log = versions.VersionedTable(spark, f"{root}/lineage")
    artifact = registry.run_sql(spark, "SELECT 1 AS num FROM sales_t", f"{root}/out", {"sales.t": spark.range(2)}, lineage=log, user="me", as_of="d")
    assert artifact.row_count == 2 and artifact.schema == ({"dtype": "int", "name": "num"},)
    assert log.read().first()["inputs"] == ["sales.t"]
    with pytest.raises(PermissionError):
        registry.run_sql(spark, "SELECT 1", f"{root}/no", {"finance.ledger": spark.range(1)})


@pytest.mark.parametrize("sql", [
    "SELECT * FROM finance.secret", "SELECT 1 WHERE EXISTS (SELECT 1 FROM Finance.secret)", "WITH x AS (SELECT * FROM finance.secret) SELECT * FROM x",
    "SELECT * FROM finance_ledger", "SELECT * FROM parquet.`/tmp/x`", "CREATE TABLE y AS SELECT * FROM spark_catalog.finance.secret",
])
def test_sql_names_no_restricted_table(spark, sql):
    with pytest.raises(PermissionError):
        registry.check_query(spark, sql, ["ops"])
    if "parquet" not in sql:
        registry.check_query(spark, sql, ["finance"])
    registry.check_query(spark, "SELECT * FROM sales_t JOIN range(3)", [])


def test_a_large_bucket_is_written_by_several_tasks(spark):
    data = spark.range(20_000).select(F.col("id").cast("string").alias("order_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    table = buckets.BucketedTable(spark, fresh_dir(spark, "buckets"), ["order_id"], 1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        table.insert_absent(data, ["text"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(table.read().inputFiles()) > 1 and table.read().distinct().count() == 20_000


def test_a_batch_leaves_no_enriched_rows(spark, lookups):
    root = fresh_dir(spark, "flow")
    flow = orders.OrderFlow(spark, root, lookups)
    flow.run(batch(spark, 50, 4), "1")
    from pyspark.errors import AnalysisException

    for folder in ("staging/1", "enriched/1"):
        with pytest.raises(AnalysisException):
            spark.read.parquet(f"{root}/{folder}")
