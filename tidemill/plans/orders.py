"""The order flow: accept once, enrich, stage, promote, refresh the views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.times import trunc_ntz
from tidemill.operators.buckets import BucketedTable
from tidemill.operators.joins import enrich, split_enriched
from tidemill.plans.catalog import job, tables
from tidemill.plans.sales import hourly_sales
from tidemill.session import fresh_dir, remove_dir

ORDER_COLUMNS = (
    "order_id", "customer_id", "product_id", "product_name", "category", "quantity", "unit_price", "currency",
    "total_amount_usd", "zip_code", "city", "state", "country", "shipping_zone", "order_timestamp",
)


@dataclass(frozen=True)
class Lookups:
    """``products(product_id, product_name, category)``, ``currencies(currency, rate_to_usd)`` and
    ``zips(zip_code, city, state, country, shipping_zone)``."""

    products: DataFrame
    currencies: DataFrame
    zips: DataFrame


def enrich_orders(staged: DataFrame, lookups: Lookups) -> DataFrame:
    """Orders with product, zone and amount; ``missing`` names lookups without a match.

    The amount is price times quantity times rate, rounded to cents.
    """
    tagged = enrich(staged, {
        "product": (lookups.products, "product_id"), "currency": (lookups.currencies, "currency"), "zip": (lookups.zips, "zip_code"),
    })
    amount = F.col("unit_price").cast("decimal(10,2)") * F.col("quantity") * F.col("rate_to_usd").cast("decimal(10,6)")
    return tagged.withColumn("total_amount_usd", amount.cast("decimal(12,2)"))


class OrderFlow:
    """Staging, production, rejects and the hourly view of one order pipeline.

    Production and rejects lie by hash of the order id, production also by month, and the view by hash of the hour: a batch searches
    the buckets of its orders, reads production of its months, and rewrites the view's buckets of its hours. It writes one
    file for each bucket and month, or several where that is too large for a task.
    """

    def __init__(self, spark: SparkSession, path: str, lookups: Lookups, buckets: int = 4):
        self.spark, self.path, self.lookups = spark, path, lookups
        self.month = F.coalesce(F.date_format("order_timestamp", "yyyy-MM"), F.lit("none"))
        self.production = BucketedTable(spark, f"{path}/production", ["order_id"], buckets, self.month)
        self.rejects = BucketedTable(spark, f"{path}/rejects", ["order_id"], buckets)
        self.hourly = BucketedTable(spark, f"{path}/hourly", ["hour"], buckets)

    def run(self, batch: DataFrame, batch_id: str) -> None:
        """Stage a batch, promote its new complete orders, keep the rest as rejects, refresh touched hours.

        Repeating a batch changes nothing, whether it came to its end or not. An action.
        """
        staging = f"{self.path}/staging/{batch_id}"
        batch.write.mode("overwrite").parquet(staging)
        staged = self.spark.read.schema(batch.schema).parquet(staging)
        tagged, enriched = enrich_orders(staged, self.lookups), f"{self.path}/enriched/{batch_id}"
        tagged.write.mode("overwrite").parquet(enriched)  # joined once, read by rejects and production
        good, bad = split_enriched(self.spark.read.schema(tagged.schema).parquet(enriched))
        self.rejects.insert_absent(bad.select("order_id", "order_timestamp", F.array_join("missing", "|").alias("missing")),
                                   ["order_timestamp"])
        self.production.insert_absent(good.select(*ORDER_COLUMNS), ["order_timestamp"])
        months = [r[0] for r in staged.select(self.month).distinct().collect()]  # one value for each month of the batch
        hour = trunc_ntz("hour", F.col("order_timestamp")).alias("hour")
        facts = self.production.read(months, like=good.select(*ORDER_COLUMNS)).withColumn("hour", hour)
        facts = facts.join(staged.select(hour).distinct(), "hour", "left_semi")
        fresh = hourly_sales(facts, "order_timestamp", "category", "quantity", "total_amount_usd", "customer_id")
        self.hourly.replace_keys(fresh)
        remove_dir(self.spark, enriched)
        remove_dir(self.spark, staging)


def table_orders(spark, sf_dir) -> tuple[DataFrame, Lookups]:
    """Line items as orders; the lookups leave out some parts and nations on purpose."""
    lineitem, orders, part, supplier, nation = tables(spark, sf_dir, "lineitem", "orders", "part", "supplier", "nation")
    # A line repeats within an order, so the position is made unique by its part, supplier and price.
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    rows = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"]).join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"])
    staged = rows.select(
        key.alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"), F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), F.lit(2).cast("decimal(10,2)").alias("unit_price"),
        F.col("l_returnflag").alias("currency"), F.col("s_nationkey").cast("string").alias("zip_code"), F.col("l_shipdate").alias("order_timestamp"),
    )
    rates = spark.createDataFrame([("A", "1.000000"), ("N", "0.920000"), ("R", "149.500000")], "currency string, rate string")
    return staged, Lookups(
        part.filter("p_type <> 'PROMO'").select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category")),
        rates.select("currency", F.col("rate").cast("decimal(10,6)").alias("rate_to_usd")),
        nation.filter("n_regionkey <> 4").select(F.col("n_nationkey").cast("string").alias("zip_code"), F.col("n_name").alias("city"),
                                                 F.lit("-").alias("state"), F.col("n_name").alias("country"), F.col("n_regionkey").alias("shipping_zone")),
    )


TABLE_ORDERS_SQL = """
    staged AS (SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2))) AS order_id,
      o_custkey, l_partkey, CAST(l_quantity AS INTEGER) AS quantity, l_returnflag, s_nationkey, l_shipdate FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
    enriched AS (SELECT *, CAST(2 * quantity * CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.92 ELSE 149.5 END AS DECIMAL(12,2)) AS amount
      FROM staged JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey WHERE p_type <> 'PROMO' AND n_regionkey <> 4)
"""


@job("order_promotion", f"""
    WITH {TABLE_ORDERS_SQL} SELECT date_trunc('hour', l_shipdate) AS hour, p_type AS category, count(*) AS order_count, CAST(sum(quantity) AS BIGINT) AS total_units,
      CAST(sum(amount) AS DOUBLE) AS total_revenue_usd, CAST(sum(amount) AS DOUBLE) / CAST(count(amount) AS DOUBLE) AS avg_order_value_usd,
      count(DISTINCT o_custkey) AS unique_customers FROM enriched GROUP BY 1, 2
""")
def order_promotion(spark, sf_dir):
    """Two batches, the second of which repeats the first; the refreshed hourly view is the result."""
    staged, lookups = table_orders(spark, sf_dir)
    flow = OrderFlow(spark, fresh_dir(spark, "orders"), lookups, buckets=2)
    flow.run(staged.filter("currency = 'A'"), "1")
    flow.run(staged, "2")
    return flow.hourly.read()


@job("order_rejects", """
    SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2))) AS order_id,
      concat_ws('|', CASE WHEN p_type = 'PROMO' THEN 'product' END, CASE WHEN n_regionkey = 4 THEN 'zip' END) AS missing
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey WHERE p_type = 'PROMO' OR n_regionkey = 4
""")
def order_rejects(spark, sf_dir):
    staged, lookups = table_orders(spark, sf_dir)
    rejects = split_enriched(enrich_orders(staged, lookups))[1]
    return rejects.select("order_id", F.array_join("missing", "|").alias("missing")).distinct()
