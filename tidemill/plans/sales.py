"""Sales and event statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.times import trunc_ntz, within_last
from tidemill.functions.values import money_avg, money_sum, spending_tier, tier
from tidemill.operators.columns import top_per_group
from tidemill.operators.joins import star_join
from tidemill.plans.catalog import job, table, tables

AS_OF = "2024-01-30 00:00:00"

# Amounts of the test tables are larger than those the usual tier floors were made for.
TABLE_TIERS = [(5_000_000, "enterprise"), (3_000_000, "growth"), (1_500_000, "scale")]


def spend_by_customer(orders, keys, amount):
    """Order count and spend per key."""
    return orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("order_count"), money_sum(F.col(amount)).alias("total_amount"))


@job("spend_tiers", """
    SELECT c_custkey AS customer_id, n_name AS region, count(*) AS order_count,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
           CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 5000000 THEN 'enterprise'
                WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 3000000 THEN 'growth'
                WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 1500000 THEN 'scale'
                ELSE 'starter' END AS spending_tier
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY c_custkey, n_name ORDER BY total_amount DESC
""")
def spend_tiers(spark, sf_dir):
    orders, customer, nation = tables(spark, sf_dir, "orders", "customer", "nation")
    # Sums first: the join then carries one row per customer instead of one per order.
    spend = spend_by_customer(orders, ["o_custkey"], "o_totalprice")
    named = spend.join(customer, spend["o_custkey"] == customer["c_custkey"]).join(
        nation, customer["c_nationkey"] == nation["n_nationkey"]
    )
    return named.select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("region"), "order_count", "total_amount",
        tier(F.col("total_amount"), TABLE_TIERS, "starter", "unknown").alias("spending_tier"),
    ).orderBy(F.desc("total_amount"), "customer_id")


@job("order_spend_classes", """
    SELECT o_orderstatus AS status,
           CASE WHEN o_totalprice >= 1000 THEN 'enterprise' WHEN o_totalprice >= 500 THEN 'growth'
                WHEN o_totalprice >= 200 THEN 'scale' ELSE 'starter' END AS spending_tier, count(*) AS n
    FROM orders GROUP BY ALL
""")
def order_spend_classes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_orderstatus").alias("status"), spending_tier(F.col("o_totalprice")).alias("spending_tier")).agg(
        F.count(F.lit(1)).alias("n")
    )


def hourly_sales(rows, ts, category, units, amount, customer):
    """Hourly order count, units, revenue, average value and distinct customers per category."""
    return rows.groupBy(trunc_ntz("hour", F.col(ts)).alias("hour"), F.col(category).alias("category")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(units).cast("bigint").alias("total_units"),
        money_sum(F.col(amount)).alias("total_revenue_usd"), money_avg(F.col(amount)).alias("avg_order_value_usd"),
        F.countDistinct(customer).alias("unique_customers"),
    )


@job("sales_hourly", """
    SELECT date_trunc('hour', ts) AS hour, event_type AS category, count(*) AS order_count,
           CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total_units,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_usd,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(value) AS DOUBLE) AS avg_order_value_usd,
           count(DISTINCT user_id) AS unique_customers
    FROM events GROUP BY 1, 2
""")
def sales_hourly(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("units", F.get_json_object("props", "$.k").cast("bigint"))
    return hourly_sales(events, "ts", "event_type", "units", "value", "user_id")


@job("product_performance_daily", """
    SELECT date_trunc('day', l_shipdate) AS day, p_partkey AS product_id, p_name AS product_name, p_type AS category,
           count(*) AS order_count, CAST(sum(l_quantity) AS BIGINT) AS total_units_sold,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_usd
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4
""")
def product_performance_daily(spark, sf_dir):
    lineitem, part = tables(spark, sf_dir, "lineitem", "part")
    # Grouping by the key alone halves the shuffle; the names are joined to the sums.
    sums = lineitem.groupBy(trunc_ntz("day", F.col("l_shipdate")).alias("day"), "l_partkey").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("l_quantity").cast("bigint").alias("total_units_sold"),
        money_sum(F.col("l_extendedprice")).alias("total_revenue_usd"),
    )
    return sums.join(part, sums["l_partkey"] == part["p_partkey"]).select(
        "day", F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), "order_count", "total_units_sold", "total_revenue_usd",
    )


def daily_products(rows, ts, product, name, category, units, amount):
    """Order count, units and revenue per day and product."""
    return rows.groupBy(trunc_ntz("day", F.col(ts)).alias("day"), product, name, category).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(units).cast("bigint").alias("total_units_sold"),
        money_sum(F.col(amount)).alias("total_revenue_usd"),
    )


def zone_totals(rows, zone, country, amount, customer):
    """Order count, revenue, average value and distinct customers per zone and country."""
    return rows.groupBy(zone, country).agg(
        F.count(F.lit(1)).alias("order_count"), money_sum(F.col(amount)).alias("total_revenue_usd"),
        money_avg(F.col(amount)).alias("avg_order_value_usd"), F.countDistinct(customer).alias("unique_customers"),
    )


@job("zone_stats", """
    SELECT r_name AS shipping_zone, n_name AS country, count(*) AS order_count,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_usd,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_order_value_usd,
           count(DISTINCT o_custkey) AS unique_customers
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2
""")
def zone_stats(spark, sf_dir):
    orders, customer, nation, region = tables(spark, sf_dir, "orders", "customer", "nation", "region")
    # A customer has one zone, so its orders are summed before the lookups are joined.
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s")
    )
    joined = star_join(per_customer, [
        (customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey"),
        (nation.withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey"),
        (region, "r_regionkey"),
    ])
    zone = joined.groupBy(F.col("r_name").alias("shipping_zone"), F.col("n_name").alias("country")).agg(
        F.sum("n").alias("order_count"), F.sum("s").cast("double").alias("total_revenue_usd"),
        F.count("c_custkey").alias("unique_customers"),
    )
    return zone.withColumn("avg_order_value_usd", F.col("total_revenue_usd") / F.col("order_count").cast("double"))


@job("event_summary", """
    SELECT event_type, count(*) AS event_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(value) AS DOUBLE) AS avg_revenue
    FROM events GROUP BY event_type ORDER BY event_count DESC
""")
def event_summary(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), money_sum(F.col("value")).alias("total_revenue"),
        money_avg(F.col("value")).alias("avg_revenue"),
    ).orderBy(F.desc("event_count"), "event_type")


@job("daily_revenue", """
    SELECT date_trunc('day', ts) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS daily_revenue,
           count(*) AS daily_events
    FROM events WHERE value > 0 GROUP BY 1 ORDER BY 1 LIMIT 10
""")
def daily_revenue(spark, sf_dir):
    events = table(spark, sf_dir, "events").filter(F.col("value") > 0)
    return events.groupBy(trunc_ntz("day", F.col("ts")).alias("day")).agg(
        money_sum(F.col("value")).alias("daily_revenue"), F.count(F.lit(1)).alias("daily_events")
    ).orderBy("day").limit(10)


@job("daily_patterns", """
    SELECT date_trunc('day', ts) AS day, event_type, count(*) AS events,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM events GROUP BY 1, 2 ORDER BY day, events DESC, event_type
""")
def daily_patterns(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(trunc_ntz("day", F.col("ts")).alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), money_sum(F.col("value")).alias("revenue")
    ).orderBy("day", F.desc("events"), "event_type")


@job("revenue_analysis", """
    SELECT event_type, count(*) AS transactions, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(value) AS DOUBLE) AS avg_revenue,
           max(value) AS max_revenue
    FROM events WHERE value > 0 GROUP BY event_type ORDER BY total_revenue DESC
""")
def revenue_analysis(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("value") > 0).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("transactions"), money_sum(F.col("value")).alias("total_revenue"),
        money_avg(F.col("value")).alias("avg_revenue"), F.max("value").alias("max_revenue"),
    ).orderBy(F.desc("total_revenue"))


@job("json_props", """
    SELECT event_type, count(*) AS events, count(CASE WHEN props LIKE '%7%' THEN 1 END) AS has_seven,
           count(CASE WHEN props LIKE '%"k"%' THEN 1 END) AS has_k,
           CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total
    FROM events GROUP BY event_type
""")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("props").like("%7%")).alias("has_seven"),
        F.count_if(F.col("props").contains('"k"')).alias("has_k"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k_total"),
    )


def event_stats(events, ts, as_of):
    """Totals, last-hour and last-minute counts and the newest event per type."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(within_last(F.col(ts), as_of, "1 HOUR")).alias("last_hour_count"),
        F.count_if(within_last(F.col(ts), as_of, "1 MINUTE")).alias("last_minute_count"),
        F.max(ts).alias("last_event_time"),
    )


@job("events_stats", """
    SELECT event_type, count(*) AS total_count,
           count(CASE WHEN ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 HOUR THEN 1 END) AS last_hour_count,
           count(CASE WHEN ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 MINUTE THEN 1 END) AS last_minute_count,
           max(ts) AS last_event_time
    FROM events GROUP BY event_type
""")
def events_stats(spark, sf_dir):
    return event_stats(table(spark, sf_dir, "events"), "ts", AS_OF)


@job("events_by_type", """
    SELECT event_type, count(*) AS count FROM events GROUP BY event_type ORDER BY count DESC
""")
def events_by_type(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), "event_type"
    )


@job("last_window_counts", """
    SELECT count(*) AS total, count(CASE WHEN ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 30 DAY THEN 1 END) AS last_30_days,
           count(CASE WHEN ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 DAY THEN 1 END) AS last_day,
           count(CASE WHEN ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 HOUR THEN 1 END) AS last_hour,
           max(ts) AS latest
    FROM events
""")
def last_window_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(within_last(F.col("ts"), AS_OF, "30 DAYS")).alias("last_30_days"),
        F.count_if(within_last(F.col("ts"), AS_OF, "1 DAY")).alias("last_day"),
        F.count_if(within_last(F.col("ts"), AS_OF, "1 HOUR")).alias("last_hour"),
        F.max("ts").alias("latest"),
    )


@job("region_category_sales", """
    SELECT n_name AS region, p_type AS category,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2))) AS DOUBLE) AS revenue_sum,
           count(*) AS order_count, max(l_quantity) AS quantity_max
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey
    WHERE l_returnflag <> 'R' GROUP BY 1, 2
""")
def region_category_sales(spark, sf_dir):
    lineitem, part, supplier, nation = tables(spark, sf_dir, "lineitem", "part", "supplier", "nation")
    revenue = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")
    kept = lineitem.filter(F.col("l_returnflag") != "R").withColumn("revenue", revenue)
    joined = kept.join(part, kept["l_partkey"] == part["p_partkey"]).join(
        supplier, kept["l_suppkey"] == supplier["s_suppkey"]
    ).join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    return joined.groupBy(F.col("n_name").alias("region"), F.col("p_type").alias("category")).agg(
        F.sum("revenue").cast("double").alias("revenue_sum"), F.count(F.lit(1)).alias("order_count"),
        F.max("l_quantity").alias("quantity_max"),
    )


@job("top_products", """
    SELECT p_partkey AS product_id, p_name AS product, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 ORDER BY revenue DESC, product_id LIMIT 10
""")
def top_products(spark, sf_dir):
    lineitem, part = tables(spark, sf_dir, "lineitem", "part")
    best = lineitem.groupBy("l_partkey").agg(money_sum(F.col("l_extendedprice")).alias("revenue")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    return best.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product"), "revenue").orderBy(
        F.desc("revenue"), "product_id"
    ).limit(10)


@job("top_products_per_category", """
    SELECT category, product_id, revenue, CAST(rank AS INTEGER) AS rank FROM (
      SELECT p_type AS category, p_partkey AS product_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
             row_number() OVER (PARTITION BY p_type ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, p_partkey) AS rank
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) WHERE rank <= 3
""")
def top_products_per_category(spark, sf_dir):
    lineitem, part = tables(spark, sf_dir, "lineitem", "part")
    sums = lineitem.groupBy("l_partkey").agg(money_sum(F.col("l_extendedprice")).alias("revenue")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    ).select(F.col("p_type").alias("category"), F.col("p_partkey").alias("product_id"), "revenue")
    return top_per_group(sums, ["category"], [F.desc("revenue"), F.asc("product_id")], 3)
