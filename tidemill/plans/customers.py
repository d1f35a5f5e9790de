"""Customer retention and daily digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import numbered_lines, preview
from tidemill.functions.times import moment, trunc_ntz, whole_days_between
from tidemill.functions.values import money_sum
from tidemill.operators.columns import dense_row_ids, priority_order, top_per_group
from tidemill.plans.catalog import job, table, tables
from tidemill.plans.relational import PRIORITIES

AS_OF = "2001-08-02 00:00:00"

# Recency limits in days, size of the intake and its span, and the fallback text.
HIGH_DAYS, MEDIUM_DAYS, INTAKE, ACTIVE_SPAN = 14, 21, 100, "30 DAYS"
NO_STRATEGY = "No specific strategy generated"


def risk_level(days: Column, segment: Column, vip: str = "VIP") -> Column:
    return F.when((days > HIGH_DAYS) & (segment == vip), "HIGH").when(days > MEDIUM_DAYS, "MEDIUM").otherwise("LOW")


def retention_risk(customers: DataFrame, as_of: str, vip: str = "VIP", intake: int | None = INTAKE) -> DataFrame:
    """Recently active customers with the greatest spend: average order value, recency and risk.

    ``customers`` is ``(customer_id, customer_name, total_orders, total_spent, last_order_date, customer_segment)``.
    """
    active = customers.filter(F.col("last_order_date") >= moment(as_of) - F.expr(f"INTERVAL {ACTIVE_SPAN}"))
    if intake is not None:
        active = active.orderBy(F.desc("total_spent"), "customer_id").limit(intake)
    days = whole_days_between(moment(as_of), F.col("last_order_date"))
    return active.withColumns({
        "avg_order_value": F.round(F.try_divide(F.col("total_spent").cast("decimal(18,2)"), F.col("total_orders").cast("decimal(18,0)")), 2).cast("double"),
        "days_since_last_order": days,
        "risk_level": risk_level(days, F.col("customer_segment"), vip),
        "analysis_date": F.date_format(moment(as_of), "yyyy-MM-dd"),
    })


def risk_summary(enriched: DataFrame) -> DataFrame:
    """One row: customers per risk level, mean order value and revenue."""
    level = F.col("risk_level")
    return enriched.agg(
        F.count(F.lit(1)).alias("total_customers"), F.count_if(level == "HIGH").alias("high_risk"),
        F.count_if(level == "MEDIUM").alias("medium_risk"), F.count_if(level == "LOW").alias("low_risk"),
        F.round(F.avg(F.col("avg_order_value").cast("decimal(18,2)")), 2).cast("double").alias("avg_order_value"),
        money_sum(F.col("total_spent")).alias("total_revenue"), F.max("analysis_date").alias("analysis_date"),
    )


def strategies_by_position(high_risk: DataFrame, answers: DataFrame, order: list[Column], text: str = "content") -> DataFrame:
    """Match the n-th numbered line of the answer text to the n-th customer; the rest get the default."""
    lines = answers.select(F.posexplode(numbered_lines(F.col(text))).alias("_p", "ai_strategy"))
    placed = dense_row_ids(high_risk, order, "_row", start=0)
    joined = placed.join(lines, placed["_row"] == lines["_p"], "left")
    return joined.withColumn("ai_strategy", F.coalesce("ai_strategy", F.lit(NO_STRATEGY))).drop("_row", "_p")


def customer_activity(spark, sf_dir) -> DataFrame:
    customer, orders = tables(spark, sf_dir, "customer", "orders")
    spend = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("total_orders"), money_sum(F.col("o_totalprice")).alias("total_spent"),
        F.max("o_orderdate").alias("last_order_date"),
    )
    return spend.join(customer, "c_custkey").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), "total_orders", "total_spent",
        "last_order_date", F.col("c_mktsegment").alias("customer_segment"),
    )


ACTIVITY_SQL = """
    activity AS (SELECT c_custkey AS customer_id, c_name AS customer_name, n AS total_orders, s AS total_spent, d AS last_order_date, c_mktsegment AS customer_segment
      FROM customer JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s, max(o_orderdate) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey),
    intake AS (SELECT * FROM activity WHERE last_order_date >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAY ORDER BY total_spent DESC, customer_id LIMIT 100),
    risk AS (SELECT *, round(CAST(total_spent AS DECIMAL(18,2)) / total_orders, 2)::DOUBLE AS avg_order_value,
      CAST(floor((epoch_us(TIMESTAMP '2001-08-02') - epoch_us(last_order_date)) / 86400000000) AS BIGINT) AS days_since_last_order FROM intake),
    levels AS (SELECT *, CASE WHEN days_since_last_order > 14 AND customer_segment = 'AUTOMOBILE' THEN 'HIGH'
      WHEN days_since_last_order > 21 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level, '2001-08-02' AS analysis_date FROM risk)
"""


@job("retention_risk", f"WITH {ACTIVITY_SQL} SELECT * FROM levels")
def retention_risk_job(spark, sf_dir):
    return retention_risk(customer_activity(spark, sf_dir), AS_OF, "AUTOMOBILE")


@job("risk_summary", f"""
    WITH {ACTIVITY_SQL} SELECT count(*) AS total_customers, count(CASE WHEN risk_level = 'HIGH' THEN 1 END) AS high_risk,
      count(CASE WHEN risk_level = 'MEDIUM' THEN 1 END) AS medium_risk, count(CASE WHEN risk_level = 'LOW' THEN 1 END) AS low_risk,
      round(CAST(sum(CAST(avg_order_value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_order_value,
      CAST(sum(CAST(total_spent AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, max(analysis_date) AS analysis_date FROM levels
""")
def risk_summary_job(spark, sf_dir):
    return risk_summary(retention_risk(customer_activity(spark, sf_dir), AS_OF, "AUTOMOBILE"))


@job("strategy_lines", f"""
    WITH {ACTIVITY_SQL}, high AS (SELECT *, row_number() OVER (ORDER BY total_spent DESC, customer_id) AS pos FROM levels WHERE risk_level = 'HIGH'),
    lines AS (SELECT 'Offer from ' || n_name AS t, row_number() OVER (ORDER BY n_nationkey) AS pos FROM nation)
    SELECT customer_id, coalesce(t, 'No specific strategy generated') AS ai_strategy FROM high LEFT JOIN lines USING (pos)
""")
def strategy_lines(spark, sf_dir):
    levels = retention_risk(customer_activity(spark, sf_dir), AS_OF, "AUTOMOBILE")
    nation = table(spark, sf_dir, "nation")
    numbered = nation.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n")).select(
        F.array_join(F.transform("n", lambda e: F.concat((e["n_nationkey"] + 1).cast("string"), F.lit(". Offer from "), e["n_name"])), "\n").alias("content")
    )
    return strategies_by_position(
        levels.filter("risk_level = 'HIGH'"), numbered, [F.desc("total_spent"), F.asc("customer_id")]
    ).select("customer_id", "ai_strategy")


# Fixed values of the digest: characters of a description, of the whole list, and the shortest possible line.
DESCRIPTION_CHARS, DIGEST_CHARS, SHORTEST_LINE = 100, 500, 10


def daily_digest(tickets: DataFrame, day: Column, ranked: list[str], levels: dict[str, list[str]]) -> DataFrame:
    """Counts per priority group and the top issues of every day.

    ``tickets`` is ``(id, title, description, priority, created_at)``. The list is
    cut at 500 characters and a line has at least ten, so fifty lines per day
    decide it; only those meet in one task.
    """
    dated = tickets.withColumn("day", day)
    counts = dated.groupBy("day").agg(
        F.count(F.lit(1)).alias("tickets"), *[F.count_if(F.col("priority").isin(v)).alias(n) for n, v in levels.items()]
    )
    order = [priority_order(F.col("priority"), ranked), F.desc("created_at"), F.asc("id")]
    top = top_per_group(dated, ["day"], order, DIGEST_CHARS // SHORTEST_LINE + 1, "place")
    line = F.concat(F.lit("- ["), "priority", F.lit("] "), "title", F.lit(": "), preview(F.coalesce("description", F.lit("")), DESCRIPTION_CHARS), F.lit("..."))
    lists = top.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("l")).select(
        "day", preview(F.array_join(F.transform("l", lambda e: e["line"]), "\n"), DIGEST_CHARS).alias("issues")
    )
    return counts.join(lists, "day")


LEVELS = {"high": ["1-URGENT", "2-HIGH"], "medium": ["3-MEDIUM"], "low": ["4-NOT SPECIFIED", "5-LOW"]}


@job("daily_digest", """
    WITH t AS (SELECT date_trunc('day', o_orderdate) AS day, o_orderkey AS id, o_orderpriority AS priority, o_orderdate,
      CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 ELSE 5 END AS p,
      '- [' || o_orderpriority || '] Order ' || o_orderkey || ': customer ' || o_custkey || ' status ' || o_orderstatus || '...' AS line FROM orders)
    SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS tickets, count(CASE WHEN p < 2 THEN 1 END) AS high, count(CASE WHEN p = 2 THEN 1 END) AS medium,
      count(CASE WHEN p > 2 THEN 1 END) AS low, substring(string_agg(line, chr(10) ORDER BY p, o_orderdate DESC, id), 1, 500) AS issues
    FROM t GROUP BY 1
""")
def daily_digest_job(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    tickets = orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string"), F.lit(" status "), "o_orderstatus").alias("description"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("created_at"),
    )
    digest = daily_digest(tickets, trunc_ntz("day", F.col("created_at")), PRIORITIES, LEVELS)
    return digest.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
