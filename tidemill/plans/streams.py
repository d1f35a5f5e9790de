"""Streaming jobs, replayed over the tables until all input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.payloads import is_json
from tidemill.operators import sinks
from tidemill.operators.buckets import BucketedTable
from tidemill.operators.joins import enrich, split_enriched
from tidemill.plans.catalog import job, table, tables
from tidemill.plans.sales import hourly_sales
from tidemill.session import fresh_dir
from tidemill.streaming import intake, sync

AS_OF = "2024-01-31 00:00:00"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; its event time is in UTC."""
    schema = table(spark, sf_dir, "events").schema
    # Written as a pattern, the path may be one file or a folder of files.
    return intake.file_stream(spark, f"{sf_dir}/events.parque[t]", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def resent(events: DataFrame) -> DataFrame:
    """Every purchase arrives a second time ten minutes later."""
    copies = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(600))).otherwise(F.array(F.lit(0)))
    shifted = events.withColumn("_late", F.explode(copies))
    return shifted.withColumn("ts", F.timestamp_seconds(F.unix_micros("ts") / 1_000_000 + F.col("_late"))).drop("_late")


@job("dedup_stream", "SELECT event_id, event_type, user_id, value FROM events")
def dedup_stream(spark, sf_dir):
    root = fresh_dir(spark, "dedup")
    unique = intake.dedup(resent(event_stream(spark, sf_dir)), "event_id", "ts", intake.REPLAY)
    intake.drain(unique, f"{root}/checkpoint", intake.to_folder(f"{root}/out"))
    return spark.read.parquet(f"{root}/out").select("event_id", "event_type", "user_id", "value")


@job("intake_stats", """
    SELECT n + p AS total, n AS new, p AS duplicates, n AS queued FROM (
      SELECT count(*) AS n, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS p FROM events)
""")
def intake_stats(spark, sf_dir):
    root = fresh_dir(spark, "intake")
    stream = resent(event_stream(spark, sf_dir)).select("event_id", "ts", "event_type")
    intake.drain(stream, f"{root}/checkpoint", intake.ingest_unique(root, "event_id", "ts"))
    return spark.read.parquet(f"{root}/stats").agg(*[F.sum(c).alias(c) for c in ("total", "new", "duplicates", "queued")])


@job("sliding_counts", """
    WITH w AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - off AS window_start, value FROM events, (VALUES (INTERVAL 0 MINUTE), (INTERVAL 30 MINUTE)) o(off))
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM w GROUP BY 1, 2
""")
def sliding_counts(spark, sf_dir):
    root = fresh_dir(spark, "sliding")
    counts = intake.windowed_counts(event_stream(spark, sf_dir), "ts", [], "1 hour", "30 minutes", lateness=None,
                                    aggs={"total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")})
    intake.drain(counts, f"{root}/checkpoint", intake.to_folder(f"{root}/out"), "update")
    rows = intake.current_rows(spark, f"{root}/out", ["window_start", "window_end"])
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@job("stream_stats", """
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2
""")
def stream_stats(spark, sf_dir):
    root = fresh_dir(spark, "stats")
    counts = intake.windowed_counts(event_stream(spark, sf_dir), "ts", ["event_type"], "1 day", lateness=None)
    intake.drain(counts, f"{root}/checkpoint", intake.to_folder(f"{root}/out"), "update")
    rows = intake.current_rows(spark, f"{root}/out", ["window_start", "window_end", "event_type"])
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@job("dlq_split", """
    SELECT 'events' AS target, event_type AS detail, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 2
    UNION ALL SELECT 'dead_letters', 'payload is no JSON', count(*) FROM events WHERE event_type = 'error'
""")
def dlq_split(spark, sf_dir):
    """Error events get a broken payload and must end up as dead letters."""
    root = fresh_dir(spark, "routing")
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("!"), "props")).otherwise(F.col("props"))
    stream = event_stream(spark, sf_dir).withColumn("props", broken)
    error = F.when(~is_json(F.col("props")), F.lit("payload is no JSON"))
    intake.drain(stream, f"{root}/checkpoint", intake.route(root, error, "event_id", "props", ["event_id", "event_type", "props"], AS_OF))
    good = spark.read.parquet(f"{root}/events").select(F.lit("events").alias("target"), F.col("event_type").alias("detail"))
    bad = spark.read.parquet(f"{root}/dead_letters").select(F.lit("dead_letters").alias("target"), F.col("error_message").alias("detail"))
    return good.unionByName(bad).groupBy("target", "detail").agg(F.count(F.lit(1)).alias("n"))


@job("payload_normalise", """
    SELECT CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS event_type,
      count(CASE WHEN event_type = 'click' THEN 1 END) AS raw_payloads, count(*) AS n FROM events GROUP BY 1
""")
def payload_normalise(spark, sf_dir):
    root = fresh_dir(spark, "normalise")
    kind = F.col("event_type")
    messy = event_stream(spark, sf_dir).withColumns({
        "event_type": F.when(kind != "error", kind), "props": F.when(kind == "click", F.concat(F.lit("text "), "props")).otherwise(F.col("props")),
    })
    intake.drain(intake.normalise_events(messy, payload="props"), f"{root}/checkpoint", intake.to_folder(f"{root}/out"))
    raw = F.get_json_object("props", "$.raw").isNotNull()
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count_if(raw).alias("raw_payloads"), F.count(F.lit(1)).alias("n"))


@job("stream_enrich", """
    SELECT c_mktsegment AS segment, count(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1
    UNION ALL SELECT NULL, count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer) HAVING count(*) > 0
""")
def stream_enrich(spark, sf_dir):
    root = fresh_dir(spark, "enrich")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    out = intake.enrich_stream(event_stream(spark, sf_dir), {"customer": (customer, "user_id")})
    intake.drain(out, f"{root}/checkpoint", intake.to_folder(f"{root}/out"))
    return spark.read.parquet(f"{root}/out").groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@job("retry_schedule", """
    WITH f AS (SELECT event_id, ts, CAST(1 + event_id % 5 AS INTEGER) AS attempt FROM events WHERE event_type = 'error')
    SELECT event_id, attempt, CASE WHEN attempt >= 4 THEN 'dead_letter' ELSE 'retry' END AS outcome,
      CASE WHEN attempt < 4 THEN least(60.0::DOUBLE, 2.0::DOUBLE * 2 ** (attempt - 1)) END AS delay_seconds,
      CASE WHEN attempt < 4 THEN attempt + 1 END AS next_attempt,
      CASE WHEN attempt < 4 THEN ts + to_seconds(CAST(2 * 2 ** (attempt - 1) AS BIGINT)) END AS next_attempt_at FROM f
""")
def retry_schedule(spark, sf_dir):
    failures = table(spark, sf_dir, "events").filter("event_type = 'error'").select(
        "event_id", "ts", (F.lit(1) + F.col("event_id") % 5).cast("int").alias("attempt")
    )
    return sync.schedule_retries(failures, "attempt", "ts").drop("ts")


@job("stream_dashboard", """
    SELECT event_type, count(*) AS total, count(CASE WHEN ts > TIMESTAMP '2024-01-30' - INTERVAL 1 MINUTE THEN 1 END) AS last_minute,
      count(CASE WHEN ts > TIMESTAMP '2024-01-30' - INTERVAL 1 HOUR THEN 1 END) AS last_hour, max(ts) AS last_event_time FROM events GROUP BY 1
""")
def stream_dashboard(spark, sf_dir):
    """Totals by type over the landed event table."""
    from tidemill.plans.sales import event_stats

    root = fresh_dir(spark, "dashboard")
    intake.drain(event_stream(spark, sf_dir), f"{root}/checkpoint", intake.to_folder(f"{root}/out"))
    landed = spark.read.parquet(f"{root}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return event_stats(landed, "ts", "2024-01-30 00:00:00").withColumnsRenamed(
        {"total_count": "total", "last_hour_count": "last_hour", "last_minute_count": "last_minute"}
    )


@job("order_flow", """
    SELECT date_trunc('hour', ts) AS hour, c_mktsegment AS category, count(*) AS order_count, CAST(sum(user_id) AS BIGINT) AS total_units,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_usd,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(value) AS DOUBLE) AS avg_order_value_usd, count(DISTINCT user_id) AS unique_customers
    FROM events JOIN customer ON user_id = c_custkey JOIN part ON p_partkey = event_id % 1000 GROUP BY 1, 2
""")
def order_flow(spark, sf_dir):
    """Ingest without duplicates → enrich → stage → promote → refresh the hourly view."""
    root = fresh_dir(spark, "orders")
    stream = resent(event_stream(spark, sf_dir)).withColumn("product", F.col("event_id") % 1000)
    intake.drain(stream, f"{root}/checkpoint", intake.ingest_unique(f"{root}/intake", "event_id", "ts"))
    accepted = spark.read.parquet(f"{root}/intake/accepted").drop("batch_id").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    customer, part = tables(spark, sf_dir, "customer", "part")
    tagged = enrich(accepted, {
        "customer": (customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("category")), "user_id"),
        "product": (part.select(F.col("p_partkey").alias("product"), "p_name"), "product"),
    })
    sinks.write_parquet(tagged, f"{root}/staging")
    good, rejects = split_enriched(spark.read.parquet(f"{root}/staging"))
    sinks.write_parquet(rejects, f"{root}/rejects")
    production = BucketedTable(spark, f"{root}/production", ["event_id"])
    production.insert_absent(good, ["ts"])
    return hourly_sales(production.read(), "ts", "category", "user_id", "value", "user_id")
