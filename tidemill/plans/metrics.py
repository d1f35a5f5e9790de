"""Time-series analytics: rates, histograms, quantiles, anomalies and metric results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import aggregates, rates
from tidemill.plans.catalog import job, table
from tidemill.session import fresh_dir
from tidemill.sources.metric_results import result_rows, to_matrix, with_datetime

DELTAS_SQL = """
    deltas AS (SELECT event_type, ts, CASE WHEN v < p THEN v ELSE v - p END AS delta FROM (
      SELECT event_type, ts, CAST(value AS DECIMAL(18,2)) AS v,
             lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM events) WHERE p IS NOT NULL)
"""


def event_counters(spark, sf_dir):
    """Event values read as counter samples, one series per type; every drop is a restart."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", F.col("value").cast("decimal(18,2)").alias("v"))
    return rates.counter_deltas(events, ["event_type"], "ts", "v", "event_id")


@job("counter_increase", f"""
    WITH {DELTAS_SQL} SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, CAST(sum(delta) AS DOUBLE) AS increase FROM deltas GROUP BY 1, 2
""")
def counter_increase(spark, sf_dir):
    grown = rates.windowed_increase(event_counters(spark, sf_dir), ["event_type"], "ts", "5 minutes")
    return grown.withColumn("increase", F.col("increase").cast("double"))


@job("counter_rate", f"""
    WITH {DELTAS_SQL} SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CAST(sum(delta) AS DOUBLE) / 3600 AS rate FROM deltas GROUP BY 1, 2
""")
def counter_rate(spark, sf_dir):
    return rates.windowed_rate(event_counters(spark, sf_dir), ["event_type"], "ts", "1 hour", 3600)


@job("rate_sliding", """
    WITH d AS (SELECT event_type, ts, CAST(value AS DECIMAL(18,2)) AS v,
      lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type, user_id % 10 ORDER BY ts, event_id) AS b FROM events),
    m AS (SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts) AS w, CASE WHEN v < b THEN v ELSE v - b END AS delta FROM d WHERE b IS NOT NULL)
    SELECT event_type, w + n * INTERVAL 1 MINUTE AS at, CAST(sum(delta) AS DOUBLE) / 300 AS rate FROM m, range(1, 6) r(n) GROUP BY 1, 2
""")
def rate_sliding(spark, sf_dir):
    """Rate over five minutes at every minute, of ten counters for each type, summed by type."""
    events = table(spark, sf_dir, "events").select(
        "event_type", (F.col("user_id") % 10).alias("shard"), "ts", "event_id", F.col("value").cast("decimal(18,2)").alias("v"))
    deltas = rates.counter_deltas(events, ["event_type", "shard"], "ts", "v", "event_id")
    return rates.sliding_rate(deltas, ["event_type"], "ts", 5, "1 minute", 60)


@job("resample_1m", """
    SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts) AS step_start, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2
""")
def resample_1m(spark, sf_dir):
    return rates.resample(table(spark, sf_dir, "events"), ["event_type"], "ts", "value", "1 minute", "event_id")


@job("range_query", """
    WITH e AS (SELECT event_type, ts, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2),
    g AS (SELECT DISTINCT event_type, unnest(generate_series(time_bucket(INTERVAL 1 MINUTE, lo), hi + INTERVAL 6 MINUTE, INTERVAL 1 MINUTE)) AS at
      FROM events, (SELECT min(ts) AS lo, max(ts) AS hi FROM events))
    SELECT g.event_type, g.at, e.value FROM g ASOF JOIN e ON g.event_type = e.event_type AND g.at >= e.ts WHERE g.at < e.ts + INTERVAL 5 MINUTE
""")
def range_query(spark, sf_dir):
    """The last value within five minutes, at every minute."""
    return rates.values_at_steps(table(spark, sf_dir, "events"), ["event_type"], "ts", "value", 60, 300, "event_id")


@job("bucket_rate_quantile", """
    WITH bounds AS (SELECT unnest([0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 'infinity'::DOUBLE]::DOUBLE[]) AS le),
    m AS (SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts) AS start, le, count(*) FILTER (value <= le) AS c FROM events, bounds GROUP BY 1, 2, 3),
    b AS (SELECT event_type, start + a * INTERVAL 1 MINUTE AS moment, le, CAST(sum(c) AS DOUBLE) AS c FROM m, range(1, 6) r(a) GROUP BY 1, 2, 3),
    s AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(c) OVER w, 0) AS before, max(c) OVER (PARTITION BY event_type, moment) AS n
      FROM b WINDOW w AS (PARTITION BY event_type, moment ORDER BY le)),
    q AS (SELECT event_type, moment, q, le, low, c, before, n * q AS rank FROM s, (VALUES (0.5::DOUBLE), (0.95)) x(q) WHERE c >= n * q AND c > 0
      QUALIFY row_number() OVER (PARTITION BY event_type, moment, q ORDER BY le) = 1)
    SELECT event_type, moment AS "at", max(CASE WHEN q = 0.5 THEN v END) AS p50, max(CASE WHEN q = 0.95 THEN v END) AS p95 FROM (
      SELECT event_type, moment, q, round(CASE WHEN le = 'infinity' THEN low ELSE low + (le - low) * ((rank - before) / (c - before)) END, 6) AS v FROM q)
    GROUP BY 1, 2
""")
def bucket_rate_quantile(spark, sf_dir):
    """Median and 95th percentile from the growth of histogram buckets over five minutes, at every minute."""
    events = table(spark, sf_dir, "events").withColumn("start", F.window("ts", "1 minute").getField("start"))
    grown = rates.sliding_buckets(aggregates.bucket_counts(events, ["event_type", "start"], "value"), ["event_type"], "start", 5, 60)
    p50 = aggregates.bucket_quantile(grown, ["event_type", "at"], 0.5, "p50")
    p95 = aggregates.bucket_quantile(grown, ["event_type", "at"], 0.95, "p95")
    return p50.join(p95, ["event_type", "at"]).select("event_type", "at", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@job("quality_trend", """
    SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS step_start, arg_max(value, (ts, event_id)) AS quality_score,
           epoch_us(time_bucket(INTERVAL 1 MINUTE, ts)) // 1000000 AS timestamp
    FROM events WHERE event_type = 'view' AND ts > TIMESTAMP '2024-01-30' - INTERVAL 48 HOUR GROUP BY 1
""")
def quality_trend(spark, sf_dir):
    recent = table(spark, sf_dir, "events").filter(
        (F.col("event_type") == "view") & (F.col("ts") > F.lit("2024-01-30").cast("timestamp_ntz") - F.expr("INTERVAL 48 HOURS"))
    )
    steps = rates.resample(recent, ["event_type"], "ts", "value", "1 minute", "event_id")
    return steps.select("step_start", F.col("value").alias("quality_score"), F.unix_timestamp("step_start").alias("timestamp"))


@job("latest_sums", """
    SELECT event_type, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
      SELECT event_type, user_id, arg_max(value, (ts, event_id)) AS v FROM events GROUP BY 1, 2) GROUP BY 1
""")
def latest_sums(spark, sf_dir):
    latest = rates.latest_samples(table(spark, sf_dir, "events"), ["event_type", "user_id"], "ts", "value", "event_id")
    exact = latest.withColumn("value", F.col("value").cast("decimal(18,2)"))
    return rates.sum_by(exact, ["event_type"], "value").withColumn("total", F.col("total").cast("double"))


@job("stage_average", """
    SELECT event_type, round(avg(s / n), 6) AS avg_duration_seconds FROM (
      SELECT event_type, user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1
""")
def stage_average(spark, sf_dir):
    sums = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("s"), F.count(F.lit(1)).alias("n")
    )
    out = rates.average_ratio_by(sums, ["event_type"], "s", "n", "avg_duration_seconds")
    return out.withColumn("avg_duration_seconds", F.round("avg_duration_seconds", 6))


@job("throughput", f"""
    WITH {DELTAS_SQL}, r AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS w, CAST(sum(delta) AS DOUBLE) / 3600 AS rate FROM deltas GROUP BY 1, 2)
    SELECT event_type, round(avg(rate), 9) AS avg_rows_per_second, max(rate) AS peak_rows_per_second, count(*) AS sample_count FROM r GROUP BY 1
""")
def throughput(spark, sf_dir):
    hourly = rates.windowed_rate(event_counters(spark, sf_dir), ["event_type"], "ts", "1 hour", 3600)
    out = rates.throughput_summary(hourly, ["event_type"], "rate")
    return out.withColumn("avg_rows_per_second", F.round("avg_rows_per_second", 9))


@job("throughput_peak", f"""
    WITH {DELTAS_SQL}, r AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CAST(sum(delta) AS DOUBLE) / 3600 AS rate FROM deltas GROUP BY 1, 2)
    SELECT * FROM r WHERE rate = (SELECT max(rate) FROM r)
""")
def throughput_peak(spark, sf_dir):
    return rates.peak_rows(rates.windowed_rate(event_counters(spark, sf_dir), ["event_type"], "ts", "1 hour", 3600), "rate")


@job("bucket_counts", """
    SELECT event_type, le, count(CASE WHEN value <= le THEN 1 END) AS count FROM events,
    (VALUES (0.1::DOUBLE), (0.5), (1), (2.5), (5), (10), (30), (60), ('infinity'::DOUBLE)) b(le) GROUP BY 1, 2
""")
def bucket_counts(spark, sf_dir):
    return aggregates.bucket_counts(table(spark, sf_dir, "events"), ["event_type"], "value")


@job("bucket_quantile", """
    WITH b AS (SELECT event_type, le, count(CASE WHEN value <= le THEN 1 END)::DOUBLE AS c FROM events,
        (VALUES (0.1::DOUBLE), (0.5), (1), (2.5), (5), (10), (30), (60), ('infinity'::DOUBLE)) b(le) GROUP BY 1, 2),
    s AS (SELECT event_type, le, c, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(c) OVER w, 0) AS before, max(c) OVER (PARTITION BY event_type) AS n
        FROM b WINDOW w AS (PARTITION BY event_type ORDER BY le)),
    q AS (SELECT event_type, q, le, low, c, before, n * q AS rank FROM s, (VALUES (0.5::DOUBLE), (0.95)) x(q) WHERE c >= n * q AND c > 0
        QUALIFY row_number() OVER (PARTITION BY event_type, q ORDER BY le) = 1)
    SELECT event_type, max(CASE WHEN q = 0.5 THEN v END) AS p50, max(CASE WHEN q = 0.95 THEN v END) AS p95 FROM (
      SELECT event_type, q, round(CASE WHEN le = 'infinity' THEN low ELSE low + (le - low) * ((rank - before) / (c - before)) END, 6) AS v FROM q) GROUP BY 1
""")
def bucket_quantile(spark, sf_dir):
    buckets = aggregates.bucket_counts(table(spark, sf_dir, "events"), ["event_type"], "value")
    p50 = aggregates.bucket_quantile(buckets, ["event_type"], 0.5, "p50")
    p95 = aggregates.bucket_quantile(buckets, ["event_type"], 0.95, "p95")
    return p50.join(p95, "event_type").select("event_type", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@job("exact_quantiles", """
    SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1
""")
def exact_quantiles(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    both = aggregates.exact_quantiles(events, ["event_type"], "value", {"median": 0.5, "p95": 0.95})
    return both.select("event_type", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"))


@job("median_anomaly", """
    SELECT e.event_type, event_id, value, round(median, 6) AS median, round(2 * median, 6) AS threshold FROM events e
    JOIN (SELECT event_type, median(value) AS median FROM events GROUP BY 1) m ON e.event_type = m.event_type WHERE value > 2 * median
""")
def median_anomaly(spark, sf_dir):
    flagged = aggregates.above_median(table(spark, sf_dir, "events").select("event_type", "event_id", "value"), ["event_type"], "value")
    return flagged.select("event_type", "event_id", "value", F.round("median", 6).alias("median"), F.round("threshold", 6).alias("threshold"))


@job("freshness", """
    SELECT event_type, max(ts) AS latest, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1000000.0::DOUBLE AS freshness_seconds FROM events GROUP BY 1
""")
def freshness(spark, sf_dir):
    return aggregates.freshness_seconds(table(spark, sf_dir, "events"), "ts", "2024-01-31 00:00:00", ["event_type"])


@job("matrix_to_rows", """
    SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, epoch_us(ts) AS micros, value FROM events
""")
def matrix_to_rows(spark, sf_dir):
    folded = to_matrix(table(spark, sf_dir, "events"), ["event_type", "user_id"], "ts", "value")
    rows = result_rows(folded)
    return rows.select(
        F.col("metric")["event_type"].alias("event_type"), F.col("metric")["user_id"].alias("user_id"),
        F.round(F.col("timestamp") * 1_000_000).cast("bigint").alias("micros"), "value",
    )


@job("error_increase", f"""
    WITH {DELTAS_SQL} SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, CAST(sum(delta) AS DOUBLE) AS increase FROM deltas
    WHERE event_type = 'error' GROUP BY 1
""")
def error_increase(spark, sf_dir):
    errors = event_counters(spark, sf_dir).filter(F.col("event_type") == "error")
    return rates.windowed_increase(errors, ["event_type"], "ts", "5 minutes").select("window_start", F.col("increase").cast("double").alias("increase"))


@job("metrics_export", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS samples, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2
""")
def metrics_export(spark, sf_dir):
    """Metric results exported to Parquet with a readable time, then read back."""
    path = fresh_dir(spark, "export")
    rows = result_rows(to_matrix(table(spark, sf_dir, "events"), ["event_type"], "ts", "value"))
    with_datetime(rows).write.parquet(path)
    return spark.read.parquet(path).groupBy(F.col("metric")["event_type"].alias("event_type"), F.date_format("datetime", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("samples"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    )


@job("metric_lines", """
    SELECT 'events_total{event_type="' || event_type || '",user="' || user_id || '"} ' || count(*) || ' 1706572800' AS value FROM events GROUP BY event_type, user_id
""")
def metric_lines(spark, sf_dir):
    """Counters per type and user in the text form of a metrics push."""
    from tidemill.operators.sinks import metric_lines as lines

    counts = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    labels = F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return lines(counts, F.lit("events_total"), F.col("n"), labels, F.lit(1706572800))
