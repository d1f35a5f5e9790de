"""Deterministic generated data: every value is a hash of the row number and the seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generated orders.
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CAD", "AUD", "CHF")
EVENT_TYPES = ("user", "order", "payment", "other")
CATEGORIES = ("electronics", "clothing", "books", "home")
COUNTRIES = ("US", "UK", "DE", "FR", "JP")


def roll(name: str, seed: int, n: int, key: str = "id") -> Column:
    """Uniform integer in ``[0, n)`` that depends on the key, the seed and a name."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(name)), F.lit(n))


def pick(values: Sequence[str], name: str, seed: int, key: str = "id") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (roll(name, seed, len(values), key) + 1).cast("int"))


def orders(spark: SparkSession, n: int, seed: int, start: str, spread_seconds: int = 3600, duplicate_percent: int = 5,
           products: int = 15, zips: int = 10) -> DataFrame:
    """Orders over a time span (``spread_seconds=0`` is a burst); a share repeats an earlier id."""
    base = spark.range(n)
    repeats = roll("dup", seed, 100) < duplicate_percent
    source = F.when(repeats & (F.col("id") > 0), F.floor(F.col("id") / 2)).otherwise(F.col("id"))
    rows = base.withColumn("src", source)
    offset = roll("ts", seed, spread_seconds, "src") if spread_seconds else F.lit(0)
    return rows.select(
        F.concat(F.lit("ORD-"), F.lpad(F.col("src").cast("string"), 10, "0")).alias("order_id"),
        F.concat(F.lit("CUST-"), roll("cust", seed, 10_000, "src").cast("string")).alias("customer_id"),
        F.concat(F.lit("PROD-"), F.lpad((roll("prod", seed, products, "src") + 1).cast("string"), 3, "0")).alias("product_id"),
        (roll("qty", seed, 10, "src") + 1).cast("int").alias("quantity"),
        ((roll("price", seed, 50_000, "src") + 100) / 100).cast("decimal(10,2)").alias("unit_price"),
        pick(CURRENCIES, "cur", seed, "src").alias("currency"),
        F.lpad((roll("zip", seed, zips, "src") + 10_000).cast("string"), 5, "0").alias("zip_code"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(start)) + offset).alias("order_timestamp"),
        F.to_json(F.struct(F.concat(F.lit("s-"), roll("sess", seed, 1_000_000, "src").cast("string")).alias("session_id"))).alias("raw_data"),
    )


def users(spark: SparkSession, n: int, seed: int, start: str) -> DataFrame:
    """Signup records with some malformed e-mail addresses."""
    return spark.range(n).select(
        F.col("id").alias("user_id"),
        F.concat(F.lit("user"), F.col("id").cast("string"), F.when(roll("mail", seed, 20) == 0, F.lit("")).otherwise(F.lit("@example.com"))).alias("email"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(start)) - roll("day", seed, 365) * 86_400).alias("signup_date"),
        pick(COUNTRIES, "country", seed).alias("country"),
        (roll("rev", seed, 1_200_000) / 100 - 100).alias("revenue"),
        pick(CATEGORIES, "cat", seed).alias("product_category"),
        (roll("min", seed, 120) + 1).cast("int").alias("session_duration_minutes"),
        (roll("act", seed, 10) > 1).alias("is_active"),
    )


def sales(spark: SparkSession, n: int, seed: int, start: str) -> DataFrame:
    quantity, price = (roll("qty", seed, 20) + 1).cast("int"), (roll("price", seed, 99_000) + 1000) / 100
    return spark.range(n).select(
        F.concat(F.lit("T"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("transaction_id"),
        pick(CATEGORIES, "prod", seed).alias("product_name"), pick(COUNTRIES, "reg", seed).alias("region"),
        quantity.alias("quantity"), price.alias("unit_price"),
        F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(start)) - roll("day", seed, 365) * 86_400), "yyyy-MM-dd").alias("transaction_date"),
        pick(("consumer", "business"), "seg", seed).alias("customer_segment"),
        F.round(quantity * price, 2).alias("total_amount"),
    )


def stream_events(spark: SparkSession, n: int, seed: int, start: str, rate: int = 100) -> DataFrame:
    """Typed events with JSON payloads at ``rate`` per second."""
    epoch = F.unix_timestamp(F.lit(start)) + F.floor(F.col("id") / rate)
    body = {
        "user": F.struct(F.col("id").alias("user_id"), epoch.alias("timestamp")),
        "order": F.struct(F.col("id").alias("order_id"), (roll("amt", seed, 50_000) / 100).alias("amount"), epoch.alias("timestamp")),
        "payment": F.struct(F.col("id").alias("transaction_id"), pick(("card", "bank"), "m", seed).alias("method"), epoch.alias("timestamp")),
    }
    kind = F.col("event_type")
    payload = F.to_json(F.struct(F.col("id"), epoch.alias("timestamp")))
    for name, content in body.items():
        payload = F.when(kind == name, F.to_json(content)).otherwise(payload)
    return spark.range(n).withColumn("event_type", pick(EVENT_TYPES, "type", seed)).select(
        F.concat(F.lit("e-"), F.col("id").cast("string")).alias("event_id"), "event_type", payload.alias("payload"),
        epoch.cast("string").alias("timestamp"),
    )


def rate_stream(spark: SparkSession, rows_per_second: int, seed: int) -> DataFrame:
    """Unbounded events at a limited rate."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return ticks.select(
        F.col("value").alias("event_id"), F.col("timestamp").alias("ts"), pick(EVENT_TYPES, "type", seed, "value").alias("event_type")
    )
