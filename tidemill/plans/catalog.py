"""Registry of jobs: name → callable and, where there is one, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
SQL: dict[str, str] = {}


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def add(fn: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"job {name} is registered twice")
        JOBS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


# All tables of a data folder.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
          "labels", "conversations")


def every_table(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dict(zip(TABLES, tables(spark, sf_dir, *TABLES)))


def load_all() -> None:
    """Import every module that registers jobs."""
    from tidemill.plans import customers, metrics, orders, quality, relational, sales, search, storage, streams  # noqa: F401
