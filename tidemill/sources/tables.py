"""Relational sources, incremental scans, snapshots and the catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, partitions: int = 16, fetch_size: int = 50_000,
               properties: Mapping[str, str] | None = None) -> DataFrame:
    """Relational table, read in parallel ranges of ``partition_column`` with batched fetches."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions)
        )
    return reader.load()


def since(df: DataFrame, column: str, mark: str | None) -> DataFrame:
    """Rows above the high-water mark; the filter reaches the source."""
    if mark is None:
        return df
    return df.filter(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))


def high_water_mark(df: DataFrame, column: str) -> str | None:
    """Greatest value as text (one aggregated row comes to the driver)."""
    return df.agg(F.max(column).cast("string")).first()[0]


def snapshot_tables(frames: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Write every table below ``path``; returns the folder of each (an action per table)."""
    written = {}
    for name, df in frames.items():
        written[name] = f"{path.rstrip('/')}/{name}"
        df.write.mode("errorifexists").parquet(written[name])
    return written


def catalogue(frames: Mapping[str, DataFrame]) -> list[tuple[str, str, str, int]]:
    """``(table, column, type, position)`` of named frames, from their schemas."""
    return [
        (name, f.name, f.dataType.simpleString(), i)
        for name, df in sorted(frames.items()) for i, f in enumerate(df.schema.fields, start=1)
    ]


def catalogue_frame(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    return spark.createDataFrame(catalogue(frames), "table_name string, column_name string, data_type string, position int")


def registered_tables(spark: SparkSession, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Tables and views of the current catalog by name."""
    listed = [t.name for t in spark.catalog.listTables()]
    return {n: spark.table(n) for n in listed if names is None or n in names}
