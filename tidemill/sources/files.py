"""File readers and dispatch by extension."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as string."""
    return spark.read.option("header", True).csv(path)


def csv_typed(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with the declared schema, else inferred types and dates (an extra pass over the data)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).option("preferDate", True).csv(path)


def csv_tolerant(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``(good rows, rejects)`` of a CSV with malformed lines; rejects keep the raw line."""
    with_corrupt = StructType(list(schema.fields)).add(CORRUPT, "string")
    rows = (
        spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT).schema(with_corrupt).csv(path)
    )
    # A line is judged by all its columns, and Spark wants one of them to be read beside the raw line.
    read = F.coalesce(F.col(schema.fields[0].name).cast("string"), F.lit("")) >= ""
    return rows.filter(F.col(CORRUPT).isNull() & read).drop(CORRUPT), rows.filter(F.col(CORRUPT).isNotNull() & read)


def ndjson(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(path)


def json_document(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A JSON object, or an array of them, per file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def parquet(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Parquet file, folder or glob; ``recursive`` finds files at any depth."""
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path))


def avro(spark: SparkSession, path: str) -> DataFrame:
    """Needs the spark-avro package on the classpath."""
    return spark.read.format("avro").load(path)


def folder(spark: SparkSession, path: str, suffix: str, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """All files below a folder with the suffix, every row of every file."""
    return read(spark, os.path.join(path, f"*{suffix}"))


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    ".csv": csv_typed,
    ".json": json_document,
    ".ndjson": ndjson,
    ".jsonl": ndjson,
    ".parquet": parquet,
    ".avro": avro,
}


def detect_format(path: str) -> str:
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension not in READERS:
        raise ValueError(f"unsupported file type {extension or path!r}; known: {', '.join(READERS)}")
    return extension


def load_file(spark: SparkSession, path: str) -> DataFrame:
    return READERS[detect_format(path)](spark, path)


def view_name(path: str) -> str:
    stem = os.path.splitext(os.path.basename(path.rstrip("/")))[0]
    return re.sub(r"[- ]", "_", stem)


def register_file(spark: SparkSession, path: str) -> dict:
    """Load, register as a view, and describe: rows, columns and a preview of five rows (an action)."""
    df = load_file(spark, path)
    name = view_name(path)
    df.createOrReplaceTempView(name)
    return {
        "table": name,
        "rows": df.count(),
        "columns": df.columns,
        "preview": [row.asDict() for row in df.limit(5).collect()],
    }
