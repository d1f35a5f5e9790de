"""Writers. Every function here is an action unless its docstring says otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.operators.matching import flatten_lists
from tidemill.session import literal_row


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, source: str, day: str, run_id: str) -> str:
    """Layout ``source_name=…/ingest_date=…/run_id=…`` below ``path``; a repeated run replaces its own folder."""
    folder = f"{path}/source_name={source}/ingest_date={day}/run_id={run_id}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def write_csv(df: DataFrame, path: str, lists: Sequence[str] = ()) -> None:
    """CSV with header; list columns become ``|``-joined text."""
    flatten_lists(df, lists).write.mode("overwrite").option("header", True).csv(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def load_rows(df: DataFrame, path: str, if_exists: str = "append") -> None:
    """Bulk append, or truncate and load with ``replace``."""
    df.write.mode({"append": "append", "replace": "overwrite"}[if_exists]).parquet(path)


def dead_letters(df: DataFrame, key: str, payload: Column, error: Column, failed_at: Column | str, retries: Column | int = 0) -> DataFrame:
    """Rejects in dead-letter form (not an action)."""
    at = failed_at if isinstance(failed_at, Column) else F.lit(failed_at).cast("timestamp_ntz")
    count = retries if isinstance(retries, Column) else F.lit(retries)
    return df.select(
        F.col(key).cast("string").alias("event_id"), payload.alias("payload"), error.alias("error_message"),
        at.alias("failed_at"), count.cast("int").alias("retry_count"),
    )


def write_with_summary(df: DataFrame, path: str, summary_path: str, as_of: str, measures: Mapping[str, Column] | None = None) -> dict:
    """Write Parquet and a one-row JSON summary, both from a single pass."""
    seen = Observation()
    named = [c.alias(n) for n, c in (measures or {}).items()]
    df.observe(seen, F.count(F.lit(1)).alias("row_count"), *named).write.mode("overwrite").parquet(path)
    summary = {"output": path, "columns": df.columns, "written_at": as_of, **seen.get}
    spark = df.sparkSession
    row = literal_row(spark, [path, df.columns, as_of, int(summary["row_count"])],
                      "output string, columns array<string>, written_at string, row_count bigint")
    row.write.mode("overwrite").json(summary_path)
    return summary


def metric_lines(df: DataFrame, name: Column, value: Column, labels: Column, ts: Column) -> DataFrame:
    """Prometheus text lines ``name{label="v"} value ts`` (not an action); labels in key order.

    Backslash, quote and line end are escaped in label values; a null value is an empty label.
    """

    def escaped(v: Column) -> Column:
        v = F.replace(F.coalesce(v, F.lit("")), F.lit("\\"), F.lit("\\\\"))
        return F.replace(F.replace(v, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))

    pairs = F.transform(
        F.array_sort(F.map_entries(labels)),
        lambda e: F.concat(e["key"], F.lit('="'), escaped(e["value"]), F.lit('"')),
    )
    return df.select(
        F.concat(name, F.lit("{"), F.array_join(pairs, ","), F.lit("} "), value.cast("string"), F.lit(" "), ts.cast("string")).alias("value")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("append").text(path)


LOG_ROWS = "_msg string, _time string, level string, stage string, rows bigint, duration double"


def log_rows(spark, entries: Sequence[tuple], path: str | None = None) -> DataFrame:
    """Structured run-log entries, appended as JSON when a path is given."""
    rows = spark.createDataFrame(list(entries), LOG_ROWS)
    if path:
        rows.write.mode("append").json(path)
    return rows
