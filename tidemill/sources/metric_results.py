"""Results of a metrics API (instant vectors and range matrices) as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = (
    "status string, data struct<resultType:string, result:array<struct<metric:map<string,string>, "
    "value:array<string>, values:array<array<string>>>>>"
)


def result_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``(metric map, timestamp double, value double)`` from JSON results.

    Fails on an unsuccessful result and on result types other than ``vector``
    and ``matrix``.
    """
    parsed = df.select(F.from_json(F.col(payload), RESULT).alias("r"))
    kind = F.col("r.data.resultType")
    problem = (
        F.when(F.coalesce(F.col("r.status"), F.lit("")) != "success", F.concat(F.lit("query failed: "), F.coalesce("r.status", F.lit("unreadable"))))
        .when(~F.coalesce(kind.isin("vector", "matrix"), F.lit(False)), F.concat(F.lit("unsupported result type: "), F.coalesce(kind, F.lit("none"))))
    )
    checked = parsed.select(
        F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)).alias("_ok"),
        kind.alias("kind"), F.explode("r.data.result").alias("s"),
    ).filter("_ok")
    samples: Column = F.when(F.col("kind") == "vector", F.array("s.value")).otherwise(F.col("s.values"))
    points = checked.select(F.col("s.metric").alias("metric"), F.explode(samples).alias("p"))
    return points.select("metric", F.col("p")[0].cast("double").alias("timestamp"), F.col("p")[1].cast("double").alias("value"))


def with_datetime(rows: DataFrame) -> DataFrame:
    return rows.withColumn("datetime", F.timestamp_seconds("timestamp"))


def to_matrix(df: DataFrame, labels: list[str], ts: str, value: str, slice_unit: str = "hour", points: int = 100_000) -> DataFrame:
    """Series folded to matrix results, one JSON text per series, time slice and run of input rows.

    A run is at most ``points`` neighbouring rows of an input partition, which
    bounds the array of samples however busy a series is.
    """
    df = df.withColumn("_run", F.floor(F.monotonically_increasing_id() / points))
    epoch = (F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1_000_000.0))
    point = F.array(epoch.cast("string"), F.col(value).cast("string"))
    metric = F.create_map(*[x for label in labels for x in (F.lit(label), F.col(label).cast("string"))])
    folded = df.groupBy(*labels, F.date_trunc(slice_unit, ts).alias("_slice"), "_run").agg(F.collect_list(point).alias("values"))
    series = F.struct(metric.alias("metric"), F.col("values"))
    result = F.struct(
        F.lit("success").alias("status"), F.struct(F.lit("matrix").alias("resultType"), F.array(series).alias("result")).alias("data")
    )
    return folded.select(F.to_json(result).alias("payload"))
