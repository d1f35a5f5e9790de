"""Counters and resampling over labelled time series.

Rates use no extrapolation: they are the sum of reset-aware increases inside the
window divided by its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _increase(value: Column, before: Column) -> Column:
    """A smaller value than before means that the counter restarted from zero."""
    return F.when(value < before, value).otherwise(value - before)


#: Samples of one series that a task sorts.
CHUNK_ROWS = 1_000_000


def fitting_chunk(df: DataFrame, series: Sequence[str], ts: str, chunk_rows: int = CHUNK_ROWS) -> str:
    """Longest of day, hour, minute and second in which no series has more than ``chunk_rows`` samples (a second if none). An action."""
    for chunk in ("1 day", "1 hour", "1 minute"):
        fullest = df.groupBy(*series, F.window(ts, chunk).getField("start")).count().agg(F.max("count")).first()[0]
        if (fullest or 0) <= chunk_rows:
            return chunk
    return "1 second"


def counter_deltas(df: DataFrame, series: Sequence[str], ts: str, value: str, tie: str | None = None,
                   chunk: str | None = None) -> DataFrame:
    """Increase from sample to sample: ``(series, ts, delta)``.

    A long series is cut into time chunks, so no task has to sort a whole
    series; the step between two chunks comes from one first/last summary row
    per chunk. Without ``chunk`` the length follows the row count (see :func:`fitting_chunk`).
    """
    series = list(series)
    chunk = chunk or fitting_chunk(df, series, ts)
    order = [ts] + ([tie] if tie else [])
    rows = df.withColumn("_chunk", F.window(ts, chunk).getField("start"))
    w = Window.partitionBy(*series, "_chunk").orderBy(*order)
    inner = rows.withColumn("_before", F.lag(value).over(w)).filter(F.col("_before").isNotNull())
    inner = inner.select(*series, ts, _increase(F.col(value), F.col("_before")).alias("delta"))
    rank = F.struct(*order)
    ends = rows.groupBy(*series, "_chunk").agg(
        F.min_by(F.struct(F.col(ts).alias("_ts"), F.col(value).alias("_first")), rank).alias("_head"),
        F.max_by(value, rank).alias("_last"),
    )
    across = ends.withColumn("_before", F.lag("_last").over(Window.partitionBy(*series).orderBy("_chunk")))
    steps = across.filter(F.col("_before").isNotNull()).select(
        *series, F.col("_head._ts").alias(ts), _increase(F.col("_head._first"), F.col("_before")).alias("delta")
    )
    return inner.unionByName(steps)


def windowed_increase(deltas: DataFrame, keys: Sequence[str], ts: str, window: str) -> DataFrame:
    """Sum of deltas per tumbling window."""
    return deltas.groupBy(*keys, F.window(ts, window).getField("start").alias("window_start")).agg(
        F.sum("delta").alias("increase")
    )


def windowed_rate(deltas: DataFrame, keys: Sequence[str], ts: str, window: str, seconds: float) -> DataFrame:
    """Increase per second in each tumbling window."""
    grown = windowed_increase(deltas, keys, ts, window)
    return grown.withColumn("rate", F.col("increase").cast("double") / F.lit(float(seconds))).drop("increase")


def sliding_rate(deltas: DataFrame, keys: Sequence[str], ts: str, steps: int, step: str, step_seconds: int) -> DataFrame:
    """``(keys, at, rate)``: at the end of each step the increase per second over the last ``steps`` steps, summed over all
    series of a key. Moments whose window holds no delta are left out.

    Deltas are summed by step before each sum goes to the windows it lies in.
    """
    grown = windowed_increase(deltas, keys, ts, step)
    ahead = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("_ahead")
    spread = grown.select(*keys, "window_start", "increase", ahead)
    at = F.col("window_start") + F.make_dt_interval(secs=(F.col("_ahead") * step_seconds).cast("decimal(18,6)"))
    total = spread.groupBy(*keys, at.alias("at")).agg(F.sum("increase").alias("_increase"))
    return total.select(*keys, "at", (F.col("_increase").cast("double") / F.lit(float(steps * step_seconds))).alias("rate"))


def resample(df: DataFrame, series: Sequence[str], ts: str, value: str, step: str, tie: str | None = None) -> DataFrame:
    """Last sample of each series in every step."""
    rank = F.struct(*([ts] + ([tie] if tie else [])))
    return df.groupBy(*series, F.window(ts, step).getField("start").alias("step_start")).agg(
        F.max_by(value, rank).alias(value)
    )


def values_at_steps(df: DataFrame, series: Sequence[str], ts: str, value: str, step_seconds: int, look_back_seconds: int,
                    tie: str | None = None) -> DataFrame:
    """``(series, at, value)``: at every step the last sample at or before it, if it is younger than the look-back.

    A gap longer than the look-back leaves steps without a row. Of a step's samples only the last goes on to the steps behind it, as many
    as the look-back has, and the latest that comes to a step counts: two aggregates that combine before the shuffle, so a
    series with most of all samples needs neither a window nor a sort. Samples without time or value are no samples; of equal times the
    greatest ``tie`` (or value) counts.
    """
    step, back = step_seconds * 1_000_000, look_back_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    late = micros + (step - 1)
    rank = F.struct(micros.alias("t"), F.col(tie if tie else value).alias("tie"), F.col(value).alias("v"))
    known = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(*series, (late - F.pmod(late, F.lit(step))).alias("_at"), rank.alias("_r"))
    last = known.groupBy(*series, "_at").agg(F.max("_r").alias("_r"))
    ahead = F.explode(F.sequence(F.lit(0), F.lit(back // step))).alias("_k")
    spread = last.select(*series, "_at", "_r", ahead).select(*series, (F.col("_at") + F.col("_k") * step).alias("_at"), "_r")
    seen = spread.where(F.col("_at") - F.col("_r.t") < back).groupBy(*series, "_at").agg(F.max("_r").alias("_r"))
    at = F.timestamp_micros("_at").cast(df.schema[ts].dataType)
    return seen.select(*series, at.alias("at"), F.col("_r.v").alias(value))


def sliding_buckets(buckets: DataFrame, keys: Sequence[str], start: str, steps: int, step_seconds: int) -> DataFrame:
    """``(keys, at, le, count)``: growth of cumulative buckets over the last ``steps`` steps, at the end of each step.

    ``buckets`` has the growth in each step, ``(keys, start, le, count)``. A step that no observation reaches within the window is left out.
    """
    ahead = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("_ahead")
    at = F.col(start) + F.make_dt_interval(secs=(F.col("_ahead") * step_seconds).cast("decimal(18,6)"))
    return buckets.select("*", ahead).groupBy(*keys, at.alias("at"), "le").agg(F.sum("count").alias("count"))


def latest_samples(df: DataFrame, series: Sequence[str], ts: str, value: str, tie: str | None = None) -> DataFrame:
    rank = F.struct(*([ts] + ([tie] if tie else [])))
    return df.groupBy(*series).agg(F.max_by(value, rank).alias(value))


def sum_by(samples: DataFrame, keys: Sequence[str], value: str, name: str = "total") -> DataFrame:
    return samples.groupBy(*keys).agg(F.sum(value).alias(name))


def average_ratio_by(sums: DataFrame, keys: Sequence[str], total: str, count: str, name: str) -> DataFrame:
    """Mean over series of ``total / count``."""
    return sums.groupBy(*keys).agg(F.avg(F.try_divide(F.col(total), F.col(count))).alias(name))


def throughput_summary(samples: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return samples.groupBy(*keys).agg(
        F.avg(value).alias("avg_rows_per_second"),
        F.max(value).alias("peak_rows_per_second"),
        F.count(F.lit(1)).alias("sample_count"),
    )


def peak_rows(samples: DataFrame, value: str) -> DataFrame:
    """Rows that hold the overall maximum, by a scalar subquery."""
    return samples.filter(F.col(value) == samples.agg(F.max(value)).scalar())
