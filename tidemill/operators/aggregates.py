"""Aggregations, exact quantiles, histograms and null statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemill.session import ensure_checkpoint_dir

AGG_FUNCTIONS = {"sum": F.sum, "mean": F.avg, "count": F.count, "min": F.min, "max": F.max}


def aggregate_by(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Sequence[str]]) -> DataFrame:
    """Dictionary-driven aggregation; output columns are named ``{column}_{function}``."""
    columns = []
    for column, names in aggs.items():
        for name in names:
            if name not in AGG_FUNCTIONS:
                raise ValueError(f"unknown aggregate {name!r}; known: {', '.join(AGG_FUNCTIONS)}")
            columns.append(AGG_FUNCTIONS[name](column).alias(f"{column}_{name}"))
    return df.groupBy(*keys).agg(*columns)


def facet_counts(df: DataFrame, field: str, top: int = 100) -> DataFrame:
    """Most frequent values with their counts, nulls excluded."""
    return (
        df.filter(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("doc_count"))
        .orderBy(F.desc("doc_count"), "value").limit(top)
    )


def first_seen_order(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values with the position of their first occurrence."""
    return df.groupBy(value).agg(F.min(order).alias(order))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls per column, cells that are null, and number of rows."""
    per_column = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns]
    out = df.agg(*per_column, F.count(F.lit(1)).alias("rows"))
    total = sum((F.col(f"{c}_nulls") for c in df.columns), F.lit(0).cast("bigint"))
    return out.withColumn("null_cells", total)


#: Bits of a digit of the radix selection, and how many rows of open digits are broadcast at most.
DIGIT_BITS, OPEN_ROWS = 16, 200_000


def _mapped(df: DataFrame, column: str, ddl: str, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The frame with one null-free numeric column changed, batch by batch."""
    at = df.columns.index(column)
    schema = StructType([f if i != at else StructField(column, StructType.fromDDL(f"x {ddl}")[0].dataType) for i, f in enumerate(df.schema.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array(change(columns[at].to_numpy()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, schema)


def ordered_image(values: np.ndarray) -> np.ndarray:
    """Doubles as longs of the same order; both zeros are one, NaN is the greatest."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)


def from_image(images: np.ndarray) -> np.ndarray:
    return np.where(images < 0, images ^ np.int64((1 << 63) - 1), images).view(np.float64)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles per key, one column for each name; nulls do not count, keys without a value are absent.

    Radix selection for all keys and quantiles at once. The input is read once: keys and values, as longs of the same order, are checkpointed. Then
    rounds count digits of 16 bits, combined before the shuffle; after each only the values behind the digits that hold a wanted rank
    are counted on, and once a digit holds no more values than it has numbers, all bits left are the last digit. So no round knows more
    than 65,536 numbers of a key and quantile, and one key may hold all rows. Null keys are a group. An action.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys, names = list(keys), list(quantiles)
    key = F.struct(*[F.col(c) for c in keys]) if keys else F.struct(F.lit(0).alias("all"))
    plain = df.where(F.col(value).isNotNull()).select(key.alias("k"), F.col(value).cast("double").alias("v"))
    rows = _mapped(plain, "v", "bigint", ordered_image).checkpoint()
    totals = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("n") - 1) * F.lit(float(quantiles[c]))).alias("pos")) for i, c in enumerate(names)])
    ranks = totals.select("k", F.explode(wanted).alias("w")).select("k", "w.i", "w.pos")
    ends = F.array(F.floor("pos"), F.ceil("pos")).cast("array<bigint>")
    left = ranks.select("k", "i", "pos", F.posexplode(ends).alias("end", "t")).withColumn("prefix", F.lit(0).cast("bigint"))
    sizes = totals.agg(F.count(F.lit(1)).alias("keys"), F.max("n").alias("most")).first()
    hint = F.broadcast if 2 * len(names) * sizes["keys"] <= OPEN_ROWS else (lambda frame: frame)
    bits, most = 64, sizes["most"] or 0
    while bits:
        width = bits if most <= 1 << DIGIT_BITS else DIGIT_BITS
        digit = F.shiftright("v", bits - width)
        if bits == 64:
            counted = rows.select("k", F.lit(0).cast("bigint").alias("prefix"), digit.alias("d"))
            joined = F.col("d")
        else:
            among = left.select(F.col("k").alias("ok"), F.col("prefix").alias("op")).distinct()
            near = rows.join(hint(among), (F.col("k") == F.col("ok")) & (F.shiftright("v", bits) == F.col("op")))
            counted = near.select("k", F.col("op").alias("prefix"), digit.bitwiseAND((1 << width) - 1).alias("d"))
            joined = F.shiftleft("prefix", width).bitwiseOR(F.col("d"))
        digits = counted.groupBy("k", "prefix", "d").agg(F.count(F.lit(1)).alias("c"))
        order = Window.partitionBy("k", "prefix").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = digits.withColumn("upto", F.sum("c").over(order))
        found = left.join(upto, ["k", "prefix"]).where((F.col("t") < F.col("upto")) & (F.col("t") >= F.col("upto") - F.col("c")))
        # A row for each key, quantile and end of its interval.
        left = found.select("k", "i", "pos", "end", (F.col("t") - F.col("upto") + F.col("c")).alias("t"), joined.alias("prefix"), "c")
        bits -= width
        if bits:
            left = left.checkpoint()
            most = left.agg(F.max("c")).first()[0]
            left = left.drop("c")
    values = _mapped(left.select("k", "i", "pos", "end", "prefix"), "prefix", "double", from_image)
    low, high = F.max(F.when(F.col("end") == 0, F.col("prefix"))), F.max(F.when(F.col("end") == 1, F.col("prefix")))
    part = F.max("pos") - F.floor(F.max("pos"))
    single = values.groupBy("k", "i").agg((low + F.when(part > 0, (high - low) * part).otherwise(0.0)).alias("q"))
    wide = single.groupBy("k").agg(*[F.max(F.when(F.col("i") == i, F.col("q"))).alias(c) for i, c in enumerate(names)])
    return wide.select(*[F.col("k")[c].alias(c) for c in keys], *names)


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.5, name: str = "quantile") -> DataFrame:
    """One exact interpolated quantile per key, see :func:`exact_quantiles`."""
    return exact_quantiles(df, keys, value, {name: q})


def above_median(df: DataFrame, keys: Sequence[str], value: str, factor: float = 2.0) -> DataFrame:
    """Rows whose value is strictly greater than ``factor`` times the median of their group."""
    medians = exact_quantile(df, keys, value, 0.5, "median")
    joined = df.join(medians, list(keys))
    return joined.withColumn("threshold", F.col("median") * F.lit(factor)).filter(F.col(value) > F.col("threshold"))


# Upper bounds of the duration histogram in seconds; the last bucket is open.
DURATION_BOUNDS = (0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)


def bucket_counts(df: DataFrame, keys: Sequence[str], value: str, bounds: Sequence[float] = DURATION_BOUNDS) -> DataFrame:
    """Cumulative histogram ``(keys, le, count)``; ``le`` of the open bucket is infinity.

    One conditional count per bound in a single aggregation, then unpivoted.
    """
    keys = list(keys)
    counted = df.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= b).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_all"),
    )
    entries = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("count")) for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_all").alias("count")))
    return counted.select(*keys, F.explode(F.array(*entries)).alias("_e")).select(*keys, "_e.le", "_e.count")


def bucket_quantile(buckets: DataFrame, keys: Sequence[str], q: float, name: str = "quantile") -> DataFrame:
    """Quantile from cumulative buckets by linear interpolation inside the crossing bucket.

    When the rank falls into the open bucket the highest finite bound is returned.
    Works on one row per bucket, whose number per key is fixed by the bounds.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("le")
    steps = buckets.select(
        *keys, "le", F.col("count").cast("double").alias("count"),
        F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("_low"),
        F.coalesce(F.lag(F.col("count").cast("double")).over(w), F.lit(0.0)).alias("_before"),
        (F.max(F.col("count").cast("double")).over(Window.partitionBy(*keys)) * F.lit(q)).alias("_rank"),
    ).filter((F.col("count") >= F.col("_rank")) & (F.col("count") > 0))
    crossing = steps.groupBy(*keys).agg(
        F.min_by(F.struct("le", "count", "_low", "_before", "_rank"), "le").alias("_c")
    ).select(*keys, "_c.*")
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * F.try_divide(
        F.col("_rank") - F.col("_before"), F.col("count") - F.col("_before")
    )
    return crossing.select(*keys, F.when(F.col("le") == float("inf"), F.col("_low")).otherwise(inside).alias(name))


def argmax(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Values of the row with the greatest ``order`` tuple; nulls in ``columns`` may win.

    ``max_by`` combines on the map side, so hot keys send one row per task.
    """
    rank = F.struct(*order)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), rank).alias("_best"))
    return best.select(*keys, "_best.*")


def freshness_seconds(df: DataFrame, ts: str, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    """Seconds between the newest row and the clock."""
    from tidemill.functions.times import seconds_since

    newest = df.groupBy(*keys).agg(F.max(ts).alias("latest"))
    return newest.withColumn("freshness_seconds", seconds_since(as_of, F.col("latest")))
