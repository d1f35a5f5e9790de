"""Joins. Strategy is left to the optimizer, which broadcasts only sides below its size limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

JOIN_KINDS = {"inner": "inner", "left": "left", "outer": "full", "full": "full", "right": "right",
              "semi": "left_semi", "anti": "left_anti"}


def join_datasets(left: DataFrame, right: DataFrame, on: Sequence[str] = (), how: str = "inner",
                  cross_limit: int | None = 1000) -> DataFrame:
    """Equi join by column names; clashing right columns get the suffix ``_right``.

    ``cross`` ignores ``on``. Its right side must be a small list: more than
    ``cross_limit`` rows raise an error instead of multiplying the data, unless the caller gives no limit.
    """
    clashes = [c for c in right.columns if c in set(left.columns) and (how == "cross" or c not in set(on))]
    right = right.withColumnsRenamed({c: f"{c}_right" for c in clashes})
    if how == "cross":
        if cross_limit is None:
            return left.crossJoin(right)
        if len(right.take(cross_limit + 1)) > cross_limit:
            raise ValueError(f"cross join needs a right side of at most {cross_limit} rows")
        return left.crossJoin(F.broadcast(right))
    if how not in JOIN_KINDS:
        raise ValueError(f"unknown join {how!r}; known: {', '.join(JOIN_KINDS)}, cross")
    return left.join(right, list(on), JOIN_KINDS[how])


def star_join(fact: DataFrame, lookups: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Inner join of a fact table with lookup tables, each on its key column."""
    return reduce(lambda acc, pair: acc.join(pair[0], pair[1]), lookups, fact)


def enrich(fact: DataFrame, lookups: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Left join with every lookup and name the lookups that had no match.

    ``lookups`` maps a name to ``(table, key column)``. The added column
    ``missing`` is an array of lookup names, empty for complete rows, so one
    scan feeds both the good rows and the rejects.
    """
    out = fact
    for name, (table, key) in lookups.items():
        out = out.join(table.withColumn(f"_has_{name}", F.lit(True)), key, "left")
    flags = [F.when(F.col(f"_has_{n}").isNull(), F.lit(n)) for n in lookups]
    return out.withColumn("missing", F.array_compact(F.array(*flags))).drop(*[f"_has_{n}" for n in lookups])


def split_enriched(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(complete rows, rejects)`` of :func:`enrich`."""
    good = enriched.filter(F.size("missing") == 0).drop("missing")
    return good, enriched.filter(F.size("missing") > 0)


def update_back(df: DataFrame, updates: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Fill nulls of ``columns`` (target → update column) from ``updates`` by key."""
    source = updates.select(key, *[F.col(u).alias(f"_new_{t}") for t, u in columns.items()])
    joined = df.join(source, key, "left")
    return joined.withColumns(
        {t: F.coalesce(F.col(t), F.col(f"_new_{t}")) for t in columns}
    ).drop(*[f"_new_{t}" for t in columns])


def restrict_to(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the candidate ids."""
    return df.join(ids.select(key), key, "left_semi")


def absent_from(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the target."""
    return df.join(target.select(key), key, "left_anti")


def _common_type(seen: set[DataType]) -> DataType:
    """Narrowest type that holds all values of the given ones exactly (floats as double), string as the last resort."""
    # Digits of the whole-number types.
    digits = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
    decimals = {t for t in seen if isinstance(t, DecimalType)}
    if len(seen) == 1:
        return next(iter(seen))
    if seen <= set(digits):
        return LongType()
    if seen <= {*digits, *decimals}:
        whole = max([t.precision - t.scale for t in decimals] + [digits[t] for t in seen - decimals])
        scale = max(t.scale for t in decimals)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    if seen <= {*digits, *decimals, FloatType(), DoubleType()}:
        return DoubleType()
    for time in (TimestampType(), TimestampNTZType()):
        if seen <= {DateType(), time}:
            return time
    return StringType()


def union_diagonal(*frames: DataFrame) -> DataFrame:
    """Union by name; absent columns become null and differing types their widest common type."""
    types: dict[str, set[DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType)
    mixed = {name: _common_type(seen) for name, seen in types.items() if len(seen) > 1}
    aligned = [
        f.withColumns({c: F.col(c).cast(mixed[c]) for c in f.columns if c in mixed}) if mixed else f for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def concat_batches(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def append_copies(df: DataFrame, changes: Mapping[str, str], order_by: Sequence[str], n: int,
                  where: str | None = None) -> DataFrame:
    """The table plus changed copies of its first ``n`` rows (after ``where``)."""
    source = df.filter(where) if where else df
    copies = source.orderBy(*order_by).limit(n)
    shaped = copies.select(*[F.expr(changes[c]).alias(c) if c in changes else F.col(c) for c in df.columns])
    return df.unionByName(shaped)


def join_by_day(metrics: DataFrame, facts: DataFrame, metric_ts: str, fact_ts: str,
                metric_aggs: Sequence, fact_aggs: Sequence) -> DataFrame:
    """Both sides aggregated to days first, then joined on the day."""
    m = metrics.groupBy(F.date_format(metric_ts, "yyyy-MM-dd").alias("day")).agg(*metric_aggs)
    f = facts.groupBy(F.date_format(fact_ts, "yyyy-MM-dd").alias("day")).agg(*fact_aggs)
    return m.join(f, "day")
