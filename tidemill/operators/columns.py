"""Column shaping, row filters, row numbering and caller-supplied steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemill.session import ensure_checkpoint_dir

ROW_BITS = (1 << 33) - 1


def rename_by_alias(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Give canonical names: the first alias present wins, existing canonical columns stay."""
    present = set(df.columns)
    renames = {}
    for canonical, names in aliases.items():
        if canonical in present:
            continue
        hit = next((n for n in names if n in present and n not in renames), None)
        if hit:
            renames[hit] = canonical
    return df.withColumnsRenamed(renames) if renames else df


def add_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def canonical_first(df: DataFrame, canonical: Sequence[str]) -> DataFrame:
    extras = [c for c in df.columns if c not in set(canonical)]
    return df.select(*canonical, *extras)


def all_of(*predicates: Column | None) -> Column:
    """Conjunction of the given predicates; ``None`` means no restriction."""
    return reduce(lambda a, b: a & b, [p for p in predicates if p is not None], F.lit(True))


def bounded(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Inclusive range; ``None`` leaves a side open and 0 is a bound like any other."""
    return all_of(None if low is None else c >= low, None if high is None else c <= high)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep rows without nulls and, in string columns, without blank values."""
    conditions = [F.col(f.name).isNotNull() for f in df.schema.fields]
    conditions += [F.trim(F.col(f.name)) != "" for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.filter(all_of(*conditions))


def stamp(df: DataFrame, source: str, as_of: str, at: str = "processed_at") -> DataFrame:
    """Ingest metadata: time of processing and name of the source."""
    return df.withColumns({at: F.lit(as_of).cast("timestamp_ntz"), "source_name": F.lit(source)})


def dense_row_ids(df: DataFrame, order_by: Sequence[Column | str], name: str = "row_id", start: int = 1) -> DataFrame:
    """Gap-free numbering in the given total order, without a one-task window.

    Rows are range-partitioned and sorted, numbered inside each partition, and
    shifted by the sizes of the earlier partitions. The partitioned rows are
    checkpointed (an action): counts and rows must come from the same split,
    also when an executor is lost between the two passes.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .select("*", F.spark_partition_id().alias("_part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)).alias("_pos"))
        .checkpoint()
    )
    # One row per partition, so this window and the broadcast are bounded by the partition count.
    shifts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_shift"),
    )
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_shift") + F.col("_pos") + F.lit(start))
        .drop("_part", "_pos", "_shift")
    )


def unique_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique but not dense ids, without any shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


STEP_KINDS = ("filter", "select", "derive", "rename", "sort", "limit", "aggregate", "drop")


def apply_steps(df: DataFrame, steps: Sequence[Mapping[str, object]]) -> DataFrame:
    """Run caller-supplied steps: each is ``{"op": kind, …}`` with SQL expressions as text.

    ``filter``: expr; ``select``: exprs; ``derive``/``rename``: columns;
    ``sort``: by, optional descending; ``limit``: n; ``aggregate``: by, exprs; ``drop``: names.
    """
    for step in steps:
        kind = step["op"]
        if kind == "filter":
            df = df.filter(F.expr(step["expr"]))
        elif kind == "select":
            df = df.selectExpr(*step["exprs"])
        elif kind == "derive":
            df = df.withColumns({k: F.expr(v) for k, v in step["columns"].items()})
        elif kind == "rename":
            df = df.withColumnsRenamed(dict(step["columns"]))
        elif kind == "sort":
            df = df.orderBy(*step["by"], ascending=not step.get("descending", False))
        elif kind == "limit":
            df = df.limit(int(step["n"]))
        elif kind == "aggregate":
            df = df.groupBy(*step["by"]).agg(*[F.expr(e) for e in step["exprs"]])
        elif kind == "drop":
            df = df.drop(*step["names"])
        else:
            raise ValueError(f"unknown step {kind!r}; known: {', '.join(STEP_KINDS)}")
    return df


def transform_columns(
    df: DataFrame,
    filter_expr: str | None = None,
    select: Sequence[str] | None = None,
    sort_by: Sequence[str] | None = None,
    descending: bool = False,
) -> DataFrame:
    """Optional filter, projection and sort of one dataset."""
    steps: list[Mapping[str, object]] = []
    if filter_expr:
        steps.append({"op": "filter", "expr": filter_expr})
    if select:
        steps.append({"op": "select", "exprs": list(select)})
    if sort_by:
        steps.append({"op": "sort", "by": list(sort_by), "descending": descending})
    return apply_steps(df, steps)


def priority_order(c: Column, ranked: Sequence[str]) -> Column:
    """Sort key from an explicit order; values outside the list come last."""
    expr = F.when(c == ranked[0], 0)
    for i, value in enumerate(ranked[1:], start=1):
        expr = expr.when(c == value, i)
    return expr.otherwise(len(ranked))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group.

    The limit on ``row_number`` is applied before the shuffle as well, so a task
    never receives more than ``k`` rows per group and upstream partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def keyset_page(df: DataFrame, order: str, key: str, size: int, after: tuple[object, object] | None = None) -> DataFrame:
    """Next page in ``(order, key)`` order; rows tied on ``order`` are never skipped."""
    if after is not None:
        mark, last_key = F.lit(after[0]), F.lit(after[1])
        mark = mark.cast(df.schema[order].dataType)
        df = df.filter((F.col(order) > mark) | ((F.col(order) == mark) & (F.col(key) > last_key)))
    return df.orderBy(order, key).limit(size)
