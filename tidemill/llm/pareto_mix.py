"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import column_name, n_words, stored

BUCKETS = 4096


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """Target of each source: ``sizes(source, source_size)`` → ``source, source_size, target``.

    Sources in code point order, null last, take ``weights`` in turn and divide ``share`` of all sizes. No target
    exceeds ``cap`` times its source; the excess goes to the others by weight until none is above. In closed form:
    with sources ordered by cap/weight, the first that fit under the common level are full. A source without words
    gets 0. The table has one row per source; the windows run over that table only.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn + 1)
    by_level = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("w", w)
        .withColumn("top", F.col("source_size") * F.lit(float(cap)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("w_all", F.sum("w").over(everything))
        .withColumn("top_before", F.coalesce(F.sum("top").over(before), F.lit(0.0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("top_before")) / (F.col("w_all") - F.col("w_before")))
    )
    full = ranked.withColumn("is_full", F.col("top") / F.col("w") <= F.col("level"))
    rest = F.when(~F.col("is_full"), F.col("w"))
    level = (
        F.col("total") - F.sum(F.when(F.col("is_full"), F.col("top")).otherwise(0.0)).over(everything)
    ) / F.sum(rest).over(everything)
    target = F.when(F.col("is_full"), F.col("top")).otherwise(level * F.col("w"))
    return full.select("source", "source_size", target.alias("target"))


def random_share(seed: str, *parts: Column) -> Column:
    """Uniform number in (0, 1) that depends only on the given values."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def pareto_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
    preference: str | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``size, source_size, target, copies, taken`` added (names that clash get ``_``).

    A source that shall give ``target`` words has ``r = target / source_size`` expected copies of each document:
    ``floor(r)`` whole copies are certain, and for the remainder ``p = r - floor(r)`` the documents are ranked by the
    random odds ``u / (1 - u)`` over the inclusion odds ``p / (1 - p)``, times an optional positive ``preference``
    column. The sample is the head of that order up to the words still wanted (the last document is taken if the
    middle of it is within), so every source meets its target to half a document.

    The cut is found from sums by 4,096 buckets of the rank; only the documents of one bucket per source are put in
    order. Documents and their texts are not shuffled: one cut per source is joined to them. Rows alike in doc_id,
    size and source rank alike and are taken together. Null doc_id is a value like any other; null text has size 0;
    null source is the last source; null or non-positive preference counts as 1. Empty table: empty result.
    """
    size, rank = column_name(docs, "size"), column_name(docs, "rank")
    u = random_share(seed, F.col("doc_id"), F.col(size), F.col("source"))
    like = F.lit(1.0)
    if preference:
        given = F.col(preference).cast("double")
        like = F.when(given > 0, given).otherwise(1.0)
    sized = docs.withColumn(size, n_words(F.col("text")))
    # the odds of p are the same for all documents of a source: they shift no rank inside it
    odds = u / (1.0 - u) / like
    keyed = sized.withColumn(rank, odds / (1.0 + odds))
    small = stored(keyed.select("source", F.col(size).alias("size"), F.col(rank).alias("rank")), "mix-sizes")
    bucket = F.least(F.floor(F.col("rank") * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    plan = source_targets(small.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = stored(
        plan.withColumn("whole", F.floor(ratio))
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-plan",
    )
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = small.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("here"))
    sums = sums.withColumn("upto", F.sum("here").over(by_bucket))
    edge = (
        sums.join(plan.select(F.col("source").alias("s"), "wanted"), F.col("source").eqNullSafe(F.col("s")))
        .where(F.col("upto") > F.col("wanted"))
        .groupBy("source")
        .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("here")).alias("below"), "wanted"), "bucket").alias("e"))
        .select(F.col("source").alias("s"), "e.*")
    )
    in_edge = small.join(edge, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("bucket")))
    by_rank = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("size").over(by_rank), F.lit(0))
    last = (
        in_edge.withColumn("before", F.col("below") + first)
        .where(F.col("before") + F.col("size") / 2 <= F.col("wanted"))
        .groupBy("source")
        .agg(F.max("rank").alias("last"))
    )
    cuts = (
        plan.withColumnRenamed("source", "of_source")
        .join(edge.select("s", "bucket"), F.col("of_source").eqNullSafe(F.col("s")), "left")
        .drop("s")
        .join(last.withColumnRenamed("source", "s"), F.col("of_source").eqNullSafe(F.col("s")), "left")
        .select(
            F.struct(
                "of_source", "source_size", "target", F.col("whole").cast("long").alias("whole"), "last",
                # without an edge all documents of the source fit into what is wanted
                F.coalesce(F.col("bucket"), F.lit(BUCKETS)).alias("bucket"), (F.col("wanted") > 0).alias("some"),
            ).alias("cut")
        )
    )
    cuts = stored(cuts, "mix-cuts")
    cut = column_name(keyed, "cut")
    joined = keyed.join(cuts.withColumnRenamed("cut", cut), F.col("source").eqNullSafe(F.col(f"{cut}.of_source")), "left")
    c = lambda f: F.col(f"{cut}.{f}")
    at = F.least(F.floor(F.col(rank) * BUCKETS), F.lit(BUCKETS - 1))
    drawn = c("some") & ((at < c("bucket")) | ((at == c("bucket")) & F.coalesce(F.col(rank) <= c("last"), F.lit(False))))
    copies = F.coalesce(c("whole") + drawn.cast("long"), F.lit(0).cast("long"))
    return joined.select(
        *[F.col(x) for x in docs.columns],
        F.col(size),
        c("source_size").alias(column_name(docs, "source_size")),
        c("target").alias(column_name(docs, "target")),
        copies.alias(column_name(docs, "copies")),
        (copies * F.col(size)).alias(column_name(docs, "taken")),
    )


def repeated(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row as often as it is taken, in the columns of ``docs``."""
    copies = column_name(docs, "copies")
    mixed = pareto_mix(docs, **settings).where(F.col(copies) > 0)
    one = column_name(docs, "copy")
    times = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(one)
    return mixed.select(*docs.columns, times).drop(one)
