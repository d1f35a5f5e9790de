"""Rank fusion, side-by-side comparison and extractive answers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import keyword_score, query_keywords, sentences
from tidemill.operators.columns import top_per_group

# Fusion constant and list weights.
RRF_K, LEXICAL_WEIGHT, SEMANTIC_WEIGHT = 60, 0.5, 0.5


def rank_fusion(lists: Mapping[str, DataFrame], weights: Mapping[str, float] | None = None, k: int = RRF_K) -> DataFrame:
    """Weighted reciprocal ranks of ranked lists ``(query_id, doc_id, rank)`` summed per document."""
    weights = weights or {"lexical": LEXICAL_WEIGHT, "semantic": SEMANTIC_WEIGHT}
    parts = None
    for name, hits in lists.items():
        part = hits.select(
            F.col("query_id").cast("bigint").alias("query_id"), F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.lit(float(weights[name])) * (F.lit(1.0) / (F.col("rank") + k))).alias("part"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("query_id", "doc_id").agg(F.round(F.sum("part"), 9).alias("score"))


def with_documents(hits: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents of the hits; unknown ids are dropped."""
    return hits.join(docs, key)


def side_by_side(approaches: Mapping[str, DataFrame]) -> DataFrame:
    """Hit lists of several approaches stacked with an ``approach`` column."""
    out = None
    for name, hits in approaches.items():
        part = hits.select(F.lit(name).alias("approach"), F.col("query_id").cast("bigint").alias("query_id"),
                           F.col("doc_id").cast("bigint").alias("doc_id"), F.col("score").cast("double").alias("score"), "rank")
        out = part if out is None else out.unionByName(part)
    return out


def extractive_answers(hits: DataFrame, docs: DataFrame, queries: DataFrame, query_id: str, text: str, body: str,
                       top_docs: int = 3, top_sentences: int = 3) -> DataFrame:
    """``(query_id, answer)``: the sentences of the best documents that hold most query words.

    ``hits`` is ``(query_id, doc_id, score)``. Sentences keep their document order
    on equal scores; blank ones are skipped. Documents are joined by id, and only
    the wanted number of sentences per query meets in one task.
    """
    best = top_per_group(hits.select("query_id", "doc_id", "score"), ["query_id"], [F.desc("score"), F.asc("doc_id")], top_docs)
    words = queries.select(F.col(query_id).cast("bigint").alias("query_id"), query_keywords(F.col(text)).alias("keywords"))
    pieces = (
        best.join(docs.select("doc_id", F.col(body).alias("_body")), "doc_id").join(words, "query_id")
        .select("query_id", "keywords", F.col("rank").alias("doc_no"),
                F.posexplode(sentences(F.col("_body"))).alias("pos", "sentence"))
        .withColumn("sentence", F.trim(F.regexp_replace("sentence", r"^\s+|\s+$", "")))
        .filter(F.col("sentence") != "")
        .withColumn("hits", keyword_score(F.col("sentence"), F.col("keywords")))
    )
    order = [F.desc("hits"), F.asc("doc_no"), F.asc("pos")]
    chosen = top_per_group(pieces, ["query_id"], order, top_sentences, "place")
    lines = chosen.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("place", F.concat(F.lit("- "), "sentence").alias("line")))).alias("l")
    )
    return lines.select("query_id", F.array_join(F.transform("l", lambda e: e["line"]), "\n").alias("answer"))
