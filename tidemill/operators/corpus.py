"""Corpus building: sources to documents, table rows to documents, graph quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.payloads import row_json
from tidemill.operators.columns import dense_row_ids

CORPUS_COLUMNS = ("title", "body", "source", "service", "tags", "updated_at", "author")


def corpus_source(df: DataFrame, source: str, service: str, tags: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Project one source to the corpus columns; ``columns`` gives title, body, updated_at and author."""
    return df.withColumns({
        **columns,
        "source": F.lit(source),
        "service": F.lit(service),
        "tags": F.array(*[F.lit(t) for t in tags]),
    })


def build_corpus(sources: Sequence[DataFrame], run_date: str, order_by: Sequence[str]) -> DataFrame:
    """Union of projected sources with dense document ids.

    Every source carries the ``order_by`` columns; values of ``updated_at`` that
    are no dates are replaced by the run date.
    """
    merged = None
    for source in sources:
        part = source.select(*order_by, *CORPUS_COLUMNS)
        merged = part if merged is None else merged.union(part)
    dated = merged.withColumn(
        "updated_at", F.when(F.col("updated_at").contains("-"), F.col("updated_at")).otherwise(F.lit(run_date))
    )
    return dense_row_ids(dated, list(order_by), "doc_id").select("doc_id", *CORPUS_COLUMNS)


def rows_to_documents(df: DataFrame, table: str, order_by: Sequence[str]) -> DataFrame:
    """Rows as ``(id, source, content, metadata)`` documents, numbered from 0 in key order."""
    numbered = dense_row_ids(df, list(order_by), "_row", start=0)
    return numbered.select(
        F.concat(F.lit(f"{table}_"), F.col("_row").cast("string")).alias("id"),
        F.lit(table).alias("source"),
        row_json(df.columns).alias("content"),
        F.struct(F.lit(table).alias("table"), F.col("_row").cast("bigint").alias("row_id")).alias("metadata"),
    )


def graph_quality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Entities, relations, orphans and the connected share of a graph ``nodes(id)``, ``edges(src, dst)``."""
    linked = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    flagged = nodes.select("id").join(linked.withColumn("_linked", F.lit(1)), "id", "left")
    totals = flagged.agg(
        F.count(F.lit(1)).alias("entity_count"), F.count_if(F.col("_linked").isNull()).alias("orphan_count")
    )
    connected = F.try_divide((F.col("entity_count") - F.col("orphan_count")).cast("double"), F.col("entity_count").cast("double"))
    return totals.select(
        "entity_count", edges.agg(F.count(F.lit(1))).scalar().alias("relation_count"), "orphan_count",
        F.coalesce(connected, F.lit(0.0)).alias("extraction_accuracy"),
    )


def orphan_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    linked = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return nodes.join(linked, "id", "left_anti")
