"""Exact and cell-pruned nearest neighbours by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemill.functions.vectors import unit
from tidemill.operators.columns import top_per_group
from tidemill.session import no_rows

DIGITS = 6
MAX_BROADCAST_QUERIES = 4096
VECTOR_BLOCK = 100_000
#: Similarities that a task holds at a time.
TILE = 4_000_000


def _matrix(column: pd.Series) -> np.ndarray:
    rows = np.stack(column.to_numpy()).astype(np.float64)
    sizes = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, sizes, out=np.zeros_like(rows), where=sizes > 0)


def _block_topk(query_ids: np.ndarray, query_rows: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
                threshold: float | None, wanted: np.ndarray | None = None) -> pd.DataFrame:
    """Best ``k`` of one block for each query, complete with ties decided by id; ``wanted``, queries x rows, tells what counts."""
    asked, hits, scores = [], [], []
    tile = max(1, TILE // max(1, len(ids)))
    for at in range(0, len(query_ids), tile):
        similarity = query_rows[at:at + tile] @ rows.T
        np.round(similarity, DIGITS, out=similarity)
        for i, (q, line) in enumerate(zip(query_ids[at:at + tile], similarity), at):
            keep = np.arange(len(ids)) if threshold is None else np.flatnonzero(line >= threshold)
            if wanted is not None:
                keep = keep[wanted[i, keep]]
            if len(keep) > k:
                cut = np.partition(line[keep], len(keep) - k)[len(keep) - k]
                keep = keep[line[keep] >= cut]
            order = keep[np.lexsort((ids[keep], -line[keep]))][:k]
            asked.append(np.full(len(order), q))
            hits.append(ids[order])
            scores.append(line[order])
    if not asked:
        return pd.DataFrame({"query_id": [], "doc_id": [], "score": []})
    return pd.DataFrame({"query_id": np.concatenate(asked), "doc_id": np.concatenate(hits), "score": np.concatenate(scores)})


RESULT = StructType([
    StructField("query_id", LongType()), StructField("doc_id", LongType()), StructField("score", DoubleType()),
])


def _usable(df: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows with an id and a vector without nulls; others have no similarity to anything."""
    whole = F.col(key).isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", F.isnull)
    return df.select(F.col(key).cast("bigint").alias(key), "embedding", *more).filter(whole)


def _same_size(df: DataFrame, head: pd.DataFrame) -> DataFrame:
    """Rows whose vector is as long as those of the queries."""
    sizes = sorted(set(map(len, head["embedding"])))
    if len(sizes) > 1:
        raise ValueError(f"queries have vectors of different lengths: {sizes}")
    return df.filter(F.size("embedding") == sizes[0])


def knn(vectors: DataFrame, queries: DataFrame, k: int = 10, threshold: float | None = None,
        max_broadcast: int = MAX_BROADCAST_QUERIES, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """Exact top ``k`` by cosine similarity: ``(query_id, doc_id, score, rank)``.

    ``vectors`` is ``(doc_id bigint, embedding)`` and ``queries`` is
    ``(query_id bigint, embedding)``. Scores are rounded before ranking, so the
    order does not depend on how sums are evaluated; ties go to the smaller id.
    Rows whose id or vector is null, holds nulls or has another length than the
    queries' match nothing.

    Up to ``max_broadcast`` queries (checked by an action) travel to the vectors
    and each Arrow batch returns at most ``k`` rows per query. Beyond that both
    sides are cut into hash blocks of about ``max_broadcast`` and
    ``vector_block`` rows that meet pairwise.
    """
    queries, vectors = _usable(queries, "query_id"), _usable(vectors, "doc_id")
    head = queries.limit(max_broadcast + 1).toPandas()
    if len(head) == 0:
        return no_rows(vectors.sparkSession, "query_id bigint, doc_id bigint, score double, rank int")
    queries, vectors = _same_size(queries, head), _same_size(vectors, head)
    if len(head) <= max_broadcast:
        query_ids, query_rows = head["query_id"].to_numpy(), _matrix(head["embedding"])

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield _block_topk(query_ids, query_rows, batch["doc_id"].to_numpy(), _matrix(batch["embedding"]), k, threshold)

        best = vectors.mapInPandas(score, RESULT)
    else:
        best = _blockwise(vectors, queries, k, threshold, max_broadcast, vector_block)
    return top_per_group(best, ["query_id"], [F.desc("score"), F.asc("doc_id")], k)


def _blockwise(vectors: DataFrame, queries: DataFrame, k: int, threshold: float | None, query_block: int, vector_block: int) -> DataFrame:
    """Block nested search. Hash blocks are even, whatever the data, and one block of each side fits a task."""
    whole = F.lit(0).cast("bigint").alias("cell")
    return _meet(vectors.select("*", whole), queries.select("*", whole), k, threshold, query_block, vector_block)


def _meet(vectors: DataFrame, queries: DataFrame, k: int, threshold: float | None, query_block: int, vector_block: int) -> DataFrame:
    """Queries meet the vectors of their cell; both sides of a cell are cut into hash blocks by the counts of that cell."""
    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    def block(c: str, n: str) -> Column:
        return F.pmod(F.xxhash64(c), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    cuts = blocks(queries, query_block, "qn").join(blocks(vectors, vector_block, "vn"), "cell")  # a row for each cell
    q = queries.join(cuts, "cell").select("query_id", F.col("embedding").alias("asked"), "cell", block("query_id", "qn").alias("qb"), every("vn").alias("vb"))
    v = vectors.join(cuts, "cell").select("doc_id", "embedding", "cell", block("doc_id", "vn").alias("vb"), every("qn").alias("qb"))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"query_id": [], "doc_id": [], "score": []})
        return _block_topk(left["query_id"].to_numpy(), _matrix(left["asked"]),
                           right["doc_id"].to_numpy(), _matrix(right["embedding"]), k, threshold)

    keys = ["cell", "qb", "vb"]
    return q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(score, RESULT)


def knn_filtered(items: DataFrame, where: Column, queries: DataFrame, k: int = 10, threshold: float | None = None) -> DataFrame:
    """Restrict by metadata first, then search what is left."""
    return knn(items.filter(where).select("doc_id", "embedding"), queries, k, threshold)


def knn_without(items: DataFrame, text: str, unwanted: str, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nearest among the items whose text is known and lacks the word in any case."""
    return knn_filtered(items, ~F.lower(F.col(text)).contains(unwanted.lower()), queries, k)


def two_stage(items: DataFrame, where: Column, queries: DataFrame, k: int = 10, candidate_limit: int | None = None) -> DataFrame:
    """Filter to candidates (optionally the first ``candidate_limit`` by id), then rank them by similarity."""
    candidates = items.filter(where).select("doc_id", "embedding")
    if candidate_limit is not None:
        candidates = candidates.orderBy("doc_id").limit(candidate_limit)
    return knn(candidates, queries, k)


def train_cells(vectors: DataFrame, cells: int = 100, seed: int = 7) -> DataFrame:
    """Cluster centres ``(cell, centre)`` of all unit vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = _usable(vectors, "doc_id").select(array_to_vector(unit(F.col("embedding"))).alias("features"))
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=20).fit(data)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(centres, "cell bigint, centre array<double>")


def _cell_matrix(cells: DataFrame, max_cells: int = MAX_BROADCAST_QUERIES) -> tuple[np.ndarray, np.ndarray]:
    centres = cells.limit(max_cells + 1).toPandas()
    if len(centres) > max_cells:
        raise ValueError(f"more than {max_cells} cells")
    return centres["cell"].to_numpy(), _matrix(centres["centre"])


def _nearest(rows: np.ndarray, cell_ids: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    similarity = np.round(rows @ centres.T, DIGITS)
    return cell_ids[np.lexsort((np.broadcast_to(cell_ids, similarity.shape), -similarity), axis=1)[:, :n]]


def assign_cells(vectors: DataFrame, cells: DataFrame) -> DataFrame:
    """Vectors with the cell of their nearest centre. Stored with ``partitionBy("cell")``, a search reads only
    the cells that it probes."""
    cell_ids, centres = _cell_matrix(cells)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=_nearest(_matrix(batch["embedding"]), cell_ids, centres, 1)[:, 0])

    return _usable(vectors, "doc_id").filter(F.size("embedding") == centres.shape[1]).mapInPandas(
        assign, "doc_id bigint, embedding array<float>, cell bigint"
    )


def knn_by_cells(homes: DataFrame, queries: DataFrame, cells: DataFrame, k: int = 10, probes: int = 3,
                 max_broadcast: int = MAX_BROADCAST_QUERIES, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """Approximate search over :func:`assign_cells` rows: a query meets only its ``probes`` nearest cells.

    With ``probes`` equal to the number of cells the result is exact. Up to
    ``max_broadcast`` queries travel to the vectors; more are sent to the cells
    they probe and meet them block by block, with the same result.
    """
    queries, homes = _usable(queries, "query_id"), _usable(homes, "doc_id", "cell")
    head = queries.limit(max_broadcast + 1).toPandas()
    if len(head) == 0:
        return no_rows(homes.sparkSession, "query_id bigint, doc_id bigint, score double, rank int")
    queries, homes = _same_size(queries, head), _same_size(homes, head)
    cell_ids, centres = _cell_matrix(cells)
    if len(head) > max_broadcast:

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(cells=list(_nearest(_matrix(batch["embedding"]), cell_ids, centres, probes)))

        sent = queries.mapInPandas(probe, "query_id bigint, embedding array<double>, cells array<bigint>")
        sent = sent.select("query_id", "embedding", F.explode("cells").alias("cell"))
        found = _meet(homes, sent, k, None, max_broadcast, vector_block)
        return top_per_group(found, ["query_id"], [F.desc("score"), F.asc("doc_id")], k)
    query_ids, query_rows = head["query_id"].to_numpy(), _matrix(head["embedding"])
    probed = _nearest(query_rows, cell_ids, centres, probes)
    askers = {int(c): np.flatnonzero((probed == c).any(axis=1)) for c in np.unique(probed)}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cell, block in batch.groupby("cell"):
                who = askers[int(cell)]
                yield _block_topk(query_ids[who], query_rows[who], block["doc_id"].to_numpy(), _matrix(block["embedding"]), k, None)

    found = homes.filter(F.col("cell").isin(list(askers))).mapInPandas(score, RESULT)
    return top_per_group(found, ["query_id"], [F.desc("score"), F.asc("doc_id")], k)


def hashed_vectors(docs: DataFrame, doc_id: str, text: str, dims: int = 256) -> DataFrame:
    """Unit-length hashed TF-IDF vectors ``(doc_id, embedding)``; the default featuriser without a model."""
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    from tidemill.functions.text import tokens

    words = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("words"))
    counted = HashingTF(inputCol="words", outputCol="tf", numFeatures=dims).transform(words)
    weighted = IDF(inputCol="tf", outputCol="tfidf").fit(counted).transform(counted)
    normed = Normalizer(inputCol="tfidf", outputCol="unit").transform(weighted)
    return normed.select("doc_id", vector_to_array("unit", "float32").alias("embedding"))


def encode_with(docs: DataFrame, doc_id: str, text: str, load_model, batch_size: int = 32) -> DataFrame:
    """Vectors from a caller's model: ``load_model()`` runs once per task and returns ``encode(list) -> rows``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_model()
        for batch in batches:
            for at in range(0, len(batch), batch_size):
                piece = batch.iloc[at:at + batch_size]
                rows = [[float(x) for x in row] for row in encode(piece["text"].tolist())]
                yield pd.DataFrame({"doc_id": piece["doc_id"].to_numpy(), "embedding": rows})

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInPandas(run, "doc_id bigint, embedding array<float>")
