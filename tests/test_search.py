from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import corpus, fusion, lexical, vector_search
from tidemill.session import fresh_dir

DOCS = [
    (1, "Red bolt", "a red bolt for doors, red and strong", ["metal", "red"]),
    (2, "Blue bolt", "a blue bolt", ["metal"]),
    (3, "Paint", "red paint", []),
    (4, "Empty", None, ["none"]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, title string, body string, tags array<string>")


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid bigint, text string")


def bm25(texts, query):
    """Plain BM25 over token lists."""
    n, avg = len(texts), sum(map(len, texts.values())) / len(texts)
    scores = {}
    for doc, words in texts.items():
        total = 0.0
        for term in query:
            df, tf = sum(term in w for w in texts.values()), words.count(term)
            if tf:
                total += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
        if total:
            scores[doc] = round(total, 6)
    return scores


def test_bm25_equals_the_formula(spark, docs):
    hits = lexical.bm25_topk(docs, "doc_id", ["body"], ask(spark, "red bolt red", "nothing here"), "qid", "text")
    texts = {d: (body or "").replace(",", "").lower().split() for d, _, body, _ in DOCS}
    assert {r["doc_id"]: r["score"] for r in hits.collect()} == bm25(texts, ["red", "bolt", "red"])


def test_same_hits_without_broadcast(spark, docs, monkeypatch):
    queries = ask(spark, "red bolt", "blue")
    want = sorted(map(tuple, lexical.bm25_topk(docs, "doc_id", ["title", "body"], queries, "qid", "text").collect()))
    monkeypatch.setattr(lexical, "MAX_BROADCAST_TERMS", 0)
    got = sorted(map(tuple, lexical.bm25_topk(docs, "doc_id", ["title", "body"], queries, "qid", "text").collect()))
    assert got == want and len(want) == 4


def test_best_field_and_boost(spark, docs):
    def score(boosts):
        return lexical.boosted_search(docs, "doc_id", boosts, ask(spark, "paint"), "qid", "text").first()["score"]

    title, body = score({"title": 1.0}), score({"body": 1.0})
    assert score({"title": 2.0}) == pytest.approx(2 * title, abs=1e-5)
    assert score({"title": 1.0, "body": 1.0}) == max(title, body) and score({"title": 9.0, "body": 1.0}) == pytest.approx(9 * title, abs=1e-5)
    kept = lexical.boosted_search(docs, "doc_id", {"title": 1.0}, ask(spark, "bolt"), "qid", "text", F.col("doc_id") > 1)
    assert [r["doc_id"] for r in kept.collect()] == [2]


def test_list_fields_and_index(spark, docs):
    path = fresh_dir(spark, "index")
    lexical.write_index(docs, "doc_id", ["tags", "body"], path)
    index = spark.read.parquet(path)
    assert {(r["doc_id"], r["tf"]) for r in index.filter("field = 'tags' AND term = 'metal'").collect()} == {(1, 1), (2, 1)}
    stats = {r["field"]: (r["n_docs"], r["avg_len"]) for r in lexical.field_stats(index).collect()}
    assert stats["tags"] == (4, 1.0) and stats["body"][0] == 4
    assert lexical.vocabulary(index).filter("term = ''").count() == 0


def test_boolean(spark, docs):
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(lexical.boolean_search(docs, "doc_id", "body", ["red"], ["paint"], k=None)) == [1]
    assert ids(lexical.boolean_search(docs, "doc_id", "body", ["red blue"], k=None)) == [1, 2, 3]
    assert ids(lexical.boolean_search(docs, "doc_id", "body", ["red", "bolt"])) == [1]


def test_typos(spark, docs):
    hits = lexical.fuzzy_search(docs, "doc_id", ["title", "body"], ask(spark, "piant", "stronk"), "qid", "text")
    assert {(r["query_id"], r["doc_id"]) for r in hits.filter("rank = 1").collect()} == {(0, 3), (1, 1)}


def test_autocomplete(spark, docs):
    got = lexical.autocomplete(docs, "doc_id", ["title", "body"], "RED").orderBy("position").collect()
    assert [r["suggestion"] for r in got] == ["Red bolt", "red paint"]
    assert lexical.autocomplete(docs, "doc_id", ["title"], "r").count() == 0


def vectors(spark, n, dims, seed, name="doc_id"):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=dims), 1)]) for i in range(n)]
    rows[1] = (1, rows[0][1])  # an exact tie
    return rows, spark.createDataFrame(rows, f"{name} bigint, embedding array<float>")


def brute(vs, qs, k, threshold=None):
    out = set()
    unit = lambda v: np.asarray(v, np.float32).astype(float) / np.linalg.norm(np.asarray(v, np.float32).astype(float))
    for q, qv in qs:
        scored = sorted((-round(float(unit(qv) @ unit(v)), 6), i) for i, v in vs)
        kept = [(s, i) for s, i in scored if threshold is None or -s >= threshold][:k]
        out |= {(q, i, rank) for rank, (_, i) in enumerate(kept, start=1)}
    return out


def ranks(df):
    return {(r["query_id"], r["doc_id"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("limit", [1000, 2])
def test_knn_is_exact(spark, limit):
    vs, v = vectors(spark, 60, 6, 1)
    qs, q = vectors(spark, 5, 6, 2, "query_id")
    assert ranks(vector_search.knn(v, q, 4, max_broadcast=limit, vector_block=25)) == brute(vs, qs, 4)
    assert ranks(vector_search.knn(v, q, 4, 0.5, max_broadcast=limit, vector_block=25)) == brute(vs, qs, 4, 0.5)


def test_no_queries(spark):
    _, v = vectors(spark, 5, 3, 1)
    assert vector_search.knn(v, v.limit(0).withColumnRenamed("doc_id", "query_id")).count() == 0


def test_cells(spark):
    vs, v = vectors(spark, 80, 4, 3)
    qs, q = vectors(spark, 4, 4, 4, "query_id")
    cells = vector_search.train_cells(v, 5)
    homes = vector_search.assign_cells(v, cells)
    assert homes.count() == 80
    assert ranks(vector_search.knn_by_cells(homes, q, cells, 3, probes=5)) == brute(vs, qs, 3)
    assert ranks(vector_search.knn_by_cells(homes, q, cells, 3, probes=5, max_broadcast=1, vector_block=10)) == brute(vs, qs, 3)
    few = ranks(vector_search.knn_by_cells(homes, q, cells, 3, probes=1))
    assert few and few != brute(vs, qs, 3)
    assert ranks(vector_search.knn_by_cells(homes, q, cells, 3, probes=1, max_broadcast=1, vector_block=7)) == few


@pytest.mark.parametrize("limit", [100, 1])
def test_unusable_vectors_match_nothing(spark, limit):
    vs, v = vectors(spark, 30, 4, 1)
    qs, q = vectors(spark, 3, 4, 2, "query_id")
    odd = spark.createDataFrame([(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0])], v.schema)
    asked = q.unionByName(spark.createDataFrame([(9, None)], q.schema))
    assert ranks(vector_search.knn(v.unionByName(odd), asked, 4, max_broadcast=limit, vector_block=10)) == brute(vs, qs, 4)
    cells = vector_search.train_cells(v.unionByName(odd.limit(2)), 2)
    assert vector_search.assign_cells(v.unionByName(odd), cells).count() == 30


def test_small_tiles_give_the_same(spark, monkeypatch):
    vs, v = vectors(spark, 60, 6, 1)
    qs, q = vectors(spark, 5, 6, 2, "query_id")
    monkeypatch.setattr(vector_search, "TILE", 3)
    q_ids, rows = np.array([i for i, _ in qs]), vector_search._matrix(pd.Series([np.array(x) for _, x in qs]))
    ids, mine = np.array([i for i, _ in vs]), vector_search._matrix(pd.Series([np.array(x) for _, x in vs]))
    found = vector_search._block_topk(q_ids, rows, ids, mine, 4, None)
    assert {(a, b) for a, b in zip(found["query_id"], found["doc_id"])} == {(a, b) for a, b, _ in brute(vs, qs, 4)}


def test_unwanted_words_and_two_stages(spark):
    vs, v = vectors(spark, 20, 4, 5)
    _, q = vectors(spark, 2, 4, 6, "query_id")
    items = v.withColumn("text", F.when(F.col("doc_id") % 2 == 0, "a wireless set").otherwise("a wired set"))
    left = ranks(vector_search.knn_without(items, "text", "WIRELESS", q, 9))
    assert len(left) == 18 and all(i % 2 for _, i, _ in left)
    assert ranks(vector_search.two_stage(items, F.col("doc_id") < 0, q)) == set()
    some = vector_search.two_stage(items, F.col("doc_id") > 3, q, 2, candidate_limit=5)
    assert all(4 <= i <= 8 for _, i, _ in ranks(some))


def test_rank_fusion(spark):
    a = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "query_id bigint, doc_id bigint, rank int")
    b = spark.createDataFrame([(0, 2, 1), (0, 3, 2)], "query_id bigint, doc_id bigint, rank int")
    one = {r["doc_id"]: r["score"] for r in fusion.rank_fusion({"lexical": a, "semantic": b}).collect()}
    two = {r["doc_id"]: r["score"] for r in fusion.rank_fusion({"lexical": b, "semantic": a}).collect()}
    assert one == two and one[2] == round(0.5 / 61 + 0.5 / 62, 9) and one[1] == round(0.5 / 61, 9)


def test_extractive_answer(spark):
    docs = spark.createDataFrame([(1, "Nothing here. Red paint dries. Red red!"), (2, "Also red. Blue.")], "doc_id bigint, body string")
    hits = spark.createDataFrame([(0, 1, 0.9), (0, 2, 0.8), (0, 99, 0.7)], "query_id bigint, doc_id bigint, score double")
    queries = spark.createDataFrame([(0, "is red it")], "qid bigint, text string")
    answer = fusion.extractive_answers(hits, docs, queries, "qid", "text", "body").first()["answer"]
    assert answer == "- Red red!\n- Red paint dries.\n- Also red."


def test_corpus(spark):
    raw = spark.createDataFrame([(2, "b", "x", "2024-01-01"), (1, "a", "y", "soon")], "k int, t string, b string, u string")
    src = corpus.corpus_source(raw, "wiki", "docs", ["wiki"], {"title": F.col("t"), "body": F.col("b"), "updated_at": F.col("u"), "author": F.lit("me")})
    built = corpus.build_corpus([src], "2024-02-02", ["k"]).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["title"], r["updated_at"]) for r in built] == [(1, "a", "2024-02-02"), (2, "b", "2024-01-01")]


def test_graph(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("a", "a")], "src string, dst string")
    row = corpus.graph_quality(nodes, edges).first()
    assert (row["entity_count"], row["relation_count"], row["orphan_count"]) == (3, 2, 1) and row["extraction_accuracy"] == pytest.approx(2 / 3)
    assert [r["id"] for r in corpus.orphan_nodes(nodes, edges).collect()] == ["c"]
    assert corpus.graph_quality(nodes.limit(0), edges.limit(0)).first()["extraction_accuracy"] == 0.0


def test_features(spark, docs):
    from tidemill.functions.vectors import norm

    vecs = vector_search.hashed_vectors(docs.filter("body IS NOT NULL"), "doc_id", "body", 64)
    assert all(abs(r[0] - 1) < 1e-5 for r in vecs.select(norm(F.col("embedding"))).collect())
    assert vecs.exceptAll(vector_search.hashed_vectors(docs.filter("body IS NOT NULL"), "doc_id", "body", 64)).count() == 0


def test_model_batches(spark, docs):
    def load():
        return lambda texts: [[float(len(t)), float(len(texts) <= 2)] for t in texts]

    got = {r["doc_id"]: list(r["embedding"]) for r in vector_search.encode_with(docs, "doc_id", "title", load, batch_size=2).collect()}
    assert got[1] == [8.0, 1.0] and len(got) == 4


def test_words_are_counted_in_the_row_and_repeated_ids_are_one_document(spark):
    rows = [(1, "Red bolt red"), (2, "bolt"), (3, None), (4, " , ")]
    once = lexical.postings(spark.createDataFrame(rows, "doc_id long, body string"), "doc_id", ["body"])
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()  # nothing is shuffled or held for a split
    got = {tuple(r) for r in once.select("doc_id", "term", "tf", "doc_len").collect()}
    assert got == {(1, "red", 2, 3), (1, "bolt", 1, 3), (2, "bolt", 1, 1), (1, "", 1, 3), (2, "", 1, 1), (3, "", 1, 0), (4, "", 1, 0)}
    again = lexical.postings(spark.createDataFrame([*rows, (2, "bolt"), (None, "red"), (None, "red")], "doc_id long, body string"), "doc_id", ["body"])
    found = {(r.doc_id, r.term): r.tf for r in again.collect()}
    assert found[(2, "bolt")] == 2 and found[(2, "")] == 2 and found[(None, "red")] == 2 and found[(1, "red")] == 2 and len(found) == 9


def test_sums_are_spread_over_tasks_by_their_number(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "red bolt") for i in range(60)], "doc_id long, body string")
    index = lexical.postings(docs, "doc_id", ["body"])
    terms = lexical.query_terms(ask(spark, "red bolt", "bolt"), "qid", "text")
    monkeypatch.setattr(lexical, "TASK_SUMS", 10)
    plan = lexical.bm25_scores(index, terms, {"body": 1.0})._jdf.queryExecution().toString()
    assert "hashpartitioning(doc_id" in plan and ", 12)" in plan.replace("#", ", ") or "RepartitionByExpression [doc_id" in plan and "], 12" in plan
