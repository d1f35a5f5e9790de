"""Keyword, vector and hybrid search over documents, pages and embeddings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemill.operators import block_index, corpus, fusion, lexical, vector_index, vector_search
from tidemill.plans.catalog import job, table, tables
from tidemill.session import ensure_checkpoint_dir, fresh_dir

WORDS = r"list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def bm25_sql(docs: str, fields: dict[str, float], queries: str, combine: str = "sum", prefix: str = "") -> str:
    """SQL common table expressions ``{prefix}scores(query_id, doc_id, score)``."""
    p = prefix
    tok = " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, {WORDS.format(c=f)} AS w FROM {docs}" for f in fields)
    boost = "CASE field " + " ".join(f"WHEN '{f}' THEN {b}::DOUBLE" for f, b in fields.items()) + " END"
    return f"""
      {p}tok AS ({tok}),
      {p}stats AS (SELECT field, count(*) AS n_docs, sum(len(w)) / count(*) AS avg_len FROM {p}tok GROUP BY 1),
      {p}post AS (SELECT doc_id, field, len(w) AS doc_len, unnest(w) AS term FROM {p}tok),
      {p}tf AS (SELECT doc_id, field, term, count(*) AS tf, any_value(doc_len) AS doc_len FROM {p}post GROUP BY 1, 2, 3),
      {p}df AS (SELECT field, term, count(*) AS df FROM {p}tf GROUP BY 1, 2),
      {p}qt AS (SELECT query_id, term, count(*)::DOUBLE AS weight FROM (SELECT query_id, unnest({WORDS.format(c='qtext')}) AS term FROM {queries}) GROUP BY 1, 2),
      {p}parts AS (SELECT query_id, doc_id, field, sum(weight * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * ({boost})
          * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / avg_len))) AS s
        FROM {p}qt JOIN {p}df USING (term) JOIN {p}stats USING (field) JOIN {p}tf USING (field, term) GROUP BY 1, 2, 3),
      {p}scores AS (SELECT query_id, doc_id, round({'sum' if combine == 'sum' else 'max'}(s), 6) AS score FROM {p}parts GROUP BY 1, 2)
    """


TOP10 = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)"
ITEMS_SQL = "q AS (SELECT item_id AS query_id, text AS qtext FROM benchmark)"


@job("postings", f"""
    WITH t AS (SELECT doc_id, unnest({WORDS.format(c='text')}) AS term FROM documents)
    SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS occurrences FROM t GROUP BY 1
""")
def postings(spark, sf_dir):
    """Vocabulary of the stored index: documents and occurrences per word."""
    documents = table(spark, sf_dir, "documents")
    path = fresh_dir(spark, "index")
    lexical.write_index(documents, "doc_id", ["text"], path)
    index = spark.read.parquet(path).filter(F.col("term") != lexical.LENGTH)
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("tf").alias("occurrences"))


@job("bm25_topk", f"""
    WITH {ITEMS_SQL}, d AS (SELECT doc_id, text FROM documents), {bm25_sql('d', {'text': 1.0}, 'q')}
    SELECT query_id, doc_id, score, CAST({TOP10} AS INTEGER) AS rank FROM scores QUALIFY rank <= 10
""")
def bm25_topk(spark, sf_dir):
    documents, benchmark = tables(spark, sf_dir, "documents", "benchmark")
    return lexical.bm25_topk(documents, "doc_id", ["text"], benchmark, "item_id", "text")


PAGES_SQL = r"""pg AS (SELECT page_id AS doc_id, regexp_extract(html, '<html lang="([a-z]*)"', 1) AS category, length(html) AS size,
    regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_replace(html, '<[^>]+>', ' ', 'g') AS body FROM pages)"""


def page_documents(spark, sf_dir):
    """Pages as documents with title, tag-free body, language and size."""
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), F.regexp_extract(html, r'<html lang="([a-z]*)"', 1).alias("category"),
        F.length(html).alias("size"), F.regexp_extract(html, r"<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_replace(html, r"<[^>]+>", " ").alias("body"), "url",
    )


@job("bm25_indexed", f"""
    WITH {ITEMS_SQL}, d AS (SELECT doc_id, text FROM documents), {bm25_sql('d', {'text': 1.0}, 'q')}
    SELECT query_id, doc_id, score, CAST({TOP10} AS INTEGER) AS rank FROM scores QUALIFY rank <= 10
""")
def bm25_indexed(spark, sf_dir):
    """As ``bm25_topk``, from a stored index whose blocks are opened only where a result can be."""
    documents, benchmark = tables(spark, sf_dir, "documents", "benchmark")
    path = fresh_dir(spark, "block-index")
    block_index.write_block_index(documents, "doc_id", ["text"], path)
    return block_index.search_blocks(spark, path, benchmark, "item_id", "text", {"text": 1.0})


@job("boosted_match", f"""
    WITH {ITEMS_SQL}, {PAGES_SQL}, {bm25_sql('pg', {'title': 2.0, 'body': 1.0}, 'q', 'max')}
    SELECT query_id, doc_id, score, CAST({TOP10} AS INTEGER) AS rank FROM scores JOIN pg USING (doc_id)
    WHERE category = 'en' AND size >= 0 QUALIFY rank <= 10
""")
def boosted_match(spark, sf_dir):
    where = (F.col("category") == "en") & (F.col("size") >= 0)
    return lexical.boosted_search(page_documents(spark, sf_dir), "doc_id", {"title": 2.0, "body": 1.0},
                                  table(spark, sf_dir, "benchmark"), "item_id", "text", where)


@job("bool_search", f"""
    WITH q AS (SELECT 0 AS query_id, 'the with' AS qtext), d AS (SELECT doc_id, text FROM documents), {bm25_sql('d', {'text': 1.0}, 'q')},
    ok AS (SELECT doc_id FROM tok WHERE list_contains(w, 'the') AND list_contains(w, 'with') AND NOT list_contains(w, 'die') AND NOT list_contains(w, 'wing'))
    SELECT doc_id, score, CAST({TOP10} AS INTEGER) AS rank FROM scores JOIN ok USING (doc_id) QUALIFY rank <= 10
""")
def bool_search(spark, sf_dir):
    return lexical.boolean_search(table(spark, sf_dir, "documents"), "doc_id", "text", ["the", "with"], ["die", "wing"])


@job("bool_filter", f"""
    WITH t AS (SELECT doc_id, {WORDS.format(c='text')} AS w FROM documents)
    SELECT doc_id FROM t WHERE list_contains(w, 'the') AND NOT list_contains(w, 'die')
""")
def bool_filter(spark, sf_dir):
    return lexical.boolean_search(table(spark, sf_dir, "documents"), "doc_id", "text", ["the"], ["die"], k=None)


@job("term_lookup", "SELECT doc_id, lang, source, n_chars FROM documents WHERE source = 'src3'")
def term_lookup(spark, sf_dir):
    return lexical.term_lookup(table(spark, sf_dir, "documents"), "source", "src3").select("doc_id", "lang", "source", "n_chars")


@job("fuzzy_search", f"""
    WITH q0 AS (SELECT min(p_partkey) AS query_id, replace(p_name, 'e', '') AS qtext FROM part GROUP BY 2),
    d AS (SELECT p_partkey AS doc_id, p_name AS name, p_type AS kind FROM part),
    tok AS (SELECT doc_id, 'name' AS field, {WORDS.format(c='name')} AS w FROM d UNION ALL SELECT doc_id, 'kind', {WORDS.format(c='kind')} FROM d),
    stats AS (SELECT field, count(*) AS n_docs, sum(len(w)) / count(*) AS avg_len FROM tok GROUP BY 1),
    post AS (SELECT doc_id, field, len(w) AS doc_len, unnest(w) AS term FROM tok),
    tf AS (SELECT doc_id, field, term, count(*) AS tf, any_value(doc_len) AS doc_len FROM post GROUP BY 1, 2, 3),
    df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY 1, 2),
    q1 AS (SELECT query_id, term AS l, count(*)::DOUBLE AS weight FROM (SELECT query_id, unnest({WORDS.format(c='qtext')}) AS term FROM q0) GROUP BY 1, 2),
    qt AS (SELECT query_id, term, max(weight * (1 - levenshtein(l, term) / greatest(length(l), length(term))::DOUBLE)) AS weight
      FROM q1, (SELECT DISTINCT term FROM tf) WHERE levenshtein(l, term) <= 2 GROUP BY 1, 2 HAVING weight > 0),
    parts AS (SELECT query_id, doc_id, field, sum(weight * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2::DOUBLE
      / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / avg_len))) AS s
      FROM qt JOIN df USING (term) JOIN stats USING (field) JOIN tf USING (field, term) GROUP BY 1, 2, 3),
    scores AS (SELECT query_id, doc_id, round(max(s), 6) AS score FROM parts GROUP BY 1, 2)
    SELECT query_id, doc_id, score, CAST({TOP10} AS INTEGER) AS rank FROM scores QUALIFY rank <= 10
""")
def fuzzy_search(spark, sf_dir):
    """Part names with letters lost, searched in name and type."""
    part = table(spark, sf_dir, "part")
    queries = part.groupBy(F.replace("p_name", F.lit("e"), F.lit("")).alias("qtext")).agg(F.min("p_partkey").alias("query_id"))
    docs = part.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"))
    return lexical.fuzzy_search(docs, "doc_id", ["name", "kind"], queries, "query_id", "qtext")


@job("autocomplete", """
    WITH v AS (SELECT p_partkey AS o, 0 AS f, p_name AS suggestion FROM part UNION ALL SELECT p_partkey, 1, p_type FROM part)
    SELECT suggestion, min((o, f)).o AS position FROM (SELECT suggestion, {'o': o, 'f': f} AS k, o, f FROM v) WHERE lower(suggestion) LIKE 'sm%'
    GROUP BY 1 ORDER BY min(k) LIMIT 5
""".replace("min((o, f)).o", "min(k).o"))
def autocomplete(spark, sf_dir):
    return lexical.autocomplete(table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_type"], "SM")


def label_centres(spark, sf_dir):
    """Mean vector per label as ``(query_id, embedding)``: a query set whose size is the number of labels."""
    embeddings = table(spark, sf_dir, "embeddings")
    means = embeddings.select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos").agg(
        F.round(F.avg(F.col("x").cast("double")), 6).alias("m")
    )
    # One entry per dimension and label.
    listed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("l"))
    return listed.select(F.col("label").cast("bigint").alias("query_id"), F.transform("l", lambda e: e["m"]).alias("embedding"))


def vector_items(spark, sf_dir):
    """Embeddings with the language, size and text of the document of the same id."""
    embeddings, documents = tables(spark, sf_dir, "embeddings", "documents")
    return embeddings.select(F.col("vec_id").alias("doc_id"), "embedding", "label").join(
        documents.select("doc_id", "lang", "n_chars", "text"), "doc_id"
    )


CENTRES_SQL = """
    x AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
    centres AS (SELECT label AS query_id, list(m ORDER BY pos) AS c FROM (SELECT label, pos, round(avg(v), 6) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
    sims AS (SELECT CAST(query_id AS BIGINT) AS query_id, vec_id AS doc_id, label, embedding,
      round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c), 6) AS score FROM embeddings, centres)
"""


@job("knn_topk", f"""
    WITH {CENTRES_SQL} SELECT query_id, doc_id, score, CAST({TOP10} AS INTEGER) AS rank FROM sims QUALIFY rank <= 10
""")
def knn_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return vector_search.knn(vectors, label_centres(spark, sf_dir))


@job("knn_threshold", f"""
    WITH {CENTRES_SQL} SELECT query_id, doc_id, score, CAST({TOP10} AS INTEGER) AS rank FROM sims WHERE score >= 0.4 QUALIFY rank <= 25
""")
def knn_threshold(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return vector_search.knn(vectors, label_centres(spark, sf_dir), 25, 0.4)


@job("knn_all", """
    WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id,
      round(list_cosine_similarity(CAST(b.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])), 6) AS score FROM embeddings a, embeddings b)
    SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 3
""")
def knn_all(spark, sf_dir):
    """Every vector as a query; beyond 4,096 they meet block by block."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return vector_search.knn(vectors, vectors.withColumnRenamed("doc_id", "query_id"), 3)


@job("knn_filtered", f"""
    WITH {CENTRES_SQL} SELECT query_id, s.doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, s.doc_id) AS INTEGER) AS rank
    FROM sims s JOIN documents d ON d.doc_id = s.doc_id WHERE lang = 'en' AND n_chars >= 300 QUALIFY rank <= 10
""")
def knn_filtered(spark, sf_dir):
    where = (F.col("lang") == "en") & (F.col("n_chars") >= 300)
    return vector_search.knn_filtered(vector_items(spark, sf_dir), where, label_centres(spark, sf_dir))


@job("knn_not", f"""
    WITH {CENTRES_SQL} SELECT query_id, s.doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, s.doc_id) AS INTEGER) AS rank
    FROM sims s JOIN documents d ON d.doc_id = s.doc_id WHERE lower(text) NOT LIKE '%the%' QUALIFY rank <= 10
""")
def knn_not(spark, sf_dir):
    return vector_search.knn_without(vector_items(spark, sf_dir), "text", "the", label_centres(spark, sf_dir))


@job("knn_cells", f"""
    WITH {CENTRES_SQL}, home AS (SELECT doc_id, query_id AS cell FROM sims QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, query_id) = 1),
    probe AS (SELECT a.query_id, b.query_id AS cell FROM centres a, centres b
      QUALIFY row_number() OVER (PARTITION BY a.query_id ORDER BY round(list_cosine_similarity(a.c, b.c), 6) DESC, b.query_id) <= 3)
    SELECT s.query_id, s.doc_id, score, CAST(row_number() OVER (PARTITION BY s.query_id ORDER BY score DESC, s.doc_id) AS INTEGER) AS rank
    FROM sims s JOIN home h ON h.doc_id = s.doc_id JOIN probe p ON p.query_id = s.query_id AND p.cell = h.cell QUALIFY rank <= 10
""")
def knn_cells(spark, sf_dir):
    """Search in the three nearest of the label cells; vectors are stored by cell first."""
    centres = label_centres(spark, sf_dir)
    cells = centres.select(F.col("query_id").alias("cell"), F.col("embedding").alias("centre"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    path = fresh_dir(spark, "cells")
    vector_search.assign_cells(vectors, cells).write.partitionBy("cell").parquet(path)
    homes = spark.read.parquet(path).withColumn("cell", F.col("cell").cast("bigint"))
    return vector_search.knn_by_cells(homes, centres, cells, probes=3)


def _fiftieth(spark, sf_dir):
    """All vectors, their index over trained cells, and every vector whose id is divisible by 50 as a query."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    model = vector_index.train_quantiser(vectors, cells=32)
    path = fresh_dir(spark, "vector-index")
    vector_index.write_vector_index(vectors, model, path)
    asked = vectors.where(F.col("doc_id") % 50 == 0).withColumnRenamed("doc_id", "query_id")
    return vectors, vector_index.read_vector_index(spark, path), model, asked


FIFTIETH_SQL = """
    s AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id,
      round(list_cosine_similarity(CAST(b.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])), 6) AS score
      FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0)
"""


@job("knn_bounded", f"""
    WITH {FIFTIETH_SQL} SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM s QUALIFY rank <= 10
""")
def knn_bounded(spark, sf_dir):
    """Exact neighbours from codes and their error bounds."""
    _, index, model, asked = _fiftieth(spark, sf_dir)
    return vector_index.search_exact(index, model, asked)


@job("knn_recall", """
    SELECT vec_id AS query_id, CAST(10 AS BIGINT) AS wanted, TRUE AS enough FROM embeddings WHERE vec_id % 50 = 0
""")
def knn_recall(spark, sf_dir):
    """Recall of the approximate index against exact search: ``enough`` tells whether it is 0.9 or more over all queries."""
    vectors, index, model, asked = _fiftieth(spark, sf_dir)
    probes, depth = vector_index.calibrate(vectors, model)
    found = vector_index.search_index(index, model, asked, probes=probes, depth=depth).select("query_id", "doc_id", F.lit(1).alias("hit"))
    exact = vector_search.knn(vectors, asked).join(found, ["query_id", "doc_id"], "left")
    ensure_checkpoint_dir(spark)
    by_query = exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("hits")).checkpoint()  # searched once
    enough = by_query.agg(F.coalesce(F.sum("hits") >= 0.9 * F.sum("wanted"), F.lit(True))).first()[0]
    return by_query.select("query_id", "wanted", F.lit(enough).alias("enough"))


@job("hybrid_two_stage", f"""
    WITH {CENTRES_SQL} SELECT query_id, s.doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, s.doc_id) AS INTEGER) AS rank
    FROM sims s JOIN documents d ON d.doc_id = s.doc_id WHERE lang IN ('en', 'fr') AND n_chars <= 5000 QUALIFY rank <= 10
""")
def hybrid_two_stage(spark, sf_dir):
    where = F.col("lang").isin("en", "fr") & (F.col("n_chars") <= 5000)
    return vector_search.two_stage(vector_items(spark, sf_dir), where, label_centres(spark, sf_dir))


def _hit_lists(spark, sf_dir):
    """Lexical hits of the benchmark texts and semantic hits of the label centres, on common query numbers."""
    documents, benchmark = tables(spark, sf_dir, "documents", "benchmark")
    lexical_hits = lexical.bm25_topk(documents, "doc_id", ["text"], benchmark, "item_id", "text")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return lexical_hits, vector_search.knn(vectors, label_centres(spark, sf_dir)), documents, benchmark


LISTS_SQL = f"""
    {ITEMS_SQL}, d AS (SELECT doc_id, text FROM documents), {bm25_sql('d', {'text': 1.0}, 'q')}, {CENTRES_SQL},
    lex AS (SELECT query_id, doc_id, score, {TOP10} AS rank FROM scores QUALIFY rank <= 10),
    sem AS (SELECT query_id, doc_id, score, {TOP10} AS rank FROM sims QUALIFY rank <= 10),
    fused AS (SELECT query_id, doc_id, round(sum(part), 9) AS score FROM (
      SELECT query_id, doc_id, 0.5::DOUBLE * (1.0::DOUBLE / (60 + rank)) AS part FROM lex
      UNION ALL SELECT query_id, doc_id, 0.5::DOUBLE * (1.0::DOUBLE / (60 + rank)) FROM sem) GROUP BY 1, 2)
"""


@job("rrf", f"WITH {LISTS_SQL} SELECT query_id, doc_id, score, lang FROM fused JOIN documents USING (doc_id)")
def rrf(spark, sf_dir):
    lexical_hits, semantic_hits, documents, _ = _hit_lists(spark, sf_dir)
    fused = fusion.rank_fusion({"lexical": lexical_hits, "semantic": semantic_hits})
    return fusion.with_documents(fused, documents.select("doc_id", "lang")).select("query_id", "doc_id", "score", "lang")


@job("compare_approaches", f"""
    WITH {LISTS_SQL}, hyb AS (SELECT query_id, s.doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, s.doc_id) AS rank
      FROM sims s JOIN documents dd ON dd.doc_id = s.doc_id WHERE lang = 'en' QUALIFY rank <= 10)
    SELECT 'keyword' AS approach, query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM lex UNION ALL
    SELECT 'vector', query_id, doc_id, score, CAST(rank AS INTEGER) FROM sem UNION ALL SELECT 'hybrid', query_id, doc_id, score, CAST(rank AS INTEGER) FROM hyb
""")
def compare_approaches(spark, sf_dir):
    lexical_hits, semantic_hits, _, _ = _hit_lists(spark, sf_dir)
    hybrid = vector_search.two_stage(vector_items(spark, sf_dir), F.col("lang") == "en", label_centres(spark, sf_dir))
    return fusion.side_by_side({"keyword": lexical_hits, "vector": semantic_hits, "hybrid": hybrid})


@job("extractive_answer", f"""
    WITH {LISTS_SQL}, best AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS doc_no FROM fused QUALIFY doc_no <= 3),
    sent AS (SELECT query_id, doc_no, list_filter(string_split_regex(qtext, '\\s+'), lambda w: length(w) > 2) AS kw,
      string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS s
      FROM best JOIN documents USING (doc_id) JOIN q USING (query_id)),
    pieces AS (SELECT query_id, doc_no, kw, generate_subscripts(s, 1) AS pos, regexp_replace(unnest(s), '^\\s+|\\s+$', '', 'g') AS sentence FROM sent),
    scored AS (SELECT query_id, doc_no, pos, sentence, list_sum(list_transform(kw, lambda k: (length(lower(sentence)) - length(replace(lower(sentence), lower(k), ''))) // length(k))) AS hits
      FROM pieces WHERE sentence <> ''),
    top AS (SELECT query_id, sentence, row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, doc_no, pos) AS place FROM scored QUALIFY place <= 3)
    SELECT query_id, string_agg('- ' || sentence, chr(10) ORDER BY place) AS answer FROM top GROUP BY 1
""")
def extractive_answer(spark, sf_dir):
    lexical_hits, semantic_hits, documents, benchmark = _hit_lists(spark, sf_dir)
    fused = fusion.rank_fusion({"lexical": lexical_hits, "semantic": semantic_hits})
    return fusion.extractive_answers(fused, documents, benchmark, "item_id", "text", "text")


@job("corpus_etl", r"""
    WITH m AS (SELECT 0 AS r, doc_id AS k, 'src ' || source AS title, text AS body, 'documents' AS source, 'internal-docs|documents' AS tags, '2024-05-01' AS updated_at, lang AS author FROM documents
      UNION ALL SELECT 1, page_id, url, html, 'pages', 'web|pages', '2024-06-01', '' FROM pages
      UNION ALL SELECT 2, conv_id * 1000 + turn, role, text, 'conversations', 'chat|conversations', '2024-06-30', role FROM conversations)
    SELECT row_number() OVER (ORDER BY r, k, title) AS doc_id, title, md5(body) AS body_md5, source, tags, updated_at, author FROM m
""")
def corpus_etl(spark, sf_dir):
    documents, pages, conversations = tables(spark, sf_dir, "documents", "pages", "conversations")
    sources = [
        corpus.corpus_source(documents.withColumns({"r": F.lit(0), "k": F.col("doc_id")}), "documents", "internal-docs", ["internal-docs", "documents"], {
            "title": F.concat(F.lit("src "), "source"), "body": F.col("text"), "updated_at": F.lit("2024-05-01"), "author": F.col("lang")}),
        corpus.corpus_source(pages.withColumns({"r": F.lit(1), "k": F.col("page_id")}), "pages", "web", ["web", "pages"], {
            "title": F.col("url"), "body": F.col("html"), "updated_at": F.lit("2024-06-01"), "author": F.lit("")}),
        corpus.corpus_source(conversations.withColumns({"r": F.lit(2), "k": F.col("conv_id") * 1000 + F.col("turn")}), "conversations", "chat", ["chat", "conversations"], {
            "title": F.col("role"), "body": F.col("text"), "updated_at": F.lit("yesterday"), "author": F.col("role")}),
    ]
    built = corpus.build_corpus(sources, "2024-06-30", ["r", "k", "title"])
    return built.select("doc_id", "title", F.md5("body").alias("body_md5"), "source", F.array_join("tags", "|").alias("tags"), "updated_at", "author")


ROW_TABLES = {"customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey", "supplier": "s_suppkey"}


@job("rows_to_docs", " UNION ALL ".join(
    f"SELECT '{t}_' || (row_number() OVER (ORDER BY {k}) - 1) AS id, '{t}' AS source, CAST(to_json(t) AS VARCHAR) AS content, row_number() OVER (ORDER BY {k}) - 1 AS row_id FROM {t} t"
    for t, k in ROW_TABLES.items()
))
def rows_to_docs(spark, sf_dir):
    parts = [corpus.rows_to_documents(table(spark, sf_dir, t), t, [k]) for t, k in ROW_TABLES.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("id", "source", "content", "metadata.row_id")


@job("graph_quality", """
    WITH nodes AS (SELECT 'r' || r_regionkey AS id FROM region UNION ALL SELECT 'n' || n_nationkey FROM nation UNION ALL SELECT 's' || s_suppkey FROM supplier
      UNION ALL SELECT 'd' || doc_id FROM documents),
    edges AS (SELECT 'n' || n_nationkey AS src, 'r' || n_regionkey AS dst FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
      UNION ALL SELECT 'd' || doc_id, 'q' || quality FROM labels),
    linked AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
    c AS (SELECT (SELECT count(*) FROM nodes) AS e, (SELECT count(*) FROM edges) AS r, (SELECT count(*) FROM nodes WHERE id NOT IN (SELECT id FROM linked)) AS o)
    SELECT e AS entity_count, r AS relation_count, o AS orphan_count, round((e - o)::DOUBLE / e, 9) AS extraction_accuracy FROM c
""")
def graph_quality(spark, sf_dir):
    region, nation, supplier, documents, labels = tables(spark, sf_dir, "region", "nation", "supplier", "documents", "labels")
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    nodes = region.select(name("r", "r_regionkey").alias("id")).union(nation.select(name("n", "n_nationkey"))).union(
        supplier.select(name("s", "s_suppkey"))).union(documents.select(name("d", "doc_id")))
    edges = nation.select(name("n", "n_nationkey").alias("src"), name("r", "n_regionkey").alias("dst")).union(
        supplier.select(name("s", "s_suppkey"), name("n", "s_nationkey"))).union(labels.select(name("d", "doc_id"), name("q", "quality")))
    return corpus.graph_quality(nodes, edges).withColumn("extraction_accuracy", F.round("extraction_accuracy", 9))


@job("text_vectors")
def text_vectors(spark, sf_dir):
    """Hashed TF-IDF vectors of all documents with their length."""
    vectors = vector_search.hashed_vectors(table(spark, sf_dir, "documents"), "doc_id", "text")
    from tidemill.functions.vectors import norm

    return vectors.select("doc_id", F.round(norm(F.col("embedding")), 4).alias("length"), F.size("embedding").alias("dims"))
