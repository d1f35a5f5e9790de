"""Joins, unions, sorts, pages and row-level work."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions.payloads import json_field
from tidemill.functions.times import on_day
from tidemill.functions.values import money_sum
from tidemill.operators import aggregates, columns, joins, versions
from tidemill.operators.buckets import BucketedTable
from tidemill.plans.catalog import job, table, tables
from tidemill.session import fresh_dir


@job("star_enrich", """
    SELECT n_name AS country, p_brand AS brand, count(*) AS order_count,
           CAST(sum(CAST(l_quantity * p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2
""")
def star_enrich(spark, sf_dir):
    lineitem, part, supplier, nation = tables(spark, sf_dir, "lineitem", "part", "supplier", "nation")
    rows = joins.star_join(lineitem, [
        (part.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey"),
        (supplier.withColumnsRenamed({"s_suppkey": "l_suppkey", "s_nationkey": "n_nationkey"}), "l_suppkey"),
        (nation, "n_nationkey"),
    ])
    return rows.groupBy(F.col("n_name").alias("country"), F.col("p_brand").alias("brand")).agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum(F.col("l_quantity") * F.col("p_retailprice")).alias("total_amount"),
    )


def _document_lookups(spark, sf_dir):
    documents, labels, embeddings = tables(spark, sf_dir, "documents", "labels", "embeddings")
    return joins.enrich(documents.select("doc_id", "lang", "n_chars"), {
        "labels": (labels.select("doc_id", "quality", "toxic"), "doc_id"),
        "vectors": (embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id"),
    })


@job("enrich_complete", """
    SELECT d.doc_id, lang, n_chars, quality, toxic, label FROM documents d
    JOIN labels USING (doc_id) JOIN embeddings e ON e.vec_id = d.doc_id
""")
def enrich_complete(spark, sf_dir):
    return joins.split_enriched(_document_lookups(spark, sf_dir))[0]


@job("enrich_rejects", """
    SELECT d.doc_id, concat_ws('|', CASE WHEN l.doc_id IS NULL THEN 'labels' END, CASE WHEN e.vec_id IS NULL THEN 'vectors' END) AS missing
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN embeddings e ON e.vec_id = d.doc_id
    WHERE l.doc_id IS NULL OR e.vec_id IS NULL
""")
def enrich_rejects(spark, sf_dir):
    rejects = joins.split_enriched(_document_lookups(spark, sf_dir))[1]
    return rejects.select("doc_id", F.array_join("missing", "|").alias("missing"))


@job("join_inner", """
    SELECT s.s_suppkey AS key, s.s_acctbal AS acctbal, c.c_acctbal AS acctbal_right
    FROM supplier s JOIN customer c ON s.s_suppkey = c.c_custkey
""")
def join_inner(spark, sf_dir):
    return joins.join_datasets(*_accounts(spark, sf_dir), on=["key"], how="inner")


@job("join_left", """
    SELECT c.c_custkey AS key, c.c_acctbal AS acctbal, s.s_acctbal AS acctbal_right
    FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey
""")
def join_left(spark, sf_dir):
    suppliers, customers = _accounts(spark, sf_dir)
    return joins.join_datasets(customers, suppliers, on=["key"], how="left")


@job("join_full", """
    SELECT coalesce(l.doc_id, e.vec_id) AS key, l.quality AS value, e.label AS value_right
    FROM labels l FULL JOIN embeddings e ON l.doc_id = e.vec_id
""")
def join_full(spark, sf_dir):
    labels, embeddings = tables(spark, sf_dir, "labels", "embeddings")
    return joins.join_datasets(
        labels.select(F.col("doc_id").alias("key"), F.col("quality").alias("value")),
        embeddings.select(F.col("vec_id").alias("key"), F.col("label").alias("value")), on=["key"], how="outer",
    )


def _accounts(spark, sf_dir):
    supplier, customer = tables(spark, sf_dir, "supplier", "customer")
    return (supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("acctbal")),
            customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("acctbal")))


@job("join_left_grouped", """
    SELECT c_mktsegment AS segment, count(o_orderkey) AS orders,
           coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS spent
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1 ORDER BY spent DESC
""")
def join_left_grouped(spark, sf_dir):
    customer, orders = tables(spark, sf_dir, "customer", "orders")
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s")
    )
    return customer.join(per_customer, "c_custkey", "left").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orders"), F.coalesce(F.sum("s").cast("double"), F.lit(0.0)).alias("spent")
    ).orderBy(F.desc("spent"))


@job("candidate_semi", """
    SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
""")
def candidate_semi(spark, sf_dir):
    documents, labels = tables(spark, sf_dir, "documents", "labels")
    return joins.restrict_to(documents.select("doc_id", "lang", "source"), labels.filter("quality = 1"), "doc_id")


@job("insert_absent", """
    SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def insert_absent(spark, sf_dir):
    documents, labels = tables(spark, sf_dir, "documents", "labels")
    return versions.new_rows(labels.select("doc_id"), documents.select("doc_id", "lang", "n_chars"), ["doc_id"], ["n_chars"])


@job("upsert_latest", """
    WITH ship AS (SELECT l_orderkey AS k, max(l_shipdate) AS v, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT k AS order_id, status, updated_at, lines FROM (
      SELECT *, row_number() OVER (PARTITION BY k ORDER BY updated_at DESC, seq DESC) AS rn FROM (
        SELECT o_orderkey AS k, o_orderstatus AS status, o_orderdate AS updated_at, CAST(NULL AS BIGINT) AS lines, 0 AS seq FROM orders
        UNION ALL SELECT k, 'SHIPPED', v, n, 1 FROM ship)) WHERE rn = 1
""")
def upsert_latest(spark, sf_dir):
    """The first load is written, the batch merged into the buckets of its keys."""
    target, batch = _order_states(spark, sf_dir)
    stored = BucketedTable(spark, fresh_dir(spark, "orders"), ["order_id"])
    for rows in (target, batch):
        stored.upsert(rows, ["updated_at"])
    return stored.read()


def _order_states(spark, sf_dir):
    """Orders as first seen, and their later state once shipped (with a new column)."""
    orders, lineitem = tables(spark, sf_dir, "orders", "lineitem")
    target = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("updated_at"))
    batch = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.max("l_shipdate").alias("updated_at"), F.count(F.lit(1)).alias("lines")
    ).withColumn("status", F.lit("SHIPPED"))
    return target, batch


@job("update_back", """
    SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN d.source END, e.label_name) AS origin
    FROM documents d LEFT JOIN labels l USING (doc_id)
    LEFT JOIN (SELECT vec_id, 'label-' || label AS label_name FROM embeddings) e ON e.vec_id = d.doc_id
""")
def update_back(spark, sf_dir):
    documents, labels, embeddings = tables(spark, sf_dir, "documents", "labels", "embeddings")
    trusted = documents.select("doc_id", "source").join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        "doc_id", F.when(F.col("quality") == 1, F.col("source")).alias("origin")
    )
    updates = embeddings.select(F.col("vec_id").alias("doc_id"), F.concat(F.lit("label-"), F.col("label").cast("string")).alias("label_name"))
    return joins.update_back(trusted, updates, "doc_id", {"origin": "label_name"})


@job("metrics_by_day", """
    SELECT m.day, rows_processed, orders, revenue FROM
      (SELECT strftime(ts, '%m-%d') AS day, count(*) AS rows_processed FROM events GROUP BY 1) m JOIN
      (SELECT strftime(o_orderdate, '%m-%d') AS day, count(*) AS orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1) f ON m.day = f.day
""")
def metrics_by_day(spark, sf_dir):
    events, orders = tables(spark, sf_dir, "events", "orders")
    # The two tables share no year, so calendar days are matched.
    year = F.lit("2000")
    same = lambda c: F.concat(year, F.date_format(c, "-MM-dd")).cast("date")
    out = joins.join_by_day(
        events.withColumn("d", same("ts")), orders.withColumn("d", same("o_orderdate")), "d", "d",
        [F.count(F.lit(1)).alias("rows_processed")],
        [F.count(F.lit(1)).alias("orders"), money_sum(F.col("o_totalprice")).alias("revenue")],
    )
    return out.withColumn("day", F.substring("day", 6, 5))


@job("agg_dict", """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity_sum, min(l_discount) AS l_discount_min,
           max(l_tax) AS l_tax_max, count(l_orderkey) AS l_orderkey_count, avg(l_quantity) AS l_quantity_mean
    FROM lineitem GROUP BY 1, 2
""")
def agg_dict(spark, sf_dir):
    return aggregates.aggregate_by(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "l_quantity": ["sum", "mean"], "l_discount": ["min"], "l_tax": ["max"], "l_orderkey": ["count"],
    })


@job("global_totals", """
    SELECT count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           max(o_orderdate) AS latest, count(DISTINCT o_custkey) AS customers FROM orders
""")
def global_totals(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("orders"), money_sum(F.col("o_totalprice")).alias("revenue"),
        F.max("o_orderdate").alias("latest"), F.countDistinct("o_custkey").alias("customers"),
    )


@job("facets", """
    SELECT source AS value, count(*) AS doc_count FROM documents WHERE source IS NOT NULL GROUP BY 1
    ORDER BY doc_count DESC, value LIMIT 100
""")
def facets(spark, sf_dir):
    return aggregates.facet_counts(table(spark, sf_dir, "documents"), "source")


@job("facets_lang", """
    SELECT lang AS value, count(*) AS doc_count FROM documents WHERE lang IS NOT NULL GROUP BY 1
    ORDER BY doc_count DESC, value LIMIT 100
""")
def facets_lang(spark, sf_dir):
    return aggregates.facet_counts(table(spark, sf_dir, "documents"), "lang")


@job("argmax_customer_order", """
    SELECT o_custkey, o_orderkey AS best_order, o_totalprice AS best_price, o_orderpriority AS best_priority, statuses FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS rn FROM orders)
    JOIN (SELECT o_custkey, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY 1)
    USING (o_custkey) WHERE rn = 1
""")
def argmax_customer_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderkey", "o_totalprice", "o_orderpriority"), F.struct("o_totalprice", "o_orderkey")).alias("b"),
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), "|").alias("statuses"),
    ).select("o_custkey", F.col("b.o_orderkey").alias("best_order"), F.col("b.o_totalprice").alias("best_price"),
             F.col("b.o_orderpriority").alias("best_priority"), "statuses")


@job("price_rank_depth", """
    SELECT o_custkey, count(DISTINCT o_totalprice) AS max_rank FROM orders GROUP BY 1
""")
def price_rank_depth(spark, sf_dir):
    # The greatest dense rank of a group is its number of distinct values; no window is needed.
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.countDistinct("o_totalprice").alias("max_rank"))


@job("dense_ranks", """
    SELECT c_nationkey AS nation, c_custkey AS customer, CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS INTEGER) AS rank
    FROM customer
""")
def dense_ranks(spark, sf_dir):
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"))
    ranked = table(spark, sf_dir, "customer").withColumn("rank", F.dense_rank().over(w))
    return ranked.select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("customer"), "rank")


@job("top_customers", """
    SELECT o_custkey AS customer, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders
    WHERE o_orderstatus <> 'F' GROUP BY 1 ORDER BY spent DESC, customer LIMIT 100
""")
def top_customers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "F")
    return orders.groupBy(F.col("o_custkey").alias("customer")).agg(money_sum(F.col("o_totalprice")).alias("spent")).orderBy(
        F.desc("spent"), "customer"
    ).limit(100)


@job("latest_rows", "SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def latest_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value").orderBy(
        F.desc("ts"), F.desc("event_id")
    ).limit(5)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@job("priority_sort", """
    SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders
    ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
             WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 ELSE 5 END, o_orderdate DESC, o_orderkey
""")
def priority_sort(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate").orderBy(
        columns.priority_order(F.col("o_orderpriority"), PRIORITIES), F.desc("o_orderdate"), "o_orderkey"
    )


@job("keyset_page", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > TIMESTAMP '1997-06-15' OR (o_orderdate = TIMESTAMP '1997-06-15' AND o_orderkey > 0)
    ORDER BY o_orderdate, o_orderkey LIMIT 1000
""")
def keyset_page(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return columns.keyset_page(orders, "o_orderdate", "o_orderkey", 1000, ("1997-06-15 00:00:00", 0))


@job("union_sources", """
    SELECT 'orders' AS source, o_orderstatus AS kind, o_orderdate AS at FROM orders
    UNION ALL SELECT 'events', event_type, ts FROM events
""")
def union_sources(spark, sf_dir):
    orders, events = tables(spark, sf_dir, "orders", "events")
    return orders.select(F.lit("orders").alias("source"), F.col("o_orderstatus").alias("kind"), F.col("o_orderdate").alias("at")).union(
        events.select(F.lit("events").alias("source"), F.col("event_type").alias("kind"), F.col("ts").alias("at"))
    )


@job("diagonal_union", """
    SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, CAST(s_acctbal AS DOUBLE) AS amount, NULL AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer
    UNION ALL SELECT p_partkey, p_name, p_size, NULL FROM part
""")
def diagonal_union(spark, sf_dir):
    supplier, customer, part = tables(spark, sf_dir, "supplier", "customer", "part")
    return joins.union_diagonal(
        supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount")),
        customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("amount")),
    )


@job("self_append", """
    WITH base AS (SELECT event_id, user_id, event_type, ts, value FROM events), copy AS (
      SELECT event_id, user_id + 1000 AS user_id, 'new_event' AS event_type, ts + INTERVAL 1 HOUR AS ts, CAST(50 AS DOUBLE) AS value
      FROM (SELECT * FROM base WHERE event_type = 'purchase' ORDER BY event_id LIMIT 100))
    SELECT event_type, count(*) AS n, min(user_id) AS min_user, max(ts) AS last_ts FROM (SELECT * FROM base UNION ALL SELECT * FROM copy) GROUP BY 1
""")
def self_append(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    grown = joins.append_copies(
        events, {"user_id": "user_id + 1000", "event_type": "'new_event'", "ts": "ts + INTERVAL 1 HOUR", "value": "50.0D"},
        ["event_id"], 100, "event_type = 'purchase'",
    )
    return grown.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("user_id").alias("min_user"), F.max("ts").alias("last_ts")
    )


@job("clean_rows", """
    SELECT doc_id, lang, quality, label FROM (
      SELECT d.doc_id, CASE WHEN d.lang = 'es' THEN ' ' ELSE d.lang END AS lang, l.quality, e.label
      FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = d.doc_id)
    WHERE quality IS NOT NULL AND label IS NOT NULL AND lang IS NOT NULL AND trim(lang) <> ''
""")
def clean_rows(spark, sf_dir):
    documents, labels, embeddings = tables(spark, sf_dir, "documents", "labels", "embeddings")
    messy = documents.select("doc_id", F.when(F.col("lang") == "es", " ").otherwise(F.col("lang")).alias("lang")).join(
        labels.select("doc_id", "quality"), "doc_id", "left"
    ).join(embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "left")
    return columns.drop_incomplete(messy)


@job("row_ids", """
    SELECT doc_id, lang, row_number() OVER (ORDER BY lang, n_chars DESC, doc_id) AS row_id FROM documents
""")
def row_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return columns.dense_row_ids(rows, ["lang", F.desc("n_chars"), "doc_id"]).drop("n_chars")


@job("peak_value", "SELECT event_id, event_type, ts, value FROM events WHERE value = (SELECT max(value) FROM events)")
def peak_value(spark, sf_dir):
    from tidemill.operators.rates import peak_rows

    return peak_rows(table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value"), "value")


@job("ordered_distinct", "SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1")
def ordered_distinct(spark, sf_dir):
    return aggregates.first_seen_order(table(spark, sf_dir, "part"), "p_name", "p_partkey")


@job("optional_filters", """
    SELECT p_partkey, p_name, p_type, p_retailprice FROM part
    WHERE p_type = 'ECONOMY' AND p_retailprice >= 0 AND p_retailprice <= 1000 AND p_size > 0
""")
def optional_filters(spark, sf_dir):
    where = columns.all_of(
        F.col("p_type") == "ECONOMY", columns.bounded(F.col("p_retailprice"), 0, 1000), F.col("p_size") > 0, None
    )
    return table(spark, sf_dir, "part").filter(where).select("p_partkey", "p_name", "p_type", "p_retailprice")


@job("day_rows", """
    SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1
""")
def day_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(on_day(F.col("ts"), "2024-01-15")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@job("expression_steps", """
    SELECT seg, count(*) AS n, max(bal) AS top FROM (SELECT c_mktsegment AS seg, round(c_acctbal) AS bal FROM customer WHERE c_acctbal > 0)
    GROUP BY seg
""")
def expression_steps(spark, sf_dir):
    return columns.apply_steps(table(spark, sf_dir, "customer"), [
        {"op": "filter", "expr": "c_acctbal > 0"},
        {"op": "derive", "columns": {"bal": "round(c_acctbal)"}},
        {"op": "rename", "columns": {"c_mktsegment": "seg"}},
        {"op": "aggregate", "by": ["seg"], "exprs": ["count(*) AS n", "max(bal) AS top"]},
    ])


@job("adhoc_sql", """
    SELECT n_name, count(*) AS customers, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END)::BIGINT AS in_debt
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def adhoc_sql(spark, sf_dir):
    for name in ("customer", "nation"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"adhoc_{name}")
    return spark.sql("""
        SELECT n_name, count(*) AS customers, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS in_debt
        FROM adhoc_customer JOIN adhoc_nation ON c_nationkey = n_nationkey GROUP BY n_name
    """)


@job("json_fields", """
    SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1
""")
def json_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(json_field(F.col("props"), "$.k", "bigint").alias("k")).agg(F.count(F.lit(1)).alias("n"))
