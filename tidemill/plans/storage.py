"""Stored tables: versions, sync, schema registry, file ETL and ingest runs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.payloads import schema_columns, schema_fingerprint
from tidemill.operators import columns, registry, sinks, versions
from tidemill.plans.catalog import TABLES, every_table, job, table, tables
from tidemill.session import fresh_dir, literal_row, no_rows
from tidemill.sources import dispatch, files
from tidemill.sources.tables import catalogue_frame
from tidemill.streaming.sync import TableSync, due, schedule_retries


@job("snapshots", """
    SELECT CAST(1 AS BIGINT) AS version, count(*) AS rows, count(DISTINCT event_type) AS types FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 2, count(*), count(DISTINCT event_type) FROM events
    UNION ALL SELECT 3, count(*), count(DISTINCT event_type) FROM events WHERE event_type <> 'click'
""")
def snapshots(spark, sf_dir):
    """Three versions of one table (create, append, replace), each read back as of its version."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    stored = versions.VersionedTable(spark, fresh_dir(spark, "snapshots"))
    stored.replace(events.filter("event_type <> 'error'"), "2024-02-01")
    stored.append(events.filter("event_type = 'error'"), "2024-02-02")
    stored.replace(events.filter("event_type <> 'click'"), "2024-02-03")
    out = None
    for version in (1, 2, 3):
        part = stored.read(version).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_type").alias("types"))
        part = part.select(F.lit(version).cast("bigint").alias("version"), "rows", "types")
        out = part if out is None else out.unionByName(part)
    return out


@job("incremental_sync", """
    WITH ship AS (SELECT l_orderkey AS k, max(l_shipdate) AS v, count(*) AS n FROM lineitem GROUP BY 1),
    changes AS (SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderdate AS updated_at, CAST(NULL AS BIGINT) AS lines FROM orders
      UNION ALL SELECT k, 'SHIPPED', v, n FROM ship WHERE {'v': v, 'k': k} > (SELECT max({'v': o_orderdate, 'k': o_orderkey}) FROM orders))
    SELECT order_id, status, updated_at, lines FROM changes QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1
""")
def incremental_sync(spark, sf_dir):
    """Bootstrap with the orders, then one increment with later shipments and a new column."""
    orders, lineitem = tables(spark, sf_dir, "orders", "lineitem")
    initial = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("updated_at"))
    shipped = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.max("l_shipdate").alias("updated_at"), F.count(F.lit(1)).alias("lines")
    ).withColumn("status", F.lit("SHIPPED"))
    sync = TableSync(spark, fresh_dir(spark, "sync"), "order_id", "updated_at")
    sync.run_once(initial)
    sync.run_once(initial.unionByName(shipped, allowMissingColumns=True))
    return sync.table.read()


@job("schema_registry")
def schema_registry(spark, sf_dir):
    """Fingerprint of every table's schema, registered as a version."""
    frames = every_table(spark, sf_dir)
    seen = spark.createDataFrame(
        [(n, schema_fingerprint(df.schema), len(schema_columns(df.schema)), i) for i, (n, df) in enumerate(frames.items())],
        "source_name string, schema_hash string, columns int, seen_order int",
    )
    known = no_rows(spark, "source_name string, version int, schema_hash string")
    counts = registry.table_stats(frames)
    return registry.register_schemas(known, seen).join(seen.select("source_name", "columns"), "source_name").join(
        counts.withColumnRenamed("table_name", "source_name"), "source_name"
    )


@job("schema_versions", """
    SELECT source_name, schema_hash, CAST(row_number() OVER (PARTITION BY source_name ORDER BY seen_order, schema_hash) AS INTEGER) AS version FROM (
      SELECT source AS source_name, lang AS schema_hash, min(doc_id) AS seen_order FROM documents GROUP BY 1, 2)
""")
def schema_versions(spark, sf_dir):
    """Version numbers in order of first sight; the language of a document plays the fingerprint."""
    seen = table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_name"), F.col("lang").alias("schema_hash"), F.col("doc_id").alias("seen_order")
    )
    known = no_rows(spark, "source_name string, version int, schema_hash string")
    return registry.register_schemas(known, seen)


@job("table_stats", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) > 0 AS populated FROM {t}" for t in TABLES))
def table_stats(spark, sf_dir):
    return registry.table_stats(every_table(spark, sf_dir))


@job("catalogue", f"""
    SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS position FROM information_schema.columns WHERE table_name IN {TABLES}
""")
def catalogue(spark, sf_dir):
    return catalogue_frame(spark, every_table(spark, sf_dir)).drop("data_type")


def file_etl(spark: SparkSession, folder: str, suffix: str, output: str, order_by: list[str], as_of: str, schema: str | None = None) -> DataFrame:
    """Read every file of a folder, drop incomplete rows, number the rest, write Parquet and a summary."""
    rows = files.folder(spark, folder, suffix, lambda s, p: files.csv_typed(s, p, schema))
    clean = columns.drop_incomplete(rows)
    numbered = columns.dense_row_ids(columns.stamp(clean, folder.rstrip("/").rsplit("/", 1)[-1], as_of, "etl_timestamp"), order_by)
    sinks.write_with_summary(numbered, f"{output}/data", f"{output}/summary", as_of)
    return spark.read.parquet(f"{output}/data")


@job("file_etl", """
    SELECT row_number() OVER (ORDER BY s_suppkey) AS row_id, s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal >= 0
""")
def file_etl_job(spark, sf_dir):
    """Suppliers written as CSV files with gaps, then read, cleaned and numbered."""
    supplier = table(spark, sf_dir, "supplier")
    landing = fresh_dir(spark, "landing")
    supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("s_name"), "s_acctbal").write.option("header", True).csv(landing)
    out = file_etl(spark, landing, ".csv", fresh_dir(spark, "etl"), ["s_suppkey"], "2024-01-01", "s_suppkey bigint, s_name string, s_acctbal double")
    return out.select("row_id", "s_suppkey", "s_name", "s_acctbal")


def ingest_job(spark: SparkSession, book: registry.RunRegistry, task: Mapping, output: str, as_of: str) -> DataFrame | None:
    """Run one ingestion task: raw copy, normalised copy, schema version and run record.

    ``task`` has ``source_name``, ``source_type``, ``options``, ``run_id`` and
    ``attempt``. A failure is recorded and gives ``None``; whether it is tried
    again is up to the retry schedule.
    """
    name, kind, run_id = task["source_name"], task["source_type"], task["run_id"]
    day = as_of[:10]
    try:
        raw = dispatch.read_source(spark, kind, task["options"])
        kept = sinks.write_partitioned(raw, f"{output}/raw", name, day, run_id)
        ready = dispatch.normalise(spark.read.parquet(kept), kind, name, as_of)
        done = spark.read.parquet(sinks.write_partitioned(ready.drop("source_name"), f"{output}/processed", name, day, run_id))
        version = book.schema_version(name, ready, as_of)
        book.record_success(name, kind, run_id, done.count(), version, as_of, task.get("attempt", 1))
        return done
    except Exception as error:  # the run registry keeps every kind of failure
        book.record_failure(name, kind, run_id, task.get("attempt", 1), f"{type(error).__name__}: {error}",
                            {k: v for k, v in task.items() if k != "options"}, as_of)
        return None


def ingest_with_retries(spark: SparkSession, book: registry.RunRegistry, tasks: Iterable[Mapping], output: str, as_of: str) -> None:
    """Run tasks; a failed one is stored with the time of its next attempt, or as a dead letter after the last."""
    for task in tasks:
        attempt = task.get("attempt", 1)
        done = ingest_job(spark, book, task, output, as_of) is not None
        if done and attempt == 1:
            continue
        row = (task["run_id"], task["source_name"], task["source_type"], attempt, as_of)
        state = literal_row(spark, row, "run_id string, source_name string, source_type string, attempt int, failed_at timestamp_ntz")
        if done:
            state = state.withColumns({"outcome": F.lit("done"), "next_attempt": F.lit(None).cast("int"), "next_attempt_at": F.lit(None).cast("timestamp_ntz")})
        else:
            state = schedule_retries(state, "attempt", "failed_at")
        book.store_retries(state)


def run_due(spark: SparkSession, book: registry.RunRegistry, options: Mapping[str, Mapping], output: str, as_of: str) -> int:
    """Try all runs again whose time has come, with the options of their source, and give their number.

    Options are not stored with the runs, for they may hold credentials; a source without options waits on.
    """
    rows = due(book.retries(), as_of).orderBy("next_attempt_at", "run_id").collect()  # a run is a driver's task anyway
    tasks = [{"run_id": r["run_id"], "source_name": r["source_name"], "source_type": r["source_type"], "attempt": r["next_attempt"],
              "options": options[r["source_name"]]} for r in rows if r["source_name"] in options]
    ingest_with_retries(spark, book, tasks, output, as_of)
    return len(tasks)


@job("ingest_retries", """
    SELECT 'documents' AS source_name, 1 AS attempt, 'success' AS status, NULL AS outcome, count(*) AS row_count FROM documents
    UNION ALL SELECT 'events', 2, 'success', 'done', count(*) FROM events UNION ALL SELECT 'ledger', 4, 'failed', 'dead_letter', NULL
""")
def ingest_retries(spark, sf_dir):
    """A source that comes back after its first failure, and one that never does."""
    root = fresh_dir(spark, "ingest")
    book = registry.RunRegistry(spark, f"{root}/registry")
    kinds = {"documents": "parquet_file", "events": "parquet_file", "ledger": "fax"}
    options = {"documents": {"path": f"{sf_dir}/documents.parquet"}, "events": {"path": f"{root}/not-there-yet"}, "ledger": {}}
    tasks = [{"source_name": n, "source_type": k, "run_id": f"{n}-1", "options": options[n]} for n, k in kinds.items()]
    ingest_with_retries(spark, book, tasks, root, "2024-02-01 00:00:00")
    options["events"] = {"path": f"{sf_dir}/events.parquet"}
    for second in (1, 2, 6, 14):  # nothing is due after one second
        run_due(spark, book, options, root, f"2024-02-01 00:00:{second:02}")
    outcomes = book.retries().select("run_id", "outcome")
    return book.runs().join(outcomes, "run_id", "left").select("source_name", "attempt", "status", "outcome", "row_count")


@job("ingest_runs", """
    SELECT 'documents' AS source_name, 'success' AS status, count(*) AS row_count, CAST(1 AS INTEGER) AS schema_version FROM documents
    UNION ALL SELECT 'events', 'success', count(*), 1 FROM events UNION ALL SELECT 'ledger', 'failed', NULL, NULL
""")
def ingest_runs(spark, sf_dir):
    """Two sources and one unknown source type, with the run view as the result."""
    root = fresh_dir(spark, "ingest")
    book = registry.RunRegistry(spark, f"{root}/registry")
    for name in ("documents", "events"):
        task = {"source_name": name, "source_type": "parquet_file", "options": {"path": f"{sf_dir}/{name}.parquet"}, "run_id": f"{name}-1"}
        ingest_job(spark, book, task, root, "2024-02-01 00:00:00")
    ingest_job(spark, book, {"source_name": "ledger", "source_type": "fax", "options": {}, "run_id": "ledger-1"}, root, "2024-02-01 00:00:00")
    return registry.latest_runs(book.runs()).select("source_name", "status", "row_count", "schema_version")


@job("rows_per_source", """
    SELECT 'documents' AS source_name, count(*) AS rows FROM documents UNION ALL SELECT 'events', count(*) FROM events ORDER BY rows DESC
""")
def rows_per_source(spark, sf_dir):
    """Row counts over all files below a partitioned landing folder."""
    root = fresh_dir(spark, "processed")
    for name in ("documents", "events"):
        key = "doc_id" if name == "documents" else "event_id"
        sinks.write_partitioned(table(spark, sf_dir, name).select(F.col(key).alias("id")), root, name, "2024-02-01", f"{name}-1")
    return files.parquet(spark, root).groupBy("source_name").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"))
