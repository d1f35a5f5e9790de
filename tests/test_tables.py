from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import buckets, joins, registry, sinks, versions
from tidemill.plans import storage
from tidemill.session import fresh_dir
from tidemill.streaming.sync import TableSync, due, schedule_retries

DDL = "k int, v string, t int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def test_versions(spark):
    table = versions.VersionedTable(spark, fresh_dir(spark, "t"))
    assert not table.exists() and table.current_version() == 0
    table.replace(frame(spark, (1, "a", 1)), "d1")
    table.append(frame(spark, (2, "b", 1)), "d2")
    table.upsert(frame(spark, (1, "c", 2), (1, "b", 0)), ["k"], ["t"], "d3")
    table.insert_absent(frame(spark, (2, "x", 9), (3, "y", 9), (3, "z", 1)), ["k"], ["t"], "d4")
    assert [sorted(tuple(r) for r in table.read(v).collect()) for v in (1, 2, 3, 4)] == [
        [(1, "a", 1)], [(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (2, "b", 1)], [(1, "c", 2), (2, "b", 1), (3, "z", 1)]]
    assert [r["operation"] for r in table.history().collect()] == ["replace", "append", "upsert", "insert_absent"]
    table.clear("d5")
    assert table.read().count() == 0 and table.read(4).count() == 3
    with pytest.raises(ValueError):
        table.read(99)


def test_batch_id_is_applied_once(spark):
    table = versions.VersionedTable(spark, fresh_dir(spark, "t"))
    for _ in range(2):
        table.append(frame(spark, (1, "a", 1)), "d", "batch-1")
    assert table.read().count() == 1 and table.current_version() == 1


def test_drift_adds_nullable_columns(spark):
    table = versions.VersionedTable(spark, fresh_dir(spark, "t"))
    table.replace(frame(spark, (1, "a", 1)), "d")
    table.append(spark.createDataFrame([(5.0, 2, 3, "b")], "extra double, t int, k int, v string"), "d")
    assert table.read().columns == ["k", "v", "t", "extra"]
    assert sorted(table.read().collect())[1]["v"] == "b"
    table.upsert(spark.createDataFrame([(1, 7, True)], "k int, t int, flag boolean"), ["k"], ["t"], "d")
    row = table.read().filter("k = 1").first()
    assert row["flag"] is True and row["v"] is None


def test_two_writers_cannot_commit_one_version(spark):
    table = versions.VersionedTable(spark, fresh_dir(spark, "t"))
    table.replace(frame(spark, (1, "a", 1)), "d")
    with pytest.raises(Exception):
        table._commit("replace", [], frame(spark).schema, "d", None, None, None)


def stored_files(table):
    return set(table.read().inputFiles())


def test_a_key_touches_one_bucket(spark):
    table = buckets.BucketedTable(spark, fresh_dir(spark, "b"), ["k"], 8)
    with pytest.raises(ValueError):
        table.read()
    assert table.upsert(frame(spark), ["t"]) == 0 and not table.exists()
    assert table.upsert(frame(spark, *[(i, "a", 1) for i in range(200)], (7, "b", 2)), ["t"]) == 8
    before = stored_files(table)
    assert len(before) == 8 and table.read().count() == 200
    assert table.upsert(frame(spark, (7, "old", 0), (7, "new", 3)), ["t"]) == 1
    assert len(before & stored_files(table)) == 7 and len(stored_files(table)) == 8
    assert table.read().filter("k = 7").first()["v"] == "new" and table.read().count() == 200
    before = stored_files(table)
    table.insert_absent(frame(spark, (7, "x", 9), (500, "y", 9), (500, "z", 1), (None, "n", 1)), ["t"])
    assert before <= stored_files(table) and len(stored_files(table)) <= 10
    table.insert_absent(frame(spark, (500, "w", 0)), ["t"])
    assert [tuple(r) for r in table.read().filter("k = 500").collect()] == [(500, "z", 1)] and table.read().count() == 202
    before = stored_files(table)
    assert table.replace_keys(frame(spark, (500, "p", 1), (500, "q", 1))) == 1
    assert sorted(r["v"] for r in table.read().filter("k = 500").collect()) == ["p", "q"] and table.read().count() == 203


def test_the_first_load_decides_the_number_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 1000)
    path = fresh_dir(spark, "b")
    assert buckets.BucketedTable(spark, path, ["k"]).upsert(frame(spark), ["t"]) == 0  # nothing yet
    touched = buckets.BucketedTable(spark, path, ["k"]).upsert(frame(spark, *[(i, "a", 1) for i in range(300)]), ["t"])
    assert 5 <= touched <= 12  # some 24 bytes a row
    again = buckets.BucketedTable(spark, path, ["k"])
    again.insert_absent(frame(spark, *[(i, "b", 1) for i in range(1000)]), ["t"])
    assert again.buckets == touched and again.read().count() == 1000 and again.read().where("v = 'a'").count() == 300
    assert buckets.BucketedTable(spark, path, ["k"]).upsert(frame(spark, (7, "new", 3)), ["t"]) == 1


def test_a_bucket_shows_new_columns(spark):
    table = buckets.BucketedTable(spark, fresh_dir(spark, "b"), ["k"], 4)
    table.upsert(frame(spark, *[(i, "a", 1) for i in range(9)]), ["t"])
    table.upsert(frame(spark).withColumn("extra", F.lit(1)), ["t"])
    assert table.read().columns == ["k", "v", "t", "extra"] and table.read().count() == 9
    table.upsert(spark.createDataFrame([(1, 7, 2.5)], "k int, t int, more double"), ["t"])
    row = table.read().filter("k = 1").first()
    assert (row["v"], row["t"], row["extra"], row["more"]) == (None, 7, None, 2.5)


rows_of = st.lists(st.tuples(st.integers(0, 4), st.sampled_from("abc"), st.integers(0, 3)), max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_of, rows_of)
def test_upsert_is_idempotent(spark, target, batch):
    # One row per key and version, as a batch from a keyed source has.
    t = frame(spark, *{(k, s): (k, v, s) for k, v, s in target}.values())
    b = frame(spark, *{(k, s): (k, v, s) for k, v, s in batch}.values())
    once = versions.upserted(versions.latest_per_key(t, ["k"], ["t"]), b, ["k"], ["t"])
    twice = versions.upserted(once, b, ["k"], ["t"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_types():
    schema = versions.declared_schema([("a", "numeric"), ("b", "timestamp with time zone"), ("c", "inet")])
    assert [f.dataType.simpleString() for f in schema] == ["decimal(18,4)", "timestamp", "string"]


def source(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, plan string, updated_at string, deleted_at string").withColumn(
        "updated_at", F.col("updated_at").cast("timestamp_ntz"))


@pytest.mark.parametrize("page_size", [None, 2])
def test_sync_in_steps(spark, page_size):
    sync = TableSync(spark, fresh_dir(spark, "s"), "id", "updated_at")
    first = [(1, "free", "2024-01-01", None), (2, "pro", "2024-01-02", None), (3, "pro", "2024-01-02", None)]
    assert sync.run_once(source(spark, *first), page_size) == 3
    assert sync.mark().row_count == 3
    assert sync.run_once(source(spark, *first), page_size) == 0  # nothing new
    # Ties at the page edge, an update, inserts and a soft delete.
    later = [(1, "team", "2024-01-03", None), (2, "pro", "2024-01-03", "2024-01-03"), (3, "pro", "2024-01-02", None),
             (4, "free", "2024-01-03", None), (5, "free", "2024-01-03", None), (6, "free", "2024-01-03", None)]
    assert sync.run_once(source(spark, *later), page_size) == 5
    assert sorted((r["id"], r["plan"]) for r in sync.table.read().collect()) == [(1, "team"), (2, "pro"), (3, "pro"), (4, "free"), (5, "free"), (6, "free")]
    assert sorted(r["id"] for r in sync.active().collect()) == [1, 3, 4, 5, 6]
    assert sync.mark().row_count == 8


def test_sync_adds_a_column_without_new_rows(spark):
    sync = TableSync(spark, fresh_dir(spark, "s"), "id", "updated_at")
    df = source(spark, (1, "free", "2024-01-01", None))
    sync.run_once(df)
    sync.run_once(df.withColumn("seats", F.lit(3)))
    assert "seats" in sync.table.read().columns and sync.table.read().count() == 1


def test_retry_schedule(spark):
    failures = spark.createDataFrame([(i, i) for i in (1, 2, 3, 4)], "id int, attempt int").withColumn(
        "failed_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    out = schedule_retries(failures, "attempt", "failed_at")
    assert [(r["outcome"], r["delay_seconds"]) for r in out.orderBy("id").collect()] == [
        ("retry", 2.0), ("retry", 4.0), ("retry", 8.0), ("dead_letter", None)]
    assert due(out, "2024-01-01 00:00:04").count() == 2


def test_registry(spark):
    book = registry.RunRegistry(spark, fresh_dir(spark, "r"))
    a, b = spark.createDataFrame([], "x int"), spark.createDataFrame([], "x int, y int")
    assert [book.schema_version("s", d, "t") for d in (a, b, a)] == [1, 2, 1]
    assert book.schema_version("other", b, "t") == 1
    book.record_success("s", "csv", "run-1", 5, 1, "2024-01-01 00:00:00")
    book.record_failure("s", "csv", "run-2", 1, "boom", {"a": 1}, "2024-01-03 00:00:00")
    book.record_success("s", "csv", "run-2", 7, 2, "2024-01-03 00:01:00", attempt=2)
    state = registry.health(book.runs(), book.failures(), "2024-01-03 12:00:00").first()
    assert (state["total_runs"], state["sources"], state["failures"], state["runs_last_day"]) == (2, 1, 1, 1)
    assert registry.latest_runs(book.runs()).first()["row_count"] == 7


def test_known_schemas_keep_their_version(spark):
    known = spark.createDataFrame([("s", 1, "h1"), ("s", 2, "h2")], "source_name string, version int, schema_hash string")
    seen = spark.createDataFrame([("s", "h1", 0), ("s", "h4", 2), ("s", "h3", 1), ("t", "h1", 0)], "source_name string, schema_hash string, seen_order int")
    got = {(r["source_name"], r["schema_hash"]): r["version"] for r in registry.register_schemas(known, seen).collect()}
    assert got == {("s", "h3"): 3, ("s", "h4"): 4, ("t", "h1"): 1}


def test_access():
    registry.check_access("sales.orders", [])
    registry.check_access("finance.ledger", ["finance"])
    with pytest.raises(PermissionError):
        registry.check_access("Finance.ledger", ["ops"])


def test_lineage(spark):
    table = versions.VersionedTable(spark, fresh_dir(spark, "l"))
    item = registry.Artifact("/x", "parquet", ({"name": "a", "dtype": "int"},), 3, ("/in",))
    registry.log_lineage(table, item, "sql", "me", "2024-01-01")
    assert table.read().first()["inputs"] == ["/in"]


def test_ingest_job(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,amount\n1,2.5\n2,3.5\n")
    root = fresh_dir(spark, "ingest")
    book = registry.RunRegistry(spark, f"{root}/registry")
    task = {"source_name": "finance", "source_type": "csv_file", "options": {"path": str(tmp_path / "f.csv")}, "run_id": "r1"}
    for _ in range(2):  # the same run again replaces its own output
        assert storage.ingest_job(spark, book, task, root, "2024-02-01 00:00:00").count() == 2
    assert spark.read.parquet(f"{root}/processed").filter("source_name = 'finance'").count() == 2
    assert storage.ingest_job(spark, book, {**task, "options": {"path": "/nowhere"}, "run_id": "r2"}, root, "2024-02-01 00:00:00") is None
    assert book.failures().count() == 1 and book.runs().count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, [])], "id int, tags array<string>")
    sinks.write_csv(df, str(tmp_path / "csv"), ["tags"])
    assert sorted(r["tags"] or "" for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()) == ["", "a|b"]
    sinks.write_ndjson(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    sinks.load_rows(df, str(tmp_path / "load"))
    sinks.load_rows(df, str(tmp_path / "load"))
    assert spark.read.parquet(str(tmp_path / "load")).count() == 4
    sinks.load_rows(df, str(tmp_path / "load"), "replace")
    assert spark.read.parquet(str(tmp_path / "load")).count() == 2
    summary = sinks.write_with_summary(df, str(tmp_path / "out"), str(tmp_path / "sum"), "2024-01-01", {"top": F.max("id")})
    assert (summary["row_count"], summary["top"]) == (2, 2) and spark.read.json(str(tmp_path / "sum")).first()["row_count"] == 2
    sinks.replace_table(df, "sink_table")
    assert spark.table("sink_table").count() == 2
    assert registry.folder_size(spark, str(tmp_path / "out")).first()["files"] >= 1


def test_metric_lines_and_logs(spark, tmp_path):
    df = spark.createDataFrame([("m", 1.5, {"b": "2", "a": "1"}, 7)], "n string, v double, l map<string,string>, t bigint")
    lines = sinks.metric_lines(df, F.col("n"), F.col("v"), F.col("l"), F.col("t"))
    assert lines.first()[0] == 'm{a="1",b="2"} 1.5 7'
    sinks.write_lines(lines, str(tmp_path / "m"))
    sinks.log_rows(spark, [("done", "2024-01-01", "INFO", "load", 3, 0.5)], str(tmp_path / "log"))
    assert json.loads(spark.read.text(str(tmp_path / "log")).first()[0])["stage"] == "load"


def test_join_tool(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert joins.join_datasets(a, b, ["k"], "outer").count() == 3
    assert joins.join_datasets(a, b, ["k"], "inner").columns == ["k", "v", "v_right"]
    assert joins.join_datasets(a, b, ["k"], "cross").columns == ["k", "v", "k_right", "v_right"]
    with pytest.raises(ValueError):
        joins.join_datasets(a, spark.range(20), how="cross", cross_limit=10)
    with pytest.raises(ValueError):
        joins.join_datasets(a, b, ["k"], "sideways")


def test_transform_and_load(spark):
    spark.range(4).createOrReplaceTempView("numbers4")
    table = versions.VersionedTable(spark, fresh_dir(spark, "tl"))
    versions.transform_and_load(spark, "SELECT id FROM numbers4", lambda d: d.filter("id > 1"), table, "d")
    assert table.read().count() == 2
    assert joins.concat_batches([table.read(), table.read()]).count() == 4


def test_union_keeps_exact_types(spark):
    def one(kind):
        return spark.range(1).select(F.lit("2024-01-02" if kind in ("date", "timestamp_ntz") else "1").cast(kind).alias("x"))

    for kinds, want in {("decimal(10,2)", "decimal(12,4)"): "decimal(12,4)", ("decimal(10,2)", "int"): "decimal(12,2)", ("date", "timestamp_ntz"): "timestamp_ntz",
                        ("int", "double"): "double", ("int", "smallint"): "bigint", ("int", "string"): "string", ("decimal(38,0)", "decimal(38,38)"): "string"}.items():
        assert dict(joins.union_diagonal(*map(one, kinds)).dtypes)["x"] == want, kinds


def test_cross_without_limit_is_the_callers_choice(spark):
    assert joins.join_datasets(spark.range(3), spark.range(20), how="cross", cross_limit=None).count() == 60
