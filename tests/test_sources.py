from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators import columns
from tidemill.sources import dispatch, files, metric_results, paged, synthetic, tables
from tidemill.sources.paged import paged_api


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text("id,name,day\n1,x,2024-01-02\n2,,2024-01-03\n")
    (tmp_path / "b.csv").write_text("id,name,day\n3,z,2024-01-04\n")
    (tmp_path / "c.ndjson").write_text('{"id": 1, "tags": ["a"]}\n{"id": 2}\n')
    (tmp_path / "d.json").write_text('[{"id": 1}, {"id": 2}, {"id": 3}]')
    return tmp_path


def test_csv_as_strings_and_typed(spark, folder):
    assert {t for _, t in files.csv_strings(spark, str(folder / "a.csv")).dtypes} == {"string"}
    assert dict(files.csv_typed(spark, str(folder / "a.csv")).dtypes) == {"id": "int", "name": "string", "day": "date"}
    declared = files.csv_typed(spark, str(folder / "a.csv"), "id bigint, name string, day string")
    assert dict(declared.dtypes)["id"] == "bigint"


def test_bad_lines_become_rejects(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,name\n1,x\nnope,y\n3,z\n")
    good, rejects = files.csv_tolerant(spark, str(tmp_path / "bad.csv"), StructType.fromDDL("id int, name string"))
    assert good.count() == 2 and [r[files.CORRUPT] for r in rejects.collect()] == ["nope,y"]


def test_all_files_of_a_folder(spark, folder):
    assert files.folder(spark, str(folder), ".csv", files.csv_typed).count() == 3


def test_register_file(spark, folder):
    seen = files.register_file(spark, str(folder / "d.json"))
    assert (seen["table"], seen["rows"], seen["columns"], len(seen["preview"])) == ("d", 3, ["id"], 3)
    assert files.load_file(spark, str(folder / "c.ndjson")).count() == 2
    assert files.view_name("/x/my-file 1.csv") == "my_file_1"
    with pytest.raises(ValueError):
        files.load_file(spark, "x.xlsx")
    files.register_file(spark, str(folder / "a.csv"))
    assert spark.sql("SELECT count(*) FROM a WHERE name IS NOT NULL").first()[0] == 1


def test_parquet_glob_and_depth(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x/y/1"))
    spark.range(2).write.parquet(str(tmp_path / "x/y/2"))
    assert files.parquet(spark, str(tmp_path / "x"), recursive=True).count() == 5
    assert files.parquet(spark, str(tmp_path / "x/y/*")).count() == 5


def test_avro_needs_its_package(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.avro(spark, str(tmp_path))


def test_pages_with_next_links(spark, tmp_path):
    for i, follow in [(1, True), (2, True), (3, False)]:
        page = {"data": [{"id": i * 10 + j, "email": f"{i}{j}@x"} for j in range(2)]}
        page["next"] = str(tmp_path / f"p{i + 1}.json") if follow else None
        (tmp_path / f"p{i}.json").write_text(json.dumps(page))
    df = paged_api(spark, str(tmp_path / "p1.json"), "id int, email string", paginate="true")
    assert sorted(r["id"] for r in df.collect()) == [10, 11, 20, 21, 30, 31]
    numbered = paged_api(spark, str(tmp_path / "p{page}.json"), "id int", pages="2")
    assert numbered.count() == 4
    single = paged_api(spark, str(tmp_path / "p1.json"), "id int")
    assert single.count() == 2


def test_single_object_and_bare_list_pages(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"data": {"id": 1, "extra": {"a": 1}}}')
    (tmp_path / "l.json").write_text('[{"id": 1.5}, {"id": null}]')
    assert paged_api(spark, str(tmp_path / "o.json"), "id int, extra string").first()["extra"] == '{"a":1}'
    assert [r["id"] for r in paged_api(spark, str(tmp_path / "l.json"), "id double").collect()] == [1.5, None]


def test_typed_and_malformed_pages(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"data": [{"at": "2024-01-02T03:04:05", "n": 2}], "next": "t.json"}')
    row = paged_api(spark, str(tmp_path / "t.json"), "at timestamp_ntz, n double").first()
    assert (str(row["at"]), row["n"]) == ("2024-01-02 03:04:05", 2.0)
    for name, text in {"scalar": "7", "text": '{"data": "x"}', "type": '[{"n": "many"}]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
        with pytest.raises(Exception):
            paged_api(spark, str(tmp_path / f"{name}.json"), "n int").collect()
    (tmp_path / "round.json").write_text(json.dumps({"data": [], "next": str(tmp_path / "round.json")}))
    with pytest.raises(Exception, match="circle"):
        paged_api(spark, str(tmp_path / "round.json"), "n int", paginate="true").collect()


def test_page_addresses():
    assert paged.with_params("http://h/x", {"a": "b c", "limit": 5}) == "http://h/x?a=b+c&limit=5"
    assert paged.with_params("http://h/x?y=1", {"a": 2}) == "http://h/x?y=1&a=2" and paged.with_params("f.json", {}) == "f.json"
    assert paged.next_page("http://h/a/1", '{"next": "2"}') == "http://h/a/2" and paged.next_page("http://h/a", "[]") is None
    with pytest.raises(ValueError):
        paged.next_page("http://h/a", '{"next": "file:///etc/x"}')


def test_webhook_row(spark):
    row = dispatch.read_source(spark, "webhook_event", {"payload": {"event_type": "a", "data": {"n": 1}}, "received_at": "2024-01-01T00:00:00Z"}).first()
    assert row["data"]["n"] == 1 and row["received_at"] == "2024-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        dispatch.read_source(spark, "webhook_event", {"payload": "text", "received_at": ""})
    with pytest.raises(ValueError):
        dispatch.read_source(spark, "fax", {})


def test_normalise(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "bad")], "emitted_at string, created_at string")
    out = dispatch.normalise(df, "rest_api", "src", "2024-02-01 00:00:00")
    row = out.first()
    assert row["emitted_at"] is not None and row["created_at"] is None and row["source_name"] == "src"


def test_metric_results(spark):
    vector = {"status": "success", "data": {"resultType": "vector", "result": [{"metric": {"stage": "a"}, "value": [1700000000, "1.5"]}]}}
    matrix = {"status": "success", "data": {"resultType": "matrix", "result": [{"metric": {"stage": "b"}, "values": [[1, "2"], [2, "3"]]}]}}
    df = spark.createDataFrame([(json.dumps(vector),), (json.dumps(matrix),)], "payload string")
    got = sorted((r["metric"]["stage"], r["timestamp"], r["value"]) for r in metric_results.result_rows(df).collect())
    assert got == [("a", 1700000000.0, 1.5), ("b", 1.0, 2.0), ("b", 2.0, 3.0)]
    for bad in ({"status": "error"}, {"status": "success", "data": {"resultType": "scalar", "result": [{"metric": {}}]}}):
        with pytest.raises(Exception, match="query failed|unsupported"):
            metric_results.result_rows(spark.createDataFrame([(json.dumps(bad),)], "payload string")).collect()


def test_generated_orders(spark):
    a = synthetic.orders(spark, 2000, 7, "2024-01-01 00:00:00")
    assert a.exceptAll(synthetic.orders(spark, 2000, 7, "2024-01-01 00:00:00")).count() == 0
    distinct = a.select("order_id").distinct().count()
    assert 1850 < distinct < 1990
    assert a.filter("quantity < 1 OR unit_price <= 0").count() == 0
    # A repeated id is the same order.
    assert a.distinct().count() == distinct
    burst = synthetic.orders(spark, 50, 7, "2024-01-01 00:00:00", spread_seconds=0)
    assert burst.select("order_timestamp").distinct().count() == 1
    assert synthetic.stream_events(spark, 100, 1, "2024-01-01 00:00:00").select("event_type").distinct().count() == 4
    assert synthetic.sales(spark, 10, 1, "2024-01-01 00:00:00").filter("total_amount <> round(quantity * unit_price, 2)").count() == 0
    bad = synthetic.users(spark, 1000, 1, "2024-01-01 00:00:00").filter(~F.col("email").contains("@")).count()
    assert 10 < bad < 120


def test_snapshot_and_catalogue(spark, tmp_path):
    frames = {"a": spark.range(3), "b": spark.createDataFrame([("x", 1.0)], "s string, d double")}
    written = tables.snapshot_tables(frames, str(tmp_path / "snap"))
    assert spark.read.parquet(written["a"]).count() == 3
    assert [r[:3] for r in tables.catalogue(frames)] == [("a", "id", "bigint"), ("b", "s", "string"), ("b", "d", "double")]
    frames["b"].createOrReplaceTempView("snap_b")
    assert "snap_b" in tables.registered_tables(spark, ["snap_b"])


def test_high_water_mark(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00")], "id int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    mark = tables.high_water_mark(df.filter("id = 1"), "t")
    assert [r["id"] for r in tables.since(df, "t", mark).collect()] == [2] and tables.since(df, "t", None).count() == 2


def test_alias_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "cust_id int, CustomerID int, email int")
    out = columns.rename_by_alias(df, {"customer_id": ("customer_id", "cust_id", "CustomerID"), "email": ("email", "mail")})
    assert out.columns == ["customer_id", "CustomerID", "email"]


def test_steps_reject_unknown_kinds(spark):
    assert columns.transform_columns(spark.range(5), "id > 1", ["id * 2 AS x"], ["x"], True).first()["x"] == 8
    with pytest.raises(ValueError):
        columns.apply_steps(spark.range(1), [{"op": "eval", "code": "1"}])


def test_dense_row_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = columns.dense_row_ids(df, ["k"]).filter("row_id <> k + 1")
    assert got.count() == 0


def test_optional_bounds(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,)], "p double")
    assert df.filter(columns.bounded(F.col("p"), 0)).count() == 2
    assert df.filter(columns.bounded(F.col("p"))).count() == 3
