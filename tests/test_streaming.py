from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemill.functions.payloads import is_json
from tidemill.session import fresh_dir
from tidemill.sources import synthetic
from tidemill.streaming import intake

DDL = "event_id string, event_type string, payload string, ts timestamp"


def drop(spark, folder, *batches):
    """Each batch becomes one landed file, in order."""
    for rows in batches:
        df = spark.createDataFrame(list(rows), "event_id string, event_type string, payload string, ts string")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").json(folder)


def row(i, minute=0, kind="a", payload="{}"):
    return (f"e{i}", kind, payload, f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z")


def stream(spark, folder, per_batch=1):
    return intake.file_stream(spark, folder, DDL, "json", per_batch)


LATE = [[row(1), row(2), row(1)], [row(2, 10), row(3, 20)], [row(1, 5), row(4, 30)]]


@pytest.mark.parametrize("per_batch", [1, 10])
def test_duplicates_across_files(spark, per_batch):
    root = fresh_dir(spark, "s")
    drop(spark, f"{root}/in", *LATE)
    unique = intake.dedup(stream(spark, f"{root}/in", per_batch), "event_id", "ts")
    intake.drain(unique, f"{root}/cp", intake.to_folder(f"{root}/out"))
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{root}/out").collect()) == ["e1", "e2", "e3", "e4"]


def test_hot_key_is_thinned_before_the_shuffle(spark):
    hot = spark.range(3000).select(F.lit("k").alias("key"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"))
    assert intake.thin_duplicates(hot.coalesce(1), "key", "ts").count() == 1
    far = spark.createDataFrame([("k", "2024-01-01 00:00:00"), ("k", "2024-01-01 00:30:00"), ("k", "2024-01-01 02:00:00"), (None, "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00")], "key string, t string")
    kept = intake.thin_duplicates(far.select("key", F.col("t").cast("timestamp").alias("ts")).coalesce(1), "key", "ts")
    assert kept.count() == 4  # the repeat within the hour is gone; rows without key stay


@pytest.mark.parametrize("per_batch", [1, 10])
def test_ingest_statistics(spark, per_batch):
    root = fresh_dir(spark, "s")
    drop(spark, f"{root}/in", *LATE)
    write = intake.ingest_unique(root, "event_id", "ts")
    intake.drain(stream(spark, f"{root}/in", per_batch), f"{root}/cp", write)
    total = spark.read.parquet(f"{root}/stats").agg(F.sum("total"), F.sum("new"), F.sum("duplicates")).first()
    assert tuple(total) == (7, 4, 3)
    # A row that comes back after the window is accepted again.
    drop(spark, f"{root}/in", [row(1, 200)])
    intake.drain(stream(spark, f"{root}/in", per_batch), f"{root}/cp", write)
    assert spark.read.parquet(f"{root}/accepted").filter("event_id = 'e1'").count() == 2


def test_restart_adds_nothing(spark):
    root = fresh_dir(spark, "s")
    drop(spark, f"{root}/in", *LATE)
    for _ in range(2):
        intake.drain(stream(spark, f"{root}/in"), f"{root}/cp", intake.to_folder(f"{root}/out"))
    assert spark.read.parquet(f"{root}/out").count() == 7
    # The same batch written again replaces its folder.
    batch = spark.read.parquet(f"{root}/out").filter("batch_id = 0").drop("batch_id").collect()
    intake.to_folder(f"{root}/out")(spark.createDataFrame(batch, DDL), 0)
    assert spark.read.parquet(f"{root}/out").count() == 7


@pytest.mark.parametrize("per_batch", [1, 10])
def test_windows_equal_batch(spark, per_batch):
    root = fresh_dir(spark, "s")
    drop(spark, f"{root}/in", *LATE)
    counts = intake.windowed_counts(stream(spark, f"{root}/in", per_batch), "ts", ["event_type"], "10 minutes", "5 minutes", "2 hours")
    intake.drain(counts, f"{root}/cp", intake.to_folder(f"{root}/out"), "update")
    got = intake.current_rows(spark, f"{root}/out", ["window_start", "window_end", "event_type"])
    want = spark.read.schema(DDL).json(f"{root}/in").groupBy(F.window("ts", "10 minutes", "5 minutes").alias("w"), "event_type").count()
    shape = lambda df, *c: sorted(tuple(r) for r in df.select(*c).collect())
    assert shape(got, "window_start", "event_type", "n") == shape(want, "w.start", "event_type", "count")


def test_routing_and_normalisation(spark):
    root = fresh_dir(spark, "s")
    drop(spark, f"{root}/in", [row(1, payload='{"a":1}'), row(2, kind=None, payload="oops"), row(3, kind=" ", payload="[1]")])
    events = stream(spark, f"{root}/in")
    error = F.when(~is_json(F.col("payload")), F.lit("bad payload"))
    intake.drain(events, f"{root}/cp", intake.route(root, error, "event_id", "payload", ["event_id", "payload"], "2024-01-02 00:00:00"))
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{root}/events").collect()) == ["e1", "e3"]
    letter = spark.read.parquet(f"{root}/dead_letters").first()
    assert (letter["event_id"], letter["payload"], letter["error_message"], letter["retry_count"]) == ("e2", "oops", "bad payload", 0)
    normal = intake.normalise_events(spark.read.schema(DDL).json(f"{root}/in")).orderBy("event_id").collect()
    assert [(r["event_type"], r["payload"]) for r in normal] == [("a", '{"a":1}'), ("unknown", '{"raw":"oops"}'), ("unknown", "[1]")]


def test_static_lookup(spark):
    root = fresh_dir(spark, "s")
    drop(spark, f"{root}/in", [row(1, kind="a"), row(2, kind="b")])
    lookup = spark.createDataFrame([("a", 1)], "event_type string, zone int")
    out = intake.enrich_stream(stream(spark, f"{root}/in"), {"zone": (lookup, "event_type")})
    intake.drain(out, f"{root}/cp", intake.to_folder(f"{root}/out"))
    assert sorted((r["event_id"], r["missing"]) for r in spark.read.parquet(f"{root}/out").collect()) == [("e1", []), ("e2", ["zone"])]


def test_many_events(spark):
    root = fresh_dir(spark, "s")
    synthetic.stream_events(spark, 500, 3, "2024-01-01 00:00:00").withColumn("ts", F.timestamp_seconds(F.col("timestamp").cast("bigint"))).write.json(f"{root}/in")
    intake.drain(stream(spark, f"{root}/in", 2), f"{root}/cp", intake.to_folder(f"{root}/out"))
    assert spark.read.parquet(f"{root}/out").select("event_id").distinct().count() == 500


def test_rate_stream(spark):
    assert synthetic.rate_stream(spark, 10, 1).isStreaming


@pytest.fixture(scope="module")
def unordered(spark, tmp_path_factory):
    """Events as 400 files in order of key, not of time."""
    folder = str(tmp_path_factory.mktemp("unordered") / "events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartitionByRange(400, "event_id").write.parquet(folder)
    return folder.rsplit("/", 1)[0]


@pytest.mark.parametrize("name", ["dedup_stream", "sliding_counts", "stream_stats", "intake_stats"])
def test_no_row_is_lost_on_many_unordered_files(spark, unordered, name):
    from tidemill.plans import catalog

    catalog.load_all()
    one = catalog.JOBS[name](spark, "/root/testdata/sf0.001")
    many = catalog.JOBS[name](spark, unordered).select(*one.columns)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


@pytest.mark.parametrize("per_batch", [1, 10])
def test_repeats_beyond_the_window_and_rows_without_key_stay(spark, per_batch):
    root = fresh_dir(spark, "s")
    lost = ("x", "a", "{}", None)
    nobody = (None, "a", "{}", "2024-01-01T00:00:00Z")
    drop(spark, f"{root}/in", [row(1, 300), row(1, 0), lost], [row(1, 10), row(1, 310), nobody], [nobody, lost, row(2, 5)])
    intake.drain(stream(spark, f"{root}/in", per_batch), f"{root}/cp", intake.ingest_unique(root, "event_id", "ts"))
    kept = [(r["event_id"], r["ts"] is None) for r in spark.read.parquet(f"{root}/accepted").collect()]
    assert sorted(kept, key=str) == sorted([("e1", False)] * 2 + [("e2", False)] + [("x", True)] * 2 + [(None, False)] * 2, key=str)
    total = spark.read.parquet(f"{root}/stats").agg(F.sum("total"), F.sum("new"), F.sum("duplicates")).first()
    assert tuple(total) == (9, 7, 2)


def test_hot_keys_with_many_times_build_no_lists(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("all times of a key in one row")

    for name in ("collect_list", "collect_set"):
        monkeypatch.setattr(intake.F, name, refuse)
    monkeypatch.setattr(intake, "BLOCK_CELLS", 3)
    rnd, root, w = random.Random(3), fresh_dir(spark, "s"), 3600
    spread = {"dense": 20_000, "chains": 900_000, "far": 9_000_000, "old": 600_000}
    taken, total = {k: [] for k in spread}, 0
    for batch_id in range(3):
        rows = [(k, rnd.randrange(-n, n), "p") for k, n in spread.items() for _ in range(500)]
        rows += [("edge", t + batch_id * 7200, "p") for t in (0, 3600, 3601, 7200)]
        for k, t in sorted({(k, t) for k, t, _ in rows}):
            if all(abs(t - e) > w for e in taken.setdefault(k, [])):
                taken[k].append(t)
        total += len(rows)
        batch = spark.createDataFrame(rows, "k string, s long, p string").select("k", F.timestamp_seconds("s").alias("ts"), "p").repartition(5)
        intake.ingest_unique(root, "k", "ts", w)(batch, batch_id)
    got = spark.read.parquet(f"{root}/accepted").select("k", F.unix_seconds("ts")).collect()
    assert sorted(map(tuple, got)) == sorted((k, t) for k, ts in taken.items() for t in ts)
    stats = spark.read.parquet(f"{root}/stats").agg(F.sum("total"), F.sum("new")).first()
    assert tuple(stats) == (total, len(got))
