from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import aggregates, rates


def series(spark, rows):
    return spark.createDataFrame(rows, "s string, t string, v double").select("s", F.col("t").cast("timestamp_ntz").alias("ts"), "v")


SAMPLES = [("a", "2024-01-01 00:00:00", 10.0), ("a", "2024-01-01 00:01:00", 15.0), ("a", "2024-01-01 00:02:00", 4.0),
           ("a", "2024-01-01 00:07:00", 9.0), ("b", "2024-01-01 00:00:30", 1.0)]


@pytest.mark.parametrize("chunk", ["1 minute", "5 minutes", "1 day"])
def test_counter_with_restart(spark, chunk):
    deltas = rates.counter_deltas(series(spark, SAMPLES), ["s"], "ts", "v", chunk=chunk)
    assert sorted(r["delta"] for r in deltas.collect()) == [4.0, 5.0, 5.0]
    grown = rates.windowed_increase(deltas, ["s"], "ts", "5 minutes").orderBy("window_start").collect()
    assert [(r["s"], r["increase"]) for r in grown] == [("a", 9.0), ("a", 5.0)]
    rate = rates.windowed_rate(deltas, ["s"], "ts", "5 minutes", 300).orderBy("window_start").first()["rate"]
    assert rate == pytest.approx(9 / 300)


def test_single_sample_has_no_increase(spark):
    assert rates.counter_deltas(series(spark, SAMPLES[-1:]), ["s"], "ts", "v").count() == 0


def test_sliding_rate_sums_series(spark):
    rows = [("x", *r) for r in SAMPLES] + [("y", "a", "2024-01-01 00:00:10", 1.0), ("y", "a", "2024-01-01 00:01:10", 4.0)]
    df = spark.createDataFrame(rows, "k string, s string, t string, v double").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    deltas = rates.counter_deltas(df, ["k", "s"], "ts", "v").withColumn("all", F.lit(1))
    got = {str(r["at"])[14:]: r["rate"] for r in rates.sliding_rate(deltas, ["all"], "ts", 5, "1 minute", 60).collect()}
    grown = {1: 5.0 + 3.0, 2: 4.0, 7: 5.0}  # by minute
    want = {f"{at:02}:00": sum(v for m, v in grown.items() if at - 5 <= m < at) / 300 for at in range(2, 13)}
    assert got == {k: pytest.approx(v) for k, v in want.items() if v}


def test_chunks_follow_the_row_count(spark):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    df = spark.range(3000).select(F.lit("a").alias("s"), (start + F.make_dt_interval(secs=(F.col("id") * 4).cast("decimal(18,6)"))).alias("ts"),
                                  (F.col("id") % 7).alias("v"), "id")
    assert [rates.fitting_chunk(df, ["s"], "ts", n) for n in (3000, 900, 15, 14)] == ["1 day", "1 hour", "1 minute", "1 second"]
    cut = rates.fitting_chunk(df, ["s"], "ts", 20)
    one, many = (rates.counter_deltas(df, ["s"], "ts", "v", "id", chunk=c) for c in ("1 day", cut))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty() and one.count() == 2999


def test_latest_and_resample(spark):
    latest = rates.latest_samples(series(spark, SAMPLES), ["s"], "ts", "v")
    assert {r["s"]: r["v"] for r in latest.collect()} == {"a": 9.0, "b": 1.0}
    assert rates.sum_by(latest, [], "v").first()["total"] == 10.0
    steps = rates.resample(series(spark, SAMPLES), ["s"], "ts", "v", "5 minutes")
    assert sorted((r["s"], r["v"]) for r in steps.collect()) == [("a", 4.0), ("a", 9.0), ("b", 1.0)]
    assert [r["s"] for r in rates.peak_rows(latest, "v").collect()] == ["a"]


@pytest.mark.parametrize("bits", [11, 16])
def test_exact_quantiles(spark, monkeypatch, bits):
    monkeypatch.setattr(aggregates, "DIGIT_BITS", bits)  # short digits take several rounds
    rng = random.Random(5)
    rows = [("hot", float(rng.choice([rng.gauss(0, 1), round(rng.gauss(0, 1), 1), 1e300, -1e-300, -0.0, 0.0]))) for _ in range(3000)]
    rows += [("one", 7.0), ("two", 1.0), ("two", 2.0), (None, -5.0), (None, 5.0), ("same", 3.5)] + [("same", 3.5)] * 50
    df = spark.createDataFrame(rows + [("two", None), ("none", None)], "k string, v double")
    wanted = {"least": 0.0, "median": 0.5, "p95": 0.95, "greatest": 1.0, "again": 0.5}
    want = df.where("v IS NOT NULL").groupBy("k").agg(*[F.percentile("v", q).alias(c) for c, q in wanted.items()]).collect()
    got = aggregates.exact_quantiles(df, ["k"], "v", wanted)
    assert got.columns == ["k", *wanted]
    assert {r.k: tuple(r)[1:] for r in got.collect()} == {r.k: pytest.approx(tuple(r)[1:]) for r in want}
    if bits < 16:
        return
    whole = aggregates.exact_quantile(df, [], "v", 0.25, "q")
    assert whole.columns == ["q"] and whole.first()[0] == pytest.approx(df.agg(F.percentile("v", 0.25)).first()[0])
    assert aggregates.exact_quantiles(df.where("k = 'none'"), ["k"], "v", wanted).isEmpty()


def test_ordered_images():
    values = np.array([-np.inf, -1e300, -1.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.5, 1e300, np.inf, np.nan])
    images = aggregates.ordered_image(values)
    assert images[4] == images[5] and (np.diff(np.delete(images, 4)) > 0).all()
    assert np.array_equal(aggregates.from_image(images), values, equal_nan=True)


def test_above_median_is_strict(spark):
    df = spark.createDataFrame([("a", x) for x in (1.0, 1.0, 1.0, 2.0, 2.1)], "k string, v double")
    assert [r["v"] for r in aggregates.above_median(df, ["k"], "v").collect()] == [2.1]


def test_buckets(spark):
    df = spark.createDataFrame([("a", x) for x in (0.05, 0.1, 0.2, 3.0, 100.0)], "k string, v double")
    buckets = aggregates.bucket_counts(df, ["k"], "v")
    counts = {r["le"]: r["count"] for r in buckets.collect()}
    assert counts[0.1] == 2 and counts[0.5] == 3 and counts[5.0] == 4 and counts[60.0] == 4 and counts[float("inf")] == 5
    assert aggregates.bucket_quantile(buckets, ["k"], 0.5).first()["quantile"] == pytest.approx(0.1 + 0.4 * 0.5)
    assert aggregates.bucket_quantile(buckets, ["k"], 0.99).first()["quantile"] == 60.0


def test_aggregate_tool(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 3.0)], "k string, v double")
    out = aggregates.aggregate_by(df, ["k"], {"v": ["sum", "count", "mean"]}).orderBy("k").collect()
    assert tuple(out[0]) == ("a", 1.0, 1, 1.0)
    with pytest.raises(ValueError):
        aggregates.aggregate_by(df, ["k"], {"v": ["median"]})


def test_argmax_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, o int, v string")
    assert aggregates.argmax(df, ["k"], ["v"], ["o"]).first()["v"] is None


def test_label_values_are_escaped(spark):
    from pyspark.sql import functions as F

    from tidemill.operators.sinks import metric_lines

    labels = F.create_map(F.lit("a"), F.lit('x"\\\n'), F.lit("b"), F.lit(None).cast("string"))
    line = metric_lines(spark.range(1), F.lit("m"), F.lit(1), labels, F.lit(2)).first()[0]
    assert line == 'm{a="x\\"\\\\\\n",b=""} 1 2'


def test_values_at_steps_stop_at_the_look_back(spark):
    at = lambda m, s=0: f"2024-01-01 00:{m:02d}:{s:02d}"
    rows = [("a", at(0, 30), 1.0), ("a", at(0, 59), 2.0), ("a", at(2), 3.0), ("a", at(20), 4.0), ("b", at(1, 1), 5.0), ("b", at(1, 1), 6.0),
            ("b", None, 7.0), ("b", at(2), None), (None, at(3), 8.0)]
    df = spark.createDataFrame(rows, "s string, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
    got = {(r.s, r.at.strftime("%M:%S")): r.v for r in rates.values_at_steps(df, ["s"], "t", "v", 60, 180).collect()}
    want = {}
    for s, samples in {"a": [(30, 1.0), (59, 2.0), (120, 3.0), (1200, 4.0)], "b": [(61, 6.0)], None: [(180, 8.0)]}.items():
        for step in range(0, 1800, 60):
            near = [v for t, v in samples if step - 180 < t <= step]
            if near:
                want[(s, f"{step // 60:02d}:00")] = near[-1]
    assert got == want and ("a", "10:00") not in got
    assert rates.values_at_steps(df.limit(0), ["s"], "t", "v", 60, 180).isEmpty()


def test_sliding_buckets(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0, 2), ("a", "2024-01-01 00:01:00", 1.0, 3), ("a", "2024-01-01 00:00:00", 5.0, 4)]
    df = spark.createDataFrame(rows, "k string, start string, le double, count long").withColumn("start", F.col("start").cast("timestamp"))
    got = {(r.at.minute, r.le): r["count"] for r in rates.sliding_buckets(df, ["k"], "start", 2, 60).collect()}
    assert got == {(1, 1.0): 2, (2, 1.0): 5, (3, 1.0): 3, (1, 5.0): 4, (2, 5.0): 4}
