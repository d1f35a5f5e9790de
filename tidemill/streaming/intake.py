"""Event intake as micro-batches with exactly-once output folders.

Every batch writes to a folder named after its batch id and replaces it when the
batch runs again, so a restart adds no rows. Offsets and state live in the
checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from tidemill.functions.payloads import json_or_raw

# Rows are flushed every two seconds, duplicates are looked for within an hour.
FLUSH_INTERVAL = "2 seconds"
DEDUP_WINDOW = "1 hour"
DEDUP_SECONDS = 3600
#: Lateness under which no row of stored files is late.
REPLAY = "36500 days"
#: Cells of time, as long as the dedup window, that are ordered together.
BLOCK_CELLS = 1024


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_batch: int = 100,
                pattern: str | None = None) -> DataFrame:
    """Files landing in a folder; ``files_per_batch`` bounds the intake of one batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, rows_per_batch: int = 100_000) -> DataFrame:
    """Topic values as text; needs the Kafka package on the classpath."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("maxOffsetsPerTrigger", rows_per_batch).load()
    )
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string").alias("payload"), "timestamp")


def start(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append",
          continuous: bool = False) -> StreamingQuery:
    """Run batches through ``write``: until the input is used up, or forever every two seconds."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=FLUSH_INTERVAL) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def drain(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process all input that is there now and stop."""
    start(stream, checkpoint, write, mode).awaitTermination()


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def normalise_events(df: DataFrame, event_type: str = "event_type", payload: str = "payload") -> DataFrame:
    """Default type ``unknown``; payloads that are no JSON become ``{"raw": …}``."""
    return df.withColumns({
        event_type: F.coalesce(F.when(F.trim(event_type) != "", F.col(event_type)), F.lit("unknown")),
        payload: json_or_raw(F.col(payload)),
    })


def thin_duplicates(df: DataFrame, key: str, ts: str, seconds: int = DEDUP_SECONDS) -> DataFrame:
    """Drop repeats inside each Arrow batch, before any shuffle.

    A key that fills a third of the stream then reaches its state partition with
    one row per Arrow batch. Repeats farther apart than the window stay.
    """

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ordered = batch.sort_values(ts, kind="stable")
            first = ordered.groupby(key, dropna=False)[ts].transform("first")
            age = (ordered[ts] - first).dt.total_seconds()
            repeat = ordered.duplicated(key) & (age <= seconds) & ordered[key].notna()
            yield ordered[~repeat]

    return df.mapInPandas(thin, df.schema)


def dedup(stream: DataFrame, key: str, ts: str, window: str = DEDUP_WINDOW, seconds: int = DEDUP_SECONDS) -> DataFrame:
    """One row per key; state expires when the watermark is ``window`` past a key's row.

    Rows that arrive later than ``window`` behind the newest are dropped by the engine. Give ``REPLAY`` where stored files
    may come in any order of time: no row is late then, and the state holds every key.
    """
    return thin_duplicates(stream, key, ts, seconds).withWatermark(ts, window).dropDuplicatesWithinWatermark([key])


def route(path: str, error: Column, key: str, payload: str, good_columns: Sequence[str], as_of: str) -> Callable[[DataFrame, int], None]:
    """Writer that splits a batch: rows without ``error`` to ``events``, the rest to ``dead_letters``."""
    from tidemill.operators.sinks import dead_letters

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("_error", error)
        good = tagged.filter(F.col("_error").isNull()).select(*good_columns)
        good.write.mode("overwrite").parquet(batch_folder(f"{path}/events", batch_id))
        bad = dead_letters(tagged.filter(F.col("_error").isNotNull()), key, F.col(payload), F.col("_error"), as_of)
        bad.write.mode("overwrite").parquet(batch_folder(f"{path}/dead_letters", batch_id))

    return write


def _cells(times: DataFrame, key: str, micros: int) -> DataFrame:
    """``key, _cell, _start`` of each cell that has times: the first time of the chain that its times belong to.

    A chain is cut where nothing follows within the window, which two neighbouring cells show. The start
    is looked up among the cells of a block, and beyond it among the blocks of the key.
    """
    cells = times.groupBy(key, "_cell").agg(F.min("_t").alias("_low"), F.max("_t").alias("_high"))
    before = cells.select(key, (F.col("_cell") + 1).alias("_cell"), F.col("_high").alias("_before"))
    alone = F.col("_before").isNull() | (F.col("_low") - F.col("_before") > micros)
    heads = cells.join(before, [key, "_cell"], "left").select(
        key, "_cell", F.floor(F.col("_cell") / BLOCK_CELLS).alias("_block"), F.when(alone, F.col("_low")).alias("_head"))
    inside = Window.partitionBy(key, "_block").orderBy("_cell")
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = heads.groupBy(key, "_block").agg(F.max("_head").alias("_last")).select(key, "_block", F.max("_last").over(earlier).alias("_carried"))
    return heads.withColumn("_own", F.max("_head").over(inside)).join(blocks, [key, "_block"]).select(
        key, "_cell", F.coalesce("_own", "_carried").alias("_start"))


def _accept(micros: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of sorted chains, the times farther than the window from the last one accepted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = 0
        for batch in batches:
            t, start = (batch.column(k).to_numpy() for k in (1, 2))
            keep = t == start  # the first of a chain
            ends = np.append(np.flatnonzero(keep), len(t))
            if ends[0]:
                ends = np.append(0, ends)
            for i, end in zip(ends[:-1], ends[1:], strict=True):
                if keep[i]:
                    last, i = t[i], i + 1
                while i < end:
                    i += np.searchsorted(t[i:end], last + micros, side="right")
                    if i < end:
                        keep[i], last = True, t[i]
                        i += 1
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


def ingest_unique(path: str, key: str, ts: str, seconds: int = DEDUP_SECONDS) -> Callable[[DataFrame, int], None]:
    """Writer that keeps rows whose key has no accepted row within ``seconds`` before or after, with statistics per batch.

    A key's rows are taken by time: each is accepted unless an accepted one, of this batch or an earlier, is within the
    window. Rows of one key and time collapse by a partial aggregation first. Accepted keys of earlier batches come
    from their folders, pruned by event time. Rows without key or time are no duplicates of anything and stay.

    Only keys and times are put in order. Time is cut into cells, so wide that all times of a cell are within the
    window of each other; earlier accepted rows meet times of their own and the neighbouring cells. The times left are cut
    into chains by gaps above the window. A task streams through its chains and holds one accepted time; chains of
    one key are spread over tasks, and a single chain without a gap is read by one task.
    """
    micros = seconds * 1_000_000

    def cell(t: str) -> Column:
        return F.expr(f"({t} - pmod({t}, {micros + 1}L)) div {micros + 1}L")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        others = [c for c in batch.columns if c not in (key, ts)]
        known = F.col(key).isNotNull() & F.col(ts).isNotNull()
        rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("_none"))
        at = F.unix_micros(F.col(ts).cast("timestamp")).alias("_t")
        times = batch.filter(known).select(key, at).distinct().withColumn("_cell", cell("_t"))
        accepted = f"{path}/accepted"
        if batch_id > 0:
            span = batch.filter(known).agg(F.min(ts), F.max(ts)).first()
            earlier = spark.read.schema(batch.schema.add("batch_id", IntegerType())).parquet(accepted).filter(
                (F.col("batch_id") < batch_id) & F.col(key).isNotNull())
            if span[0] is not None:
                reach = F.expr(f"INTERVAL {seconds} SECONDS")
                earlier = earlier.filter((F.col(ts) >= F.lit(span[0]) - reach) & (F.col(ts) <= F.lit(span[1]) + reach))
            met = earlier.filter(F.col(ts).isNotNull()).select(key, at).withColumn("_own", cell("_t")).withColumn(
                "_cell", F.explode(F.array(*[F.col("_own") + d for d in (-1, 0, 1)])))
            seen = met.groupBy(key, "_cell").agg(
                F.max(F.when(F.col("_own") <= F.col("_cell"), F.col("_t"))).alias("_below"),
                F.min(F.when(F.col("_own") >= F.col("_cell"), F.col("_t"))).alias("_above"))
            # one of the same cell is near in any case, and then is the greatest below or the least above
            far = lambda c: F.coalesce(F.abs(F.col("_t") - F.col(c)) > micros, F.lit(True))
            times = times.join(seen, [key, "_cell"], "left").filter(far("_below") & far("_above")).select(key, "_t", "_cell")
        left = f"{path}/times/batch_id={batch_id}"
        times.write.mode("overwrite").parquet(left)
        times = spark.read.schema(times.schema).parquet(left)
        chains = times.join(_cells(times, key, micros), [key, "_cell"]).select(key, "_t", "_start")
        fresh_times = chains.repartition(key, "_start").sortWithinPartitions(key, "_start", "_t").mapInArrow(
            _accept(micros), chains.select(key, "_t").schema).withColumn("_new", F.lit(True))
        each = batch.filter(known).groupBy(key, ts).agg(F.min_by(rest, F.xxhash64(*(others or [key]))).alias("_o"), F.count(F.lit(1)).alias("_copies"))
        tagged = each.withColumn("_t", at).join(fresh_times, [key, "_t"], "left").select(
            key, ts, *[F.col(f"_o.{c}").alias(c) for c in others], "_copies", F.coalesce("_new", F.lit(False)).alias("_new"))
        tagged = tagged.unionByName(batch.filter(~known).select("*", F.lit(1).cast("long").alias("_copies"), F.lit(True).alias("_new")))
        staged = f"{path}/tagged/batch_id={batch_id}"
        tagged.write.mode("overwrite").parquet(staged)
        stored = spark.read.parquet(staged)
        stored.filter("_new").drop("_new", "_copies").write.mode("overwrite").parquet(batch_folder(accepted, batch_id))
        fresh = F.sum(F.when(F.col("_new"), 1).otherwise(0))
        stored.agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("total"), F.coalesce(fresh, F.lit(0)).cast("bigint").alias("new"),
        ).select("total", "new", (F.col("total") - F.col("new")).alias("duplicates"), F.col("new").alias("queued")).write.mode(
            "overwrite"
        ).parquet(batch_folder(f"{path}/stats", batch_id))

    return write


def windowed_counts(stream: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str | None = None, lateness: str | None = "10 minutes",
                    aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """Counts (and further aggregates) per event-time window; old windows leave the state with the watermark.

    Rows later than ``lateness`` are dropped by the engine. ``None`` sets no watermark: no row is lost, and the state holds all
    windows, which suits the replay of stored files.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    columns = [F.count(F.lit(1)).alias("n")] + [c.alias(name) for name, c in (aggs or {}).items()]
    timed = stream.withWatermark(ts, lateness) if lateness else stream
    grouped = timed.groupBy(window.alias("w"), *keys).agg(*columns)
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", *(aggs or {}))


def current_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every row that update-mode batches wrote below ``path``."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_r"))
    return newest.select(*keys, "_r.*")


def enrich_stream(stream: DataFrame, lookups: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Stream–static left joins; ``missing`` names the lookups without a match."""
    from tidemill.operators.joins import enrich

    return enrich(stream, lookups)
