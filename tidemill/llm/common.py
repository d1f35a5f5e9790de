"""Helpers shared by the corpus operators: stored intermediates, Arrow text access, random order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import fresh_dir

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to a new folder below the shared one and read it again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of ``stored`` tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def column_name(df: DataFrame, wanted: str) -> str:
    """A name like ``wanted`` that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bit_filter(rows: DataFrame, place: Column, bits: int) -> np.ndarray:
    """Bits that are set at ``place`` of some row, as words of 32: fixed size, whatever the rows.

    It lets a scan skip most rows that have no partner; more rows than bits only make it skip fewer.
    """
    words = rows.select(place.alias("p")).groupBy(F.shiftright("p", 5).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 32).cast("int"))).alias("b"))
    got = words.toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy().astype(np.uint32)
    return out


def is_set(words: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (words[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1) == 1


ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits spread over all bits, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, as many as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.inverse = np.uint64(pow(int(ODD), -1, 1 << 64))

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) <= n:
            with np.errstate(over="ignore"):
                self.up = np.concatenate([self.up, self.up * (self.up[-1] * ODD)])
                self.down = np.concatenate([self.down, self.down * (self.down[-1] * self.inverse)])
        return self.up, self.down


POWERS = Powers()


class Texts:
    """UTF-8 bytes of some rows of a string column without copies: row ``i`` is ``data[start[i]:end[i]]``; null is empty."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
        n = len(column)
        raw = column.buffers()
        edges = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        first = int(edges[0])
        last = int(edges[-1])
        self.data = np.frombuffer(raw[2], np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
        self.start, self.end = edges[:-1] - first, edges[1:] - first


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = (1 << 21) - 2) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of one piece take about ``limit`` bytes; one text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        t = Texts(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(t.end, t.start[at] + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
