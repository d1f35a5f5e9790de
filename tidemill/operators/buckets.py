"""Stored tables as plain Parquet folders, partitioned by a hash of the key: a batch reads and writes only the buckets of its keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.versions import added_columns, latest_per_key, new_rows
from tidemill.session import ensure_checkpoint_dir

BUCKET, PART = "_bucket", "_part"
#: Size of a bucket's rows as JSON text, some 100 MB of Parquet, that the first load is cut into.
BUCKET_BYTES = 512 << 20


def not_there(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class BucketedTable:
    """Rows with one bucket folder for each hash of ``key``.

    Without ``buckets`` their number comes from the bytes of the first batch and is kept beside the rows; choose it yourself where the table
    is to grow far beyond its first load, so that one bucket fits a task.

    A batch that is repeated after a crash ends in the same rows: an upsert keeps the newest row of a key, and
    an insert leaves out the keys that are there. New columns are null in older rows. One writer at a time.

    ``part`` names an expression over a row, such as its day, that cuts each bucket further; a table with it takes inserts
    only, and ``read`` can be restricted to some parts.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int | None = None, part: Column | None = None):
        self.spark, self.path, self.key, self.buckets, self.part = spark, path.rstrip("/"), list(key), buckets, part

    def _number(self, batch: DataFrame) -> int:
        """Number of buckets: given, stored, or taken from the size of this first batch (an action) and stored."""
        if self.buckets is None:
            kept = self.spark.read.schema("buckets int")
            try:
                self.buckets = kept.json(f"{self.path}/_buckets").agg(F.max("buckets")).first()[0]
            except AnalysisException as error:
                if not not_there(error):
                    raise
        if self.buckets is None:
            size = batch.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
            if not size:
                return 1  # nothing to place yet
            self.buckets = -(-size // BUCKET_BYTES)
            self.spark.range(0, 1, 1, 1).select(F.lit(self.buckets).cast("int").alias("buckets")).write.mode("overwrite").json(f"{self.path}/_buckets")
        return self.buckets

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(self.path)
        except AnalysisException as error:
            if not_there(error):
                return None
            raise

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self, parts: Sequence[str] | None = None, like: DataFrame | None = None) -> DataFrame:
        """All rows, or those of some parts; of a table without rows the empty frame ``like``."""
        stored = self._stored()
        if stored is None:
            if like is None:
                raise ValueError(f"{self.path} has no rows yet")
            return like.limit(0)
        if parts is not None:
            stored = stored.filter(F.col(PART).cast("string").isin(list(parts)))
        return stored.drop(BUCKET, PART)

    def _placed(self, df: DataFrame) -> DataFrame:
        placed = df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self._number(df))).cast("int"))
        return placed if self.part is None else placed.withColumn(PART, self.part.cast("string"))

    def _touched(self, placed: DataFrame) -> list[int]:
        """Bucket numbers of a batch, as many as there are buckets at most. An action."""
        return [r[0] for r in placed.select(BUCKET).distinct().collect()]

    def _write(self, placed: DataFrame, mode: str) -> None:
        by = [BUCKET] if self.part is None else [BUCKET, PART]
        # Dynamic: an overwrite replaces the folders that get rows and leaves all others alone.
        # Rebalanced: a bucket that is too large for a task is written by several, small ones share a task.
        placed.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(self.path)

    def upsert(self, batch: DataFrame, order: Sequence[str]) -> int:
        """Merge a batch by name: newest per key wins, the batch on equal order. Gives the number of rewritten buckets.

        The batch is read twice; store it first if its source may change meanwhile.
        """
        if self.part is not None:
            raise ValueError("a table with parts takes inserts only")
        placed, stored = self._placed(batch), self._stored()
        touched = self._touched(placed)
        if stored is None:
            if touched:
                self._write(latest_per_key(placed, self.key, order), "overwrite")
            return len(touched)
        if not touched:
            if not added_columns(stored.schema, placed.schema):
                return 0
            touched = [stored.select(F.min(BUCKET)).first()[0]]  # a bucket that shows the new columns
        both = stored.filter(F.col(BUCKET).isin(touched)).withColumn("_seq", F.lit(0)).unionByName(
            latest_per_key(placed, self.key, order).withColumn("_seq", F.lit(1)), allowMissingColumns=True)
        # Already placed by bucket, the rows of a key need no further shuffle, and each bucket becomes one file.
        merged = latest_per_key(both.repartition(BUCKET), [BUCKET, *self.key], [*order, "_seq"]).drop("_seq")
        self._write(merged, "overwrite")
        return len(touched)

    def insert_absent(self, batch: DataFrame, order: Sequence[str]) -> None:
        """Add the rows whose key is not there yet, first per key in ``order``; only the buckets of the batch are searched."""
        placed, stored = self._placed(batch), self._stored()
        if stored is None:
            fresh = new_rows(placed.limit(0), placed, self.key, order)
        else:
            fresh = new_rows(stored.filter(F.col(BUCKET).isin(self._touched(placed))), placed, self.key, order)
        self._write(fresh, "append")

    def replace_keys(self, rows: DataFrame) -> int:
        """Put ``rows`` in the place of all rows that have one of their keys. Gives the number of rewritten buckets.

        The rows are checkpointed first: their buckets, their keys and the new files are all made from them.
        """
        ensure_checkpoint_dir(self.spark)
        rows = rows.checkpoint()
        placed, stored = self._placed(rows), self._stored()
        touched = self._touched(placed)
        if stored is not None and touched:
            kept = stored.filter(F.col(BUCKET).isin(touched)).join(placed.select(*self.key).distinct(), self.key, "left_anti")
            placed = kept.unionByName(placed, allowMissingColumns=True)
        if touched:
            self._write(placed, "overwrite")
        return len(touched)
