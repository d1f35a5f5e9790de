"""Incremental table sync with a stored mark, and persisted retries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.buckets import BucketedTable, not_there
from tidemill.operators.columns import keyset_page
from tidemill.session import fresh_dir, literal_row, remove_dir

MARK_ROWS = "last_sync string, last_key string, row_count bigint"


@dataclass(frozen=True)
class Mark:
    """How far a copy has come: greatest ``(updated_at, key)`` and the rows read so far."""

    last_sync: str
    last_key: str
    row_count: int


@dataclass
class TableSync:
    """Keeps a copy of a source table, stored by hash of its key.

    The first run copies everything, later runs only rows above the mark
    ``(updated_at, key)``. A batch is stored once, merged, and then its mark is
    written: a crash in between repeats the batch, which changes nothing. New
    source columns are added, deleted rows keep their ``deleted_at`` and stay readable.
    """

    spark: SparkSession
    path: str
    key: str
    updated_at: str
    buckets: int | None = None

    @property
    def table(self) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.path}/table", [self.key], self.buckets)

    def mark(self) -> Mark | None:
        try:
            marks = self.spark.read.schema(MARK_ROWS).json(f"{self.path}/marks")
        except AnalysisException as error:
            if not_there(error):
                return None
            raise
        last = marks.agg(F.max_by(F.struct(*marks.columns), "row_count")).first()[0]
        return Mark(**last.asDict()) if last is not None else None

    def pending(self, source: DataFrame, mark: Mark | None) -> DataFrame:
        """Source rows above the mark; the filter reaches the source."""
        if mark is None:
            return source
        types = dict(source.dtypes)
        at, last = F.lit(mark.last_sync).cast(types[self.updated_at]), F.lit(mark.last_key).cast(types[self.key])
        updated = F.col(self.updated_at)
        return source.filter((updated >= at) & ((updated > at) | (F.col(self.key) > last)))

    def _advance(self, batch: DataFrame, mark: Mark | None) -> tuple[Mark | None, int]:
        edge = batch.agg(F.max(F.struct(self.updated_at, self.key)).alias("m"), F.count(F.lit(1)).alias("n")).select(
            F.col(f"m.{self.updated_at}").cast("string"), F.col(f"m.{self.key}").cast("string"), "n"
        ).first()
        if edge[2] == 0:
            return mark, 0
        return Mark(edge[0], edge[1], (mark.row_count if mark else 0) + edge[2]), edge[2]

    def run_once(self, source: DataFrame, page_size: int | None = None) -> int:
        """Bring the copy up to date and return the number of rows taken.

        Without ``page_size`` all pending rows go in one batch, which is what
        scales; with it, pages are taken in key order until one comes up short.
        """
        taken, mark = 0, self.mark()
        while True:
            batch, whole = self.pending(source, mark), page_size is None or mark is None
            if not whole:
                batch = keyset_page(batch, self.updated_at, self.key, page_size)
            landing = fresh_dir(self.spark, "landing")
            batch.write.parquet(landing)  # the mark is taken from the rows that are merged
            stored = self.spark.read.schema(batch.schema).parquet(landing)
            mark, count = self._advance(stored, mark)
            self.table.upsert(stored, [self.updated_at])
            if count:
                literal_row(self.spark, (mark.last_sync, mark.last_key, mark.row_count), MARK_ROWS).write.mode("append").json(f"{self.path}/marks")
            remove_dir(self.spark, landing)
            taken += count
            if whole or count < page_size:
                return taken

    def active(self, deleted_at: str = "deleted_at") -> DataFrame:
        """Rows that are not soft-deleted."""
        rows = self.table.read()
        return rows.filter(F.col(deleted_at).isNull()) if deleted_at in rows.columns else rows


# Retry delays double from two seconds up to a minute; the fourth failure is final.
BACKOFF_BASE, BACKOFF_CAP, MAX_ATTEMPTS = 2.0, 60.0, 4


def backoff_seconds(attempt: Column) -> Column:
    return F.least(F.lit(BACKOFF_CAP), F.lit(BACKOFF_BASE) * F.pow(F.lit(2.0), attempt - 1))


def schedule_retries(failures: DataFrame, attempt: str, failed_at: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Add ``outcome`` (``retry`` or ``dead_letter``), ``next_attempt`` and ``next_attempt_at``."""
    final = F.col(attempt) >= max_attempts
    delay = backoff_seconds(F.col(attempt).cast("double"))
    return failures.withColumns({
        "outcome": F.when(final, "dead_letter").otherwise("retry"),
        "delay_seconds": F.when(~final, delay),
        "next_attempt": F.when(~final, F.col(attempt) + 1),
        "next_attempt_at": F.when(~final, F.col(failed_at) + F.make_dt_interval(secs=delay.cast("decimal(18,6)"))),
    })


def due(retries: DataFrame, as_of: str) -> DataFrame:
    """Scheduled rows whose time has come; they join the next batch."""
    return retries.filter((F.col("outcome") == "retry") & (F.col("next_attempt_at") <= F.lit(as_of).cast("timestamp_ntz")))
