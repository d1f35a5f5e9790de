"""Session factory and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "tidemill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session in UTC with adaptive execution.

    ``shuffle_partitions`` is an upper bound: adaptive execution merges small
    partitions, so on a cluster set it to two to four times the total cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(SETTINGS)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(settings or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    created = tempfile.mkdtemp(prefix="tidemill-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def literal_row(spark: SparkSession, values: Sequence, ddl: str) -> DataFrame:
    """One row of literals in one partition; unlike ``createDataFrame`` it needs no Python worker."""
    columns = []
    for value, field in zip(values, StructType.fromDDL(ddl).fields, strict=True):
        c = F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) else F.lit(value)
        columns.append(c.cast(field.dataType).alias(field.name))
    return spark.range(0, 1, 1, 1).select(*columns)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """A small fixed table as one plan node, in one partition."""
    fields = StructType.fromDDL(ddl).fields
    listed = ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)
    names = [f"CAST(col{k + 1} AS {f.dataType.simpleString()}) AS {f.name}" for k, f in enumerate(fields)]
    return spark.sql(f"SELECT {', '.join(names)} FROM VALUES {listed}")


def no_rows(spark: SparkSession, ddl: str) -> DataFrame:
    return literal_row(spark, [None] * len(StructType.fromDDL(ddl).fields), ddl).limit(0)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """New, not yet existing path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder of :func:`fresh_dir` on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
