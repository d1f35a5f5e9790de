"""Metadata: schema versions, run registry, lineage, access rules and table statistics."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.payloads import schema_columns, schema_fingerprint
from tidemill.operators.buckets import BucketedTable
from tidemill.operators.versions import VersionedTable
from tidemill.session import literal_row, no_rows

SCHEMA_ROWS = "source_name string, version int, schema_hash string, columns string, first_seen string"
RUN_ROWS = ("source_name string, source_type string, run_id string, status string, row_count bigint, "
            "schema_version int, error string, attempt int, finished_at string")
FAILURE_ROWS = "source_name string, source_type string, run_id string, attempt int, error string, payload string, failed_at string"
RETRY_ROWS = ("run_id string, source_name string, source_type string, attempt int, outcome string, next_attempt int, "
              "next_attempt_at timestamp_ntz")
RECORD_KEYS = {"retries": ["run_id"], "schemas": ["source_name", "schema_hash"], "runs": ["run_id"], "failures": ["run_id", "attempt"]}
LINEAGE_ROWS = ("ts string, user string, tool string, inputs array<string>, output string, format string, "
                "schema string, row_count bigint")


def register_schemas(known: DataFrame, seen: DataFrame) -> DataFrame:
    """New registry rows for fingerprints not known yet.

    ``known`` is ``(source_name, version, schema_hash)``, ``seen`` adds
    ``seen_order``. A known hash keeps its version; new ones continue after the
    greatest version of their source, in the order seen.
    """
    fresh = seen.groupBy("source_name", "schema_hash").agg(F.min("seen_order").alias("seen_order")).join(
        known.select("source_name", "schema_hash"), ["source_name", "schema_hash"], "left_anti"
    )
    tops = known.groupBy("source_name").agg(F.max("version").alias("_top"))
    numbered = fresh.withColumn("_n", F.row_number().over(Window.partitionBy("source_name").orderBy("seen_order", "schema_hash")))
    return numbered.join(tops, "source_name", "left").select(
        "source_name", (F.coalesce("_top", F.lit(0)) + F.col("_n")).cast("int").alias("version"), "schema_hash"
    )


@dataclass
class RunRegistry:
    """Schema versions, runs and failures of ingestion jobs; a record touches one bucket of its table."""

    spark: SparkSession
    path: str

    def _table(self, name: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.path}/{name}", RECORD_KEYS[name])

    def _rows(self, name: str, ddl: str) -> DataFrame:
        return self._table(name).read(like=no_rows(self.spark, ddl))

    def schemas(self) -> DataFrame:
        return self._rows("schemas", SCHEMA_ROWS)

    def runs(self) -> DataFrame:
        return self._rows("runs", RUN_ROWS)

    def failures(self) -> DataFrame:
        return self._rows("failures", FAILURE_ROWS)

    def retries(self) -> DataFrame:
        return self._rows("retries", RETRY_ROWS)

    def store_retries(self, rows: DataFrame) -> None:
        """Keep the newest state of each run: waiting, given up, or done."""
        self._table("retries").upsert(rows.select(*StructType.fromDDL(RETRY_ROWS).fieldNames()), ["attempt"])

    def schema_version(self, source: str, df: DataFrame, as_of: str) -> int:
        """Version of the frame's schema for the source, registering it when new."""
        digest = schema_fingerprint(df.schema)
        known = self.schemas().filter(F.col("source_name") == source).agg(
            F.max(F.when(F.col("schema_hash") == digest, F.col("version"))).alias("same"), F.max("version").alias("top")
        ).first()
        if known["same"] is not None:
            return known["same"]
        version = (known["top"] or 0) + 1
        row = (source, version, digest, json.dumps(schema_columns(df.schema)), as_of)
        self._table("schemas").insert_absent(literal_row(self.spark, row, SCHEMA_ROWS), ["version"])
        return version

    def record_success(self, source: str, kind: str, run_id: str, row_count: int, version: int, as_of: str, attempt: int = 1) -> None:
        row = (source, kind, run_id, "success", row_count, version, None, attempt, as_of)
        self._table("runs").upsert(literal_row(self.spark, row, RUN_ROWS), ["attempt"])

    def record_failure(self, source: str, kind: str, run_id: str, attempt: int, error: str, payload: Mapping, as_of: str) -> None:
        failure = (source, kind, run_id, attempt, error, json.dumps(payload, sort_keys=True), as_of)
        self._table("failures").insert_absent(literal_row(self.spark, failure, FAILURE_ROWS), ["failed_at"])
        row = (source, kind, run_id, "failed", None, None, error, attempt, as_of)
        self._table("runs").upsert(literal_row(self.spark, row, RUN_ROWS), ["attempt"])


def health(runs: DataFrame, failures: DataFrame, as_of: str) -> DataFrame:
    """One row: runs, sources, failures and the runs of the last day."""
    recent = F.col("finished_at").cast("timestamp_ntz") > F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.countDistinct("source_name").alias("sources"),
        F.count_if(recent).alias("runs_last_day"),
        F.max("finished_at").alias("last_run_at"),
    ).withColumn("failures", failures.agg(F.count(F.lit(1))).scalar())


def latest_runs(runs: DataFrame) -> DataFrame:
    """View of the newest run per source."""
    best = F.max_by(F.struct("run_id", "status", "row_count", "schema_version", "finished_at"), F.struct("finished_at", "run_id"))
    return runs.groupBy("source_name").agg(best.alias("r")).select("source_name", "r.*")


@dataclass(frozen=True)
class Artifact:
    """Description of a stored dataset."""

    uri: str
    format: str
    schema: tuple[dict[str, str], ...]
    row_count: int
    inputs: tuple[str, ...] = field(default=())


def lineage_row(artifact: Artifact, tool: str, user: str, as_of: str) -> tuple:
    return (as_of, user, tool, list(artifact.inputs), artifact.uri, artifact.format,
            json.dumps(list(artifact.schema)), artifact.row_count)


def log_lineage(table: VersionedTable, artifact: Artifact, tool: str, user: str, as_of: str) -> int:
    rows = literal_row(table.spark, lineage_row(artifact, tool, user, as_of), LINEAGE_ROWS)
    return table.append(rows, as_of)


# Table name prefixes that only the named role may read.
RESTRICTED = {"finance.": "finance"}


def check_access(table: str, roles: Sequence[str], restricted: Mapping[str, str] = RESTRICTED) -> None:
    """Raise ``PermissionError`` before a restricted table is resolved."""
    for prefix, role in restricted.items():
        if table.lower().startswith(prefix) and role not in roles:
            raise PermissionError(f"{table} needs role {role}")


def relations(spark: SparkSession, sql: str) -> list[list[str]]:
    """Name parts of every relation that the parsed text mentions, its own WITH names left in; nothing is run."""
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    return [[part.strip() for part in found.split(",")] for found in re.findall(r"UnresolvedRelation \[([^\]]*)\]", parsed)
            + re.findall(r"UnresolvedTableOrView \[([^\]]*)\]", parsed)]


def check_query(spark: SparkSession, sql: str, roles: Sequence[str], restricted: Mapping[str, str] = RESTRICTED) -> None:
    """Raise ``PermissionError`` if a statement that is to be run names a restricted table, its view, or a path as a table."""
    database = spark.catalog.currentDatabase()
    for parts in relations(spark, sql):
        if not all(re.fullmatch(r"\w+", part) for part in parts):
            raise PermissionError(f"{'.'.join(parts)} is a path, not a table")
        check_access(".".join(parts[-2:] if len(parts) > 1 else [database, *parts]), roles, restricted)
        if len(parts) == 1:
            check_access(parts[0], roles, {prefix.replace(".", "_"): role for prefix, role in restricted.items()})


def table_stats(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count, populated)`` for named frames in one job."""
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("populated", F.col("row_count") > 0)


def folder_size(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files and bytes below a table folder; lengths come from the listing, contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def stored_artifact(df: DataFrame, uri: str, inputs: Sequence[str] = ()) -> Artifact:
    """Write a result as Parquet and describe it; rows are counted while writing. An action."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(uri)
    return Artifact(uri, "parquet", tuple(schema_columns(df.schema)), seen.get["rows"], tuple(inputs))


def run_sql(spark: SparkSession, sql: str, uri: str, tables: Mapping[str, DataFrame] | None = None, roles: Sequence[str] = (),
            lineage: VersionedTable | None = None, user: str = "", as_of: str = "") -> Artifact:
    """Run SQL over named frames and store the result; ``tables`` are the only inputs besides the catalog.

    Access is checked before a name is resolved, for the given tables and for every
    relation of the text; paths in place of tables are refused. A dot in a table name becomes
    an underscore in its view. With a ``lineage`` table the run is logged.
    """
    check_query(spark, sql, roles)
    for name in tables or {}:
        check_access(name, roles)
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name.replace(".", "_"))
    artifact = stored_artifact(spark.sql(sql), uri, list(tables or {}))
    if lineage is not None:
        log_lineage(lineage, artifact, "sql", user, as_of)
    return artifact
