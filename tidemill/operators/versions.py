"""Versioned Parquet tables: append, replace, upsert, insert-if-absent, snapshots and time travel.

A version is a manifest row that lists data folders. Data is written first and
the manifest last, so readers never see a half-written version; a repeated
``batch_id`` changes nothing. Old folders stay readable for time travel.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tidemill.session import literal_row, no_rows

MANIFEST = ("version bigint, operation string, paths array<string>, batch_id string, committed_at string, "
            "schema string, note string")


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Last row of each key. The limit of one row per key also applies before the shuffle."""
    descending = [c.desc() if isinstance(c, Column) else F.col(c).desc() for c in order]
    window = Window.partitionBy(*key).orderBy(*descending)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def upserted(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Target with the batch merged in by name: newest per key wins, the batch on equal order."""
    both = target.withColumn("_seq", F.lit(0)).unionByName(batch.withColumn("_seq", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, key, [*order, "_seq"]).drop("_seq")


def new_rows(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in the target yet, first per key in ``order``."""
    window = Window.partitionBy(*key).orderBy(*order)
    first = batch.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    return first.join(target.select(*key), list(key), "left_anti")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def manifest(self) -> DataFrame:
        """One row per version; empty when the table does not exist."""
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.path}/_manifest/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, MANIFEST)

    def head(self, version: int | None = None) -> Row | None:
        """Manifest row of the newest, or the given, version."""
        rows = self.manifest()
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        found = rows.agg(F.max_by(F.struct(*rows.columns), "version").alias("head")).first()["head"]
        if found is None and version is not None:
            raise ValueError(f"{self.path} has no version {version}")
        return found

    def exists(self) -> bool:
        return self.head() is not None

    def current_version(self) -> int:
        head = self.head()
        return head["version"] if head else 0

    def history(self) -> DataFrame:
        return self.manifest().orderBy("version")

    def read(self, version: int | None = None) -> DataFrame:
        head = self.head(version)
        if head is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._rows(head)

    def _rows(self, head: Row) -> DataFrame:
        return self.spark.read.schema(_schema_of(head)).parquet(*head["paths"])

    def _state(self, batch_id: str | None) -> tuple[Row | None, bool]:
        """Newest manifest row, and whether the batch is committed already."""
        rows = self.manifest()
        same = F.lit(False) if batch_id is None else F.col("batch_id") == batch_id
        state = rows.agg(F.max_by(F.struct(*rows.columns), "version").alias("head"), F.max(same).alias("done")).first()
        return state["head"], bool(state["done"])

    def _commit(self, operation: str, paths: list[str], schema: StructType, as_of: str, batch_id: str | None,
                note: str | None, head: Row | None) -> int:
        version = (head["version"] if head else 0) + 1
        row = (version, operation, paths, batch_id, as_of, json.dumps(schema.jsonValue()), note)
        # An existing entry makes the write fail, so two writers cannot both commit the same version.
        literal_row(self.spark, row, MANIFEST).write.mode("errorifexists").json(f"{self.path}/_manifest/{version:010d}")
        return version

    def _store(self, df: DataFrame) -> str:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return folder

    def replace(self, df: DataFrame, as_of: str, batch_id: str | None = None, operation: str = "replace",
                note: str | None = None) -> int:
        head, done = self._state(batch_id)
        if done:
            return head["version"]
        return self._commit(operation, [self._store(df)], _nullable(df.schema), as_of, batch_id, note, head)

    def append(self, df: DataFrame, as_of: str, batch_id: str | None = None) -> int:
        """Add rows by name; only the new rows are written. New columns are null in older rows."""
        head, done = self._state(batch_id)
        if done:
            return head["version"]
        return self._append(df, as_of, batch_id, "append", head)

    def _append(self, df: DataFrame, as_of: str, batch_id: str | None, operation: str, head: Row | None) -> int:
        schema = widened(_schema_of(head), df.schema) if head else _nullable(df.schema)
        aligned = df.select(*[
            F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ])
        paths = [*(head["paths"] if head else []), self._store(aligned)]
        return self._commit(operation, paths, schema, as_of, batch_id, None, head)

    def upsert(self, batch: DataFrame, key: Sequence[str], order: Sequence[str], as_of: str, batch_id: str | None = None,
               note: str | None = None) -> int:
        head, done = self._state(batch_id)
        if done:
            return head["version"]
        merged = upserted(self._rows(head), batch, key, order) if head else latest_per_key(batch, key, order)
        return self._commit("upsert", [self._store(merged)], _nullable(merged.schema), as_of, batch_id, note, head)

    def insert_absent(self, batch: DataFrame, key: Sequence[str], order: Sequence[str], as_of: str, batch_id: str | None = None) -> int:
        head, done = self._state(batch_id)
        if done:
            return head["version"]
        target = self._rows(head) if head else batch.limit(0)
        return self._append(new_rows(target, batch, key, order), as_of, batch_id, "insert_absent", head)

    def clear(self, as_of: str) -> int:
        """Version without rows; earlier versions stay readable."""
        return self.replace(self.read().limit(0), as_of, operation="clear")


def _schema_of(head: Row) -> StructType:
    return StructType.fromJson(json.loads(head["schema"]))


def _nullable(schema: StructType) -> StructType:
    return StructType.fromJson(json.loads(json.dumps(schema.jsonValue()).replace('"nullable": false', '"nullable": true')))


def widened(current: StructType, incoming: StructType) -> StructType:
    """Current schema plus incoming new columns, all nullable; known columns keep their type."""
    fields = list(_nullable(current).fields)
    known = {f.name for f in fields}
    return StructType(fields + [f for f in _nullable(incoming).fields if f.name not in known])


# Relational type names and their column types (anything else is a string).
RELATIONAL_TYPES = {
    "integer": "int",
    "bigint": "bigint",
    "smallint": "smallint",
    "numeric": "decimal(18,4)",
    "double precision": "double",
    "real": "float",
    "text": "string",
    "character varying": "string",
    "timestamp without time zone": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
    "boolean": "boolean",
}


def column_type(relational: str) -> DataType:
    return DataType.fromDDL(RELATIONAL_TYPES.get(relational.lower(), "string"))


def declared_schema(columns: Sequence[tuple[str, str]]) -> StructType:
    """Schema from ``(name, relational type)`` pairs."""
    schema = StructType()
    for name, type_ in columns:
        schema = schema.add(name, column_type(type_))
    return schema


def added_columns(current: StructType, incoming: StructType) -> list[str]:
    """Names that the incoming data has and the table has not (schema drift)."""
    return [f.name for f in incoming.fields if f.name not in current.fieldNames()]


def transform_and_load(spark: SparkSession, query: str, fn: Callable[[DataFrame], DataFrame], target: VersionedTable,
                       as_of: str, mode: str = "append") -> int:
    """Query → caller's frame function → table."""
    out = spark.sql(query).transform(fn)
    return target.append(out, as_of) if mode == "append" else target.replace(out, as_of)
