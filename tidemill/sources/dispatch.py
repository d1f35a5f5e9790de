"""Source types of ingestion jobs → readers."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.times import parse_utc
from tidemill.operators.columns import stamp
from tidemill.session import literal_row
from tidemill.sources import files, synthetic
from tidemill.sources.paged import paged_api


def webhook_rows(spark: SparkSession, payload: Mapping, received_at: str) -> DataFrame:
    """One payload as one row with its time of receipt."""
    if not isinstance(payload, Mapping):
        raise ValueError("a webhook payload must be an object")
    text = json.dumps({**payload, "received_at": received_at})
    holder = literal_row(spark, [text], "body string")
    schema = spark.sql("SELECT schema_of_json(:body)", {"body": text}).first()[0]
    return holder.select(F.from_json("body", F.lit(schema)).alias("r")).select("r.*")


def webhook_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Payload files dropped into a folder, each with an ``event_type`` and free-form ``data``."""
    return (
        spark.readStream.schema("event_type string, data string, received_at string")
        .option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def _rest(spark: SparkSession, options: Mapping) -> DataFrame:
    request = {k: options[k] for k in ("params", "batch_param", "batch_size") if k in options}
    extra = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k not in ("url", "schema", *request)}
    return paged_api(spark, options["url"], options["schema"], **request, **extra)


SOURCES: dict[str, Callable[[SparkSession, Mapping], DataFrame]] = {
    "rest_api": _rest,
    "csv_file": lambda s, o: files.csv_typed(s, o["path"], o.get("schema")),
    "parquet_file": lambda s, o: files.parquet(s, o["path"]),
    "json_file": lambda s, o: files.ndjson(s, o["path"], o.get("schema")),
    "synthetic_stream": lambda s, o: synthetic.stream_events(s, int(o.get("rows", 500)), int(o.get("seed", 0)), o["as_of"]),
    "webhook_event": lambda s, o: webhook_rows(s, o["payload"], o["received_at"]),
}


def read_source(spark: SparkSession, kind: str, options: Mapping) -> DataFrame:
    if kind not in SOURCES:
        raise ValueError(f"unsupported source type {kind!r}; known: {', '.join(SOURCES)}")
    return SOURCES[kind](spark, options)


def normalise(df: DataFrame, kind: str, source: str, as_of: str) -> DataFrame:
    """Ingest metadata and lenient parsing of known time columns."""
    out = stamp(df, source, as_of)
    names = ["emitted_at"] + (["created_at"] if kind == "rest_api" else [])
    types = dict(out.dtypes)
    return out.withColumns({n: parse_utc(F.col(n)) for n in names if types.get(n) == "string"})
