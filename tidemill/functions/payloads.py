"""JSON payloads and schema fingerprints."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def is_json(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def json_or_raw(c: Column) -> Column:
    """The payload where it is valid JSON, else ``{"raw": payload}``."""
    return F.when(is_json(c), c).otherwise(F.to_json(F.struct(c.alias("raw"))))


def json_field(c: Column, path: str, type_: str = "string") -> Column:
    """Field of a JSON text, such as ``$.user.id``; null when absent or of another type."""
    return F.try_variant_get(F.try_parse_json(c), path, type_)


def row_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns))


def schema_columns(schema: StructType) -> list[dict[str, str]]:
    return [{"dtype": f.dataType.simpleString(), "name": f.name} for f in schema.fields]


def schema_fingerprint(schema: StructType) -> str:
    """SHA-256 over the ordered list of column names and types."""
    return hashlib.sha256(json.dumps(schema_columns(schema), sort_keys=True).encode()).hexdigest()
