"""Paginated JSON sources: tasks fetch the page texts, Spark parses them by the declared schema."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from urllib.parse import urlencode, urljoin, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, StructType

REMOTE = ("http", "https")


def page_text(location: str) -> str:
    """Text of a page from ``http(s)://`` or a file path."""
    if urlsplit(location).scheme in REMOTE:
        from urllib.request import urlopen

        with urlopen(location, timeout=60) as response:
            return response.read().decode("utf-8")
    with open(location.removeprefix("file://"), encoding="utf-8") as handle:
        return handle.read()


def next_page(location: str, text: str) -> str | None:
    """Where the page says the next one is, relative to itself; a remote page cannot lead to a local file."""
    page = json.loads(text)
    link = page.get("next") if isinstance(page, dict) else None
    if not link:
        return None
    if urlsplit(location).scheme not in REMOTE:
        return link
    target = urljoin(location, link)
    if urlsplit(target).scheme not in REMOTE:
        raise ValueError(f"{location} leads to {link}")
    return target


def with_params(location: str, params: Mapping[str, object]) -> str:
    """The location with query parameters added to those it has."""
    if not params:
        return location
    return f"{location}{'&' if urlsplit(location).query else '?'}{urlencode(params)}"


class Pages(InputPartition):
    def __init__(self, location: str, follow: bool):
        self.location, self.follow = location, follow


class PagedReader(DataSourceReader):
    """Numbered pages are fetched in parallel. A chain of links can only be followed one by one, so a single task streams its pages."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Pages]:
        path = self.options["path"]
        if "pages" in self.options:
            first = int(self.options.get("first_page", "1"))
            return [Pages(path.replace("{page}", str(p)), False) for p in range(first, first + int(self.options["pages"]))]
        return [Pages(path, self.options.get("paginate", "false").lower() == "true")]

    def read(self, partition: Pages) -> Iterator[tuple[str]]:
        location, seen = partition.location, set()
        while location is not None:
            if location in seen:
                raise ValueError(f"the pages lead in a circle to {location}")
            seen.add(location)
            text = page_text(location)
            yield (text,)
            location = next_page(location, text) if partition.follow else None


class PagedSource(DataSource):
    """``format("paged_api")``: one row ``page`` with the text of each page."""

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return "page string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def page_rows(pages: DataFrame, schema: str) -> DataFrame:
    """Typed rows of ``pages(page)``: the list or object below ``data``, or the page itself. Anything else, and values that do not
    fit their type, raise an error."""
    kind = ArrayType(StructType.fromDDL(schema))
    body = F.coalesce(F.get_json_object("page", "$.data"), F.col("page"))
    shaped = F.when(F.ltrim(body).rlike(r"^[\[{]"), body).otherwise(F.raise_error(F.lit("a page must hold a list or an object")))
    return pages.select(F.inline(F.from_json(shaped, kind, {"mode": "FAILFAST"})))


def paged_api(spark: SparkSession, path: str, schema: str, params: Mapping[str, object] | None = None, batch_param: str | None = None,
              batch_size: int | None = None, **options: str) -> DataFrame:
    """Rows of all pages. ``params`` go into the query of the first address, ``batch_size`` under the name ``batch_param``."""
    spark.dataSource.register(PagedSource)
    asked = dict(params or {})
    if batch_param and batch_size is not None:
        asked[batch_param] = batch_size
    reader = spark.read.format("paged_api")
    for key, value in options.items():
        reader = reader.option(key, value)
    pages = reader.load(with_params(path, asked))
    if options.get("paginate", "false").lower() == "true":
        pages = pages.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("page"))  # parse in parallel
    return page_rows(pages, schema)
