"""Paged listings as a data source: a partition per run of landed pages, in batch and as a stream.

Pages are JSON objects in files named by their number (``0.json``, ``listing-12.json``). A listing is
read from page 0 on; it ends with the first page that has fewer items than a page holds, or before
the first number that is missing. What lies behind is left over from an older listing.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from assetlake import schemas as S

FORMAT = "listing_pages"
ROWS = "page bigint, item_no int, n_items int, item string"
_NUMBER = re.compile(r"(\d+)\.json$")


#: Partitions with a page each before runs get longer, and pages of the longest run.
PARTITIONS, RUN = 64, 64


@dataclass
class Page:
    number: int
    path: str


@dataclass
class Pages(InputPartition):
    pages: list[Page]


def in_runs(pages: list[Page]) -> list[Pages]:
    """Pages one behind the other as partitions: few pages spread, many do not become as many tasks."""
    run = max(1, min(RUN, len(pages) // PARTITIONS))
    return [Pages(pages[at : at + run]) for at in range(0, len(pages), run)]


def landed_pages(path: str) -> list[Page]:
    """Pages from 0 on, without a gap."""
    fs, inner = pafs.FileSystem.from_uri(path)
    found = {}
    for info in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
        if match := _NUMBER.search(info.base_name):
            found[int(match[1])] = Page(int(match[1]), info.path)
    out = []
    while len(out) in found:
        out.append(found[len(out)])
    return out


def page_items(root: str, path: str, key: str) -> list:
    fs, _ = pafs.FileSystem.from_uri(root)
    with fs.open_input_stream(path) as f:
        return json.loads(f.read()).get(key) or []


class _Pages:
    def __init__(self, options: dict):
        self.path, self.key = options["path"], options["items"]
        self.size = int(options.get("pagesize", S.LISTING_PAGE_SIZE))

    def read(self, partition: Pages) -> Iterator[tuple]:
        for page in partition.pages:
            items = page_items(self.path, page.path, self.key)
            if not items:  # an empty page ends the listing: it has a row, without an item
                yield page.number, None, 0, None
            for no, item in enumerate(items):
                yield page.number, no, len(items), json.dumps(item)


class PagesReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Pages]:
        return in_runs(landed_pages(self.path))


class PagesStream(_Pages, DataSourceStreamReader):
    """Offsets are numbers of pages; a page is taken once all before it have been full."""

    def initialOffset(self) -> dict:
        return {"pages": 0, "ended": False}

    def latestOffset(self) -> dict:
        at, ended = getattr(self, "_known", (0, False))
        pages = landed_pages(self.path)
        while at < len(pages) and not ended:  # only pages that are new since the last call are looked at
            ended = len(page_items(self.path, pages[at].path, self.key)) < self.size
            at += 1
        self._known = (at, ended)
        return {"pages": at, "ended": ended}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return in_runs(landed_pages(self.path)[start["pages"] : end["pages"]])

    def commit(self, end: dict) -> None:
        pass


class ListingPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> DataSourceReader:
        return PagesReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagesStream(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known. It also runs on the driver outside the shipped files, so it travels by value."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ListingPages)


def _items(rows: DataFrame, items: str) -> DataFrame:
    schema = {"foundAssets": S.PAGED_ASSETS_SCHEMA, "results": S.PAGED_PACKAGES_SCHEMA}[items]
    item = F.from_json("item", StructType.fromDDL(schema)[items].dataType.elementType)
    return rows.filter("item IS NOT NULL").select(item.alias("i")).select("i.*")


def read_pages(
    spark: SparkSession, path: str, items: str = "foundAssets", page_size: int = S.LISTING_PAGE_SIZE
) -> DataFrame:
    """Items of a landed listing up to its end; tasks read runs of pages."""
    register(spark)
    rows = spark.read.format(FORMAT).option("items", items).option("pageSize", page_size).load(path)
    last = rows.filter(F.col("n_items") < page_size).agg(F.min("page")).first()[0]  # null: every page is full
    return _items(rows if last is None else rows.filter(F.col("page") <= last), items)


def stream_pages(
    spark: SparkSession, path: str, items: str = "foundAssets", page_size: int = S.LISTING_PAGE_SIZE
) -> DataFrame:
    """The same as a stream: pages come as they land, in order, until the page that ends the listing."""
    register(spark)
    rows = spark.readStream.format(FORMAT).option("items", items).option("pageSize", page_size).load(path)
    return _items(rows, items)
