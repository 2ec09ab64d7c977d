"""Every operator as a query over the given tables, with the same query in SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assetlake.queries.registry import QUERIES, SQL

MODULES = ["index", "textures", "chunks", "ranges", "bakes", "releases", "exports", "usage", "streams"]


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for name in MODULES:
        importlib.import_module(f"assetlake.queries.{name}")
    return dict(QUERIES), dict(SQL)
