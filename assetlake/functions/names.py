"""Names of bundle, rowmap and index files."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.normalize import _c


#: First letters of the ids in a file, of a category that is split by them; ids without one are 0-9.
LETTERS = "[A-Z]-[A-Z]|0-9"


def _pattern(head: str, tail: str, categories: list[str]) -> str:
    cats = "|".join(sorted(categories))
    return rf"^{head}(\w+)-({S.TIER_IN_NAME})-({cats})(?:-(?:{LETTERS}))?(?:-(\d+))?{tail}$"


def bundle_pattern(prefix: str = S.ASSET_PREFIX, categories: list[str] | None = None) -> str:
    return _pattern(re.escape(prefix) + "-", r"\.parquet", categories or S.CATEGORIES)


def rowmap_pattern(categories: list[str] | None = None) -> str:
    return _pattern("", r"-rowmap\.json", categories or S.CATEGORIES)


def parse_asset_name(
    name: Column | str,
    prefix: str = S.ASSET_PREFIX,
    categories: list[str] | None = None,
) -> Column:
    """struct(kind, source, tier, category, chunk, letters) of a file name, null if it is not an asset.

    ``chunk`` is null for an unnumbered file, ``letters`` unless the category is split by first letters.
    """
    name = _c(name)

    def parts(kind: str, pattern: str) -> Column:
        def group(i: int) -> Column:
            return F.regexp_extract(name, pattern, i)

        return F.struct(
            F.lit(kind).alias("kind"),
            group(1).alias("source"),
            group(2).alias("tier"),
            group(3).alias("category"),
            F.nullif(group(4), F.lit("")).cast("int").alias("chunk"),
            F.nullif(F.regexp_extract(name, rf"-({LETTERS})(?:-\d+)?(?:-rowmap\.json|\.parquet)$", 1), F.lit("")).alias("letters"),
        )

    bundle, rowmap = bundle_pattern(prefix, categories), rowmap_pattern(categories)
    return F.when(name.rlike(bundle), parts("bundle", bundle)).when(
        name.rlike(rowmap), parts("rowmap", rowmap)
    )


def chunk_suffix(chunk: Column, numbered: Column | bool, first_unnumbered: bool) -> Column:
    """``-N`` or nothing: either only split categories are numbered, or all after the first."""
    if first_unnumbered:
        numbered = chunk > 1
    elif isinstance(numbered, bool):
        numbered = F.lit(numbered)
    return F.when(numbered, F.concat(F.lit("-"), chunk.cast("string"))).otherwise("")


def asset_name(
    source: Column | str,
    tier: Column | str,
    category: Column | str,
    chunk: Column | str | None = None,
    numbered: Column | bool = True,
    first_unnumbered: bool = False,
    prefix: str = S.ASSET_PREFIX,
    letters: Column | str | None = None,
) -> Column:
    """``<prefix>-<source>-<tier>-<category>[-<letters>][-<chunk>].parquet``; null letters leave none."""
    more = [] if letters is None else [_c(letters)]
    stem = F.concat_ws("-", F.lit(prefix), _c(source), _c(tier), _c(category), *more)
    if chunk is not None:
        stem = F.concat(stem, chunk_suffix(_c(chunk), numbered, first_unnumbered))
    return F.concat(stem, F.lit(".parquet"))


def rowmap_name(bundle: Column | str, prefix: str = S.ASSET_PREFIX) -> Column:
    """``<prefix>-a-b.parquet`` -> ``a-b-rowmap.json``."""
    stem = F.regexp_replace(_c(bundle), r"\.parquet$", "")
    stem = F.regexp_replace(stem, "^" + re.escape(prefix) + "-", "")
    return F.concat(stem, F.lit("-rowmap.json"))


def category_of_rowmap(name: Column | str) -> Column:
    """Category at the end of a rowmap file name, null if the name has none."""
    pattern = rf"-([a-z]+)(?:-(?:{LETTERS}))?(?:-\d+)?-rowmap\.json$"
    return F.get(F.regexp_extract_all(_c(name), F.lit(pattern), F.lit(1)), F.lit(0))


def material_id_of_document(path: Column | str) -> Column:
    """Parent folder of a ``material.mtlx``, else the file stem."""
    parts = F.split(_c(path), "/")
    base = F.element_at(parts, -1)
    return F.when(base == "material.mtlx", F.element_at(parts, -2)).otherwise(
        F.regexp_replace(base, r"\.[^.]*$", "")
    )
