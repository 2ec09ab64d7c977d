"""Search by category, scalars and tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.functions.payload import distance
from assetlake.operators import select as P
from assetlake.operators.releases import categories

DEFAULT_LIMIT = 20


def known_categories(manifest_files: DataFrame) -> list[str]:
    """Categories of a release; they come from a short enumeration."""
    return [r[0] for r in categories(manifest_files).orderBy("category").collect()]


def search(
    index: DataFrame,
    category: str | None = None,
    *,
    roughness: float | None = None,
    metalness: float | None = None,
    roughness_range: tuple[float, float] | None = None,
    metalness_range: tuple[float, float] | None = None,
    sources: list[str] | None = None,
    tier: str | None = "1k",
    manifest_files: DataFrame | None = None,
    include_failed: bool = True,
    score: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Index entries that match all given conditions.

    A scalar widens to a range around it. With ``score`` and a scalar the rows carry their distance
    and come nearest first, ties by (source, id). ``tier=None`` leaves tiers out; ``limit=0`` gives
    no row. All conditions form one filter, the cut is a top-k without a full sort.
    """
    bounds = {
        "roughness": P.scalar_range("roughness", roughness, roughness_range),
        "metalness": P.scalar_range("metalness", metalness, metalness_range),
    }
    known = known_categories(manifest_files) if category and manifest_files is not None else None
    out = P.by_category(index, category, known)
    out = P.from_sources(out, sources, manifest_files if sources is None else None, tier)
    for name, limits in bounds.items():
        if limits is not None:
            out = out.filter(F.col(name).between(*limits))
    out = P.has_tier(out, tier)
    if not include_failed:
        out = P.not_failed(out)
    rank = distance(roughness=roughness, metalness=metalness) if score else None
    if rank is not None:
        out = out.withColumn("score", rank)
        order = ["score", "source", "id"]
    else:
        order = ["source", "id"]
    if limit is not None:
        return out.orderBy(*order).limit(limit)
    return out.orderBy(*order) if rank is not None else out


def search_similar(index: DataFrame, category: str | None = None, **conditions) -> DataFrame:
    """``search`` with scores and the default number of rows."""
    conditions.setdefault("limit", DEFAULT_LIMIT)
    return search(index, category, score=True, **conditions)
