"""The browsable catalogue: one row per text line, in order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.normalize import lookup
from assetlake.functions.render import (
    DASH,
    color_cell,
    fmt_scalar,
    material_link,
    thumb_img,
)
from assetlake.operators.lookup import with_thumbnail
from assetlake.operators.select import not_failed

ORDER = ["source_no", "category", "part", "id", "line_no"]
LINE = [*ORDER, "line"]


def source_order(order: list[str]) -> Column:
    return lookup(F.col("source"), {s: i for i, s in enumerate(order)})


def texture_entries(index: DataFrame, thumbnails: DataFrame) -> DataFrame:
    """Table lines of textured materials: thumbnail, linked name, maps, category."""
    rows = with_thumbnail(not_failed(index), thumbnails)
    thumb = F.when(F.col("has_color"), thumb_img("source", "id", "color")).otherwise(DASH)
    line = F.concat(
        F.lit("| "), thumb, F.lit(" | "), material_link("source", "id", "name"), F.lit(" | "),
        F.array_join("maps", ", "), F.lit(" | "), F.col("category"), F.lit(" |"),
    )
    return rows.select("source", "category", "id", line.alias("line"))


def scalar_entries(index: DataFrame) -> DataFrame:
    """Table lines of scalar materials: name, colour, roughness, metalness, refraction index."""
    line = F.concat(
        F.lit("| "), F.coalesce("name", "id"), F.lit(" | "), color_cell("color_hex"), F.lit(" | "),
        fmt_scalar("roughness", 2), F.lit(" | "), fmt_scalar("metalness", 1), F.lit(" | "),
        fmt_scalar("ior", 2), F.lit(" |"),
    )
    return index.select("source", "category", "id", line.alias("line"))


def category_lines(entries: DataFrame, header: list[str]) -> DataFrame:
    """Summary, table header and end of every category that has entries.

    The number of entries comes from an aggregate; the entries themselves are not gathered.
    """
    counts = entries.groupBy("source", "category").agg(F.count(F.lit(1)).alias("n"))
    summary = F.concat(
        F.lit("<details><summary><b>"), "category", F.lit("</b> ("),
        F.col("n").cast("string"), F.lit(")</summary>"),
    )
    head = [summary, F.lit(""), *[F.lit(h) for h in header]]
    tail = [F.lit(""), F.lit("</details>"), F.lit("")]
    rows = [F.struct(F.lit(0).alias("part"), F.lit(i).alias("line_no"), c.alias("line"))
            for i, c in enumerate(head)]
    rows += [F.struct(F.lit(2).alias("part"), F.lit(i).alias("line_no"), c.alias("line"))
             for i, c in enumerate(tail)]
    return counts.select(
        "source", "category", F.lit("").alias("id"), F.explode(F.array(*rows)).alias("r")
    ).select("source", "category", "id", "r.*")


def source_lines(entries: DataFrame, manifest_files: DataFrame, scalar: bool) -> DataFrame:
    """Heading of every source: icon, count, tiers, licence and site."""
    counts = entries.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    pairs = manifest_files.select("source", "tier").distinct()
    tiers = pairs.groupBy("source").agg(F.array_sort(F.collect_list("tier")).alias("tiers"))
    rows = counts.join(tiers, "source", "left")
    icon = F.coalesce(lookup(F.col("source"), S.SOURCE_ICON), F.lit("\U0001f4e6"))
    site = F.coalesce(lookup(F.col("source"), S.SOURCE_SITE), F.lit(""))
    licence = F.coalesce(lookup(F.col("source"), S.SOURCE_LICENSE), F.lit("unknown"))
    n = F.col("n").cast("string")
    title = F.concat(F.lit("## "), icon, F.lit(" "), F.col("source"))
    if scalar:
        title = F.concat(title, F.lit(" — scalar properties"))
        facts = F.concat(
            F.lit("> "), n,
            F.lit(" materials | No textures — IOR, roughness, metalness, color values"),
        )
    else:
        facts = F.concat(
            F.lit("> "), n, F.lit(" materials | Tiers: "),
            F.coalesce(F.array_join("tiers", ", "), F.lit("")), F.lit(" | License: "), licence,
        )
    link = F.concat(F.lit("> ["), site, F.lit("]("), site, F.lit(")"))
    lines = F.array(
        *[
            F.struct(F.lit(i).alias("line_no"), c.alias("line"))
            for i, c in enumerate([title, F.lit(""), facts, link, F.lit("")])
        ]
    )
    return rows.select(
        "source", F.lit("").alias("category"), F.lit(0).alias("part"), F.lit("").alias("id"),
        F.explode(lines).alias("r"),
    ).select("source", "category", "part", "id", "r.*")


# Fixed values of the catalogue format.
TEXTURE_TABLE = ["| | Material | Maps | Category |", "|---|---|---|---|"]
SCALAR_TABLE = ["| Material | Color | Roughness | Metalness | IOR |", "|---|---|---|---|---|"]


def sections(
    index: DataFrame,
    manifest_files: DataFrame,
    thumbnails: DataFrame,
    texture_sources: list[str] | None = None,
    scalar_sources: list[str] | None = None,
) -> DataFrame:
    """Lines of all sources, keyed so that sorting by ``ORDER`` gives the document."""
    texture_sources = S.TEXTURE_SOURCES if texture_sources is None else texture_sources
    scalar_sources = S.SCALAR_SOURCES if scalar_sources is None else scalar_sources
    filled = index.withColumn("category", F.coalesce("category", F.lit("other")))
    textured = texture_entries(filled.filter(F.col("source").isin(texture_sources)), thumbnails)
    scalars = scalar_entries(filled.filter(F.col("source").isin(scalar_sources)))
    tables = []
    for entries, header, scalar in (
        (textured, TEXTURE_TABLE, False),
        (scalars, SCALAR_TABLE, True),
    ):
        body = entries.withColumns({"part": F.lit(1), "line_no": F.lit(0)})
        tables += [source_lines(entries, manifest_files, scalar), body,
                   category_lines(entries, header)]
    lines = reduce(lambda a, b: a.unionByName(b), tables)
    return lines.withColumn("source_no", source_order([*texture_sources, *scalar_sources])).select(
        *LINE
    )


def header(index: DataFrame, manifest_files: DataFrame, tag: str, date: str) -> DataFrame:
    """Title block with the totals and links to every source."""
    counts = index.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    icon = F.coalesce(lookup(F.col("source"), S.SOURCE_ICON), F.lit("\U0001f4e6"))
    link = F.concat(F.lit("["), icon, F.lit(" "), F.col("source"), F.lit("](#"), F.col("source"),
                    F.lit(")"))
    per = counts.agg(
        F.sum("n").cast("string").alias("total"),
        F.count(F.lit(1)).cast("string").alias("n_sources"),
        F.array_sort(F.collect_list(F.struct("source", link.alias("link")))).alias("links"),
    )
    n_tiers = manifest_files.agg(F.countDistinct("tier").cast("string")).scalar()
    lines = [
        F.lit("<!-- generated, do not edit -->"),
        F.lit(f"<!-- Source: release {tag} | Generated: {date} -->"),
        F.lit(""),
        F.lit("# Material Catalog"),
        F.lit(""),
        F.concat(F.lit("> **"), F.col("total"), F.lit("** materials across **"),
                 F.col("n_sources"), F.lit("** sources, **"), F.col("n_tiers"),
                 F.lit("** resolution tiers.")),
        F.lit(""),
        F.concat(F.lit("**Quick links:** "),
                 F.array_join(F.transform("links", lambda s: s["link"]), " | ")),
        F.lit(""),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("line_no"), c.alias("line"))
                     for i, c in enumerate(lines)])
    return per.withColumn("n_tiers", n_tiers).select(
        F.lit(-1).alias("source_no"), F.lit("").alias("category"), F.lit(0).alias("part"),
        F.lit("").alias("id"), F.explode(rows).alias("r"),
    ).select("source_no", "category", "part", "id", "r.*")


def catalog(
    index: DataFrame, manifest_files: DataFrame, thumbnails: DataFrame, tag: str, date: str
) -> DataFrame:
    """The whole document, sorted."""
    doc = header(index, manifest_files, tag, date).unionByName(
        sections(index, manifest_files, thumbnails)
    )
    return doc.orderBy(*ORDER)


def write_catalog(doc: DataFrame, path: str) -> None:
    """Sorted text; part files concatenate to the document in name order."""
    doc.orderBy(*ORDER).select("line").write.mode("overwrite").text(path)
