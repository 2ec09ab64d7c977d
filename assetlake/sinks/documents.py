"""Index, rowmap, manifest and document outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.normalize import _c
from assetlake.functions.render import rewrite_texture_paths, to_mtlx
from assetlake.operators.lookup import fill_scalars
from assetlake.operators.rowmap import json_text, rowmap_frames, rowmap_pieces
from assetlake.sinks.files import write_files
from assetlake.sinks.ordered import PART_BYTES, ordered_parts, write_ordered


def index_json(index: DataFrame) -> DataFrame:
    """(source, id, json): one JSON object per entry, absent optional fields left out."""
    fields = [f.name for f in S.INDEX_SCHEMA.fields if f.name in index.columns]
    return index.select("source", "id", F.to_json(F.struct(*fields)).alias("json"))


def write_index(index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines below ``source=<s>/``, sorted by id; a large source spans several files.

    Failed entries are kept with their status.
    """
    lines = index_json(index)
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartitionByRange(n, "source", "id")
        .sortWithinPartitions("source", "id")
        .select("source", "json")
        .write.mode(mode)
        .partitionBy("source")
        .text(path)
    )


def write_index_table(index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet index clustered by source, category and id, so searches skip most row groups."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = ["source", "category", "id"]
    index.repartitionByRange(n, *cols).sortWithinPartitions(*cols).write.mode(mode).parquet(path)


def pack_documents(documents: DataFrame) -> DataFrame:
    """(source, id, xml): one document per id, the last by path."""
    return documents.groupBy("source", "id").agg(F.max_by("xml", "path").alias("xml"))


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines ``{"id":…,"xml":…}`` below ``source=<s>/``."""
    packed = pack_documents(documents)
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        packed.repartitionByRange(n, "source", "id")
        .sortWithinPartitions("source", "id")
        .write.mode(mode)
        .partitionBy("source")
        .json(path)
    )


class DocumentMapTooLarge(ValueError):
    """A single JSON document was asked for, but the documents of a source are too many bytes."""


def document_map(documents: DataFrame, max_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """(file, content): one JSON map id -> xml per source in one row, refused above ``max_bytes``.

    ``write_document_maps`` writes the same bytes without a limit.
    """
    packed = pack_documents(documents)
    size = F.sum(F.octet_length("xml") + F.octet_length("id"))
    big = packed.groupBy("source").agg(size.alias("b")).filter(F.col("b") > max_bytes).take(1)
    if big:
        raise DocumentMapTooLarge(f"{big[0]['source']}: {big[0]['b']} bytes, use write_document_maps")
    entry = F.array_sort(F.collect_list(F.struct("id", "xml")))
    return packed.groupBy("source").agg(F.map_from_entries(entry).alias("m")).select(
        F.concat("source", F.lit("-mtlx.json")).alias("file"), F.to_json("m").alias("content")
    )


def write_document_maps(documents: DataFrame, root: str, part_bytes: int = PART_BYTES) -> tuple[int, int]:
    """Write ``<root>/<source>-mtlx.json``, one JSON map id -> xml per source of any size; (files, bytes)."""
    file = F.concat("source", F.lit("-mtlx.json")).alias("file")
    entry = F.concat(json_text(F.col("id")), F.lit(":"), json_text(F.col("xml")))
    pieces = pack_documents(documents).select(file, F.col("id").alias("key"), entry.alias("piece"))
    frames = documents.select(file, F.lit("{").alias("head"), F.lit("}").alias("tail")).distinct()
    return write_ordered(ordered_parts(pieces, frames, part_bytes), root)


def write_rowmaps(
    rowmap: DataFrame,
    files: DataFrame,
    release_tag: str,
    root: str,
    prefix: str = S.ASSET_PREFIX,
    part_bytes: int = PART_BYTES,
) -> tuple[int, int]:
    """Write the JSON rowmap of every bundle of ``files``, whatever its size, below ``root``; (files, bytes)."""
    frames = rowmap_frames(files, release_tag, prefix)
    pieces = rowmap_pieces(rowmap).join(frames.select("parquet_file", "file"), "parquet_file")
    keyed = pieces.select("file", F.col("id").alias("key"), "piece")
    return write_ordered(ordered_parts(keyed, frames, part_bytes), root)


def payload_files(textures: DataFrame, by_source: bool = False) -> DataFrame:
    """(file, content): ``<id>/<channel>.png`` of long texture rows, below ``<source>/`` if asked."""
    folder = ["source", "id"] if by_source else ["id"]
    name = F.concat_ws("/", *folder, F.concat("channel", F.lit(".png")))
    return textures.select(name.alias("file"), F.col("payload").alias("content"))


def materialize(textures: DataFrame, root: str, by_source: bool = False) -> tuple[int, int]:
    """Write payloads to ``<root>/<id>/<channel>.png``; files that are there are skipped.

    Two rows for one file raise: sources that share ids go to folders of their own (``by_source``).
    """
    files = payload_files(textures, by_source)
    twice = files.groupBy("file").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
    if twice:
        raise ValueError(f"{twice[0]['n']} payloads for {twice[0]['file']}")
    return write_files(files, root, skip_existing=True)


def synthesized_documents(
    materials: DataFrame, index: DataFrame, folder: str | None = None
) -> DataFrame:
    """(source, id, xml) of materials (source, id, channels).

    Textures are named ``<id>/<channel>.png``, below ``folder`` if one is given.
    """
    rows = fill_scalars(materials, index, "channels")
    # The document itself decides which scalars a texture replaces, so it gets what is left.
    base = F.col("id") if folder is None else F.concat(F.lit(folder.rstrip("/") + "/"), "id")
    files = {
        c: F.when(F.array_contains("channels", c), F.concat(base, F.lit(f"/{c}.png")))
        for c in S.CHANNELS
    }
    scalars = {c: _c(c) for c in ("roughness", "metalness", "ior")}
    return rows.select("source", "id", to_mtlx("id", scalars, files).alias("xml"))


def original_documents(materials: DataFrame, documents: DataFrame, folder: str) -> DataFrame:
    """(source, id, xml) of upstream documents with texture values pointing below ``folder``."""
    rows = materials.join(documents.select("source", "id", "xml"), ["source", "id"])
    target = F.concat(F.lit(folder.rstrip("/") + "/"), F.col("id"))
    return rows.select(
        "source", "id", rewrite_texture_paths("xml", "channels", target).alias("xml")
    )


def export_documents(
    textures: DataFrame,
    index: DataFrame,
    root: str,
    documents: DataFrame | None = None,
) -> tuple[int, int]:
    """Payloads of ``textures`` plus one ``<id>/<id>.mtlx`` per material, original or synthesised."""
    materials = textures.groupBy("source", "id").agg(
        F.array_sort(F.collect_set("channel")).alias("channels")
    )
    if documents is None:
        docs = synthesized_documents(materials, index, root)
    else:
        docs = original_documents(materials, documents, root)
    name = F.concat_ws("/", "id", F.concat("id", F.lit(".mtlx")))
    n, total = materialize(textures, root)
    m, more = write_files(docs.select(name.alias("file"), F.col("xml").alias("content")), root)
    return n + m, total + more
