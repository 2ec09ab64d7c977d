"""Rowmaps: the byte range of every payload in its bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.names import rowmap_name
from assetlake.operators.ordered import running
from assetlake.session import cut


def collector(placed: DataFrame) -> DataFrame:
    """(parquet_file, row_idx, id, channel, length) of placed textures without payload.

    The row order of a bundle is the order of its ids; it is kept as data. Of a channel that a
    material has twice, the longest payload is the one that is written.
    """
    # Used several times, and what places the textures may be a search among all bundles.
    placed = cut(placed.groupBy("parquet_file", "id", "channel").agg(F.max("length").alias("length")))
    ids = placed.select("parquet_file", "id").distinct()
    order = running(ids, ["parquet_file"], ["id"]).select(
        "parquet_file", "id", (F.col("rn") - 1).cast("int").alias("row_idx")
    )
    return placed.select("parquet_file", "id", "channel", "length").join(
        order, ["parquet_file", "id"]
    )


def rowmap_mismatch(footers: DataFrame, recorded: DataFrame) -> DataFrame:
    """Files whose number of row groups differs from the number of recorded materials."""
    groups = footers.groupBy("parquet_file").agg(F.max("n_row_groups").alias("row_groups"))
    rows = recorded.groupBy("parquet_file").agg((F.max("row_idx") + 1).alias("recorded"))
    both = groups.join(rows, "parquet_file", "left").fillna(0, ["recorded"])
    return both.filter("row_groups <> recorded")


def locate(footers: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded textures with the ``offset`` of their payload, null where it cannot be there.

    A chunk holds one uncompressed value in plain encoding, so the payload is its tail, whatever
    bytes it is made of. The row group must be that of the recorded id.
    """
    chunks = footers.filter("column is not null").select(
        "parquet_file", "row_idx", F.col("column").alias("channel"),
        "chunk_start", "chunk_size", "row_id", "codec", "num_values",
    )
    fits = (
        (F.col("codec") == "UNCOMPRESSED")
        & (F.col("num_values") == 1)
        & (F.col("length") + 4 <= F.col("chunk_size"))  # a plain value follows its length
        & (F.col("row_id").isNull() | (F.col("row_id") == F.col("id")))
    )
    end = F.col("chunk_start") + F.col("chunk_size")
    return recorded.join(chunks, ["parquet_file", "row_idx", "channel"], "left").select(
        "parquet_file", "row_idx", "id", "channel",
        F.when(fits, end - F.col("length")).alias("offset"), "length",
    )


def build_rowmap(footers: DataFrame, recorded: DataFrame) -> DataFrame:
    """Long rowmap of written bundles; a count mismatch or a payload without place is an error."""
    footers, recorded = cut(footers), cut(recorded)
    bad = rowmap_mismatch(footers, recorded).take(1)
    if bad:
        raise ValueError(
            f"{bad[0]['recorded']} recorded rows but {bad[0]['row_groups']} row groups in "
            f"{bad[0]['parquet_file']}"
        )
    located = cut(locate(footers, recorded))
    lost = located.filter("offset is null").take(1)
    if lost:
        raise ValueError(f"no place for {lost[0]['id']}/{lost[0]['channel']} in {lost[0]['parquet_file']}")
    return located


def merge_rowmaps(rowmap: DataFrame, file: str = "parquet_file") -> DataFrame:
    """One entry set per (source, tier, id): that of the last file by name."""
    key = ["source", "tier", "id"]
    last = rowmap.groupBy(*key).agg(F.max(file).alias(file))
    return rowmap.join(last, [*key, file], "left_semi")


def rowmap_entry(requests: DataFrame, rowmap: DataFrame, header_file: str | None = None) -> DataFrame:
    """(offset, length, parquet_file) per channel of each requested (source, tier, id).

    An entry without a file of its own gets the file named in the rowmap header.
    """
    keys = ["source", "tier", "id"]
    own = F.nullif("parquet_file", F.lit(""))
    file = F.coalesce(own, F.col(header_file)) if header_file else F.coalesce(own, F.lit(""))
    entries = rowmap.select(*keys, "channel", "offset", "length", file.alias("parquet_file"))
    return requests.select(*keys).distinct().join(entries, keys)


def rowmap_stats(rowmap: DataFrame, by: list[str]) -> DataFrame:
    """Materials and channels per rowmap."""
    per_id = rowmap.groupBy(*by, "id").agg(F.count(F.lit(1)).alias("c"))
    return per_id.groupBy(*by).agg(
        F.count(F.lit(1)).alias("materials"), F.sum("c").alias("channels")
    )


def rowmap_pieces(rowmap: DataFrame) -> DataFrame:
    """(parquet_file, id, piece): the JSON entry of every material."""
    ranges = F.array_sort(F.collect_list(F.struct("channel", F.struct("offset", "length"))))
    per_id = rowmap.groupBy("parquet_file", "id").agg(ranges.alias("ranges"))
    entry = F.concat(json_text(F.col("id")), F.lit(":"), F.to_json(F.map_from_entries("ranges")))
    return per_id.select("parquet_file", "id", entry.alias("piece"))


def rowmap_frames(files: DataFrame, release_tag: str, prefix: str = S.ASSET_PREFIX) -> DataFrame:
    """(parquet_file, file, head, tail): what stands around the entries of each bundle of ``files``."""
    head = F.to_json(
        F.struct(
            F.lit(1).alias("version"), F.lit(release_tag).alias("release_tag"),
            "source", "tier", "parquet_file",
        )
    )
    opened = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"materials":{'))
    return files.select(
        "parquet_file", rowmap_name("parquet_file", prefix).alias("file"), opened.alias("head"), F.lit("}}").alias("tail")
    )


def rowmap_documents(
    rowmap: DataFrame,
    files: DataFrame,
    release_tag: str,
    prefix: str = S.ASSET_PREFIX,
    max_materials: int = 500_000,
) -> DataFrame:
    """(file, content): one JSON rowmap per bundle of ``files`` in one row, also for an empty bundle.

    ``files``: (parquet_file, source, tier). A row holds no more than ``max_materials``; a larger rowmap is
    refused here and written by ``sinks.documents.write_rowmaps``, which has no limit.
    """
    big = rowmap_stats(rowmap, ["parquet_file"]).filter(F.col("materials") > max_materials).take(1)
    if big:
        raise ValueError(
            f"{big[0]['parquet_file']} has {big[0]['materials']} materials, more than one row "
            "should hold; write_rowmaps writes it in parts"
        )
    per_file = rowmap_pieces(rowmap).groupBy("parquet_file").agg(
        F.array_sort(F.collect_list(F.struct("id", "piece"))).alias("entries")
    )
    body = F.coalesce(F.array_join(F.transform("entries", lambda e: e["piece"]), ","), F.lit(""))
    joined = rowmap_frames(files, release_tag, prefix).join(per_file, "parquet_file", "left")
    return joined.select("file", F.concat("head", body, "tail").alias("content"))


def write_rowmap_table(rowmap: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """``rowmap`` as a table in buckets of (source, tier, id), sorted within them.

    Look-ups by these keys (``rowmap_entry``, ``fetch_ranges``) then read the buckets as they lie: only the
    requests are shuffled. Requests with a literal as source or tier are joined by the other keys alone, and
    then both sides are shuffled. ``path`` is the folder of the table, by default below the warehouse.
    """
    keys = ["source", "tier", "id"]
    writer = rowmap.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return rowmap.sparkSession.table(table)


def json_text(x):
    """``x`` as a JSON string."""
    wrapped = F.to_json(F.array(x))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def overlaps(rowmap: DataFrame) -> DataFrame:
    """Ranges that start before an earlier range of the same file has ended."""
    ends = rowmap.withColumn("_end", F.col("offset") + F.col("length"))
    out = running(ends, ["parquet_file"], ["offset", "id", "channel"], maxes={"_before": "_end"})
    return out.filter(F.col("offset") < F.col("_before")).drop("_end", "_before", "rn", "n")


def latest_per_key(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row per key."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("r"))
    return newest.select(*keys, "r.*")


def first_channel_wins(members: DataFrame, keys: list[str], order: str = "member_no") -> DataFrame:
    """One row per (keys, channel): the first in archive order. Pass rows without payload."""
    rest = [c for c in members.columns if c not in [*keys, "channel"]]
    first = members.groupBy(*keys, "channel").agg(F.min_by(F.struct(*rest), order).alias("r"))
    return first.select(*keys, "channel", "r.*")


