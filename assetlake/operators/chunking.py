"""Assignment of materials to size-bounded bundles. Works on (keys, id, length) rows only."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from assetlake import schemas as S
from assetlake.functions.names import asset_name
from assetlake.operators.ordered import MAX_WINDOW_ROWS, largest_group, last_before, running
from assetlake.session import cut

GROUP = ["source", "tier", "category"]


def material_sizes(textures: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """(group, id, length): payload bytes per material; helper channels starting ``_`` excluded."""
    real = textures.filter(~F.startswith("channel", F.lit("_")))
    return real.groupBy(*group, "id").agg(F.sum("length").alias("length"))


def estimate_size(textures: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """(group, bytes): payload bytes a bundle of the group would hold."""
    real = textures.filter(~F.startswith("channel", F.lit("_")))
    return real.groupBy(*group).agg(F.sum("length").alias("bytes"))


def chunk_by_count(
    sizes: DataFrame,
    group: list[str] = GROUP,
    max_bytes: int = S.MAX_BUNDLE_BYTES,
    max_window_rows: int = MAX_WINDOW_ROWS,
) -> DataFrame:
    """Chunks of equal row count, as many as the group's bytes call for.

    ``total // max + 1`` chunks are aimed at; a remainder opens one more. Adds ``chunk`` and
    ``numbered`` (false for a group that fits into one file).
    """
    pos = running(sizes, group, ["id"], {"before": "length"}, max_window_rows=max_window_rows)
    total = F.col("before_total")
    wanted = F.floor(total / F.lit(max_bytes)) + 1
    per_chunk = F.when(
        total > max_bytes, F.greatest(F.floor(F.col("n") / wanted), F.lit(1))
    ).otherwise(F.col("n"))
    return (
        pos.withColumn("chunk", (F.floor((F.col("rn") - 1) / per_chunk) + 1).cast("int"))
        .withColumn("numbered", total > max_bytes)
        .drop("rn", "n", "before", "before_total")
    )


def _next_start(ends: np.ndarray, start_bytes: np.ndarray, max_bytes: int) -> np.ndarray:
    """Index of the first row after the chunk that was opened at each start position.

    A chunk keeps the row that reaches ``max_bytes``.
    """
    return np.searchsorted(ends, start_bytes + max_bytes, side="left") + 1


def _walk(ends: np.ndarray, open_bytes: int, max_bytes: int) -> list[int]:
    """Indexes at which new chunks start, given where the open chunk began."""
    starts, at = [], open_bytes
    while (i := int(_next_start(ends, np.array([at]), max_bytes)[0])) <= len(ends):
        starts.append(i)
        at = int(ends[i - 1])
    return starts


def chunk_by_bytes(
    sizes: DataFrame,
    group: list[str] = GROUP,
    max_bytes: int = S.MAX_BUNDLE_BYTES,
    block_rows: int = MAX_WINDOW_ROWS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Greedy rotation by id: a file is closed after the row that reaches ``max_bytes``.

    Adds ``chunk`` (from 1, or going on from the open chunk that ``carry`` (group, chunk,
    open_bytes) gives for a group). A group is cut into blocks of ``block_rows`` rows. Where the
    first chunk of a block was opened follows from the blocks before it; only that one number per
    block is passed on, so the rows of a large group are never together in one task.
    """
    largest = largest_group(sizes, group)
    pos = running(sizes, group, ["id"], {"before": "length"}, None, block_rows, largest)
    pos = pos.withColumn("block", F.floor((F.col("rn") - 1) / block_rows).cast("int"))
    entry = None if carry is None else _first_entries(carry, group)
    if largest > block_rows:
        pos = cut(pos)
        later = _later_entries(pos, entry, group, block_rows, max_bytes)
        entry = later if entry is None else entry.unionByName(later)
    if entry is None:
        fresh = F.lit(0).cast("long")
        pos = pos.withColumns({"open_at": fresh, "closed": fresh})
    else:
        pos = pos.join(entry, [*group, "block"], "left").fillna(0, ["open_at", "closed"])

    schema = StructType([*sizes.schema.fields, StructField("chunk", IntegerType())])
    cols = sizes.columns

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        ends = (pdf["before"] + pdf["length"]).to_numpy()
        starts = _walk(ends, int(pdf["open_at"].iat[0]), max_bytes)
        bump = np.searchsorted(np.array(starts, dtype=np.int64), np.arange(len(ends)), "right")
        return pdf.assign(chunk=(pdf["closed"].iat[0] + bump + 1).astype("int32"))[
            [*cols, "chunk"]
        ]

    return pos.groupBy(*group, "block").applyInPandas(assign, schema)


def _first_entries(carry: DataFrame, group: list[str]) -> DataFrame:
    """(group, block 0, open_at, closed): bytes already in the open chunk lie before byte 0."""
    return carry.select(
        *group,
        F.lit(0).alias("block"),
        (-F.col("open_bytes")).cast("long").alias("open_at"),
        (F.col("chunk") - 1).cast("long").alias("closed"),
    )


def _exits(rows: DataFrame, group: list[str], max_bytes: int) -> DataFrame:
    """(group, ends, rn, leave_at, closes): how a chunk that is closed by a row would leave the row's block.

    ``leave_at`` is the byte at which the chunk that is open at the end of the block began, ``closes``
    the number of chunks closed in it from that row on, the row's own included.
    """
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(group).schema)

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        ends = (pdf["before"] + pdf["length"]).to_numpy()
        n = len(ends)
        # State "a chunk starts right after row i": follow it by repeated doubling to the block end.
        nxt = np.minimum(_next_start(ends, ends, max_bytes), n + 1) - 1
        done = nxt >= n
        hop = np.where(done, np.arange(n), nxt)
        closed = (~done).astype(np.int64)
        while True:
            further = closed[hop]
            if not further.any():
                break
            closed, hop = closed + further, hop[hop]
        return pdf[[*group, "rn"]].assign(ends=ends, leave_at=ends[hop], closes=closed + 1)

    return rows.groupBy(*group, "block").applyInPandas(leave, f"{keys}, rn bigint, ends bigint, leave_at bigint, closes bigint")


def _later_entries(
    pos: DataFrame, first_entry: DataFrame | None, group: list[str], block_rows: int, max_bytes: int
) -> DataFrame:
    """(group, block, open_at, closed) for every block after the first of the large groups.

    A place at which a block can be left points to the place at which the block is left that closes the
    open chunk: one table of pointers, doubled by joins until none is left. The places on the real way
    are found from the longest pointers down, each halving what is still unknown, and every block
    takes the last of them before it. Nothing passes through the driver but the test for the end.
    """
    large = pos.filter(F.col("n") > block_rows)
    exits = cut(_exits(large, group, max_bytes))
    fresh = F.lit(0).cast("long")
    begin = large.select(*group).distinct()
    if first_entry is None:
        begin = begin.withColumns({"open_at": fresh, "closed": fresh})
    else:
        begin = begin.join(first_entry.drop("block"), group, "left").fillna(0, ["open_at", "closed"])
    begin = cut(begin)

    def onward(places: DataFrame) -> DataFrame:
        """``places`` (group, place, …) with the place after it and the chunks closed on the way, if any."""
        wanted = places.withColumn("_at", -(F.col("place") + max_bytes))  # from the end backwards
        bounds = exits.select(*group, (-F.col("ends")).alias("_at"), (-F.col("rn")).alias("_first"), "leave_at", "closes")
        found = last_before(wanted, bounds, group, "_at", ["_first", "leave_at", "closes"], block_rows)
        return found.filter("leave_at IS NOT NULL").drop("_at", "_first")

    steps = [cut(onward(exits.select(*group, F.col("leave_at").alias("place")).distinct()))]
    while not steps[-1].isEmpty():
        one = steps[-1]
        two = one.select(*group, F.col("place").alias("leave_at"), F.col("leave_at").alias("_at"), F.col("closes").alias("_more"))
        far = one.join(two, [*group, "leave_at"])
        steps.append(cut(far.select(*group, "place", F.col("_at").alias("leave_at"), (F.col("closes") + F.col("_more")).alias("closes"))))
    way = onward(begin.withColumnRenamed("open_at", "place"))
    way = way.select(*group, F.col("leave_at").alias("place"), (F.col("closed") + F.col("closes")).alias("closed"))
    for step in reversed(steps):
        way = cut(way)
        further = way.join(step, [*group, "place"])
        way = way.unionByName(
            further.select(*group, F.col("leave_at").alias("place"), (F.col("closed") + F.col("closes")).alias("closed"))
        )
    blocks = large.filter("block > 0").groupBy(*group, "block").agg(F.min("before").alias("_at"))
    ways = way.select(*group, F.col("place").alias("_at"), F.col("place").alias("open_at"), "closed")
    ways = ways.unionByName(begin.select(*group, F.least("open_at", fresh).alias("_at"), "open_at", "closed"))
    return last_before(blocks, ways, group, "_at", ["open_at", "closed"], block_rows).drop("_at")


def alpha_ranges(
    column: str = "id", ranges: tuple[tuple[str, str], ...] = (("A", "M"), ("N", "Z"))
) -> Column:
    """Expression naming the first-letter range of an id; other first characters give ``0-9``."""
    letter = F.upper(F.substring(column, 1, 1))
    out = None
    for lo, hi in ranges:
        case = (letter.between(lo, hi), F.lit(f"{lo}-{hi}"))
        out = F.when(*case) if out is None else out.when(*case)
    return out.otherwise("0-9")


def alpha_subsplit(
    sizes: DataFrame, ranges: tuple[tuple[str, str], ...] = (("A", "M"), ("N", "Z"))
) -> DataFrame:
    """Adds ``letters``, the first-letter range a material's file is named after."""
    return sizes.withColumn("letters", alpha_ranges("id", ranges))


def letter_of(column: str = "id") -> Column:
    """First letter of an id from A to Z, ``0`` for any other first character."""
    letter = F.upper(F.substring(column, 1, 1))
    return F.when(letter.rlike("^[A-Z]$"), letter).otherwise("0")


def letter_ranges(sizes: DataFrame, group: list[str] = GROUP, max_bytes: int = S.MAX_BUNDLE_BYTES) -> DataFrame:
    """(group, letter, letters): the range of first letters, such as ``A-M``, that each letter belongs to.

    Only groups of more than ``max_bytes`` are split, into as many ranges as their bytes call for, cut at
    the quantiles of the bytes by first letter; a letter is never cut. The ranges of a group leave
    no letter out. ``letters`` is null in a group that is not split, ``0-9`` for ids without a first letter.
    """
    by_letter = sizes.groupBy(*group, letter_of("id").alias("letter")).agg(F.sum("length").alias("_bytes"))
    whole = Window.partitionBy(*group)  # at most 27 rows each
    ordered = whole.orderBy("letter")
    total, before = F.sum("_bytes").over(whole), F.sum("_bytes").over(ordered) - F.col("_bytes")
    part = F.floor(before * F.ceil(total / max_bytes) / total)
    rows = by_letter.withColumns({"_part": F.when(F.col("letter") == "0", F.lit(-1)).otherwise(part), "_total": total})
    first = F.min("letter").over(whole.partitionBy(*group, "_part"))
    rows = rows.withColumn("_first", first).withColumn("_alpha", F.col("_part") >= 0)
    within = Window.partitionBy(*group, "_alpha")
    low = F.when(F.col("_part") == F.min("_part").over(within), "A").otherwise(F.col("_first"))
    after = F.min(F.struct("_part", "_first")).over(within.orderBy("_part").rangeBetween(1, Window.unboundedFollowing))
    high = F.coalesce(F.char(F.ascii(after["_first"]) - 1), F.lit("Z"))
    label = F.when(F.col("_alpha"), F.concat(low, F.lit("-"), high)).otherwise("0-9")
    return rows.select(*group, "letter", F.when(F.col("_total") > max_bytes, label).alias("letters"))


def split_by_letters(sizes: DataFrame, group: list[str] = GROUP, max_bytes: int = S.MAX_BUNDLE_BYTES) -> DataFrame:
    """``sizes`` with the ``letters`` of :func:`letter_ranges`, by which its groups are chunked further."""
    ranges = letter_ranges(sizes, group, max_bytes)
    same = [F.col(f"s.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group]
    keyed = sizes.withColumn("_letter", letter_of("id")).alias("s")
    found = keyed.join(ranges.alias("r"), [*same, F.col("s._letter") == F.col("r.letter")])
    return found.select("s.*", "r.letters").drop("_letter")


def chunk_bounds(chunks: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """One row per bundle: (group, chunk, numbered, first_id, last_id, n, bytes, bundle_no).

    A chunk is a range of ids, so this table is all a payload row needs to find its file.
    """
    cols = [F.min("id").alias("first_id"), F.max("id").alias("last_id"),
            F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")]
    if "numbered" in chunks.columns:
        cols.append(F.max("numbered").alias("numbered"))
    if "letters" in chunks.columns and "letters" not in group:
        group = [*group, "letters"]
    return chunks.groupBy(*group, "chunk").agg(*cols)


def bundle_files(
    bounds: DataFrame, prefix: str = S.ASSET_PREFIX, first_unnumbered: bool = False
) -> DataFrame:
    """``bounds`` with the file name of each bundle, which has the ``letters`` where there are any."""
    numbered = F.col("numbered") if "numbered" in bounds.columns else True
    name = asset_name(
        "source", "tier", "category", "chunk", numbered, first_unnumbered, prefix,
        "letters" if "letters" in bounds.columns else None,
    )
    return bounds.withColumn("parquet_file", name)


def payload_offsets(
    textures: DataFrame, file: str = "parquet_file", order: tuple[str, ...] = ("id", "channel_no")
) -> DataFrame:
    """Start of every payload in a container that stores them back to back: ``offset``."""
    out = running(textures, [file], list(order), {"offset": "length"})
    return out.drop("rn", "n", "offset_total")
