"""Removal of repeated passages: suffixes sorted by hash comparison around shared anchors.

A window of ``LENGTH`` bytes is repeated when the same bytes start anywhere else. Sorting the suffix
of every byte would move each byte's neighbourhood through the shuffle. Instead every window names
its anchor, the run of ``GRAM`` bytes in it with the least hash, so equal windows have equal anchors
at equal offsets. Anchors that occur once rule their windows out; those whose windows are all the
same everywhere need no comparison; the suffixes of what is left are sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import free_name, freeze, slices, spread, text_bytes
from assetlake.llm.pretokens import powers, prefix_hashes, range_hashes
from assetlake.llm.words import mix

LENGTH = 200
GRAM = 64
#: Distinct surroundings of one anchor that one task sorts together; those of anchors with more of
#: them are narrowed down by counting, in bins of so many windows.
GROUP = 2048
BINS = (16, 4, 1)
#: Spans of small groups that a task sorts together.
SPANS = 512
_POSITION = np.uint64(31)


def anchors(offsets: np.ndarray, raw: np.ndarray, length: int, gram: int):
    """(anchor, first window, last window, prefix hashes): maximal runs of windows with one anchor.

    The anchor is the leftmost gram of least hash, so it depends on the window's bytes alone.
    """
    n = len(raw)
    prefix = prefix_hashes(raw)
    if n < length:
        none = np.empty(0, np.int64)
        return none, none, none, prefix
    at = np.arange(n - gram + 1)
    keys = range_hashes(prefix, at, at + gram)
    packed = (keys >> _POSITION) << _POSITION | at.astype(np.uint64)
    width, step, least = length - gram + 1, 1, packed
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        m = len(packed) - width + 1
        least = np.minimum(least[:m], least[width - step : width - step + m])
    anchor = (least & np.uint64((1 << 31) - 1)).astype(np.int64)
    end = np.repeat(offsets[1:], np.diff(offsets))[: n - length + 1]
    start = np.flatnonzero(np.arange(n - length + 1) + length <= end)
    if not len(start):
        return start, start, start, prefix
    anchor = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return anchor[first], start[first], start[np.append(first[1:], len(start)) - 1], prefix


def pack(low: np.ndarray, back: np.ndarray, more: np.ndarray) -> np.ndarray:
    """One long of a window's start, the anchor's distance from it, and the windows after it."""
    return low << 20 | back << 10 | more


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 20, (packed >> 10) & 1023, packed & 1023


def named(id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """(k1, k2, text): 128 bits of the SHA-256 of id and text name a row; rows that share both are equal."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.sha2(F.concat(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.lit(":"), text), 256)
    k1, k2 = (F.conv(F.substring(name, at, 16), 16, -10).cast("long") for at in (1, 17))
    return k1, k2, text


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    k1, k2, text = named(id_col, text_col)
    return docs.select(k1.alias("k1"), k2.alias("k2"), text.alias("text"))


def anchor_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, span, k1, k2, at): anchors of all texts, with a hash of all bytes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            offsets, raw = text_bytes(part.column(2))
            anchor, low, high, prefix = anchors(offsets, raw, length, gram)
            if not len(anchor):
                continue
            text = np.searchsorted(offsets, low, "right") - 1
            key = range_hashes(prefix, anchor, anchor + gram)
            span = mix(range_hashes(prefix, low, high + length) + (anchor - low).astype(np.uint64))
            at = pack(low - offsets[text], anchor - low, high - low)
            names = ["gram", "span", "k1", "k2", "at"]
            texts = pa.array(text)
            columns = [key.astype(np.int64), span.astype(np.int64), part.column(0).take(texts), part.column(1).take(texts), at]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return rows.mapInArrow(run, "gram bigint, span bigint, k1 bigint, k2 bigint, at bigint")


def common_extension(prefix, down, a, b, limit) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``limit``, by binary search."""
    low, high = np.zeros(len(a), np.int64), limit.copy()
    while (low < high).any():
        middle = (low + high + 1) >> 1
        same = (prefix[a + middle] - prefix[a]) * down[a] == (prefix[b + middle] - prefix[b]) * down[b]
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low


def sort_suffixes(raw: np.ndarray, group: np.ndarray, start: np.ndarray, room: np.ndarray):
    """(order, shared): suffixes by group, then bytes, and what each shares with the one before it.

    A merge sort in which two suffixes are compared by their common extension, found by hashes in
    a logarithm of its length, and by the byte after it. ``room`` is where each suffix ends. All
    pairs of runs are merged at once: the place of an element is its place in its own run and the
    number of elements of the other run that go before it.
    """
    prefix = prefix_hashes(raw)
    _, down = powers(len(prefix))
    padded = np.append(raw, 0).astype(np.int64)

    def shared(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return common_extension(prefix, down, start[i], start[j], np.minimum(room[i], room[j]))

    def below(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Suffix i goes before j; equal ones go by their number."""
        ext = shared(i, j)
        ends_i, ends_j = ext == room[i], ext == room[j]
        byte = padded[np.minimum(start[i] + ext, len(raw))] < padded[np.minimum(start[j] + ext, len(raw))]
        return np.where(ends_i | ends_j, np.where(ends_i & ends_j, i < j, ends_i), byte)

    order = np.argsort(group, kind="stable")
    bounds = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))
    size = np.diff(np.append(bounds, len(order)))
    base = np.repeat(bounds, size)  # where the group of each place begins
    size = np.repeat(size, size)
    run = 1
    while (size > run).any():
        place = np.flatnonzero(size > run)
        begin, end = base[place], base[place] + size[place]
        local = place - begin
        own = local // run
        other = np.minimum(begin + (own ^ 1) * run, end)
        low, high = other.copy(), np.minimum(other + run, end)
        while (todo := np.flatnonzero(low < high)).size:
            middle = (low[todo] + high[todo]) >> 1
            goes = below(order[middle], order[place[todo]])
            low[todo] = np.where(goes, middle + 1, low[todo])
            high[todo] = np.where(goes, high[todo], middle)
        merged = order.copy()
        merged[begin + own // 2 * 2 * run + local - own * run + low - other] = order[place]
        order = merged
        run *= 2
    ext = np.zeros(len(order), np.int64)
    if len(order) > 1:
        same = np.flatnonzero(group[order[1:]] == group[order[:-1]])
        ext[same + 1] = shared(order[same + 1], order[same])
    return order, ext


def neighbours(order: np.ndarray, ext: np.ndarray) -> np.ndarray:
    """Longest extension each suffix shares with any other of its group."""
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(ext, np.append(ext[1:], 0))
    return out


def repeated_windows(group, raw, offsets, back, more, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(span, window): windows of the spans whose bytes another span of the same group holds too.

    Sorting the anchors' suffixes forwards and backwards tells how far each agrees with any other
    span to the right and to the left. Only windows inside both extensions can be repeated; they
    are grouped by hash, and groups are verified byte by byte.
    """
    none = np.empty(0, np.int64)
    anchor = offsets[:-1] + back
    right = neighbours(*sort_suffixes(raw, group, anchor, offsets[1:] - anchor))
    total = len(raw)
    left = neighbours(*sort_suffixes(raw[::-1].copy(), group, total - anchor, back))
    first = np.maximum(back - left, 0)
    last = np.minimum(more, back + right - length)
    count = np.maximum(last - first + 1, 0)
    count[right < gram] = 0
    span = np.repeat(np.arange(len(back)), count)
    if not len(span):
        return none, none
    window = spread(first, count)
    at = offsets[span] + window
    prefix = prefix_hashes(raw)
    key = mix(range_hashes(prefix, at, at + length) ^ mix(group.astype(np.uint64))[span])
    order = np.argsort(key, kind="stable")
    key, span, window, at = key[order], span[order], window[order], at[order]
    same = key[1:] == key[:-1]
    for i in range(0, int(same.sum()), 4096):
        pairs = np.flatnonzero(same)[i : i + 4096]
        cells = np.arange(length)
        same[pairs] = (raw[at[pairs][:, None] + cells] == raw[at[pairs + 1][:, None] + cells]).all(axis=1)
    twice = np.append(same, False) | np.append(False, same)
    return span[twice], window[twice]


def resolve_groups(spans: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, start): repeated windows of the ambiguous spans, anchor group by anchor group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < SPANS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            key = np.array(rows.column("gram").combine_chunks())
            cut = int(np.flatnonzero(key == key[-1])[0])  # the last group may go on
            yield from portions(rows.slice(0, cut), key[:cut])
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            yield from portions(rows, np.array(rows.column("gram").combine_chunks()))

    def portions(rows: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole groups, as many together as have ``SPANS`` spans."""
        ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
        at = 0
        while at < len(key):
            to = int(ends[max(np.searchsorted(ends, at + SPANS, "right") - 1, np.searchsorted(ends, at, "right"))])
            yield from resolved(rows.slice(at, to - at))
            at = to

    def resolved(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        get = lambda c: np.array(rows.column(c).combine_chunks())
        offsets, raw = span_bytes(rows.column("bytes").combine_chunks())
        low, back, more = unpack(get("at"))
        span, window = repeated_windows(get("gram"), raw, offsets, back, more, length, gram)
        asked = get("alone")[span]
        span, window = span[asked], window[asked]
        if len(span):
            columns = [get("k1")[span], get("k2")[span], low[span] + window]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "start"])

    return spans.select("gram", "k1", "k2", "at", "alone", "bytes").mapInArrow(run, "k1 bigint, k2 bigint, start bigint")


def span_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], raw


def binned(spans: DataFrame, width: int, length: int) -> DataFrame:
    """Cut the windows first to last of each row into bins of ``width`` offsets from the anchor.

    ``inner`` hashes the bytes that all windows of the bin would share, ``outer`` all bytes of the
    windows that are there. Bins start at fixed offsets, so equal windows lie in equal bins.
    """
    columns = ["k1", "k2", "at", "asked", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                rows = batch.slice(i, 2000)
                offsets, raw = span_bytes(rows.column(4))
                _, back, _ = unpack(np.array(rows.column(2)))
                near, far = back - np.array(rows.column(6)), back - np.array(rows.column(5))  # offsets
                count = far // width - near // width + 1
                row = np.repeat(np.arange(rows.num_rows), count)
                cell = spread(near // width, count)
                low, high = np.maximum(near[row], cell * width), np.minimum(far[row], cell * width + width - 1)
                anchor = offsets[row] + back[row]
                prefix = prefix_hashes(raw)
                core = cell * width, cell * width + width - 1
                inner = range_hashes(prefix, anchor - core[0], anchor + length - core[1])
                outer = range_hashes(prefix, anchor - high, anchor + length - low)
                inner, outer = (mix(h + c.astype(np.uint64)) for h, c in ((inner, cell), (outer, low << 10 | high)))
                take = pa.array(row)
                cuts = [back[row] - high, back[row] - low, inner.astype(np.int64), outer.astype(np.int64)]
                fields = [rows.column(c).take(take) for c in range(5)] + [pa.array(c) for c in cuts]
                yield pa.RecordBatch.from_arrays(fields, [*columns, "first", "last", "inner", "outer"])

    schema = "k1 bigint, k2 bigint, at bigint, asked boolean, bytes binary, first bigint, last bigint, inner bigint, outer bigint"
    return spans.select(*columns, "first", "last").mapInArrow(run, schema)


def narrow(spans: DataFrame, length: int) -> DataFrame | None:
    """(k1, k2, start, last): repeated windows of spans around very frequent anchors, by counting.

    A bin whose outer bytes occur twice is repeated as a whole; one whose inner bytes occur once has
    nothing that is repeated; the others are cut into smaller bins, down to single windows. Of bins
    that are alike, one goes on, so that windows of other bins still find it.
    """
    found = None
    open_ = spans.select(
        "k1", "k2", "at", F.col("alone").alias("asked"), "bytes",
        F.lit(0).cast("long").alias("first"), F.col("at").bitwiseAND(1023).alias("last"),
    )
    for width in BINS:
        bins = freeze(binned(open_, width, length), "bins")
        if bins.isEmpty():
            break
        inner = freeze(
            bins.groupBy("inner").agg(F.count("*").alias("n"), F.max("asked").alias("any"))
            .where("n > 1 and any").select("inner"), "inner",
        )
        outer = freeze(
            bins.groupBy("outer").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at")).alias("one")).where("n > 1"),
            "outer",
        ).select("outer", "one")
        marked = freeze(bins.join(inner, "inner").join(outer, "outer", "left"), "bins")
        hits = marked.where("one is not null and asked").select(
            "k1", "k2", (F.shiftright("at", 20) + F.col("first")).alias("start"),
            (F.shiftright("at", 20) + F.col("last")).alias("last"),
        )
        found = hits if found is None else found.unionByName(hits)
        first = F.col("one").isNull() | (F.struct("k1", "k2", "at") == F.col("one"))
        open_ = marked.where(first).withColumn("asked", F.col("asked") & F.col("one").isNull())
    return found


def cut_spans(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` with the bytes of all windows of each anchor; a text is read once, of equal rows one."""
    keys = ["k1", "k2"]
    lists = wanted.groupBy(*keys).agg(F.collect_list(F.struct("gram", "n", "at", "alone")).alias("spans"))
    copied = freeze(rows.groupBy(*keys).count().where("count > 1").select(*keys), "copied")
    one = rows.join(copied, keys, "left_semi").groupBy(*keys).agg(F.first("text").alias("text"))
    rows = rows.join(copied, keys, "left_anti").unionByName(one)
    both = rows.join(lists, keys).select("k1", "k2", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 4 << 20):
            spans, n = batch.column(3).flatten(), np.array(batch.column(3).value_lengths())
            owner = np.repeat(np.arange(batch.num_rows), n)
            low, _, more = unpack(np.array(spans.field("at")))
            texts = [x.as_py().encode() for x in batch.column(2)]
            ranges = zip(owner.tolist(), low.tolist(), (low + more + length).tolist(), strict=True)
            cuts = pa.array([texts[i][a:b] for i, a, b in ranges], pa.binary())
            ids = [batch.column(c).take(pa.array(owner)) for c in (0, 1)]
            fields = [spans.field(c) for c in ("gram", "n", "at", "alone")]
            names = ["k1", "k2", "gram", "n", "at", "alone", "bytes"]
            yield pa.RecordBatch.from_arrays([*ids, *fields, cuts], names)

    return both.mapInArrow(run, "k1 bigint, k2 bigint, gram bigint, n bigint, at bigint, alone boolean, bytes binary")


def repeated_ranges(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    """(k1, k2, start, last, alone): ranges of repeated windows; alone marks anchors to be taken out.

    Rows with ``alone`` null are whole runs of windows; those with ``alone`` true name a run (by its
    first window) that is not repeated as a whole; those with false are its repeated windows.
    """
    rows = keyed(docs, id_col, text_col)
    found = anchor_rows(rows, length, gram)
    # tables of repeated keys are frozen before joins, which can then split what is skewed
    grams = found.groupBy("gram").agg(
        F.count("*").alias("n"), (F.min("span") == F.max("span")).alias("uniform")
    ).where("n > 1")
    grams = freeze(grams.select("gram", "uniform"), "grams")
    shared = freeze(found.join(grams, "gram"), "anchors")
    spans = (
        shared.where("not uniform").groupBy("gram", "span")
        .agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "at")).alias("one"))
        .select("gram", (F.col("c") == 1).alias("alone"), "one.*")
    )
    spans = freeze(spans, "spans")
    sizes = spans.groupBy("gram").agg(F.count("*").alias("n"), F.max("alone").alias("any")).where("any")
    wanted = spans.join(freeze(sizes.select("gram", "n"), "sizes"), "gram")
    cuts = freeze(cut_spans(rows, wanted, length), "cuts")
    small = cuts.where(F.col("n") <= GROUP)
    small = resolve_groups(small.repartition("gram").sortWithinPartitions("gram"), length, gram)
    starts = freeze(small.select("k1", "k2", "start", F.col("start").alias("last")), "windows")
    large = narrow(cuts.where(F.col("n") > GROUP), length)
    if large is not None:
        starts = starts.unionByName(large)
    low = F.shiftright("at", 20)
    more = F.col("at").bitwiseAND(1023)
    whole = shared.select("k1", "k2", low.alias("start"), (low + more).alias("last"), F.lit(None).cast("boolean").alias("alone"))
    out = spans.where("alone").select("k1", "k2", low.alias("start"), low.alias("last"), F.lit(True).alias("alone"))
    back = starts.select("k1", "k2", "start", "last", F.lit(False).alias("alone"))
    return whole.unionByName(out).unionByName(back).distinct()  # equal rows have equal ranges


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    as_text: bool = False,
) -> DataFrame:
    """Columns of ``docs`` and n_bytes, n_removed, n_spans and what is kept.

    What is kept is ``kept_bytes``, or with ``as_text`` the string ``kept_text``, in which a
    character that lost some of its bytes goes as a whole.

    Every byte that lies in a string of ``length`` bytes starting anywhere else too, in the same or
    another text, is removed; overlapping occurrences count, strings are judged on the input, and
    nothing matches across texts. Null texts count as empty; texts shorter than ``length`` stay
    whole. A row that is stored twice repeats itself, so all of it goes when it is long enough; ids
    need not be unique. A column with the name of a result is replaced.
    """
    kept_as = ("kept_text", "string") if as_text else ("kept_bytes", "binary")
    results = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), kept_as]
    names = [c for c in docs.columns if c.lower() not in dict(results)]
    docs = docs.select(*names)
    ranges = repeated_ranges(docs, id_col, text_col, length, gram)
    lists = ranges.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "last", "alone")).alias("r"))
    k1, k2, raw, cuts = (free_name(docs, c) for c in ("k1_", "k2_", "text_", "cuts_"))
    rows = docs.withColumns(dict(zip((k1, k2, raw), named(id_col, text_col), strict=True)))
    both = rows.join(
        lists.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("r").alias(cuts)), [k1, k2], "left"
    ).select(*names, raw, cuts)
    schema = docs.schema
    for name, kind in results:
        schema = schema.add(name, kind)
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, width, 8 << 20):
            out: list[list] = [[], [], [], []]
            texts, lists = batch.column(width), batch.column(width + 1)
            for i in range(batch.num_rows):
                data = texts[i].as_py().encode()
                values = lists[i].values
                spans = removed(values, length) if values is not None and len(values) else []
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                whole = b"".join(kept)
                out[0].append(len(data))
                out[1].append(len(data) - len(whole))
                out[2].append(len(spans))
                out[3].append(whole.decode("utf-8", "ignore") if as_text else whole)
            last = pa.array(out[3], pa.string() if as_text else pa.binary())
            columns = [*batch.columns[:width], *[pa.array(c, pa.int64()) for c in out[:3]], last]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return both.mapInArrow(run, schema)


def removed(values: pa.StructArray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by repeated windows."""
    start, last = np.array(values.field("start")), np.array(values.field("last"))
    alone = values.field("alone")
    marked = np.array(alone.fill_null(False))
    whole = np.array(alone.is_null()) & ~np.isin(start, start[marked])
    keep = whole | np.array(alone.is_valid()) & ~marked
    start, last = start[keep], last[keep] + length
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, last = start[order], np.maximum.accumulate(last[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > last[:-1]
    first = np.flatnonzero(new)
    return list(zip(start[first].tolist(), last[np.append(first[1:], len(start)) - 1].tolist(), strict=True))


def digest(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs.select("doc_id", "text")).drop("text")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and n_chars, if there, counted anew.

    Rows whose text loses nothing, null texts among them, are left as they are.
    """
    out = remove_repeats(docs, as_text=True)
    cut = F.col("n_removed") > 0
    out = out.withColumn("text", F.when(cut, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
