"""Spelling variants: words one letter apart, found in a trie of letter-group counts.

A word is described by how often each group of letters occurs in it. An inserted, deleted or replaced
letter changes these counts by a surplus of one and a deficit of one at most, so the words near a
given one lie on few paths of a trie whose levels are successive counts. The top of the trie is
spread over the cluster: a word is at home in the subtree of its own counts over large groups and
visits those that the budget allows. In each subtree all words descend the trie together.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import freeze, slices, spread, text_bytes
from assetlake.llm.words import lower_ascii, runs
from assetlake.session import cut

LEAST_LETTERS, LEAST_COUNT = 7, 2
DROP_EVERY = 31
FORM_TIMES = 10
#: Letter groups, the levels of the trie; and how many parts they form in the subtrees tried one after the other.
GROUPS = 32
PARTS = (4, 8, 16)
#: Words at home in a subtree beyond which it is split by the counts of smaller parts.
SUBTREE = 1 << 14
#: Different words a task counts before it passes them on, and rows that descend the trie together.
HELD, ROWS = 300_000, 1 << 16
#: Pairs of words below two nodes from which on they are compared directly; pairs verified at once.
FEW, PAIRS = 16, 1 << 18
_CAP = (1 << 16) - 1  # a larger count is taken as this in keys, where it only merges subtrees


def count_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n): all words of enough letters and occurrences, after one letter of some was dropped.

    A word is a run of Latin letters up to U+00FF with A to Z in lower case. Where the crc32 of
    ``<id>:<word>`` is divisible by 31, the letter at crc32 modulo length is left out. A null id
    counts as empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for part in slices(batches, 1):
            offsets, raw = text_bytes(part.column(1))
            raw = lower_ascii(raw)
            lead = raw == 0xC3  # the letters from U+00C0 on are this and one more byte
            inside = ((raw >= 97) & (raw <= 122)) | lead
            inside[1:] |= lead[:-1]
            start, end, first = runs(inside, offsets)
            leads = np.concatenate(([0], np.cumsum(lead)))
            long = end - start - (leads[end] - leads[start]) >= LEAST_LETTERS
            first = np.concatenate(([0], np.cumsum(long)))[first]
            data = raw.tobytes()
            words = [data[a:b] for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
            for doc, a, b in zip(part.column(0).to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                seed = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for k in range(a, b):
                    h = zlib.crc32(words[k], seed)
                    if h % DROP_EVERY == 0:
                        word = words[k].decode()
                        at = h % len(word)
                        words[k] = (word[:at] + word[at + 1 :]).encode() if len(word) > LEAST_LETTERS else b""
            held.update(words)
            if len(held) > HELD:
                yield batch(held)
                held = Counter()
        if held:
            yield batch(held)

    def batch(held: Counter[bytes]) -> pa.RecordBatch:
        held.pop(b"", None)
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_groups(words: DataFrame) -> np.ndarray:
    """Group of each letter (a byte of Latin-1): by falling frequency, the groups spread over the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            _, raw = letters(batch.column(0))
            total += np.bincount(raw, minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["letter", "n"])

    total = np.zeros(256, np.int64)
    for r in words.select("word").mapInArrow(run, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        total[r["letter"]] = r["n"]
    bits = GROUPS.bit_length() - 1
    turned = np.array([int(f"{g:0{bits}b}"[::-1], 2) for g in range(GROUPS)])
    out = np.empty(256, np.int64)
    out[np.argsort(-total, kind="stable")] = turned[np.arange(256) % GROUPS]
    return out


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, letters) of words, one byte a letter: Latin-1 holds all of them."""
    offsets, raw = text_bytes(column)
    follows = np.zeros(len(raw), bool)
    follows[1:] = raw[:-1] == 0xC3
    out = np.where(follows, raw + 64, raw)[raw != 0xC3]
    gone = np.concatenate(([0], np.cumsum(raw == 0xC3)))
    return offsets - gone[offsets], out


def vectors(offsets: np.ndarray, raw: np.ndarray, group: np.ndarray) -> np.ndarray:
    """(words, GROUPS): how many letters of each group."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(owner * GROUPS + group[raw], minlength=n * GROUPS).reshape(n, GROUPS)


def steps(parts: int) -> np.ndarray:
    """Changes of the part counts within the budget that lead to a later subtree.

    Subtrees are ordered by the counts of the largest parts, then of smaller ones, so that a subtree
    that is split comes after the same ones as before.
    """
    unit = np.eye(parts, dtype=np.int64)
    every = [*unit, *-unit, *[a - b for i, a in enumerate(unit) for j, b in enumerate(unit) if i != j]]

    def rank(step: np.ndarray) -> list:
        return [step.reshape(p, -1).sum(axis=1).tolist() for p in PARTS if p <= parts]

    zero = rank(np.zeros(parts, np.int64))
    return np.array([s for s in every if rank(s) > zero])


def keys_of(counts: np.ndarray, parts: int) -> np.ndarray:
    """Keys of subtrees as rows of bytes: the part counts, capped."""
    return np.minimum(counts, _CAP).astype(">u2").view(np.uint8).reshape(len(counts), parts * 2)


def binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    bounds = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width).buffers()[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, bounds, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def routed(words: DataFrame, group: np.ndarray, split: list[set[bytes]]) -> DataFrame:
    """(key, home, word, n): every word in its own subtree, and as a visitor in later ones within the budget.

    ``split`` has, for each size of parts, the keys of subtrees that are replaced by smaller ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                vector = vectors(*letters(part.column(0)), group)
                for level, parts in enumerate(PARTS):
                    own = np.minimum(vector.reshape(len(vector), parts, -1).sum(axis=2), _CAP)
                    moves = np.vstack([np.zeros((1, parts), np.int64), steps(parts)])
                    target = (own[:, None, :] + moves[None]).reshape(-1, parts)
                    row, move = np.divmod(np.arange(len(target)), len(moves))
                    keep = ((target >= 0) & (target <= _CAP)).all(axis=1)
                    for above in range(level):
                        key = keys_of(target.reshape(len(target), PARTS[above], -1).sum(axis=2), PARTS[above])
                        keep &= member(key, split[above])
                    key = keys_of(target, parts)
                    if level < len(split):
                        keep &= ~member(key, split[level])
                    keep = np.flatnonzero(keep)
                    if len(keep):
                        take = pa.array(row[keep])
                        columns = [binary(key[keep]), pa.array(move[keep] == 0), part.column(0).take(take), part.column(1).take(take)]
                        yield pa.RecordBatch.from_arrays(columns, ["key", "home", "word", "n"])
                    if level >= len(split) or not split[level]:
                        break

    return words.select("word", "n").mapInArrow(run, "key binary, home boolean, word string, n long")


def member(keys: np.ndarray, known: set[bytes]) -> np.ndarray:
    if not known:
        return np.zeros(len(keys), bool)
    return np.fromiter((k.tobytes() in known for k in keys), bool, len(keys))


def large_subtrees(words: DataFrame, group: np.ndarray, most: int) -> list[set[bytes]]:
    """For each size of parts but the last the keys that more than ``most`` words call home: at most words / most."""
    out: list[set[bytes]] = []
    for _ in PARTS[:-1]:
        at_home = routed(words, group, out).where("home").where(F.length("key") == 2 * PARTS[len(out)])
        big = at_home.groupBy("key").count().where(F.col("count") > most).select("key").collect()
        out.append({bytes(r["key"]) for r in big})
        if not big:
            break
    return out


def descend(vector: np.ndarray, root: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): pairs of rows below the same root whose counts differ by one surplus and one deficit at most.

    Rows are sorted by root, then counts; i is at home, j is a visitor or a later row at home. Pairs of
    nodes go down level by level as long as the budget of the way to them is not overspent; depth first, in
    portions, so that memory stays bounded. Few words below a pair of nodes are compared directly.
    """
    left = np.flatnonzero(home)
    sides = []
    for rows in (left, np.arange(len(root))):
        own, top = vector[rows], root[rows]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = top[1:] != top[:-1]
        levels = [np.append(np.flatnonzero(fresh), len(rows))]  # where each node begins
        child = []
        for k in range(GROUPS):
            fresh[1:] |= own[1:, k] != own[:-1, k]
            levels.append(np.append(np.flatnonzero(fresh), len(rows)))
            child.append(np.searchsorted(levels[-1], levels[-2]))  # first child of each node and the end
        sides.append((rows, own, levels, child))
    (lrows, lown, llevels, lchild), (rrows, rown, rlevels, rchild) = sides
    if not len(left):
        return
    ltop, rtop = root[lrows[llevels[0][:-1]]], root[rrows[rlevels[0][:-1]]]
    start = np.searchsorted(rtop, ltop)
    one = np.ones(len(ltop), np.int8)
    stack = [(0, np.arange(len(ltop)), start, one, one)]
    while stack:
        level, x, y, more, less = stack.pop()
        if len(x) > PAIRS:
            half = len(x) // 2
            stack += [(level, *(v[half:] for v in (x, y, more, less))), (level, *(v[:half] for v in (x, y, more, less)))]
            continue
        nx, ny = (lv[level][n + 1] - lv[level][n] for lv, n in ((llevels, x), (rlevels, y)))
        small = (nx * ny <= FEW) if level < GROUPS else np.ones(len(x), bool)
        at = np.flatnonzero(small)
        sizes = nx[at] * ny[at]
        ends = np.cumsum(sizes)
        for k in portions(ends, PAIRS):  # word pairs below small nodes
            own = at[k]
            place = spread(np.zeros(len(own), np.int64), sizes[k])
            wide = np.repeat(ny[own], sizes[k])
            i = lrows[np.repeat(llevels[level][x[own]], sizes[k]) + place // wide]
            j = rrows[np.repeat(rlevels[level][y[own]], sizes[k]) + place % wide]
            keep = (i < j) | ~home[j]
            i, j = i[keep], j[keep]
            gap = vector[i] - vector[j]
            near = (np.maximum(gap, 0).sum(axis=1) <= 1) & (np.maximum(-gap, 0).sum(axis=1) <= 1)
            yield i[near], j[near]
        at = np.flatnonzero(~small)
        if not len(at):
            continue
        x, y, more, less = x[at], y[at], more[at], less[at]
        cx, cy = (ch[level][n + 1] - ch[level][n] for ch, n in ((lchild, x), (rchild, y)))
        sizes = cx * cy
        place, wide = spread(np.zeros(len(x), np.int64), sizes), np.repeat(cy, sizes)
        x = np.repeat(lchild[level][x], sizes) + place // wide
        y = np.repeat(rchild[level][y], sizes) + place % wide
        gap = lown[llevels[level + 1][x], level] - rown[rlevels[level + 1][y], level]
        more, less = np.repeat(more, sizes) - np.maximum(gap, 0), np.repeat(less, sizes) - np.maximum(-gap, 0)
        keep = np.flatnonzero((more >= 0) & (less >= 0))
        stack.append((level + 1, x[keep], y[keep], more[keep], less[keep]))


def portions(ends: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of items, whose sizes sum up to ``ends``, of at most ``most`` together or one item."""
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, done + most, "right")), at + 1)
        yield slice(at, to)
        at = to


def one_apart(offsets: np.ndarray, raw: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether exactly one inserted, deleted or replaced letter tells the words i and j apart."""
    length = np.diff(offsets)
    swap = length[i] < length[j]
    a, b = np.where(swap, j, i), np.where(swap, i, j)  # a is the longer one
    gap = length[a] - length[b]
    out = gap <= 1
    order = np.flatnonzero(out)
    order = order[np.argsort(length[a[order]], kind="stable")]
    for k in portions(np.cumsum(length[a[order]] + 1), 1 << 22):  # words of alike lengths together
        own = order[k]
        width = int(length[a[own]].max()) + 1
        cells = np.arange(width)
        first, second = (
            np.where(cells < length[w][:, None], raw[np.minimum(offsets[w][:, None] + cells, len(raw) - 1)], 0)
            for w in (a[own], b[own])
        )
        differ = first != second
        same_length = differ.sum(axis=1) == 1
        at = np.argmax(differ, axis=1)  # the first difference; the longer word goes on one letter later
        shifted = first[:, 1:] != second[:, :-1]
        rest = (shifted & (cells[:-1] >= at[:, None])).any(axis=1)
        out[own] = np.where(gap[own] == 0, same_length, differ.any(axis=1) & ~rest)
    return out


def near_words(subtrees: DataFrame, group: np.ndarray) -> DataFrame:
    """(word, n_near, best): how many near words of each word a task met, and of those the most frequent.

    ``best`` is the pair of minus n and the word, so the least one is wanted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS:
                rows = pa.Table.from_batches(held).combine_chunks()
                key = rows.column("key").combine_chunks()
                last = key[len(key) - 1]
                whole = int(np.flatnonzero(np.array(pc.equal(key, last)))[0])  # the last subtree may go on
                if whole:
                    yield from met(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
                size = rows.num_rows - whole
        if held:
            yield from met(pa.Table.from_batches(held))

    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        root = np.array(rows.column("key").combine_chunks().dictionary_encode().indices)
        words = rows.column("word").combine_chunks()
        offsets, raw = letters(words)
        vector = vectors(offsets, raw, group).astype(np.int32)
        home = np.array(rows.column("home").combine_chunks())
        order = np.lexsort([*vector.T[::-1], root])
        one, two = [], []
        for i, j in descend(vector[order], root[order], home[order]):
            i, j = order[i], order[j]
            near = one_apart(offsets, raw, i, j)
            one.append(i[near])
            two.append(j[near])
        if not one or not sum(map(len, one)):
            return
        i, j = np.concatenate(one), np.concatenate(two)
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
        n = np.array(rows.column("n").combine_chunks())
        rank = np.empty(len(words), np.int64)
        rank[np.array(pc.sort_indices(words))] = np.arange(len(words))
        order = np.lexsort((rank[j], -n[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
        best = pa.StructArray.from_arrays([pa.array(-n[j[first]]), words.take(pa.array(j[first]))], ["less", "form"])
        count = pa.array(np.diff(np.append(first, len(i))))
        yield pa.RecordBatch.from_arrays([words.take(pa.array(i[first])), count, best], ["word", "n_near", "best"])

    schema = "word string, n_near long, best struct<less:long,form:string>"
    sorted_rows = subtrees.repartition("key").sortWithinPartitions("key")
    found = sorted_rows.mapInArrow(run, schema)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of forms end, by doubling; n grows tenfold at each step, so there is no cycle."""
    point = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        up = point.select(F.col("word").alias("root"), F.col("root").alias("above"))
        further = cut(point.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), "above"))
        point = further.select("word", "root")
        if further.where("above is not null").isEmpty():
            return point


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word that occurs often enough.

    Null and empty texts have no words; repeated rows count again. Near words are one inserted, deleted
    or replaced letter apart. The form is the near word of largest n, the first in code-point
    order among equals, if that n is at least ten times the word's own. Each pair of near words meets in
    one subtree only, that of the later word.
    """
    words = freeze(count_words(docs, id_col, text_col), "words")
    group = letter_groups(words)
    subtrees = routed(words, group, large_subtrees(words, group, SUBTREE))
    near = near_words(subtrees, group)
    frequent = -F.col("best")["less"] >= FORM_TIMES * F.col("n")
    all_words = freeze(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(frequent, F.col("best")["form"]).alias("form"),
            F.when(frequent, -F.col("best")["less"]).alias("form_n"),
        ), "near-words",
    )
    ends = roots(all_words.where("form is not null"))
    return all_words.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def digest(docs: DataFrame) -> DataFrame:
    return variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


_POLYNOMIAL = 0xEDB88320  # of crc32, reflected
DIGEST_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, {_POLYNOMIAL}) ELSE a >> 1 END, i)
    ORDER BY i) AS crc FROM range(256) r(i)),
o AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS w
  FROM documents),
d AS (SELECT doc_id, w, count(*) AS c FROM o WHERE length(w) >= {LEAST_LETTERS} GROUP BY ALL),
h AS (
  SELECT w, c, xor(list_reduce(
    flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''), lambda x: CASE WHEN ord(x) < 128
      THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END)),
    lambda a, b: xor(t.crc[1 + (xor(a, b) & 255)], a >> 8), 4294967295), 4294967295) AS h
  FROM d, t),
m AS (
  SELECT CASE WHEN h % {DROP_EVERY} = 0
    THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM h),
v AS (
  SELECT word, sum(c)::BIGINT AS n FROM m WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}),
x AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, x.n, v.word, v.n FROM x JOIN v ON x.less = v.word
  UNION SELECT v.word, v.n, x.word, x.n FROM x JOIN v ON x.less = v.word),
y AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n
  FROM p GROUP BY word, n),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {FORM_TIMES} * v.n THEN best END AS form,
    CASE WHEN best_n >= {FORM_TIMES} * v.n THEN best_n END AS form_n
  FROM v LEFT JOIN y USING (word)),
r AS (
  SELECT word, word AS at, form AS next FROM f
  UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.next)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.next IS NULL
"""
