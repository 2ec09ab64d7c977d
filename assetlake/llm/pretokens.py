"""Pre-tokens of whole batches at once, and their ids from a bounded store.

The public pattern for byte-level vocabularies (contractions, an optional space before letters,
digits or other signs, white space) is applied to arrays of code points: a token starts where the
class of the character changes. Equal pre-tokens are encoded once per batch and kept in the store.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from assetlake.llm.common import spread, text_bytes
from assetlake.llm.words import alike, mix, names

OTHER, LETTER, NUMBER, SPACE = range(4)
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BASE = 0x9E3779B97F4A7C15 | 1


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point, from the general categories L* and N* and White_Space."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8
    )
    out[WHITE] = SPACE
    return out


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(BASE ** i, BASE ** -i) modulo 2 ** 64 for i up to n."""
    if len(_powers.get("up", ())) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        for key, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[key] = np.cumprod(table)
    return _powers["up"], _powers["down"]


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] the polynomial of raw[i:j], times BASE ** i, modulo 2 ** 64."""
    up, _ = powers(len(raw))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range, the same wherever the bytes stand."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def split(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token bounds in bytes, first token of each text) of the texts between ``offsets``."""
    if not len(raw):
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each code point
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    bounds = np.searchsorted(at, offsets)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    kind = classes()[points]
    space = kind == SPACE
    fresh = first[:n].copy()
    fresh[1:] |= kind[1:] != kind[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = points[:-1] == 32
    after_blank &= ~first[:n]
    starts = fresh & (space | ~after_blank)
    starts[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]  # the last white space before a word
    for i in np.flatnonzero((points == 39) & starts):
        tail = points[i + 1 : i + 3]
        for k, ends in ((1, "stmd"), (2, ("re", "ve", "ll"))):
            if len(tail) >= k and not first[i + 1 : i + 1 + k].any():
                if "".join(map(chr, tail[:k])) in ends:
                    starts[i + 1] = False
                    if i + 1 + k < n:
                        starts[i + 1 + k] = True
                    break
    tokens = np.flatnonzero(starts)
    return np.append(at[tokens], len(raw)), np.searchsorted(tokens, bounds)


class Store:
    """Ids of pre-tokens, by a 64-bit name of their bytes; emptied when it holds ``most`` of them.

    ``encode`` gives the ids of a list of pre-tokens. The bytes are kept beside the ids and compared:
    a pre-token whose name leads to other bytes is encoded by itself.
    """

    def __init__(self, encode: Callable[[list[bytes], np.ndarray], list[list[int]]], most: int = 600_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.start, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.raw = np.empty(0, np.uint8)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return place, self.keys[place] == keys

    def add(self, keys: np.ndarray, tokens: list[bytes]) -> None:
        start, count, ids = flat_ids(self.encode(tokens, keys))
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.start = np.concatenate([self.start, start + len(self.ids)])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.ids = np.concatenate([self.ids, ids])
        self.at = np.concatenate([self.at, len(self.raw) + np.cumsum(size) - size])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(tokens), np.uint8)])

    def encode_texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and the end)."""
        offsets, raw = text_bytes(column)
        bounds, first = split(offsets, raw)
        start, length = bounds[:-1], np.diff(bounds)
        hashes = names(raw, start, bounds[1:])
        keys, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        _, known = self.find(keys)
        data = raw.tobytes()
        if not known.all():
            new = np.flatnonzero(~known)
            if len(self.keys) + len(new) > self.most:
                self.clear()
                new = np.arange(len(keys))
            self.add(keys[new], [data[start[i] : start[i] + length[i]] for i in sample[new]])
        place = self.find(keys)[0][inverse]
        count, begin, ids = self.count[place], self.start[place], self.ids
        same = self.size[place] == length
        same[same] = alike(raw, start[same], length[same], self.raw, self.at[place[same]])
        if not same.all():  # other bytes of the same name
            odd = np.flatnonzero(~same)
            own, own_count, own_ids = flat_ids(self.encode([data[start[i] : start[i] + length[i]] for i in odd], hashes[odd]))
            begin[odd], count[odd] = own + len(ids), own_count
            ids = np.concatenate([ids, own_ids])
        total = np.concatenate(([0], np.cumsum(count)))
        return ids[spread(begin, count)], total[np.minimum(first, len(count))]


def flat_ids(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, count, all ids) of lists of ids."""
    count = np.fromiter(map(len, found), np.int64, len(found))
    ids = np.fromiter((x for one in found for x in one), np.uint32, int(count.sum()))
    return np.cumsum(count) - count, count, ids
