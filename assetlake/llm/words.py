"""Runs of bytes as words: where they stand in a batch of texts, and what names them."""

from __future__ import annotations

import hashlib

import numpy as np

from assetlake.llm.common import spread

_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Longer runs are named one by one by a digest.
_LONG = 256


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """``raw`` with A to Z, and nothing else, in lower case."""
    return np.where((raw >= 65) & (raw <= 90), raw | 32, raw)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): maximal runs of marked bytes within texts; first run of each text and the end."""
    if not len(inside):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def names(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, the same wherever the bytes stand.

    Blocks of eight bytes go through a mixing round each, so that no family of strings collides by
    construction, as it does under polynomials modulo a power of two.
    """
    length = end - start
    out = mix(length.astype(np.uint64) + _GOLD)
    if not len(start):
        return out
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(8, np.uint8)]), 8)
    todo, at = np.flatnonzero((length > 0) & (length <= _LONG)), 0
    while len(todo):
        left = length[todo] - at
        block = np.ascontiguousarray(eight[start[todo] + at]).view("<u8")[:, 0].astype(np.uint64)
        short = left < 8
        block[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
        out[todo] = mix((out[todo] ^ block) + _GOLD)
        at += 8
        todo = todo[left > 8]
    for i in np.flatnonzero(length > _LONG).tolist():
        digest = hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def alike(raw: np.ndarray, start: np.ndarray, length: np.ndarray, other: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bytes of ``raw`` from each start on are those of ``other`` from each place on."""
    differ = raw[spread(start, length)] != other[spread(place, length)]
    wrong = np.concatenate(([0], np.cumsum(differ)))
    ends = np.cumsum(length)
    return wrong[ends] == wrong[ends - length]
