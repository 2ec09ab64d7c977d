"""Small 8-bit PNG codec and resampler for payload tasks.

The resampler and the encoder are arguments of the jobs that use them; these are the defaults.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _chunks(data: bytes):
    at = len(SIGNATURE)
    while at + 8 <= len(data):
        (length,) = struct.unpack(">I", data[at : at + 4])
        yield data[at + 4 : at + 8], data[at + 8 : at + 8 + length]
        at += 12 + length


def dimensions(data: bytes) -> tuple[int, int]:
    return struct.unpack(">II", data[16:24])


def _unfilter(raw: np.ndarray, filters: np.ndarray, step: int) -> np.ndarray:
    """Undo the row filters along anti-diagonals, all rows at once."""
    rows, width = raw.shape
    pixels = width // step
    out = np.zeros((rows + 1, pixels + 1, step), dtype=np.int32)
    src = raw.reshape(rows, pixels, step)
    r_all = np.arange(rows)
    for d in range(rows + pixels - 1):
        r = r_all[max(0, d - pixels + 1) : min(rows, d + 1)]
        c = d - r
        left, up, corner = out[r + 1, c], out[r, c + 1], out[r, c]
        kind = filters[r][:, None]
        guess = left + up - corner
        a, b, e = abs(guess - left), abs(guess - up), abs(guess - corner)
        paeth = np.where((a <= b) & (a <= e), left, np.where(b <= e, up, corner))
        pred = np.select(
            [kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) // 2, paeth], 0
        )
        out[r + 1, c + 1] = (src[r, c] + pred) & 255
    return out[1:, 1:]


def decode_rgb(data: bytes) -> np.ndarray:
    """(height, width, 3) uint8 of a non-interlaced PNG with 8 or 16 bits per sample."""
    if not data.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    body, palette, head = [], None, None
    for kind, chunk in _chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(chunk)
    width, height, bits, color, _, _, interlace = head
    if interlace or bits not in (8, 16) or (color == 3 and bits != 8):
        raise ValueError(f"unsupported PNG: {bits} bits, colour type {color}, interlace {interlace}")
    n = SAMPLES[color]
    step = n * bits // 8
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, 1 + width * step)
    filters = raw[:, 0]
    if (filters == 0).all():
        px = raw[:, 1:].reshape(height, width, step)
    else:
        px = _unfilter(raw[:, 1:].astype(np.int32), filters, step).astype(np.uint8)
    if bits == 16:
        px = px[:, :, ::2]
    if color == 3:
        return palette[px[:, :, 0]]
    if n <= 2:
        return np.repeat(px[:, :, :1], 3, axis=2)
    return np.ascontiguousarray(px[:, :, :3])


def encode_rgb(px: np.ndarray) -> bytes:
    """PNG of (height, width, 3) uint8 rows."""
    height, width, _ = px.shape
    raw = np.zeros((height, 1 + width * 3), np.uint8)
    raw[:, 1:] = px.reshape(height, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        crc = zlib.crc32(kind + body)
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", crc)

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    data = zlib.compress(raw.tobytes(), 6)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", data) + chunk(b"IEND", b"")


def fit(width: int, height: int, px: int) -> tuple[int, int]:
    """Largest size inside px × px that keeps the aspect ratio as well as whole pixels allow."""
    aspect = width / height

    def nearest(x: float, error) -> int:
        lo, hi = int(np.floor(x)), int(np.ceil(x))
        return max(lo if error(lo) <= error(hi) else hi, 1)

    if aspect <= 1:
        return nearest(px * aspect, lambda n: abs(aspect - n / px)), px
    return px, nearest(px / aspect, lambda n: abs(aspect - px / n) if n else 0)


def _weights(src: int, dst: int, lobes: int = 3) -> np.ndarray:
    scale = src / dst
    support = lobes * max(scale, 1.0)
    centre = (np.arange(dst) + 0.5) * scale
    x = (np.arange(src) + 0.5)[None, :] - centre[:, None]
    t = x / max(scale, 1.0)
    w = np.where(np.abs(x) < support, np.sinc(t) * np.sinc(t / lobes), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def lanczos(px: np.ndarray, width: int, height: int) -> np.ndarray:
    """Separable windowed-sinc shrink."""
    a = np.einsum("wx,hxc->hwc", _weights(px.shape[1], width), px.astype(np.float64), optimize=True)
    a = np.clip(np.rint(a), 0, 255)
    b = np.einsum("hy,ywc->hwc", _weights(px.shape[0], height), a, optimize=True)
    return np.clip(np.rint(b), 0, 255).astype(np.uint8)


def shrink(data: bytes, px: int) -> bytes:
    """``data`` itself when both edges fit into ``px``, otherwise an RGB PNG shrunk to fit."""
    width, height = dimensions(data)
    if width <= px and height <= px:
        if not data.startswith(SIGNATURE):
            raise ValueError("not a PNG")
        return data
    return encode_rgb(lanczos(decode_rgb(data), *fit(width, height, px)))
