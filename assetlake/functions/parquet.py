"""Parquet files of many row groups, written and read with memory that does not grow with their number.

A footer names every column chunk of every row group, and the usual libraries keep all of them as objects. Here the
entry of a row group is encoded when its row is written, and a large footer is read in portions of row groups.
"""

from __future__ import annotations

import io
import tempfile
import zlib
from collections.abc import Iterator

import pyarrow.parquet as pq
from pyspark.sql import types as T

MAGIC = b"PAR1"
#: Footers from this size on are read in portions.
FOOTER_BYTES = 4 * 1024 * 1024
#: Encoded row groups of a portion; those of a file being written that stay in memory.
PORTION_BYTES = 1024 * 1024
#: Statistics of longer values are left out.
STATISTICS_BYTES = 4096

# Kinds of the compact Thrift protocol.
_TRUE, _FALSE, _BYTE, _DOUBLE, _BINARY, _LIST, _SET, _MAP, _STRUCT = 1, 2, 3, 7, 8, 9, 10, 11, 12


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _int(n: int) -> bytes:
    return _varint(n << 1 if n >= 0 else (-n << 1) - 1)


def _text(value: bytes) -> bytes:
    return _varint(len(value)) + value


def _list(n: int, kind: int) -> bytes:
    return bytes([n << 4 | kind]) if n < 15 else bytes([0xF0 | kind]) + _varint(n)


#: A definition level for a value that is there, and for one that is null.
_THERE, _NULL = b"\x02\0\0\0\x02\x01", b"\x02\0\0\0\x02\0"
_PAGE_END = b"\x1c\x15\x02\x15\0\x15\x06\x15\x06\0\0"  # one value, plain, levels as runs


class RowGroupWriter:
    """Rows written as row groups of their own: plain pages without compression, all columns optional.

    ``statistics`` are the columns whose value is kept as minimum and maximum; nulls are counted in all.
    """

    def __init__(self, out, schema: T.StructType, statistics: set[str], metadata: dict[str, str] | None = None):
        self.out, self.schema, self.metadata = out, schema, metadata or {}
        self.columns = []
        for f in schema.fields:
            whole = isinstance(f.dataType, T.IntegerType)
            if not whole and not isinstance(f.dataType, T.StringType | T.BinaryType):
                raise TypeError(f"{f.name} is {f.dataType.simpleString()}")
            path = b"\x19\x18" + _text(f.name.encode())
            head = b"\x15" + _int(1 if whole else 6) + b"\x19\x25\0\x06" + path + b"\x15\0\x16\x02"
            self.columns.append((whole, isinstance(f.dataType, T.StringType), f.name in statistics, head))
        self.groups = tempfile.SpooledTemporaryFile(max_size=PORTION_BYTES)
        self.rows, self.at = 0, len(MAGIC)
        out.write(MAGIC)

    def write(self, row: tuple) -> None:
        entries, start = [], self.at
        for (whole, text, ranked, head), value in zip(self.columns, row, strict=True):
            if value is None:
                data, body = b"", _NULL
            elif whole:
                data = value.to_bytes(4, "little", signed=True)
                body = _THERE + data
            else:
                data = value.encode() if text else value
                body = _THERE + len(data).to_bytes(4, "little")
            tail = b"" if value is None or whole else data
            n = len(body) + len(tail)
            if n >= 1 << 31:
                raise ValueError(f"a value of {len(data)} bytes does not fit a page")
            crc = zlib.crc32(tail, zlib.crc32(body))
            crc -= (crc & 1 << 31) << 1
            page = b"\x15\0" + 2 * (b"\x15" + _int(n)) + b"\x15" + _int(crc) + _PAGE_END
            self.out.write(page + body)
            if tail:
                self.out.write(tail)
            place, size = _int(self.at), b"\x16" + _int(len(page) + n)
            known = b"\x36" + _int(int(value is None))
            if ranked and value is not None and 2 * len(data) < STATISTICS_BYTES:
                known += b"\x28" + _text(data) + b"\x18" + _text(data)
            entries.append(b"\x26" + place + b"\x1c" + head + size + size + b"\x26" + place + b"\x3c" + known + b"\0\0\0")
            self.at += len(page) + n
        size = _int(self.at - start)
        whole_group = b"\x19" + _list(len(entries), _STRUCT) + b"".join(entries)
        self.groups.write(whole_group + b"\x16" + size + b"\x16\x02\x26" + _int(start) + b"\x16" + size + b"\0")
        self.rows += 1

    def close(self) -> None:
        """Write the footer."""
        fields = self.schema.fields
        root = b"\x48" + _text(b"spark_schema") + b"\x15" + _int(len(fields)) + b"\0"
        leaves = []
        for f, (whole, text, _, _) in zip(fields, self.columns, strict=True):
            kind = b"\x25\0\x4c\x1c\0\0" if text else b""
            leaves.append(b"\x15" + _int(1 if whole else 6) + b"\x25\x02\x18" + _text(f.name.encode()) + kind + b"\0")
        head = b"\x15\x02\x19" + _list(1 + len(leaves), _STRUCT) + root + b"".join(leaves)
        head += b"\x16" + _int(self.rows) + b"\x19" + _list(self.rows, _STRUCT)
        pairs = [b"\x18" + _text(k.encode()) + b"\x18" + _text(v.encode()) + b"\0" for k, v in self.metadata.items()]
        tail = b"\x19" + _list(len(pairs), _STRUCT) + b"".join(pairs)
        tail += b"\x18" + _text(b"assetlake") + b"\x19" + _list(len(fields), _STRUCT) + len(fields) * b"\x1c\0\0" + b"\0"
        n = len(head) + self.groups.tell() + len(tail)
        if n >= 1 << 31:
            raise ValueError(f"a footer of {n} bytes, of {self.rows} rows")
        self.out.write(head)
        self.groups.seek(0)
        while block := self.groups.read(PORTION_BYTES):
            self.out.write(block)
        self.out.write(tail + n.to_bytes(4, "little") + MAGIC)
        self.discard()

    def discard(self) -> None:
        self.groups.close()


def _varint_at(buf: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = buf[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _skip(buf: bytes, at: int, kind: int) -> int:
    """Place after the value of ``kind`` that begins at ``at``; it may lie beyond the end of ``buf``."""
    if 4 <= kind <= 6:
        while buf[at] > 127:
            at += 1
        return at + 1
    if kind == _BINARY:
        n, at = _varint_at(buf, at)
        return at + n
    if kind == _STRUCT:
        while head := buf[at]:
            at += 1
            if head < 16:  # the number of the field stands by itself
                at = _skip(buf, at, 4)
            at = _skip(buf, at, head & 15)
        return at + 1
    if kind in (_LIST, _SET):
        n, inner, at = _list_at(buf, at)
        for _ in range(n):
            at = at + 1 if inner in (_TRUE, _FALSE) else _skip(buf, at, inner)
        return at
    if kind in (_TRUE, _FALSE):
        return at
    if kind in (_BYTE, _DOUBLE):
        return at + (1 if kind == _BYTE else 8)
    if kind == _MAP:
        n, at = _varint_at(buf, at)
        if n:
            both, at = buf[at], at + 1
            for _ in range(n):
                for inner in (both >> 4, both & 15):
                    at = at + 1 if inner in (_TRUE, _FALSE) else _skip(buf, at, inner)
        return at
    raise ValueError(f"a footer with a field of kind {kind}")


def _list_at(buf: bytes, at: int) -> tuple[int, int, int]:
    head, at = buf[at], at + 1
    n = head >> 4
    if n == 15:
        n, at = _varint_at(buf, at)
    return n, head & 15, at


class _Window:
    """A moving view of the footer that begins at ``start``."""

    def __init__(self, fh, start: int, end: int):
        self.fh, self.end, self.start, self.buf, self.at = fh, end, start, b"", 0

    def place(self) -> int:
        return self.start + self.at

    def take(self, step) -> bytes:
        """The bytes up to the place that ``step(buf, at)`` gives."""
        while True:
            try:
                to = step(self.buf, self.at)
                if to <= len(self.buf):
                    part, self.at = self.buf[self.at : to], to
                    return part
            except IndexError:
                pass
            self.start += self.at
            self.buf, self.at = self.buf[self.at :], 0
            self.fh.seek(self.start + len(self.buf))
            # what is wanted may be longer than a portion
            more = self.fh.read(min(max(PORTION_BYTES, len(self.buf)), self.end - self.start - len(self.buf)))
            if not more:
                raise ValueError("a footer that ends early")
            self.buf += more


def footer_portions(fh) -> Iterator[tuple[int, int, pq.FileMetaData]]:
    """(row groups of the file, number of the first one here, metadata) of a Parquet file in portions.

    A small footer is one portion; of a large one each has the row groups of ``PORTION_BYTES``.
    """
    end = fh.seek(0, 2) if not hasattr(fh, "size") else fh.size()
    fh.seek(max(0, end - 8))
    last = fh.read(8)
    n_bytes = int.from_bytes(last[:4], "little")
    if last[4:] != MAGIC or not FOOTER_BYTES <= n_bytes <= end - 12:
        fh.seek(0)
        meta = pq.ParquetFile(fh).metadata
        yield meta.num_row_groups, 0, meta
        return
    window = _Window(fh, end - 8 - n_bytes, end - 8)
    head, n, field = b"", 0, 0
    cuts, tail, groups = [], b"", b""
    while True:
        mark = window.take(lambda buf, at: buf[at : at + 1] and at + 1 or len(buf) + 1)
        kind, step = mark[0] & 15, mark[0] >> 4
        if mark[0] and not step:
            mark += window.take(lambda buf, at: _skip(buf, at, 4))
            zigzag = _varint_at(mark, 1)[0]
            field = zigzag >> 1 ^ -(zigzag & 1)
        else:
            field += step
        if mark[0] and field == 4 and kind == _LIST:
            groups = mark
            mark = window.take(lambda buf, at: _list_at(buf, at)[2])
            n = _list_at(mark, 0)[0]
            cuts.append((0, window.place()))
            for i in range(n):
                window.take(lambda buf, at: _skip(buf, at, _STRUCT))
                if window.place() - cuts[-1][1] >= PORTION_BYTES or i == n - 1:
                    cuts.append((i + 1, window.place()))
            continue
        if mark[0]:
            mark += window.take(lambda buf, at, kind=kind: _skip(buf, at, kind))
        if groups:
            tail += mark
        else:
            head += mark
        if mark == b"\0":
            break
    if n == 0:
        fh.seek(0)
        yield 0, 0, pq.ParquetFile(fh).metadata
        return
    for (first, start), (after, stop) in zip(cuts, cuts[1:], strict=False):
        fh.seek(start)
        whole = b"".join([head, groups, _list(after - first, _STRUCT), fh.read(stop - start), tail])
        small = io.BytesIO(MAGIC + whole + len(whole).to_bytes(4, "little") + MAGIC)
        yield n, first, pq.read_metadata(small)
