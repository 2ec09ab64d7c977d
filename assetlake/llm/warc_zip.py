"""WARC records in ZIP packages: written by tasks, read back by ranges found in the directories."""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import freeze
from assetlake.session import run_dir

#: Payloads from this size on are stored once; later records of the same payload only refer to it.
REVISIT_BYTES = 100
#: Size at which a WARC member is closed, and bytes of an archive that one read covers at most.
MEMBER_BYTES = 16 << 20
SLAB = 4 << 20
WARC_FOLDER, INDEX_FOLDER = "archive/", "indexes/"

# Fixed values of the ZIP format: signatures and layouts of its records.
LOCAL = struct.Struct("<4s5H3I2H")
CENTRAL = struct.Struct("<4s6H3I5H2I")
END64 = struct.Struct("<4sQ2H2I4Q")
LOCATOR64 = struct.Struct("<4sIQI")
END = struct.Struct("<4s4H2IH")
LOCAL_SIGN, CENTRAL_SIGN = b"PK\x03\x04", b"PK\x01\x02"
END64_SIGN, LOCATOR64_SIGN, END_SIGN = b"PK\x06\x06", b"PK\x06\x07", b"PK\x05\x06"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ZipWriter:
    """Stored members, one after the other, with ZIP64 sizes and directory; the stream never seeks."""

    def __init__(self, out):
        self.out, self.at, self.entries = out, 0, []

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, data: bytes) -> None:
        crc, raw = zlib.crc32(data), name.encode()
        extra = struct.pack("<2H2Q", 1, 16, len(data), len(data))
        self.entries.append((raw, crc, len(data), self.at))
        self.put(LOCAL.pack(LOCAL_SIGN, 45, 0, 0, 0, 0x21, crc, FULL32, FULL32, len(raw), len(extra)) + raw + extra)
        self.put(data)

    def close(self) -> None:
        start = self.at
        for raw, crc, size, at in self.entries:
            extra = struct.pack("<2H3Q", 1, 24, size, size, at)
            sizes = (crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32)
            self.put(CENTRAL.pack(CENTRAL_SIGN, 45, 45, 0, 0, 0, 0x21, *sizes) + raw + extra)
        size, end, n = self.at - start, self.at, len(self.entries)
        self.put(END64.pack(END64_SIGN, END64.size - 12, 45, 45, 0, 0, n, n, size, start))
        self.put(LOCATOR64.pack(LOCATOR64_SIGN, 0, end, 1))
        self.put(END.pack(END_SIGN, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


def members(f, size: int) -> list[tuple[str, int, int, int]]:
    """(name, method, offset of the data, stored size) of a ZIP file's members.

    Read from the end: the end record, with its locator and the ZIP64 end record where a field is
    full, then the central directory, then the local header of each member, which alone tells where
    the data begin.
    """
    tail_size = min(size, END.size + FULL16 + LOCATOR64.size)
    tail = f.read_at(tail_size, size - tail_size)
    at = tail.rfind(END_SIGN)
    while at >= 0 and len(tail) - at < END.size:
        at = tail.rfind(END_SIGN, 0, at)
    if at < 0:
        raise ValueError("not a ZIP file: no end record")
    _, _, _, _, count, length, start, _ = END.unpack_from(tail, at)
    if FULL16 == count or FULL32 in (length, start):
        sign, _, end64, _ = LOCATOR64.unpack_from(tail, at - LOCATOR64.size)
        if sign != LOCATOR64_SIGN:
            raise ValueError("ZIP64 locator is missing")
        sign, *_, count, length, start = END64.unpack(f.read_at(END64.size, end64))
        if sign != END64_SIGN:
            raise ValueError("ZIP64 end record is missing")
    directory, at, out = f.read_at(length, start), 0, []
    for _ in range(count):
        sign, _, _, _, method, _, _, _, packed, full, n, e, c, _, _, _, offset = CENTRAL.unpack_from(directory, at)
        if sign != CENTRAL_SIGN:
            raise ValueError("central directory is damaged")
        name = directory[at + CENTRAL.size : at + CENTRAL.size + n].decode()
        extra = directory[at + CENTRAL.size + n : at + CENTRAL.size + n + e]
        packed, offset = wide(extra, full, packed, offset)
        head = LOCAL.unpack(f.read_at(LOCAL.size, offset))
        if head[0] != LOCAL_SIGN:
            raise ValueError(f"local header of {name} is missing")
        out.append((name, method, offset + LOCAL.size + head[-2] + head[-1], packed))
        at += CENTRAL.size + n + e + c
    return out


def wide(extra: bytes, full: int, packed: int, offset: int) -> tuple[int, int]:
    """Stored size and offset, from the ZIP64 field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            if full == FULL32:
                next(values)
            packed = next(values) if packed == FULL32 else packed
            offset = next(values) if offset == FULL32 else offset
        at += 4 + n
    return packed, offset


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without payload when ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC fields, HTTP head, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def plan_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of equal payloads only the smallest id keeps one.

    Payloads below ``least`` bytes are never referred to. A null id counts as larger than any, and
    rows that repeat the smallest id all keep their payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least
    first = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = freeze(first.where("n > 1 and first is not null").select("digest", "first"), "first-payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(records: DataFrame, root: str, member_bytes: int = MEMBER_BYTES) -> DataFrame:
    """Write one ZIP package per task below ``root``; returns (path, records), frozen.

    A package holds WARC members, each record compressed for itself, and beside each member an index
    of (offset, length) lines; all members are stored. A package appears under its name only when
    complete, so a repeated task does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = pafs.FileSystem.from_uri(root)
        fs.create_dir(inner, recursive=True)
        name = f"pages-{TaskContext.get().partitionId():06d}.zip"
        part, n = f"{inner}/_{name}.{uuid.uuid4().hex}", 0
        with fs.open_output_stream(part) as out:
            package, body, index, k = ZipWriter(out), bytearray(), [], 0

            def close_member() -> None:
                package.add(f"{WARC_FOLDER}{k:06d}.warc.gz", bytes(body))
                package.add(f"{INDEX_FOLDER}{k:06d}.idx", "".join(index).encode())

            for batch in batches:
                for values in zip(*batch.columns, strict=True):
                    data = gzip.compress(record(*[v.as_py() for v in values]), mtime=0)
                    index.append(f"{len(body)} {len(data)}\n")
                    body += data
                    n += 1
                    if len(body) >= member_bytes:
                        close_member()
                        body, index, k = bytearray(), [], k + 1
            if index:
                close_member()
            package.close()
        if not n:
            fs.delete_file(part)
            return
        fs.move(part, f"{inner}/{name}")
        yield pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "records": [n]})

    return freeze(records.mapInArrow(run, "path string, records bigint"), "packages")


def list_archives(spark: SparkSession, root: str) -> DataFrame:
    """(path) of the ZIP packages below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    return files.load(root).select("path")


def record_ranges(archives: DataFrame) -> DataFrame:
    """(path, offset, length): where each record lies in its package, by its directories and indexes.

    A WARC member without index is walked through by decompressing; a compressed one raises, as its
    records have no place in the file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as f:
                    found = {name: rest for name, *rest in members(f, f.size())}
                    for name, (method, start, size) in found.items():
                        if not name.startswith(WARC_FOLDER) or not name.endswith(".warc.gz"):
                            continue
                        if method:
                            raise ValueError(f"{name} in {path} is compressed as a member")
                        index = found.get(INDEX_FOLDER + name[len(WARC_FOLDER) : -len(".warc.gz")] + ".idx")
                        ranges = indexed(f, *index[1:]) if index and not index[0] else walked(f, start, size)
                        offsets, lengths = zip(*ranges, strict=True) if ranges else ((), ())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(offsets)), pa.array([start + o for o in offsets], pa.int64()), pa.array(lengths, pa.int64())],
                            ["path", "offset", "length"],
                        )

    return archives.select("path").mapInArrow(run, "path string, offset bigint, length bigint")


def indexed(f, start: int, size: int) -> list[tuple[int, int]]:
    return [tuple(map(int, line.split())) for line in f.read_at(size, start).splitlines()]


def walked(f, start: int, size: int) -> list[tuple[int, int]]:
    """Ranges of the gzip members in a stored member, found by decompressing it piece by piece."""
    out, at, begin, unzip = [], 0, 0, zlib.decompressobj(31)
    while at < size:
        data = f.read_at(min(1 << 20, size - at), start + at)
        at += len(data)
        while data:
            unzip.decompress(data)
            data = unzip.unused_data
            if unzip.eof:
                out.append((begin, at - len(data) - begin))
                begin, unzip = at - len(data), zlib.decompressobj(31)
    return out


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the packages: ids, type, payload size and digest, and the payload.

    Ranges are dealt out by package and slab; a task reads neighbouring records in one request. The
    digest of each response is checked against its bytes and a difference raises; a revisit carries
    the size and digest of the payload it refers to, and a null payload.
    """
    ranges = record_ranges(archives.repartition("path"))
    slab = F.floor(F.col("offset") / SLAB)
    ranges = ranges.repartition("path", slab).sortWithinPartitions("path", "offset")
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    if with_payload:
        names, schema = [*names, "payload"], schema + ", payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(rows):
                path, start, length = rows[at]
                end, stop = at + 1, start + length
                while end < len(rows) and rows[end][:2] == (path, stop) and stop - start < SLAB:
                    stop += rows[end][2]
                    end += 1
                fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as f:
                    data = f.read_at(stop - start, start)
                out = [row(gzip.decompress(data[o - start : o - start + n])) for _, o, n in rows[at:end]]
                columns = [list(c) for c in zip(*out, strict=True)][: len(names)]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names)
                at = end

    def row(data: bytes) -> tuple:
        fields, http, payload = parse(data)
        number = lambda key: int(x) if (x := fields.get(key, "").removeprefix("<urn:page:").removesuffix(">")) else None
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        response = fields["WARC-Type"] == "response"
        if response and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
        size = len(payload) if response else int(http.rsplit(b"Content-Length: ", 1)[1])
        return (
            number("WARC-Record-ID"), fields["WARC-Target-URI"], fields["WARC-Type"], number("WARC-Refers-To"), size, digest,
            payload if response else None,
        )

    return ranges.mapInArrow(run, schema)


def digest(pages: DataFrame) -> DataFrame:
    """Write the pages to packages, read the packages back, and tell what each record says."""
    spark = pages.sparkSession
    archives = write_archives(plan_records(pages), run_dir(spark, "warc"))
    out = read_records(archives, with_payload=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


DIGEST_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha256(t) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id IS DISTINCT FROM first AND first IS NOT NULL
    THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
