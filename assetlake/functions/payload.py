"""Expressions over payload bytes, sizes and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.normalize import _c, lookup

UNITS = ["B", "KB", "MB", "GB", "TB"]


def sha256(payload: Column | str) -> Column:
    return F.sha2(_c(payload), 256)


def size(payload: Column | str) -> Column:
    return F.octet_length(_c(payload)).cast("long")


def has_magic(payload: Column | str, *magics: bytes) -> Column:
    """True when the payload starts with one of the magics; null stays false."""
    payload = _c(payload)
    tests = [
        F.startswith(F.substring(payload, 1, len(m)), F.lit(m)) for m in (magics or (S.PNG_MAGIC,))
    ]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def png_ok(payload: Column | str) -> Column:
    return has_magic(payload, S.PNG_MAGIC)


def ktx2_ok(payload: Column | str) -> Column:
    return has_magic(payload, S.KTX2_MAGIC)


def length_ok(length: Column | str, cap: int = S.MAX_FETCH_BYTES) -> Column:
    """A usable range length: positive and not above the cap."""
    return F.coalesce((_c(length) > 0) & (_c(length) <= cap), F.lit(False))


def data_uri(payload: Column | str) -> Column:
    return F.concat(
        F.lit("data:image/png;base64,"), F.translate(F.base64(_c(payload)), "\r\n", "")
    )


def png_dimensions(payload: Column | str) -> Column:
    """struct(width, height) of a PNG header, null for anything else."""
    payload = _c(payload)

    def uint32(pos: int) -> Column:
        return F.conv(F.hex(F.substring(payload, pos, 4)), 16, 10).cast("int")

    header = png_ok(payload) & (F.octet_length(payload) >= 24)
    return F.when(header, F.struct(uint32(17).alias("width"), uint32(21).alias("height")))


def parse_size(text: Column | str) -> Column:
    """Bytes of ``5GB``, ``500 MB``, ``12``; 0 for an empty text, null when unreadable."""
    s = F.upper(F.trim(_c(text)))
    unit = F.regexp_extract(s, r"[KMGT]?B$", 0)
    number = F.rtrim(F.substr(s, F.lit(1), F.length(s) - F.length(unit)))
    factor = lookup(unit, {u: float(1024**i) for i, u in enumerate(UNITS)})
    plain = F.when(s == "", F.lit(0).cast("long")).otherwise(s.try_cast("long"))
    return F.when(unit == "", plain).otherwise(
        (number.try_cast("double") * factor).try_cast("long")
    )


def fmt_decimal(x: Column | str, digits: int) -> Column:
    """Fixed decimals, ties resolved on the exact binary value, no thousands separators."""
    pattern = "0." + "0" * digits
    return F.call_function("format_number", _c(x), F.lit(pattern))


def fmt_size(n: Column | str) -> Column:
    """Human-readable bytes: plain below 1 KB, one decimal above."""
    n = _c(n)
    out = F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B")))
    for power, unit in enumerate([*UNITS[1:], "PB"], start=1):
        text = F.concat(fmt_decimal(n / F.lit(float(1024**power)), 1), F.lit(f" {unit}"))
        out = out.otherwise(text) if unit == "PB" else out.when(n < 1024 ** (power + 1), text)
    return out


def distance(**targets: float | None) -> Column | None:
    """Sum of |column - target|; a null value adds nothing. None without targets."""
    terms = [
        F.coalesce(F.abs(F.col(name) - F.lit(float(t))), F.lit(0.0))
        for name, t in targets.items()
        if t is not None
    ]
    return reduce(lambda a, b: a + b, terms) if terms else None
