"""Secret scan: fixed patterns, and Shannon entropy in a sliding window over candidate strings.

Everything is a projection of built-in functions: nothing is shuffled, and a text without any
candidate costs a few regular-expression searches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import free_name

WORD_KEYS = "password|passwd|secret|token|api_?key"
#: (kind, pattern, group that is measured, its least length). Matches are leftmost, not overlapping.
BASE_KINDS = [
    ("assign", rf"""(?i:{WORD_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # a run of 32 or more is the run that `+` would find
]
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: (kind, whole-string pattern of its characters, least entropy in bits of some window). A candidate
#: belongs to the first class that fits.
ENTROPY_CLASSES = [
    ("entropy_hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.9),
    ("entropy_upper", r"^[A-Z0-9]+$", 3.3),
    ("entropy_base64", r"^.*[A-Z].*$", 3.7),
]
#: Candidates that are known not to be secrets.
ALLOW_LIST = [
    r"^[^0-9]*$",
    r"^[0-9_/+-]*$",
    r"(?i:example|sample|placeholder|dummy|changeme|xxxx|0123456789|abcdefgh)",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
]
#: Candidates without an upper-case letter are judged by what is left of them without separators and
#: the words between them, of letters or of digits only, if that is so long; lower-case keys of
#: letters and digits reach 3.2 bits in 999 of 1000 cases.
WORDS = r"(?<![^/_+-])(?:[a-z]+|[0-9]+)(?![^/_+-])|[/_+-]"
LEAST_LEFT = 10
LOWER_CLASSES = [("entropy_hex", r"^[0-9a-f]+$", 2.9), ("entropy_lower", r"^[a-z0-9]+$", 3.2)]
KINDS = [kind for kind, *_ in BASE_KINDS + ENTROPY_CLASSES] + ["entropy_lower"]
#: Characters of a candidate, of a text, and elements of an array that are worked on together, so that
#: long ones take time in proportion to their length.
PIECE, CHUNK, RUN = 200, 1000, 256
MASK = "[SECRET]"
_SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, join, zero: Column) -> Column:
    """For each element of an array of longs what ``join`` makes of ``zero`` and the elements before it.

    Runs of elements are joined first, then the runs, then the elements of each run from there on.
    """

    def upto(part: Column, begin: Column) -> Column:
        empty = F.struct(begin.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            part, empty, lambda acc, x: F.struct(
                join(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ), lambda acc: acc["out"],
        )

    def over(parts: Column) -> Column:
        begins = upto(F.transform(parts, lambda part: F.aggregate(part, zero, join)), zero)
        return F.flatten(F.zip_with(parts, begins, upto))

    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(RUN))
    return _let(F.transform(starts, lambda i: F.slice(values, i, F.lit(RUN))), over)


def located(text: Column, pattern: str) -> Column:
    """(start, match) of every match: what lies between the matches tells where they are."""

    def walk(found: Column) -> Column:
        hits, gaps = found["hits"], F.slice(found["gaps"], 1, F.size(found["hits"]))
        both = F.zip_with(gaps, hits, lambda g, h: (F.length(g) + F.length(h)).cast("long"))
        starts = F.zip_with(running(both, lambda a, x: a + x, F.lit(0).cast("long")), gaps, lambda at, g: at + F.length(g))
        return F.zip_with(starts, hits, lambda start, hit: F.struct(start.alias("start"), hit.alias("hit")))

    both = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )
    none = F.array().cast("array<struct<start:bigint,hit:string>>")
    return F.when(text.rlike(pattern), _let(both, walk)).otherwise(none)


def window_entropy(candidate: Column, width: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of the windows of ``width`` characters of a candidate.

    H = log2 w - S / w with S the sum of n log2 n over the counts n. A step to the right changes S
    by the character that leaves and the one that enters only; their counts are taken from the
    characters both windows share. A long candidate is cut into pieces that overlap by one
    character less than a window, so every window lies in one of them.
    """
    table = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(width + 1)])
    g = lambda n: F.get(table, n)
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))

    def least(piece: Column) -> Column:
        first = F.substring(piece, 1, width)
        letters = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.substr(first, i, F.lit(1))))
        s0 = F.aggregate(letters, F.lit(0.0), lambda acc, c: acc + g(count(first, c)))

        def step(acc: Column, i: Column) -> Column:
            shared = F.substr(piece, i + 1, F.lit(width - 1))
            out = count(shared, F.substr(piece, i, F.lit(1)))
            into = count(shared, F.substr(piece, i + width, F.lit(1)))
            s = acc["s"] - g(out + 1) + g(out) - g(into) + g(into + 1)
            return F.struct(s.alias("s"), F.least(acc["least"], s).alias("least"))

        moves = F.length(piece) - width
        steps = F.when(moves > 0, F.sequence(F.lit(1), moves)).otherwise(F.array().cast("array<int>"))
        return _let(
            s0, lambda s: F.aggregate(steps, F.struct(s.alias("s"), s.alias("least")), step, lambda acc: acc["least"])
        )

    def longer(parts: Column) -> Column:
        after = F.concat(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")))
        return F.zip_with(parts, after, lambda one, two: F.concat(one, F.substring(two, 1, width - 1)))

    cut = F.regexp_extract_all(candidate, F.lit(rf"(?s).{{1,{PIECE - width + 1}}}"), F.lit(0))
    pieces = F.when(F.length(candidate) <= PIECE, F.array(candidate)).otherwise(_let(cut, longer))
    whole = F.filter(pieces, lambda piece: F.length(piece) >= width)
    return F.round(F.lit(math.log2(width)) - F.array_min(F.transform(whole, least)) / width, 9)


def entropy_kind(candidate: Column) -> Column:
    """Class whose threshold some window of the candidate reaches, else null."""
    allowed = F.lit(False)
    for pattern in ALLOW_LIST:
        allowed = allowed | candidate.rlike(pattern)
    left = F.regexp_replace(candidate, WORDS, "")
    lower = ~candidate.rlike("[A-Z]") & (F.length(left) >= LEAST_LEFT)
    classes = [(name, candidate.rlike(pattern), least) for name, pattern, least in ENTROPY_CLASSES]
    classes += [(name, lower & left.rlike(pattern), least) for name, pattern, least in LOWER_CLASSES]
    kind = F.lit(None).cast("string")
    for name, fits, least in reversed(classes):
        kind = F.when(fits, F.when(window_entropy(candidate) >= least, F.lit(name))).otherwise(kind)
    return F.when(~allowed, kind)


def scan_secrets(docs: DataFrame, text_col: str = "text", into: str = "secret_spans") -> DataFrame:
    """Add ``into``: array of (start, rank, end, kind), by start, then kind as listed.

    Places are code points, the end is exclusive; a span is the whole match. Null and empty texts
    have none; repeated rows give the same spans again; a column named ``into`` is replaced. Spans
    of different kinds may overlap.
    """
    raw = free_name(docs, "text_")
    out = docs.withColumn(raw, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = []
    for rank, (kind, pattern, group, least) in enumerate(BASE_KINDS):
        hits = located(F.col(raw), pattern)
        found.append(_spans(F.filter(hits, _measures(pattern, group, least)), rank, F.lit(kind)))
    judged = F.transform(
        located(F.col(raw), CANDIDATE),
        lambda x: F.struct(x["start"].alias("start"), x["hit"].alias("hit"), entropy_kind(x["hit"]).alias("kind")),
    )
    hits = free_name(out, "hits_")
    out = out.withColumn(hits, F.filter(judged, lambda x: x["kind"].isNotNull()))  # by itself: used for each kind
    for rank, kind in enumerate(KINDS[len(BASE_KINDS) :], len(BASE_KINDS)):
        found.append(_spans(F.filter(hits, _is(kind)), rank, F.lit(kind)))
    return out.withColumn(into, F.sort_array(F.concat(*found))).drop(raw, hits)


def _measures(pattern: str, group: int, least: int):
    return lambda x: F.length(F.regexp_extract(x["hit"], pattern, group)) >= least


def _is(kind: str):
    return lambda x: x["kind"] == kind


def _spans(hits: Column, rank: int, kind: Column) -> Column:
    return F.transform(
        hits,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(rank).alias("rank"),
            (x["start"] + F.length(x["hit"])).alias("end"),
            kind.alias("kind"),
        ),
    ).cast(_SPAN)


def spans_text(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by a fixed mark; overlapping spans leave one mark."""

    def joined(chunks: Column) -> Column:
        def part(begin: Column, end: Column) -> Column:
            first = F.floor(begin / CHUNK).cast("int")
            some = F.slice(chunks, first + 1, F.floor((end - 1) / CHUNK).cast("int") - first + 1)
            at = (begin - first * CHUNK + 1).cast("int")
            return F.when(end > begin, F.substr(F.array_join(some, ""), at, (end - begin).cast("int"))).otherwise(F.lit(""))

        def pieces(upto: Column) -> Column:
            gaps = F.zip_with(
                spans, upto, lambda x, at: F.when(x["start"] >= at, F.concat(part(at, x["start"]), F.lit(MASK))).otherwise(F.lit(""))
            )
            end = F.array_max(F.transform(spans, lambda x: x["end"]))
            return F.concat(F.array_join(gaps, ""), part(end, F.length(text).cast("long")))

        ends = running(F.transform(spans, lambda x: x["end"]), lambda a, x: F.greatest(a, x), F.lit(0).cast("long"))
        return _let(ends, pieces)

    chunks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(chunks, joined)).otherwise(text)


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans masked and n_chars, if there, counted anew where something was."""
    spans, mask = free_name(docs, "spans_"), free_name(docs, "masked_")
    out = scan_secrets(docs, text_col, spans)
    out = out.withColumn(mask, masked(F.col(text_col), F.col(spans)))  # by itself: a lambda would see new columns
    changed = {text_col: F.col(mask)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size(spans) > 0, F.length(mask).cast("long")).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digests of its spans."""
    out = scan_secrets(docs.select("doc_id", "text"), "text", "found").drop("text")
    base = F.filter("found", lambda x: x["rank"] < len(BASE_KINDS))
    of = lambda kind: F.size(F.filter("found", _is(kind))).cast("long")
    return out.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind, *_ in BASE_KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )


def _sql_pattern(pattern: str) -> str:
    return pattern.replace("'", "''")


def _digest_sql() -> str:
    def at(pattern: str) -> str:
        p = _sql_pattern(pattern)
        return (
            f"CASE WHEN regexp_matches(t, '{p}') THEN list_transform(range(1, 1 + len(regexp_extract_all(t, '{p}'))),"
            f" lambda i: {{'start': list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda x: length(x)))"
            f" + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i-1], lambda x: length(x))), 0),"
            f" 'hit': regexp_extract_all(t, '{p}')[i]}}) ELSE [] END"
        )

    ctes = ["d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"]
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(BASE_KINDS):
        ctes.append(f"s{rank} AS (SELECT r, unnest({at(pattern)}) AS s FROM d)")
        parts.append(
            f"SELECT r, s.start AS b, {rank} AS k, s.start + length(s.hit) AS e, '{kind}' AS kind FROM s{rank}"
            f" WHERE length(regexp_extract(s.hit, '{_sql_pattern(pattern)}', {group})) >= {least}"
        )
    ctes.append(f"c AS (SELECT r, unnest({at(CANDIDATE)}) AS s FROM d)")
    allowed = " OR ".join(f"regexp_matches(s.hit, '{p}')" for p in ALLOW_LIST)
    ctes.append(
        "w AS (SELECT r, s, array_to_string(list_filter(string_split_regex(s.hit, '[/_+-]'),"
        f" lambda x: NOT regexp_matches(x, '^([a-z]+|[0-9]+)$')), '') AS rest FROM c WHERE NOT ({allowed}))"
    )
    fits = [f"regexp_matches(s.hit, '{p}')" for _, p, _ in ENTROPY_CLASSES]
    lower = f"NOT regexp_matches(s.hit, '[A-Z]') AND length(rest) >= {LEAST_LEFT}"
    fits += [f"{lower} AND regexp_matches(rest, '{p}')" for _, p, _ in LOWER_CLASSES]
    classes = " ".join(f"WHEN {x} THEN {i}" for i, x in enumerate(fits))
    ctes.append(
        f"e AS (SELECT r, s, CASE {classes} END AS cls, list_max(list_transform(range(1, length(s.hit) - {WINDOW - 2}),"
        f" lambda i: list_entropy(string_split(substr(s.hit, i, {WINDOW}), '')))) AS h FROM w)"
    )
    for i, (kind, _, least) in enumerate(ENTROPY_CLASSES + LOWER_CLASSES):
        parts.append(
            f"SELECT r, s.start, {KINDS.index(kind)}, s.start + length(s.hit), '{kind}' FROM e"
            f" WHERE cls = {i} AND round(h, 9) >= {least}"
        )
    ctes.append("a AS (" + " UNION ALL ".join(parts) + ")")
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k, *_ in BASE_KINDS)
    joined = "string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k)"
    ctes.append(
        f"g AS (SELECT r, {counts}, {joined} FILTER (WHERE k < {len(BASE_KINDS)}) AS base, {joined} AS spans FROM a GROUP BY r)"
    )
    names = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, *_ in BASE_KINDS)
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256,"
        " coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)"
    )


DIGEST_SQL = _digest_sql()
