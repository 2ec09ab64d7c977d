"""Column expressions that turn raw catalogue values into canonical ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetlake import schemas as S


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lookup(key: Column, mapping: dict) -> Column:
    """Dictionary look-up; null when absent. The key is evaluated once, whatever its cost."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def strip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def category_segment(raw: Column | str) -> Column:
    """The part before the first slash, trimmed and lower-cased."""
    return F.lower(strip(F.substring_index(_c(raw), "/", 1)))


def normalize_category(raw: Column | str, words: dict[str, str] | None = None) -> Column:
    """Canonical category: whole segment first, then its words from left to right."""
    words = S.keyword_dictionary() if words is None else words
    seg = category_segment(raw)
    hits = F.filter(
        F.transform(F.split(seg, r"(?U)\s+"), lambda w: lookup(w, words)),
        lambda c: c.isNotNull(),
    )
    return F.coalesce(lookup(seg, words), F.get(hits, F.lit(0)), F.lit("other"))


def channel_alias(raw: Column | str) -> Column:
    return F.translate(F.lower(_c(raw)), " _", "")


def normalize_channel(
    source: Column | str, raw: Column | str, words: dict[tuple[str, str], str] | None = None
) -> Column:
    """Canonical channel of a source's map name; null means the map is skipped.

    ``source`` is a column, or the name of a source that all rows belong to.
    """
    words = S.channel_dictionary() if words is None else words
    if isinstance(source, str) and source in {s for s, _ in words}:
        return lookup(channel_alias(raw), {a: c for (s, a), c in words.items() if s == source})
    flat = {f"{s}:{a}": c for (s, a), c in words.items()}
    return lookup(F.concat(_c(source), F.lit(":"), channel_alias(raw)), flat)


def channel_from_member(name: Column | str) -> Column:
    """Raw map name in front of the extension of an archive member, null if there is none."""
    pattern = r"(?i)_([A-Za-z]+)\.(png|jpg)$"
    return F.get(F.regexp_extract_all(_c(name), F.lit(pattern), F.lit(1)), F.lit(0))


def channel_from_tokens(
    name: Column | str,
    source: str = "gpuopen",
    words: dict[tuple[str, str], str] | None = None,
) -> Column:
    """Channel of an image file: the last token of its stem that is a known map name."""
    words = S.channel_dictionary() if words is None else words
    known = {a: c for (s, a), c in words.items() if s == source}
    base = F.translate(F.lower(F.substring_index(_c(name), "/", -1)), " ", "")
    # The greedy start makes the regex find the last token; one match replaces a loop over tokens.
    pattern = rf"^(?:.*[_\-])?({'|'.join(known)})(?:[_\-].*)?\.(?:png|jpg|jpeg|tif|tiff|exr)$"
    return lookup(F.regexp_extract(base, pattern, 1), known)


def first_category(raw: Column | str) -> Column:
    """First category of a JSON value that may be an object, an array or a string."""
    raw = _c(raw)
    head = F.substring(F.ltrim(raw), 1, 1)
    value = (
        F.when(head == "{", F.get(F.json_object_keys(raw), F.lit(0)))
        .when(head == "[", F.get(F.from_json(raw, "array<string>"), F.lit(0)))
        .when(head == '"', F.get(F.from_json(F.concat(F.lit("["), raw, F.lit("]")), "array<string>"), F.lit(0)))
        .otherwise(raw)
    )
    return F.coalesce(value, F.lit(""))


def download_url(downloads: Column | str, tier: str) -> Column:
    """URL of the first download whose attribute fits the tier, null if there is none."""
    want = S.DOWNLOAD_ATTRIBUTE.get(tier)
    fits = F.filter(_c(downloads), lambda d: F.upper(d["attribute"]) == F.lit(want))
    return F.get(fits, F.lit(0))["fullDownloadPath"]


def pick_format(formats: Column | str) -> Column:
    """URL of the PNG, or of the JPEG when no PNG entry is there."""
    formats = _c(formats)
    png = F.try_element_at(formats, F.lit("png"))
    jpg = F.try_element_at(formats, F.lit("jpg"))
    has_png = png["url"].isNotNull() | png["size"].isNotNull()
    return F.when(has_png, png["url"]).otherwise(jpg["url"])


def clean_tags(text: Column | str) -> Column:
    """Comma string to tags, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(_c(text), ","), strip), lambda t: t != "")


def tags_of_json(raw: Column | str) -> Column:
    """Tags given as a JSON array or as a comma string."""
    raw = _c(raw)
    listed = F.startswith(F.ltrim(raw), F.lit("["))
    tags = F.when(listed, F.from_json(raw, "array<string>")).otherwise(clean_tags(raw))
    return F.coalesce(tags, F.array().cast("array<string>"))


def slug(name: Column | str) -> Column:
    return F.translate(F.lower(_c(name)), " ", "_")


def date_part10(x: Column | str) -> Column:
    return F.coalesce(F.substring(_c(x), 1, 10), F.lit(""))


def rgb_to_hex(rgb: Column | str, clamp: bool = False) -> Column:
    """``#RRGGBB`` of three numbers in 0..1; values above 1 overflow unless ``clamp`` is set."""
    rgb = _c(rgb)

    def level(i: int) -> Column:
        v = F.rint(rgb[i] * F.lit(255.0)).cast("int")
        return F.least(F.greatest(v, F.lit(0)), F.lit(255)) if clamp else v

    return F.when(F.size(rgb) >= 3, F.format_string("#%02X%02X%02X", level(0), level(1), level(2)))


def _hex(digits: Column) -> Column:
    ok = digits.rlike("^[0-9A-Fa-f]+$")
    return F.when(ok, F.conv(digits, 16, 10).cast("long"))


def hex_to_int(color: Column | str) -> Column:
    return _hex(F.regexp_replace(_c(color), "^#+", ""))


def hex_to_rgba(color: Column | str) -> Column:
    """[r, g, b, 1.0] of a hex colour."""
    digits = F.regexp_replace(_c(color), "^#+", "")
    part = [_hex(F.substring(digits, p, 2)) / F.lit(255.0) for p in (1, 3, 5)]
    return F.when(digits.isNotNull(), F.array(*part, F.lit(1.0)))


def tier_px(tier: Column | str) -> Column:
    """Edge length of a tier in pixels; an encoding prefix such as ``ktx2-`` is ignored."""
    return lookup(F.regexp_replace(_c(tier), "^ktx2-", ""), S.TIER_PX)


def upstream_url(source: Column | str, material_id: Column | str) -> Column:
    """Page of a material at its source."""
    template = lookup(_c(source), S.UPSTREAM_PAGE)
    return F.replace(template, F.lit("%s"), _c(material_id))


def release_tag_ok(tag: Column | str) -> Column:
    return F.coalesce(_c(tag).rlike(S.RELEASE_TAG_PATTERN), F.lit(False))


def release_order(tag: Column | str) -> Column:
    """Sortable struct of a calendar release tag."""
    nums = F.regexp_extract_all(_c(tag), F.lit(r"(\d+)"), F.lit(1))
    return F.struct(*[F.get(nums, F.lit(i)).cast("int").alias(f"n{i}") for i in range(3)])
