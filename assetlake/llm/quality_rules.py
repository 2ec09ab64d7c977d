"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import free_name

#: What ends a word: space and the five control characters from tab to carriage return.
SEPARATORS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the languages served; a text of real sentences has several.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "with", "are", "was", "this"],
    "de": ["der", "die", "und", "den", "von", "mit", "das", "nicht", "ist", "auf", "im", "zu"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "dans", "que"],
    "es": ["que", "el", "los", "del", "se", "las", "por", "con", "una", "su", "para", "y"],
}

#: (rule, measure, least, most): a text breaks a rule when the measure leaves the bounds. A bound
#: of None is open. Measures are named in ``measures``.
THRESHOLDS = [
    ("too_long", "n_words", None, 1_000_000),
    ("word_length", "mean_word_chars", 2.0, 15.0),
    ("symbols", "symbol_ratio", None, 0.10),
    ("stop_words", "n_stop_words", 2, None),
    ("dup_lines", "dup_line_ratio", None, 0.50),
    ("bullets", "bullet_ratio", None, 0.90),
    ("ellipses", "ellipsis_ratio", None, 0.30),
]


def words(text: Column) -> Column:
    """Words of a text: maximal runs without separators; none for an empty text."""
    inner = F.btrim(text, F.lit(SEPARATORS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x20\x09-\x0D]+", -1)
    )


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first one included.

    Hashes of the windows tell most texts have no window twice. For the others the windows
    themselves are sorted beside their places, and equal neighbours are the repeated ones.
    """
    n = F.size(tokens)
    starts = F.sequence(F.lit(0), n - 3)

    def three(i: Column) -> list[Column]:
        return [F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)]

    def places(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, k: x["w"].eqNullSafe(F.get(s, k - 1)["w"]) | x["w"].eqNullSafe(F.get(s, k + 1)["w"]),
        )
        return F.size(
            F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
        )

    distinct = F.size(F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*three(i)))))
    windows = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *three(i)).alias("w"), i.alias("i")))
    return F.when((n < 4) | (distinct == n - 2), F.lit(0)).otherwise(_let(F.sort_array(windows), places))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def score_rules(docs: DataFrame, text_col: str = "text", thresholds: list[tuple] | None = None) -> DataFrame:
    """Add the counts, ratios, ``failed_rules`` (names, in table order), base_failed and kept.

    Null texts count as empty and break the base rules; texts without words too. Nothing is
    shuffled and no row depends on another, so repeated rows give repeated results. Columns of
    ``docs`` with the name of a result are replaced by the result.
    """
    stop = F.array(*[F.lit(w) for w in sorted({w for ws in STOP_WORDS.values() for w in ws})])
    raw, tokens, lines = (free_name(docs, x) for x in ("text_", "tokens_", "lines_"))
    out = docs.withColumn(raw, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    with_word = F.filter(F.split(raw, "\n", -1), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    out = out.withColumns({tokens: words(F.col(raw)), lines: with_word})
    counts = {
        "n_words": F.size(tokens),
        "word_chars": F.length(without(F.col(raw), SEPARATORS)),
        "n_symbols": F.length(raw) - F.length(without(F.col(raw), SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(F.col(tokens)),
        "n_lines": F.size(lines),
        "n_stop_words": F.size(F.array_intersect(tokens, stop)),
        "bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\t]*[-*•]"))),
        "ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\t]*$"))),
    }
    out = out.withColumns({name: c.cast("long") for name, c in counts.items()})
    words_n, lines_n = F.col("n_words"), F.col("n_lines")
    out = out.withColumns(
        {
            "mean_word_chars": _ratio(F.col("word_chars"), words_n),
            "symbol_ratio": _ratio(F.col("n_symbols"), F.col("word_chars")),
            "dup_line_ratio": _ratio(F.col("n_dup_lines"), lines_n),
            "bullet_ratio": _ratio(F.col("bullet_lines"), lines_n),
            "ellipsis_ratio": _ratio(F.col("ellipsis_lines"), lines_n),
        }
    )
    broken = []
    for name, measure, least, most in thresholds or THRESHOLDS:
        bad = F.lit(False)
        if least is not None:
            bad = bad | (F.col(measure) < least)
        if most is not None:
            bad = bad | (F.col(measure) > most)
        broken.append(F.when(bad, F.lit(name)))
    base = (words_n < 50) | (100 * F.col("n_repeat_words") > 50 * words_n)
    out = out.withColumns({"failed_rules": F.array_compact(F.array(*broken)), "base_failed": base})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop(raw, tokens, lines)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the base counts and both verdicts."""
    out = score_rules(docs.select("doc_id", "text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select("doc_id", *base)


def _digest_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
    ratio = lambda part, whole: f"CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0.0 END"
    of = {
        "n_words": "n_words",
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "word_chars"),
        "n_stop_words": "n_stop_words",
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "bullet_ratio": ratio("bullet_lines", "n_lines"),
        "ellipsis_ratio": ratio("ellipsis_lines", "n_lines"),
    }
    bad = [f"({of[m]}) < {least}" for _, m, least, _ in THRESHOLDS if least is not None]
    bad += [f"({of[m]}) > {most}" for _, m, _, most in THRESHOLDS if most is not None]
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS tokens,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
w AS (SELECT r, unnest(tokens) AS w, unnest(range(1, len(tokens) + 1)) AS i FROM s),
w3 AS (
  SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM w3 WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, w, w2, w3) > 1),
rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT s.r, doc_id, len(tokens) AS n_words,
    coalesce(list_sum(list_transform(tokens, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    len(lines) AS n_lines, len(list_intersect(tokens, [{stop}])) AS n_stop_words,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\t]*[-*•]'))) AS bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t]*$'))) AS ellipsis_lines
  FROM s LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({' OR '.join(bad)}) AS kept
FROM b
"""


DIGEST_SQL = _digest_sql()
