"""Quality classifier: Bradley-Terry scores learned from preference pairs of labelled documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import free_name, freeze
from assetlake.llm.quality_rules import SEPARATORS, STOP_WORDS, SYMBOLS, without, words
from assetlake.operators.ordered import running

KEEP_SCORE = 0.7
#: Rows of the other class that each labelled row of the rarer class is compared with.
PAIRS_PER_ROW = 8
RIDGE = 1e-3
#: Rows that are numbered in one task.
RANKED_ROWS = 200_000


def features(docs: DataFrame, text_col: str, into: str) -> DataFrame:
    """Add ``into``: array of doubles, each of moderate size, from the whole text alone."""
    raw, tokens, lines = (free_name(docs, x) for x in ("text_", "tokens_", "lines_"))
    out = docs.withColumn(raw, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    with_word = F.filter(F.split(raw, "\n", -1), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    out = out.withColumns({tokens: words(F.col(raw)), lines: with_word})
    stop = F.array(*[F.lit(w) for w in sorted({w for ws in STOP_WORDS.values() for w in ws})])
    n_words, n_lines = F.size(tokens).cast("double"), F.size(lines).cast("double")
    n_chars = F.length(without(F.col(raw), " \n")).cast("double")
    distinct = F.size(F.array_distinct(tokens)).cast("double")
    count = lambda chars: n_chars_of(F.col(raw), chars)
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    variety = ratio(F.log(1 + distinct), F.log(1 + n_words))
    short = 1 / (1 + n_words)
    stops = F.size(F.array_intersect(tokens, stop)).cast("double")
    parts = [
        F.log(1 + n_words) / 4,
        short,
        F.least(ratio(n_chars, n_words), F.lit(20.0)) / 5,
        F.sqrt(ratio(count(SYMBOLS), n_chars)),
        F.sqrt(ratio(count("!"), n_chars)),
        F.sqrt(ratio(count("0123456789"), n_chars)),
        variety,
        F.pow(F.least(variety, F.lit(0.85)), 2),
        F.sqrt(ratio(distinct, n_words)),
        ratio(stops, F.sqrt(n_words)),
        F.least(stops, F.lit(4.0)) / 4,
        ratio(F.size(lines) - F.size(F.array_distinct(lines)), n_lines),
        F.least(ratio(count(".,;:"), n_words), F.lit(2.0)),
    ]
    return out.withColumn(into, F.array(*[p.cast("double") for p in parts])).drop(raw, tokens, lines)


def n_chars_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(without(text, chars))


@dataclass
class Model:
    """score = sigmoid(weights . (x - mean) / scale - threshold), moved so that the threshold scores 0.7."""

    weights: list[float]
    threshold: float

    def score(self, x: Column) -> Column:
        raw = dot(x, self.weights)
        shift = float(np.log(KEEP_SCORE / (1 - KEEP_SCORE)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(raw - F.lit(self.threshold) + F.lit(shift))))


def pair_sums(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, gradient and Hessian of the logistic loss of so many differences, one behind the other."""
    p = 1 / (1 + np.exp(-np.clip(d @ w, -40, 40)))
    hessian = (d * (p * (1 - p))[:, None]).T @ d
    return np.concatenate([[len(d)], d.T @ (p - 1), hessian.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], width: int, ridge: float) -> np.ndarray:
    """Weights of the least mean loss plus ridge; ``sums`` gives :func:`pair_sums` over all differences."""
    w = np.zeros(width)
    for _ in range(30):
        total = sums(w)
        gradient = total[1 : width + 1] / total[0] + ridge * w
        hessian = total[width + 1 :].reshape(width, width) / total[0] + ridge * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, ridge: float = RIDGE) -> Model:
    """Bradley-Terry by Newton steps: P(a preferred to b) = sigmoid(w . (x_a - x_b)).

    Every row of the rarer class meets ``pairs_per_row`` rows of the other, and every row of the
    other one of the rarer; the loss is the mean logistic loss of the differences plus a ridge.
    The threshold is the quantile of the scores at the share of rejected rows. Without rows of
    both classes nothing is learned: all scores are equal and at the threshold.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return Model(w.tolist(), 0.0)
    rng = np.random.default_rng(7)
    rare, other = (bad, good) if len(bad) <= len(good) else (good, bad)
    a = np.concatenate([np.repeat(rare, pairs_per_row), rng.choice(rare, len(other))])
    b = np.concatenate([rng.choice(other, len(rare) * pairs_per_row), other])
    better, worse = (b, a) if rare is bad else (a, b)
    scale = x.std(axis=0)
    scale[scale == 0] = 1.0
    d = (x[better] - x[worse]) / scale
    w = newton(lambda at: pair_sums(d, at), x.shape[1], ridge) / scale
    scores = np.sort(x @ w)
    k = len(bad)
    return Model(w.tolist(), float((scores[k - 1] + scores[min(k, len(scores) - 1)]) / 2))


def held_out(doc_id: Column) -> Column:
    """Rows no model sees: crc32 of the id as text leaves 2 when divided by 4; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", pairs_per_row: int = PAIRS_PER_ROW) -> Model:
    """:func:`fit_rows` on the features of the texts; the texts themselves are not shuffled."""
    free = docs.select("doc_id", F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return fit_rows(features(free, "text", "x").select("doc_id", "x"), labels, pairs_per_row)


def fit_rows(featured: DataFrame, labels: DataFrame, pairs_per_row: int = PAIRS_PER_ROW) -> Model:
    """:func:`fit_pairs` of all labelled rows (doc_id, x) that are not held out, in the tasks.

    Rows of a class are numbered by a hash of their id. Each row of the rarer class meets the next
    ``pairs_per_row`` of the other, each of the other one of the rarer. Labels that are null, other than
    0 and 1 or without a document teach nothing; an id labelled or stored twice counts as often. The
    driver gets sums over all pairs, one row per task and Newton step, and two scores for the threshold.
    """
    marks = labels.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("y"))
    marks = marks.where("labelled is not null and y in (0, 1)").where(~held_out(F.col("labelled")))
    # labels grow with the documents: never broadcast
    rows = featured.join(marks.hint("merge"), F.col("doc_id") == F.col("labelled"))
    rows = freeze(rows.select("labelled", "y", "x", F.xxhash64("labelled").alias("hash")), "quality-labelled")
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not counts:
        return Model([], 0.0)
    width = rows.select(F.max(F.size("x"))).first()[0]
    if len(counts) < 2:
        return Model([0.0] * width, 0.0)
    ranked = running(rows, ["y"], ["hash", "labelled", "x"], max_window_rows=RANKED_ROWS)
    ranked = freeze(ranked.select("y", (F.col("rn") - 1).alias("no"), "x"), "quality-ranks")
    scale = np.array(ranked.agg(*[F.stddev_pop(F.get("x", F.lit(i))) for i in range(width)]).first(), np.float64)
    scale[scale == 0] = 1.0
    pairs = freeze(differences(ranked, counts, pairs_per_row), "quality-pairs")

    def sums(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(1 + width + width * width)
            for batch in batches:
                d = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                total += pair_sums(d / scale, w)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

        return np.sum([r["sums"] for r in pairs.mapInArrow(run, "sums array<double>").collect()], axis=0)

    weights = (newton(sums, width, RIDGE) / scale).tolist()
    n_bad, n = counts[0], sum(counts.values())
    around = [n_bad - 1, min(n_bad, n - 1)]
    values = ranked.select(dot(F.col("x"), weights).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("times"))
    placed = running(values.withColumn("all", F.lit(1)), ["all"], ["s"], {"before": "times"}, max_window_rows=RANKED_ROWS)
    here = [(F.col("before") <= k) & (F.col("before") + F.col("times") > k) for k in around]
    got = placed.agg(*[F.max(F.when(h, F.col("s"))) for h in here]).first()
    return Model(weights, (got[0] + got[1]) / 2)


def differences(ranked: DataFrame, counts: dict[int, int], pairs_per_row: int) -> DataFrame:
    """(d): features of the better row less those of the worse one, of the pairs of rows (y, no, x)."""
    rare = 0 if counts[0] <= counts[1] else 1
    n_rare, n_other = counts[rare], counts[1 - rare]
    a = ranked.where(F.col("y") == rare).select(F.col("no").alias("a"), F.col("x").alias("x_a"))
    b = ranked.where(F.col("y") != rare).select(F.col("no").alias("b"), F.col("x").alias("x_b"))
    step = F.explode(F.sequence(F.lit(0), F.lit(pairs_per_row - 1))).alias("step")
    met = a.select("a", "x_a", step).withColumn("b", F.pmod(F.col("a") * pairs_per_row + F.col("step"), F.lit(n_other)))
    back = b.withColumn("a", F.pmod("b", F.lit(n_rare)))
    both = met.join(b, "b").select("x_a", "x_b").unionByName(back.join(a, "a").select("x_a", "x_b"))
    better, worse = ("x_b", "x_a") if rare == 0 else ("x_a", "x_b")
    return both.select(F.zip_with(better, worse, lambda p, q: p - q).alias("d"))


def dot(x: Column, weights: list[float]) -> Column:
    raw = F.lit(0.0)
    for i, w in enumerate(weights):
        raw = raw + F.get(x, F.lit(i)) * F.lit(float(w))
    return raw


def score_documents(
    docs: DataFrame, model: Model, text_col: str = "text", score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on); one scan, no shuffle, built-in functions.

    Null and empty texts are scored as texts without words; columns of ``docs`` with these names are
    replaced; equal texts get equal scores whatever their other columns hold.
    """
    x = free_name(docs, "features_")
    return score_rows(features(docs, text_col, x), model, x, score, predicted)


def score_rows(rows: DataFrame, model: Model, x: str, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """The same from features in column ``x``, which is dropped."""
    out = rows.withColumn(score, model.score(F.col(x))).drop(x)
    return out.withColumn(predicted, (F.col(score) >= KEEP_SCORE).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents the classifier does not reject, with their own columns as they were. Every text is read once, for its features."""
    x, score, predicted = (free_name(docs, c) for c in ("features_", "score_", "predicted_"))
    featured = freeze(features(docs, "text", x), "quality-documents")
    scored = score_rows(featured, fit_rows(featured.select("doc_id", F.col(x).alias("x")), labels), x, score, predicted)
    return scored.where(F.col(predicted) == 1).select(*docs.columns)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Every text is read once, for its features."""
    featured = freeze(features(docs.select("doc_id", "text"), "text", "x").select("doc_id", "x"), "quality-features")
    scored = score_rows(featured, fit_rows(featured, labels), "x")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
