"""Toxicity: Kneser-Ney models of the words of toxic and of ordinary texts, with a shared backoff."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import free_name, freeze, slices, spread, text_bytes
from assetlake.llm.quality_classifier import held_out
from assetlake.llm.words import mix, names, runs

CUT_SCORE = 0.3
#: Bytes of a gram: the last one is predicted from the seven before it, in one word with its marks.
GRAM = 8
#: Every task has the most frequent contexts with all their grams, at most so many, and the ratios of the
#: most frequent words that hold other grams. What is beyond them is joined to its estimates.
HOT, KNOWN = 1 << 20, 1 << 20
#: Bits of a filter of the other contexts: a gram in a context that was never met has the ratio 0.
BITS = 1 << 25
DISCOUNT = 0.75
#: Further weight of the shared backoff: as if a context had been met so many times more in each class.
PRIOR = 10
#: A toxic text is a mixture: this share of its words comes from the toxic model, the others are ordinary.
RATE = 0.01
#: One training text in so many sets the scale of the scores and is not counted.
FOLDS = 4
#: Bins of the histogram of mean ratios from which the scale is fitted, and where they end.
BINS, HIGH = 8192, 0.4
#: Entries a task adds up before it passes them on, and rows of a frame that leaves it.
HELD, FRAME = 1 << 20, 1 << 16
_EIGHT = np.uint64(8)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Words:
    """The different words of a batch of texts, and which of them stands where."""

    name: np.ndarray
    raw: np.ndarray
    start: np.ndarray
    length: np.ndarray
    inverse: np.ndarray  # different word of each word
    first: np.ndarray  # first word of each text and the end

    def texts(self, which: np.ndarray) -> pa.Array:
        """These words as strings: all signs beyond ASCII belong to words, so none is cut."""
        offsets = np.concatenate(([0], np.cumsum(self.length[which])))
        data = self.raw[spread(self.start[which], self.length[which])]
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.string(), len(which), buffers)


def words_of(column: pa.Array) -> Words:
    """Words are runs of digits, letters and signs beyond ASCII, in lower case."""
    offsets, raw = text_bytes(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    start, end, first = runs(_LETTER[raw], offsets)
    name, sample, inverse = np.unique(names(raw, start, end), return_index=True, return_inverse=True)
    return Words(name, raw, start[sample], (end - start)[sample], inverse, first)


def grams_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(grams, how many of them each word has) of a column of words, one word after the other."""
    offsets, raw = text_bytes(column)
    start, length = offsets[:-1], np.diff(offsets)
    size = length + GRAM + 1  # zeros, a mark before the word, the word, a mark after it
    at = np.cumsum(size) - size
    buffer = np.zeros(int(size.sum()), np.uint8)
    buffer[at + GRAM - 1] = 1
    buffer[spread(at + GRAM, length)] = raw[spread(start, length)]
    buffer[at + GRAM + length] = 2
    grams = np.empty(0, np.uint64)
    if len(length):
        windows = np.lib.stride_tricks.sliding_window_view(buffer, GRAM)[spread(at + 1, length + 1)]
        grams = np.ascontiguousarray(windows).view(">u8")[:, 0].astype(np.uint64)
    return grams, length + 1


def found(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each key among the sorted known ones."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def picked(values: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The value at each place, 0 where there is none."""
    out = np.zeros(len(at))
    out[there] = values[at[there]]
    return out


@dataclass
class Model:
    """Log-likelihood ratios of all grams counted and, for what is not known in a context, of contexts.

    The arrays are what every task gets: the frequent contexts with all their grams, a filter of the
    others, and the ratios of frequent words. ``values`` has the other contexts, a row for each.
    ``slope`` and ``cut`` turn the mean ratio of a text into its score.
    """

    grams: np.ndarray
    of_gram: np.ndarray
    contexts: np.ndarray
    of_context: np.ndarray
    others: np.ndarray
    words: np.ndarray
    of_word: np.ndarray
    values: DataFrame | None
    slope: float = 1.0
    cut: float = 0.0
    sent: Broadcast | None = None

    def shared(self, spark: SparkSession) -> Broadcast:
        """The arrays for tasks, sent once."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast(replace(self, values=None))
        return self.sent

    def of_words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ratio of each word but for its open grams, first open gram of each word and the end, open grams)."""
        grams, size = grams_of(column)
        context = grams >> _EIGHT
        place, known = found(self.contexts, context)
        at, there = found(self.grams, grams)
        ratio = np.where(there, picked(self.of_gram, at, there), picked(self.of_context, place, known))
        bit = place_of(context)
        rest = ~known & (self.others[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        ends = np.concatenate(([0], np.cumsum(size)))
        total = np.add.reduceat(ratio, ends[:-1]) if len(size) else np.zeros(0)
        return total, np.concatenate(([0], np.cumsum(rest)))[ends], grams[rest]


def place_of(contexts: np.ndarray) -> np.ndarray:
    """The bit of each context in the filter."""
    return (mix(contexts + np.uint64(1)) & np.uint64(BITS - 1)).astype(np.int64)


def mixture(ratio: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios of words of a toxic text, of which few come from the toxic model."""
    return np.log1p(RATE * np.expm1(np.clip(ratio, -50, 50)))


def parted(arrays: list[pa.Array], schema: list[str], most: int = FRAME) -> Iterator[pa.RecordBatch]:
    """The arrays as frames of a bounded number of rows."""
    whole = pa.RecordBatch.from_arrays(arrays, schema)
    yield from (whole.slice(i, most) for i in range(0, whole.num_rows, most))


def added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(key, t, o) with the counts of equal keys added up."""
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    sums = [np.bincount(inverse, np.concatenate([p[k] for p in parts]), len(keys)).astype(np.int64) for k in (1, 2)]
    return keys, *sums


def class_words(rows: DataFrame) -> DataFrame:
    """(word, t, o): how often each word stands in the toxic and in the ordinary texts of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, 8 << 20):
            words = words_of(part.column(1))
            toxic = np.repeat(np.array(part.column(0)), np.diff(words.first)).astype(bool)
            n = [np.bincount(words.inverse[m], minlength=len(words.name)) for m in (toxic, ~toxic)]
            yield from parted([words.texts(np.arange(len(words.name))), *map(pa.array, n)], ["word", "t", "o"])

    words = rows.select("toxic", "text").mapInArrow(run, "word string, t long, o long")
    return words.groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, t, o) of ``class_words``.

    Tasks add up their own grams, in tables of bounded size, before Spark adds up the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for part in slices(batches, 0, 1 << 18):
            grams, size = grams_of(part.column(0))
            held.append(added([(grams, *[np.repeat(np.array(part.column(k)), size) for k in (1, 2)])]))
            if sum(len(h[0]) for h in held) > HELD:
                held = [added(held)]
                if len(held[0][0]) > HELD // 2:
                    yield from frames(held.pop())
        if held:
            yield from frames(added(held))

    def frames(table: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        yield from parted([pa.array(table[0].view(np.int64)), *map(pa.array, table[1:])], ["gram", "t", "o"])

    counts = words.select("word", "t", "o").mapInArrow(run, "gram long, t long, o long")
    return counts.groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def class_counts(rows: DataFrame) -> DataFrame:
    """(gram, t, o): how often each gram stands in the toxic and in the ordinary texts of ``rows``."""
    return gram_counts(class_words(rows))


def shared_backoff(
    grams: np.ndarray, counts: np.ndarray, width: int = GRAM, below: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """p(last byte | bytes before it) of each gram of ``width`` bytes by interpolated Kneser-Ney over both classes.

    A shorter gram counts as often as there are different bytes before it; below single bytes all
    are alike. ``below`` has the (sorted grams, probabilities) of three bytes, if known.
    """

    def level(keys: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
        if below and width == 3:
            return below[1][np.searchsorted(below[0], keys)]
        _, context = np.unique(keys >> _EIGHT, return_inverse=True)
        seen = np.maximum(n - DISCOUNT, 0) / np.bincount(context, n)[context]
        left = 1 - np.bincount(context, seen)
        if width == 1:
            return seen + left[context] / 256
        mask = np.uint64((1 << 8 * (width - 1)) - 1)
        short, inverse, kinds = np.unique(keys & mask, return_inverse=True, return_counts=True)
        return seen + left[context] * level(short, kinds.astype(float), width - 1)[inverse]

    return level(grams, counts, width) if len(grams) else np.empty(0)


def three_bytes(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(gram, probability) of the last three bytes of all grams: as many as bytes make, however many texts."""
    four = counts.select(F.col("gram").bitwiseAND(F.lit((1 << 32) - 1)).alias("four")).distinct()
    three = four.groupBy(F.col("four").bitwiseAND(F.lit((1 << 24) - 1)).alias("three")).count().toArrow()
    keys, n = (three.column(k).to_numpy() for k in ("three", "count"))
    order = np.argsort(keys)
    keys = keys[order].astype(np.uint64)
    return keys, shared_backoff(keys, n[order].astype(float), 3)


def estimate(
    grams: np.ndarray, counts: np.ndarray, below: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, ...]:
    """Both classes: p(x | h) = max(n(h,x) - D, 0) / (n(h) + PRIOR) + what that leaves * shared backoff.

    Gives (ratio of each sorted gram, contexts, ratio of what is new in each, context of each gram). A
    gram that is rare or absent in a class thus has the probability that both classes share, and
    its ratio is near 1, however much less text one class has.
    """
    shared = shared_backoff(grams, counts.sum(axis=0), below=below)
    contexts, at = np.unique(grams >> _EIGHT, return_inverse=True)
    of_gram, of_context = np.zeros(len(grams)), np.zeros(len(contexts))
    for n, sign in zip(counts, (1, -1), strict=True):
        seen = np.maximum(n - DISCOUNT, 0) / (np.bincount(at, n, len(contexts))[at] + PRIOR)
        left = np.maximum(1 - np.bincount(at, seen, len(contexts)), 1e-9)
        of_gram += sign * np.log(seen + left[at] * shared)
        of_context += sign * np.log(left)
    return of_gram, contexts, of_context, at


def estimates(counts: DataFrame) -> DataFrame:
    """(context, n, place, other, ratios) of all grams: a map from next byte to ratio, ``other`` for bytes not in it.

    A task gets all grams with the same last three bytes of context. So it knows whatever their
    probabilities rest on, but for those of three bytes, which every task has.
    """
    shared = counts.sparkSession.sparkContext.broadcast(three_bytes(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for part in batches:
            held.append(part)
            rows += part.num_rows
            if rows < HELD // 4:
                continue
            table = pa.Table.from_batches(held)
            ends = np.flatnonzero(np.diff(table.column("part").to_numpy()))
            whole = int(ends[-1]) + 1 if len(ends) else 0
            if whole:
                yield from contexts_of(table.slice(0, whole))
                held = table.slice(whole).to_batches()
            rows = 0  # a group that goes on is looked at again after as many more rows
        if held:
            yield from contexts_of(pa.Table.from_batches(held))

    def contexts_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        grams = table.column("gram").to_numpy().view(np.uint64)
        order = np.argsort(grams)
        grams, n = grams[order], np.array([table.column(c).to_numpy()[order] for c in "to"], float)
        ratio, contexts, other, at = estimate(grams, n, shared.value)
        total = np.bincount(at, n.sum(axis=0), len(contexts)).astype(np.int64)
        first = np.searchsorted(at, np.arange(len(contexts) + 1)).astype(np.int32)
        following = (grams & np.uint64(255)).astype(np.int32)
        ratios = pa.MapArray.from_arrays(pa.array(first), pa.array(following), pa.array(ratio))
        arrays = [*map(pa.array, (contexts.astype(np.int64), total, place_of(contexts), other)), ratios]
        yield from parted(arrays, ["context", "n", "place", "other", "ratios"])

    part = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 24) - 1))
    rows = counts.withColumn("part", part).repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(run, "context long, n long, place long, other double, ratios map<int, double>")


def top(rows: DataFrame, n: F.Column, size: F.Column, most: int) -> F.Column:
    """Whether ``n`` of a row is beyond the least power of two from which on the sizes make at most ``most``."""
    power = F.floor(F.log2(n)).cast("int")
    least = None
    for r in sorted(rows.groupBy(power.alias("power")).agg(F.sum(size).alias("size")).collect(), reverse=True):
        most -= r["size"]
        if most < 0:
            break
        least = r["power"]
    return F.lit(False) if least is None else power >= least


def hot(values: DataFrame) -> Model:
    """A model whose tasks get the frequent contexts and a filter of the others, and no words as yet."""
    frequent = top(values, F.col("n"), F.size("ratios"), HOT)
    got = values.where(frequent).select("context", "other", F.explode("ratios").alias("next", "ratio")).toArrow()
    context, following = (got.column(c).to_numpy().astype(np.uint64) for c in ("context", "next"))
    grams = (context << _EIGHT) | following
    order = np.argsort(grams)
    contexts, sample = np.unique(context, return_index=True)
    other, ratio = (got.column(c).to_numpy() for c in ("other", "ratio"))
    values = values.where(~frequent)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    bits = values.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    others = np.zeros(BITS // 64, np.uint64)
    others[bits.column("at").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    none = np.empty(0, np.uint64), np.empty(0)
    return Model(grams[order], ratio[order], contexts, other[sample], others, *none, values)


def word_ratios(words: DataFrame, model: Model) -> DataFrame:
    """(name, ratio): log-likelihood ratio of each of the different ``words``, as part of a toxic text.

    Grams in frequent contexts are valued in the tasks, the others are joined to their estimates.
    """
    shared = model.shared(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0, 1 << 18):
            offsets, raw = text_bytes(part.column(0))
            name = names(raw, offsets[:-1], offsets[1:]).view(np.int64)
            total, first, grams = shared.value.of_words(part.column(0))
            grams = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(grams.view(np.int64)))
            yield from parted([pa.array(name), pa.array(total), grams], ["name", "total", "grams"], 4096)

    sums = words.select("word").mapInArrow(run, "name long, total double, grams array<long>")
    sums = freeze(sums, "toxicity-word-sums")
    rest = sums.select("name", F.explode("grams").alias("gram")).select(
        "name", F.shiftrightunsigned("gram", 8).alias("context"), F.col("gram").bitwiseAND(F.lit(255)).cast("int").alias("next")
    )
    ratio = F.coalesce(F.try_element_at("ratios", "next"), "other").alias("total")
    rest = rest.join(model.values.select("context", "other", "ratios").hint("merge"), "context").select("name", ratio)
    whole = sums.select("name", "total").unionByName(rest).groupBy("name").agg(F.sum("total").alias("ratio"))
    ratio = F.greatest(F.least("ratio", F.lit(50.0)), F.lit(-50.0))
    return whole.select("name", F.log1p(F.lit(RATE) * F.expm1(ratio)).alias("ratio"))


def known_words(words: DataFrame, model: Model) -> Model:
    """The model with the ratios of the most frequent of ``words`` that hold grams which tasks do not have."""
    shared = model.shared(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0, 1 << 18):
            _, first, _ = shared.value.of_words(part.column(0))
            yield part.filter(pa.array(np.diff(first) > 0))

    rows = words.select("word", (F.col("t") + F.col("o")).alias("n")).mapInArrow(run, "word string, n long")
    rows = freeze(rows, "toxicity-open-words")
    got = word_ratios(rows.where(top(rows, F.col("n"), F.lit(1), KNOWN)), model).toArrow()
    name, ratio = got.column("name").to_numpy().view(np.uint64), got.column("ratio").to_numpy()
    order = np.argsort(name)
    shared.destroy()
    model.sent = None
    return replace(model, words=name[order], of_word=ratio[order])


def mean_ratios(texts: DataFrame, model: Model) -> DataFrame:
    """(key, ratio): log-likelihood of a text as a toxic one less that as an ordinary one, by its words.

    ``texts`` are (key, text), equal keys for equal texts; each key is there once in the result, with 0
    if it has no words. Most words are valued in the tasks, the others are joined to their ratios.
    """
    shared = model.shared(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, 1, 2 << 20):
            words = words_of(part.column(1))
            at, known = found(model.words, words.name)
            value = picked(model.of_word, at, known)
            new = np.flatnonzero(~known)
            ratio, open_grams, _ = model.of_words(words.texts(new))
            closed = np.diff(open_grams) == 0
            value[new[closed]], known[new[closed]] = mixture(ratio[closed]), True
            n = np.diff(words.first)
            row = np.repeat(np.arange(part.num_rows), n)
            total = np.bincount(row, value[words.inverse], part.num_rows).astype(float)
            rest = np.flatnonzero(~known[words.inverse])
            most = max(len(words.name), 1)
            pairs, times = np.unique(row[rest] * most + words.inverse[rest], return_counts=True)
            row, word = pairs // most, pairs % most
            arrays = [pa.array(words.name.view(np.int64)[word]), words.texts(word), pa.array(times)]
            rare = pa.StructArray.from_arrays(arrays, ["name", "word", "times"])
            first = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(first), rare)
            arrays = [part.column(0), pa.array(total), pa.array(n), rare]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "total", "n", "rare"])

    rare = "array<struct<name: bigint, word: string, times: bigint>>"
    sums = texts.select("key", "text").mapInArrow(run, f"key binary, total double, n long, rare {rare}")
    # numbers that stay with the rows as they are frozen: shorter than keys
    sums = freeze(sums.withColumn("id", F.monotonically_increasing_id()), "toxicity-sums")
    rest = sums.select("id", F.explode("rare").alias("rare")).select("id", "rare.*")
    values = word_ratios(rest.select("name", "word").distinct(), model)
    rest = rest.select("id", "name", F.col("times").cast("int").alias("times")).join(values.hint("merge"), "name")
    rest = rest.groupBy("id").agg(F.sum(F.col("times") * F.col("ratio")).alias("more"))
    whole = sums.select("id", "key", "total", "n").join(rest.hint("merge"), "id", "left")
    whole = whole.select("key", (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"), "n").groupBy("key")
    return whole.agg((F.sum("total") / F.greatest(F.sum("n"), F.lit(1))).alias("ratio"))


def key_of(text: F.Column) -> F.Column:
    """128-bit digest of a text, null as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> Model:
    """Both models from all labelled texts that are not held out, and the scale of the score.

    Labels that are null, other than 0 and 1 or without a document teach nothing; an id labelled or
    stored twice counts as often. All grams of those texts are counted and have their estimates, in a
    table; the driver gets the grams of frequent contexts, the ratios of frequent words, and a
    histogram of the mean ratios of every fourth text.
    """
    marks = labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where("labelled is not null and toxic in (0, 1)").where(~held_out(F.col("labelled")))
    rows = docs.select("doc_id", F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS))
    # labels grow with the documents: never broadcast
    texts = rows.where(fold > 0).join(marks.hint("merge"), F.col("doc_id") == F.col("labelled"))
    texts = freeze(texts.select(F.col("toxic").cast("long").alias("toxic"), "text"), "toxicity-texts")
    words = freeze(class_words(texts), "toxicity-words")
    counts = freeze(gram_counts(words), "toxicity-grams")
    model = known_words(words, hot(freeze(estimates(counts), "toxicity-values")))
    return scaled(model, rows.where(fold == 0), marks)


def scaled(model: Model, rows: DataFrame, marks: DataFrame) -> Model:
    """Fit slope and cut on the histogram of mean ratios by class, both classes weighing the same.

    The cut, which gets the score 0.3, is the middle of where the least share of both classes is on the
    wrong side; the slope is that of a logistic regression through it. Without texts of both
    classes all scores are below the cut.
    """
    low = math.log1p(-RATE)
    rows = rows.select("doc_id", "text", key_of(F.col("text")).alias("key"))
    ratios = mean_ratios(rows, model)
    # labels meet the digests of the texts, not the texts
    rows = rows.select("doc_id", "key").join(marks.hint("merge"), F.col("doc_id") == F.col("labelled"))
    rows = rows.select("toxic", "key").join(ratios.hint("merge"), "key")
    bins = F.floor((F.col("ratio") - low) / (HIGH - low) * BINS)
    bins = F.greatest(F.least(bins, F.lit(BINS - 1)), F.lit(0))
    n = np.zeros((2, BINS))
    for r in rows.groupBy("toxic", bins.alias("bin")).count().collect():
        n[r["toxic"], r["bin"]] = r["count"]
    if not n.sum(axis=1).all():
        model.slope, model.cut = 1.0, 1e3
        return model
    n /= n.sum(axis=1, keepdims=True)
    edges = low + np.arange(BINS + 1) / BINS * (HIGH - low)
    wrong = np.concatenate(([0], np.cumsum(n[1]))) + 1 - np.concatenate(([0], np.cumsum(n[0])))
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    model.cut = float((edges[best[0]] + edges[best[-1]]) / 2)
    z, slope = (edges[:-1] + edges[1:]) / 2 - model.cut, 10.0
    for _ in range(100):  # Newton steps; the ridge bounds the slope of classes that part
        p = 1 / (1 + np.exp(-np.clip(slope * z, -40, 40)))
        gradient = (n[0] * p * z - n[1] * (1 - p) * z).sum() + 1e-6 * slope
        slope -= float(np.clip(gradient / ((n.sum(axis=0) * p * (1 - p) * z * z).sum() + 1e-6), -50, 50))
    model.slope = max(slope, 1.0)
    return model


def score_documents(
    docs: DataFrame, model: Model, text_col: str = "text", score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.3 on).

    Null and empty texts and those without words have the mean ratio 0. Columns of ``docs`` with these
    names are replaced; equal texts get equal scores. Rows meet their ratios by digests of the
    texts; the texts themselves are shuffled only if the caller keeps them.
    """
    text = F.col(text_col).cast("string")
    texts = docs.select(key_of(text).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    key, ratio = free_name(docs, "key_"), free_name(docs, "ratio_")
    rows = docs.withColumn(key, key_of(text))
    rows = rows.drop(*[c for c in docs.columns if c.lower() in (score.lower(), predicted.lower())])
    ratios = mean_ratios(texts, model).select(F.col("key").alias(key), F.col("ratio").alias(ratio))
    rows = rows.join(ratios.hint("merge"), key)
    x = model.slope * (F.col(ratio) - model.cut) + math.log(CUT_SCORE / (1 - CUT_SCORE))
    x = F.greatest(F.least(x, F.lit(700.0)), F.lit(-700.0))
    rows = rows.withColumn(score, 1 / (1 + F.exp(-x)))
    return rows.withColumn(predicted, (F.col(score) >= CUT_SCORE).cast("int")).drop(key, ratio)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
