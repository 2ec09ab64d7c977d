"""Near-duplicate vectors: epsilon grid order, and a recursive join of intervals of that order."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import components, forest, freeze

COSINE = 0.93
#: Leading principal dimensions that make the grid; the first ``KEYS`` of them pair the blocks.
DIMENSIONS, KEYS = 6, 2
#: Vectors of one interval, and of the intervals at which the recursion stops.
BLOCK, LEAF = 2048, 128


def usable(label: str, vector: str):
    """Vectors that can be linked: labelled, finite in every component and not zero."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    nonzero = lambda x: x != 0.0
    return F.col(label).isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, finite) & F.exists(v, nonzero), F.lit(False))


def unit_rows(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, column: str, width: int, keep: int) -> np.ndarray:
    """(width, keep) leading eigenvectors of the covariance of all unit vectors.

    Partitions add up products, Spark adds the partitions; the driver gets width x width sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if batch.num_rows:
                x = np.hstack([unit_rows(batch.column(0)), np.ones((batch.num_rows, 1))])
                total += x.T @ x
        i, j = np.divmod(np.arange(total.size), width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "v"])

    parts = vectors.select(column).mapInArrow(run, "i bigint, j bigint, v double")
    total = np.zeros((width + 1, width + 1))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[row["i"], row["j"]] = row["v"]
    n = max(total[width, width], 1.0)
    mean = total[width, :width] / n
    covariance = total[:width, :width] / n - np.outer(mean, mean)
    return np.linalg.eigh(covariance)[1][:, ::-1][:, :keep]


def grid_blocks(classes: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """Intervals of the grid order, one row each: block, label, low, high, members.

    Vectors are sorted by label, then by their cells on the leading axes, then by id, which splits
    cells that hold many vectors; an interval is up to ``BLOCK`` neighbours with one label.
    """
    keep = axes.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = unit_rows(batch.column(3)) @ axes if batch.num_rows else np.empty((0, keep))
            cells = np.floor(places / epsilon).astype(np.int32)
            columns = [pa.array(cells[:, k]) for k in range(keep)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    names = [f"cell{k}" for k in range(keep)]
    schema = "label long, rep long, m long, vector array<double>, " + ", ".join(f"{c} int" for c in names)
    rows = classes.select("label", "rep", "m", "vector").mapInArrow(project, schema)
    rows = rows.repartitionByRange("label", *names, "rep").sortWithinPartitions("label", *names, "rep")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= 2 * BLOCK:
                size = run_length(held)
                yield block(held.slice(0, size))
                held = held.slice(size)
        while held is not None and held.num_rows:
            size = run_length(held)
            yield block(held.slice(0, size))
            held = held.slice(size)

    def run_length(rows: pa.Table) -> int:
        label = rows.column("label").slice(0, BLOCK).to_numpy()
        return int(np.searchsorted(label != label[0], True))

    def block(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.select(["label", "rep", "m", "vector"]).combine_chunks()
        vectors = unit_rows(rows.column("vector").combine_chunks())
        places = vectors @ axes
        reps, m = rows.column("rep").to_numpy(), rows.column("m").to_numpy()
        row = {
            "block": [int(reps.min())],
            "label": [rows.column("label")[0].as_py()],
            "low": [places.min(axis=0).tolist()],
            "high": [places.max(axis=0).tolist()],
            "reps": [reps.tobytes()],
            "m": [m.tobytes()],
            "vectors": [vectors.tobytes()],
        }
        return pa.RecordBatch.from_pydict(row)

    out = "block long, label long, low array<double>, high array<double>, reps binary, m binary, vectors binary"
    return freeze(rows.mapInArrow(cut, out), "blocks")


def near_blocks(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(one, two) with one <= two: pairs of intervals with a label that are not provably distant.

    Each interval lies in a range of cells on the first axes; two can only hold neighbours if these
    ranges, one of them widened by a cell, meet. Pairs are found by equal cells, then boxes are
    compared on all axes.
    """
    sides = blocks.select("block", "label", "low", "high")
    cell = lambda c: F.floor(c / epsilon)

    def cells(df: DataFrame, wider: int) -> DataFrame:
        for k in range(KEYS):
            low, high = F.get("low", F.lit(k)), F.get("high", F.lit(k))
            df = df.withColumn(f"c{k}", F.explode(F.sequence(cell(low) - wider, cell(high) + wider)))
        return df

    keys = ["label", *[f"c{k}" for k in range(KEYS)]]
    one = cells(sides, 1).select(*keys, F.col("block").alias("one"), F.col("low").alias("low1"), F.col("high").alias("high1"))
    two = cells(sides, 0).select(*keys, F.col("block").alias("two"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    gap = F.zip_with(
        F.zip_with("low1", "high2", lambda a, b: a - b),
        F.zip_with("low2", "high1", lambda a, b: a - b),
        lambda a, b: F.greatest(a, b, F.lit(0.0)),
    )
    distance = F.aggregate(gap, F.lit(0.0), lambda acc, x: acc + x * x)
    pairs = one.join(two, keys).where((F.col("one") <= F.col("two")) & (distance <= epsilon * epsilon + 1e-9))
    return pairs.select("one", "two").distinct()


def join_intervals(a: np.ndarray, b: np.ndarray, axes: np.ndarray, cosine: float, same: bool):
    """Pairs (i, j) with cosine at least ``cosine``; i < j if both sides are the same interval.

    The intervals are halved until they are short; halves whose boxes on the leading axes are
    farther apart than the distance of the cosine are skipped with all that is in them.
    """
    epsilon2 = 2 - 2 * cosine + 1e-9
    pa_, pb = a @ axes, b @ axes
    left, right = [], []

    def join(i0: int, i1: int, j0: int, j1: int) -> None:
        if same and i0 >= j1:
            return
        low = np.maximum(pa_[i0:i1].min(axis=0) - pb[j0:j1].max(axis=0), pb[j0:j1].min(axis=0) - pa_[i0:i1].max(axis=0))
        if (np.maximum(low, 0) ** 2).sum() > epsilon2:
            return
        if i1 - i0 <= LEAF and j1 - j0 <= LEAF:
            i, j = np.nonzero(a[i0:i1] @ b[j0:j1].T >= cosine)
            i, j = i + i0, j + j0
            if same:
                i, j = i[i < j], j[i < j]
            left.append(i)
            right.append(j)
            return
        i2 = (i0 + i1) // 2 if i1 - i0 > LEAF else i1
        j2 = (j0 + j1) // 2 if j1 - j0 > LEAF else j1
        for s, e in ((i0, i2), (i2, i1)):
            for t, u in ((j0, j2), (j2, j1)):
                if s < e and t < u:
                    join(s, e, t, u)

    join(0, len(a), 0, len(b))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def link_blocks(pairs: DataFrame, axes: np.ndarray, cosine: float) -> DataFrame:
    """(lo, hi, n): with hi null, n vectors linked to class lo; else a link that joins lo and hi."""
    width = axes.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                same = value["one"] == value["two"]
                ids, m, vectors = [], [], []
                for side in "12":
                    ids.append(np.frombuffer(value["reps" + side], np.int64))
                    m.append(np.frombuffer(value["m" + side], np.int64))
                    vectors.append(np.frombuffer(value["vectors" + side], np.float64).reshape(-1, width))
                left, right = join_intervals(*vectors, axes, cosine, same)
                if not len(left):
                    continue
                n1 = np.bincount(left, m[1][right], len(ids[0])).astype(np.int64)
                n2 = np.bincount(right, m[0][left], len(ids[1])).astype(np.int64)
                nodes = ids[0] if same else np.concatenate(ids)
                place = np.argsort(nodes, kind="stable")
                rank = np.empty(len(nodes), np.int64)
                rank[place] = np.arange(len(nodes))
                root = forest(len(nodes), rank[left], rank[right + (0 if same else len(ids[0]))])
                moved = np.flatnonzero(root != np.arange(len(nodes)))
                lo = np.concatenate([ids[0][n1 > 0], ids[1][n2 > 0], nodes[place[root[moved]]]])
                counts = np.concatenate([n1[n1 > 0], n2[n2 > 0], np.zeros(len(moved), np.int64)])
                none = len(lo) - len(moved)
                hi = pa.array([None] * none + nodes[place[moved]].tolist(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(lo), hi, pa.array(counts)], ["lo", "hi", "n"])

    return pairs.mapInArrow(run, "lo long, hi long, n long")


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every vector.

    Two vectors are linked when their labels and lengths are equal and their cosine, in double
    precision, is at least ``cosine``. Equal vectors of a label are folded into one with a count, so
    copies are never paired; they count as links of each other. Vectors of each length are joined by
    themselves, on axes of their own. Vectors without label or id, with a null or non-finite
    component, or all zero link with nothing and are kept, their component being their own id.
    """
    v = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    v = v.withColumn("usable", F.coalesce(usable("label", "vector") & F.col("id").isNotNull(), F.lit(False)))
    out = v.where(~F.col("usable")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
    )
    widths = v.where("usable").select(F.size("vector").alias("w")).distinct().orderBy("w")
    for width in [r["w"] for r in widths.collect()]:  # one row for each embedding model
        good = v.where("usable").where(F.size("vector") == width)
        known = joined(good, width, cosine)
        out = out.unionByName(
            good.select("id", "label", "vector").join(known, ["label", "vector"]).select(
                "id", "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
            )
        )
    return out


def joined(good: DataFrame, width: int, cosine: float) -> DataFrame:
    """(label, vector, n_links, component_id) of vectors of one length, frozen."""
    epsilon = math.sqrt(2 - 2 * cosine)
    classes = freeze(
        good.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("m")), "classes"
    )
    axes = principal_axes(classes, "vector", width, min(DIMENSIONS, width))
    if axes.shape[1] < KEYS:  # vectors of one component: a second axis that is always zero
        axes = np.hstack([axes, np.zeros((axes.shape[0], KEYS - axes.shape[1]))])
    blocks = grid_blocks(classes, axes, epsilon)
    side = lambda k: blocks.select(
        F.col("block").alias("one" if k == "1" else "two"), *[F.col(c).alias(c + k) for c in ("reps", "m", "vectors")]
    )
    pairs = freeze(near_blocks(blocks, epsilon), "pairs").repartition("one", "two")
    links = freeze(link_blocks(pairs.join(side("1"), "one").join(side("2"), "two"), axes, cosine), "links")
    counts = links.where("hi is null").groupBy(F.col("lo").alias("rep")).agg(F.sum("n").alias("linked"))
    found = components(links.where("hi is not null"), "lo", "hi").withColumnRenamed("node", "rep")
    return freeze(
        classes.join(counts, "rep", "left").join(found, "rep", "left").select(
            "label", "vector", (F.col("m") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ), "known",
    )


def digest(rows: DataFrame) -> DataFrame:
    return near_vectors(rows).withColumnRenamed("id", "vec_id")


DIGEST_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
r(a, b) AS (SELECT DISTINCT a, a FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component_id, vec_id) AS component_id,
  vec_id = coalesce(c.component_id, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""
