"""Each key once, however late it is delivered again: key tables on disk behind Bloom filters."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assetlake.session import cut

BUCKETS = 256
#: Bits of a filter per key and places each key sets: 1 in some 2000 other keys seems to be there.
BITS, PLACES = 16, 7
BLOOM = "bucket int, bits binary"


def places(hashes: np.ndarray, size: int) -> np.ndarray:
    """(keys, PLACES) bits of a filter of ``size`` bits, a power of two, by double hashing."""
    h = hashes.view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(PLACES, dtype=np.uint64)) & np.uint64(size - 1)


def make_filter(hashes: np.ndarray) -> bytes:
    size = max(64, 1 << int(BITS * len(hashes) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[places(hashes, size).ravel().astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def in_filter(hashes: np.ndarray, data: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8)).view(bool)
    return bits[places(hashes, len(bits)).astype(np.int64)].all(axis=1)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"bucket": pdf["_bucket"].iloc[:1], "bits": [make_filter(pdf["_hash"].to_numpy(np.int64))]})


def _probe(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """(hash, batch): the batches in whose key table a key may be."""
    hashes = keys["_hash"].to_numpy(np.int64)
    found = [hashes[in_filter(hashes, bits)] for bits in filters["bits"]] if len(hashes) else []
    rows = [pd.DataFrame({"_hash": f, "batch": b}) for f, b in zip(found, filters["batch"], strict=False)]
    rows = [r for r in rows if len(r)]
    return pd.concat(rows).astype({"batch": "int32"}) if rows else pd.DataFrame({"_hash": np.empty(0, np.int64), "batch": np.empty(0, np.int32)})


def same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def unseen(spark: SparkSession, rows: DataFrame, keys: list[str], path: str, batch_id: int) -> DataFrame:
    """``rows`` (with _hash and _bucket) whose key is in no key table of the batches before.

    Filters are met by bucket; only keys that some filter lets through are compared exactly, with the
    tables and buckets that may have them.
    """
    filters = spark.read.schema(BLOOM + ", batch int").parquet(f"{path}/bloom").filter(F.col("batch") < batch_id)
    hits = rows.select("_bucket", "_hash").groupBy("_bucket").cogroup(
        filters.withColumnRenamed("bucket", "_bucket").groupBy("_bucket")
    ).applyInPandas(_probe, "_hash long, batch int")
    hits = cut(hits.withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS)).cast("int")))
    where = hits.groupBy("batch").agg(F.collect_set("_bucket").alias("buckets")).collect()  # at most BUCKETS a batch
    if not where:
        return rows
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    old = spark.read.schema(f"{kinds}, batch int, bucket int").parquet(f"{path}/keys")
    parts = [(F.col("batch") == r["batch"]) & F.col("bucket").isin(r["buckets"]) for r in where]
    old = old.filter(reduce(Column.__or__, parts)).select(*keys)
    asked = hits.select("_hash").distinct()
    doubtful, sure = rows.join(asked, "_hash"), rows.join(asked, "_hash", "left_anti")
    kept = doubtful.alias("new").join(old.alias("old"), same("new", "old", keys), "left_anti")
    return sure.unionByName(kept.select(*[f"new.{c}" for c in rows.columns]))


def dedupe_to_table(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Write each key once, the first time it is delivered, below ``<path>/rows/batch=<n>``.

    No state is kept in memory and there is no watermark: a duplicate of any age is found. The keys of
    a batch lie in buckets below ``<path>/keys/batch=<n>``, a Bloom filter per bucket below
    ``<path>/bloom/batch=<n>``. Of rows of one batch with the same key one is written; null keys are
    equal. A batch that is repeated overwrites itself and looks at earlier ones only.
    """
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        named = batch.dropDuplicates(keys).withColumn("_hash", F.xxhash64(*keys))
        named = cut(named.withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS)).cast("int")))
        new = cut(unseen(spark, named, keys, path, batch_id)) if batch_id else named
        new.select(*keys, F.col("_bucket").alias("bucket")).repartition("bucket").write.mode("overwrite").partitionBy(
            "bucket"
        ).parquet(f"{path}/keys/batch={batch_id}")
        filters = new.select("_bucket", "_hash").groupBy("_bucket").applyInPandas(_build, BLOOM)
        filters.write.mode("overwrite").parquet(f"{path}/bloom/batch={batch_id}")
        new.drop("_hash", "_bucket").write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
