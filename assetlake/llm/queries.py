"""The operators as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assetlake.llm import (
    bpe,
    grid_join,
    packing,
    pair_maxscore,
    probminhash,
    quality_classifier,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_counts,
    toxicity,
    variants,
    warc_zip,
)
from assetlake.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; every worker has the same one."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


@query("op3_epsilon_grid_join", grid_join.DIGEST_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.digest(table(spark, sf_dir, "embeddings"))


@query("op4_secret_scan", secret_scan.DIGEST_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@query("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


@query("op7_quality_rules", quality_rules.DIGEST_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op8_warc_zip", warc_zip.DIGEST_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.digest(table(spark, sf_dir, "pages"))


@query("op9_minhash_near_dedup", probminhash.GROUPS_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_pair_maxscore", pair_maxscore.DIGEST_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_maxscore.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_spelling_variants", variants.DIGEST_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.digest(table(spark, sf_dir, "documents"))
