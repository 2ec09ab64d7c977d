"""The pipeline and the registered queries over the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from assetlake.llm import queries as llm
from assetlake.llm.common import freeze
from tests.test_entry import rows_of

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = llm.QUERIES[name](spark, DATA)
    found = con.execute(llm.SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = freeze(stage(spark, docs, DATA), name)
        assert docs.columns == columns and 0 < docs.count() <= n
        assert docs.where("n_chars <> length(text)").isEmpty()
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert packed.select("doc_id").distinct().count() == n


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in E.queries()}
    assert "pipeline" in E.queries() and E.entry is not None


def test_stages_on_an_empty_table_with_clashing_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for name in ("mark_", "score_", "k1_", "spans_"):
        docs = docs.withColumn(name, F.lit(1))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = freeze(stage(spark, docs, DATA), name)
        assert docs.columns == columns and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == 0
