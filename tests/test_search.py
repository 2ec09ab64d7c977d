import pytest

from assetlake.operators import quality as Q
from assetlake.plans.search import search, search_similar

ROWS = [
    ("Metal032", "a", "metal", 0.3, 1.0, ["1k"], "ok"),
    ("Metal050A", "a", "metal", 0.5, 1.0, ["1k", "2k"], "failed"),
    ("Wood002", "b", "wood", 0.7, 0.0, ["1k"], "ok"),
    ("Bare", "b", "metal", None, 0.9, [], "ok"),
]
SCHEMA = (
    "id string, source string, category string, roughness double, metalness double, "
    "available_tiers array<string>, status string"
)


@pytest.fixture(scope="module")
def index(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_scalar_widens_to_an_inclusive_range(index):
    assert ids(search_similar(index, "metal", roughness=0.3)) == ["Metal032", "Metal050A"]


def test_scores_rank_and_add_up(index):
    got = search(index, roughness=0.5, metalness=0.9, score=True, tier=None).collect()
    assert [(r["id"], round(r["score"], 6)) for r in got] == [("Metal050A", 0.1), ("Metal032", 0.3)]


def test_score_without_scalar_adds_no_column(index):
    assert "score" not in search(index, score=True).columns


def test_ranges_tiers_sources_and_status(index):
    assert ids(search(index, metalness_range=(0.9, 1.0), tier=None, limit=9)) == [
        "Metal032", "Metal050A", "Bare",
    ]
    assert ids(search(index, tier="2k")) == ["Metal050A"]
    assert ids(search(index, tier="2k", include_failed=False)) == []
    assert ids(search(index, sources=["b"])) == ["Wood002"]
    assert ids(search(index, limit=0)) == []


def test_scalar_and_range_together_are_refused(index):
    with pytest.raises(ValueError):
        search(index, roughness=0.2, roughness_range=(0.1, 0.3))


def test_unknown_category_warns_and_gives_nothing(spark, index):
    files = spark.createDataFrame(
        [("a", "1k", "rowmap", "a-1k-metal-rowmap.json")],
        "source string, tier string, kind string, file_name string",
    )
    with pytest.warns(UserWarning):
        assert ids(search(index, "velvet", manifest_files=files)) == []
    assert ids(search(index, "metal", manifest_files=files)) == ["Metal032", "Metal050A"]


def test_search_is_one_filter_and_a_top_k(index):
    plan = search(index, "metal", roughness=0.4, score=True, limit=3)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_filters_reach_the_scan(spark, index, tmp_path):
    path = str(tmp_path / "index")
    index.write.parquet(path)
    out = search(spark.read.parquet(path), "metal", roughness_range=(0.1, 0.4)).select("id")
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category,metal)" in text and "GreaterThanOrEqual(roughness,0.1)" in text
    assert "metalness" not in text.split("ReadSchema")[1]


def test_gate(index):
    rows = {r["source"]: r for r in Q.success_gate(index, 0.6).collect()}
    assert (rows["a"]["ok"], rows["a"]["total"], rows["a"]["passed"]) == (1, 2, False)
    assert rows["b"]["passed"]
    Q.require_success(index, 0)
    with pytest.raises(Q.GateFailed):
        Q.require_success(index, 0.6)
