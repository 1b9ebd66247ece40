"""Top-k search, sharding, components, numbering and the pipeline."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty
from tidemark.llm import common, sharding, topk


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rng = np.random.default_rng(2)
    vectors = rng.integers(-2, 3, (150, 6)).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, [1] * 6), (900, None)]
    df = spark.createDataFrame(rows, "id long, vector array<long>").repartition(5)
    found = topk.top_k(df, df.where("id % 10 = 0"), 5)
    want = set()
    for q in range(0, 150, 10):
        scored = sorted(((-int(np.dot(vectors[q], v)), i) for i, v in enumerate(vectors) if i != q))[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    assert {tuple(r) for r in found.collect()} == want


def best_by_hand(vectors, queries, k):
    scored = {q: sorted((-sum(map(int.__mul__, vectors[q], v)), i) for i, v in enumerate(vectors) if i != q)[:k] for q in queries}
    return {(q, r + 1, i, -s) for q, found in scored.items() for r, (s, i) in enumerate(found)}


def test_top_k_sends_no_block_through_the_driver(spark, monkeypatch, conf):
    """Copies of a small table's query blocks, one for each candidate block, were broadcast together."""
    for name, size in {"CANDIDATE_ROWS": 10, "QUERY_ROWS": 4, "QUERY_BLOCKS": 2}.items():
        monkeypatch.setattr(topk, name, size)
    conf(spark__sql__autoBroadcastJoinThreshold="10m")
    vectors = np.random.default_rng(3).integers(-9, 10, (200, 4)).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "id long, vector array<long>")
    found = topk.top_k(df, df.where("id % 10 = 0"), 5)
    assert {tuple(r) for r in found.collect()} == best_by_hand(vectors, range(0, 200, 10), 5)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [3, 2**15, 2**28])
def test_top_k_of_sparse_and_of_large_values(spark, size):
    """Scores of up to 32 bits and beyond; dimensions with few values and with many."""
    rng = np.random.default_rng(4)
    vectors = (rng.integers(-size, size + 1, (120, 5)) * (rng.random((120, 5)) < [0, 0.1, 0.5, 0.9, 1])).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "id long, vector array<long>")
    found = topk.top_k(df, df.where("id % 10 = 0"), 5)
    assert {tuple(r) for r in found.collect()} == best_by_hand(vectors, range(0, 120, 10), 5)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3]), (2, [])], "id long, vector array<long>")
    assert {tuple(r) for r in topk.top_k(df, df.where("id = 0"), 5).collect()} == {(0, 1, 1, 3), (0, 2, 2, 0)}
    none = empty(spark, "id long, vector array<long>")
    assert topk.top_k(none, none, 5).collect() == [] == topk.top_k(df, none, 5).collect()
    assert topk.top_k(none, df, 5).collect() == []


def test_usable_vectors(spark):
    rows = [([1.0, -0.5],), (None,), ([None, 1.0],), ([float("nan")],), ([float("inf")],), ([float("-inf")],)]
    df = spark.createDataFrame(rows, "v array<float>")
    assert [r.q for r in df.where(topk.usable(F.col("v"))).select(topk.quantised(F.col("v")).alias("q")).collect()] == [[256, -128]]


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards_are_even(spark, shards):
    docs = documents(spark)
    found = sharding.shard(docs, shards).collect()
    sizes = Counter(r["shard"] for r in found)
    assert len(found) == docs.count()
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in found if r["shard"] == s) == list(range(n))


def test_groups_stay_together_when_they_fit(spark):
    rows = [(i, f"text {i // 4}") for i in range(1600)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    places = {}
    for r in found:
        places.setdefault(r.doc_id // 4, set()).add(r["shard"])
    assert sum(len(p) > 1 for p in places.values()) <= 25
    assert set(Counter(r["shard"] for r in found).values()) == {160}


def test_a_hot_group_fills_whole_shards(spark):
    rows = [(i, "same") for i in range(70)] + [(100 + i, f"own {i}") for i in range(130)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    assert set(Counter(r["shard"] for r in found).values()) == {20}
    assert len({r["shard"] for r in found if r.doc_id < 100}) <= 6
    assert sharding.shard(empty(spark), 40).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 299)]
    found = {r.v: r.label for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 299: 299, 300: 299}
    assert common.components(empty(spark, "a long, b long")).collect() == []


def test_numbering_has_no_gaps(spark, monkeypatch):
    monkeypatch.setattr(common, "NUMBERING_ROWS", 7)
    df = spark.createDataFrame([(i % 3, i) for i in range(100)], "g int, x long")
    found = common.numbered(df, ["g"], ["x"], 100, "n").collect()
    for g in range(3):
        assert sorted(r.n for r in found if r.g == g) == list(range(sum(1 for r in found if r.g == g)))


def test_pipeline_equals_its_operators_alone(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, path)
        assert kept.columns == docs.columns, name
        docs = common.written(kept, "stage")
    want = sorted(tuple(r) for r in pipeline.STAGES[-1][1](spark, docs, path).collect())
    assert sorted(tuple(r) for r in pipeline.run(spark, path).collect()) == want
    assert 0 < len(want) < 200


def test_pipeline_stages_stand_awkward_rows(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = documents(spark)
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns and kept.count() <= docs.count(), name
        assert stage(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0, name
