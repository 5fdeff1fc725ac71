"""Embedding near-duplicates against brute force."""

import numpy as np
import pytest

from pairpulse.llm import embeddings

SMALL = "/root/testdata/sf0.01"


def brute(vectors):
    v = np.array(vectors, float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return v @ v.T >= 0.9


def test_recall_and_links(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = frame.orderBy("vec_id").collect()
    near = brute([r.embedding for r in rows])
    result = embeddings.linked_vectors(frame)
    found = {r.vec_id: r for r in result.collect()}
    true = {r.vec_id: int(n) - 1 for r, n in zip(rows, near.sum(axis=1))}
    assert all(found[i].n_links <= n for i, n in true.items())
    assert sum(r.n_links for r in found.values()) >= 0.95 * sum(true.values())
    assert all(r.kept == (r.vec_id == r.component_id) and r.component_id <= r.vec_id for r in found.values())
    assert embeddings.audited_recall(frame, result) >= 0.9


@pytest.mark.parametrize("size", [64, 1024])
def test_hot_cluster_is_cut_into_shards(spark, monkeypatch, size):
    monkeypatch.setattr(embeddings, "SHARD_VECTORS", size)
    random = np.random.default_rng(5)
    centre = random.normal(size=16)
    v = np.concatenate([centre + 0.05 * random.normal(size=(300, 16)), random.normal(size=(100, 16))])
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    true = brute(v).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in embeddings.linked_vectors(frame).collect()}
    assert all(found[i] <= n for i, n in enumerate(true)) and sum(found.values()) >= 0.95 * true.sum()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 5), (2, [2.0, 0.0], 6), (2, [2.0, 0.0], 6), (3, [0.0, 0.0], 1), (4, None, 1),
            (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [], 1), (9, [1.0, 0.0, 0.0], 1),
            (None, [0.0, -1.0], 1), (10, [-1.0, 0.01], 1), (11, [1e300, 1e300], 1), (12, [1e-300, 1e-300], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long")
    found = embeddings.linked_vectors(frame).collect()
    assert len(found) == len(rows)
    by_id = {r.vec_id: r for r in found}
    assert (by_id[1].n_links, by_id[1].component_id, by_id[1].kept) == (2, 1, True)
    assert (by_id[2].n_links, by_id[2].component_id, by_id[2].kept) == (2, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert (by_id[i].n_links, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert (by_id[11].n_links, by_id[12].component_id) == (1, 11) and by_id[None].n_links == 0
    assert embeddings.linked_vectors(frame.limit(0)).count() == 0
