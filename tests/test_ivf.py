"""Compressed inverted lists: recall, whole indexing, every list probed, saved and loaded."""

import numpy as np
import pytest

from kinloom.config import DenseConfig
from kinloom.operators import ivf, knn


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, key, rows):
    return spark.createDataFrame([(i, p, v.tolist()) for i, p, v in rows], f"{key} long, part string, embedding array<double>")


def test_ten_thousand_references(spark):
    """8 dimensions in two bytes, eight lists: the query that is a reference comes first, with a cosine of one."""
    vectors = unit(np.random.default_rng(13).normal(size=(10_000, 8)))
    references = frame(spark, "r", [(i, "US", v) for i, v in enumerate(vectors)])
    queries = frame(spark, "q", [(i, "US", vectors[17 * i + 17]) for i in range(60)])
    for nprobe, least in ((8, 0.95), (5, 0.9)):
        config = DenseConfig(seed=13, ann_training_rows=10_000, nlist=8, nprobe=nprobe, pq_m=2, ann_shortlist=128, ann_top_k=5)
        got = ivf.top_k(queries, references, config).collect()
        assert len(got) == 300
        first = {r["q"]: r for r in got if r["rank"] == 1}
        assert all(first[i]["r"] == 17 * i + 17 and first[i]["cosine"] == pytest.approx(1) for i in range(60))
        best = {(i, int(r)) for i in range(60) for r in np.argsort(-(vectors @ vectors[17 * i + 17]), kind="stable")[:5]}
        assert len(best & {(r["q"], r["r"]) for r in got}) >= least * len(best)


def test_shortlist_acts(spark):
    """With coarse codes, a shortlist of five ranks what the codes chose; a longer one finds more."""
    vectors = unit(np.random.default_rng(3).normal(size=(3000, 16)))
    references, queries = frame(spark, "r", [(i, "x", v) for i, v in enumerate(vectors)]), frame(spark, "q", [(i, "x", vectors[i]) for i in range(100)])
    best = {(i, int(r)) for i in range(100) for r in np.argsort(-(vectors @ vectors[i]), kind="stable")[:5]}
    found = []
    for shortlist in (5, 200):
        got = ivf.top_k(queries, references, DenseConfig(nlist=4, nprobe=4, pq_m=2, ann_top_k=5, ann_shortlist=shortlist)).collect()
        found.append(len(best & {(r["q"], r["r"]) for r in got}))
    assert found[0] < 0.8 * len(best) < 0.95 * len(best) < found[1]


def test_each_partition_has_its_own_lists(spark):
    chance = np.random.default_rng(4)
    rows = [(i, "a", v) for i, v in enumerate(unit(chance.normal(size=(600, 8))))]
    rows += [(1000 + i, "b", v) for i, v in enumerate(unit(chance.normal(size=(90, 8))))] + [(5000, "c", unit(np.ones((1, 8)))[0])]
    references = frame(spark, "r", rows)
    config = DenseConfig(nlist=8, nprobe=2, pq_m=4, ann_top_k=3, ann_training_rows=300)
    index = ivf.build(references, config)
    lists = {r["part"]: r["lists"] for r in index.models.collect()}
    assert lists["b"] == 2 and lists["c"] == 1 and 5 <= lists["a"] <= 8
    assert {r["part"]: r["count"] for r in index.codes.groupBy("part").count().collect()} == {"a": 600, "b": 90, "c": 1}
    assert {len(r["code"]) for r in index.codes.collect()} == {4}
    queries = frame(spark, "q", [(i, p, rows[i][2]) for i in range(40) for p in "abcd"])
    counts = {r["part"]: r["count"] for r in ivf.search(index, queries, references, config).groupBy("part").count().collect()}
    assert counts == {"a": 120, "b": 120, "c": 40}  # no references in d


def test_blocks_change_nothing(spark, monkeypatch, tmp_path):
    """Small blocks split lists and queries over many tasks; an index read back gives the same."""
    vectors = unit(np.random.default_rng(6).normal(size=(900, 8)))
    references, queries = frame(spark, "r", [(i, "x", v) for i, v in enumerate(vectors)]), frame(spark, "q", [(i, "x", vectors[i]) for i in range(50)])
    config = DenseConfig(nlist=6, nprobe=3, pq_m=4, ann_top_k=5, ann_shortlist=40)
    rows = lambda df: sorted((r["q"], r["r"], r["rank"]) for r in df.collect())
    whole = rows(ivf.top_k(queries, references, config))
    monkeypatch.setattr(ivf, "BLOCK", 64)
    monkeypatch.setattr(ivf, "ASKED", 16)
    index = ivf.build(references.repartition(5), config)
    assert index.bins.agg({"bin": "max"}).first()[0] > 2 and index.bins.agg({"blocks": "max"}).first()[0] > 1
    assert rows(ivf.search(index, queries.repartition(3), references, config)) == whole
    index.save(f"file://{tmp_path}/index")
    again = ivf.Index.load(spark, f"file://{tmp_path}/index")
    assert rows(ivf.search(again, queries, references, config)) == whole


def test_codes_name_the_nearest_entries():
    x = np.random.default_rng(8).normal(size=(700, 12)).astype(np.float32)
    centres, books = ivf.fit_index(x, 5, 3, seed=1)
    own, codes = ivf.codes_of(x, centres, books)
    assert (own == ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)).mean() > 0.999
    offsets = (x - centres[own]).reshape(700, 3, 4)
    decoded = np.stack([books[p][codes[:, p]] for p in range(3)], axis=1)
    best = np.stack([((offsets[:, p, None] - books[p][None]) ** 2).sum(axis=2).min(axis=1) for p in range(3)], axis=1)
    assert np.allclose(((offsets - decoded) ** 2).sum(axis=2), best, atol=1e-4)
    assert ((offsets - decoded) ** 2).sum() < 0.2 * (offsets**2).sum()
    for i, ids, scores in ivf.scan_block(x[:9], [[0, 3]] * 9, [(x[i] @ centres[[0, 3]].T).tolist() for i in range(9)], own, codes, np.arange(700), books, 50):
        near = np.flatnonzero(np.isin(own, [0, 3]))
        approximate = (centres[own[near]] + decoded[near].reshape(-1, 12)) @ x[i]
        assert np.allclose(scores, np.sort(approximate)[::-1][:50], atol=1e-4) and set(ids) <= set(near.tolist())


def test_settings(spark):
    with pytest.raises(Exception, match="pq_m"):
        ivf.top_k(frame(spark, "q", [(1, "x", np.ones(8))]), frame(spark, "r", [(1, "x", np.ones(8))]), DenseConfig(pq_m=3)).collect()
    none = frame(spark, "r", [(1, "x", np.ones(8))]).where("r < 0")
    assert ivf.top_k(frame(spark, "q", [(1, "x", np.ones(8))]), none, DenseConfig(pq_m=2)).collect() == []
    assert knn.exact_top_k(frame(spark, "q", [(1, "x", np.ones(8))]), none, 3).collect() == []
