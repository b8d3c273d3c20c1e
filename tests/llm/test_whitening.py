"""Whitening against one decomposition of all rows, however they are partitioned."""

import numpy as np
import pytest

from kinloom.llm import whitening

CLASH = "vec_id long, embedding array<float>, label int, part int, n long, __vector string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, "x", "y") for i, v in rows], CLASH)


def vectors(seed, n, d):
    chance = np.random.default_rng(seed)
    return (chance.normal(size=(n, d)) @ chance.normal(size=(d, d)) / 7 + chance.normal(size=d)).astype(np.float32)


def plain(given, k=32):
    x = np.floor(64 * given.astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    centred = (n * x - s) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    return deviation, centred @ basis[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_is_the_plain_decomposition(spark, parts):
    given = vectors(1, 400, 12)
    rows = frame(spark, list(enumerate(given))).repartition(parts)
    found = whitening.whiten(rows).toPandas().sort_values(["component", "vec_id"])
    deviation, white, shares = plain(given)
    assert len(found) == 400 * 12
    assert found["n"].eq(400).all() and found["identity_error"].max() < 1e-9
    for c, own in found.groupby("component"):
        assert [int(x) for x in own["deviation"]] == deviation
        assert np.allclose(own["explained"], shares[c - 1], rtol=1e-9)
        ours, theirs = own["whitened"].to_numpy(), white[:, c - 1]
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8


def test_merge_loses_nothing():
    given = np.floor(1000 * vectors(2, 900, 20)).astype(np.int64)
    total = whitening.merge_all(whitening.summary_of(given[i : i + size]) for i, size in ((0, 1), (1, 5), (6, 394), (400, 500)))
    assert total.n == 900 and total.sums.tolist() == given.sum(axis=0).tolist()
    centred = given - given.mean(axis=0)
    assert np.allclose(total.singular, np.linalg.svd(centred, compute_uv=False), rtol=1e-10)
    assert np.allclose((total.singular[:, None] * total.vectors).T @ (total.singular[:, None] * total.vectors), centred.T @ centred, rtol=1e-9)


def test_edges(spark):
    given = vectors(3, 60, 6)
    bad = [(100, None), (101, []), (102, [1, None, 2, 3, 4, 5]), (103, [float("nan")] * 6), (104, [float("inf")] + [0] * 5)]
    rows = [*enumerate(given), (7, given[7]), (None, given[8])]
    found = whitening.whiten(frame(spark, rows + bad)).toPandas()
    assert len(found) == 62 * 6 and found["n"].eq(62).all()
    assert found["vec_id"].isna().sum() == 6 and not (found["vec_id"] >= 100).any()
    repeated = found[found["vec_id"] == 7].groupby("component")["whitened"].nunique()
    assert repeated.eq(1).all() and found["identity_error"].max() < 1e-9


def test_without_variance(spark):
    flat = vectors(4, 50, 3)
    rows = frame(spark, [(i, [*v, 5.0, v[0]]) for i, v in enumerate(flat)])  # rank 3 of 5
    found = whitening.whiten(rows).toPandas()
    assert len(found) == 250 and found["identity_error"].max() < 1e-9
    assert found.groupby("component")["whitened"].count().tolist() == [50, 50, 50, 0, 0]
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in one] == [(1, None, None, None, 0), (2, None, None, None, 0)]
    two = whitening.whiten(frame(spark, [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0])])).where("component = 1").toPandas()
    assert np.allclose(np.abs(two["whitened"]), 1) and np.allclose(two["explained"], 1)


def test_empty(spark):
    found = whitening.whiten(frame(spark, []))
    assert found.collect() == [] and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []


def test_unlike_lengths_are_an_error(spark):
    with pytest.raises(Exception, match="entries in one table"):
        whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0])]).repartition(2)).collect()


def test_deviations_beyond_a_long():
    model = whitening.Whitening(3 * 10**9, np.array([10**9 * 10**6, 7], object), np.eye(2), np.ones(2), np.ones(2) / 2, 2, 64.0, 0)
    x = np.array([[5_000_000, -9_000_000]])
    assert model.deviations(x) == [(3 * 10**9 * 5_000_000 - 10**15) ** 2 + (3 * 10**9 * -9_000_000 - 7) ** 2]
