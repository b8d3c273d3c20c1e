"""Codes against a search of all entries in Python's own integers."""

import hashlib

import numpy as np
import pytest

from kinloom.llm import vector_codes

CLASH = "vec_id long, embedding array<float>, label int, code string, error string, __label int, position int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "x", "y", 1, 2) for i, v, lab in rows], CLASH)


def plain(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label_error, sha) of usable rows, nearest entries by comparing all of them."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, list(r[1])))
    xs = [[int(np.floor(1024 * float(x))) for x in v] for _, v, _ in rows]
    width = len(xs[0]) // parts
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for x in xs]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, q):
        return min((sum((a - b) ** 2 for a, b in zip(q, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        near = [[nearest(p, c[p])[1] for c in cut] for p in range(parts)]
        for p in range(parts):
            for k in set(near[p]):
                own = [c[p] for c, i in zip(cut, near[p], strict=True) if i == k]
                books[p][k] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for (_, _, lab), e in zip(rows, errors, strict=True):
        labels[lab] = labels.get(lab, 0) + e
    return sorted((str(i), "".join(f"{k:02x}" for _, k in f), e, labels[lab], sha) for (i, _, lab), f, e in zip(rows, found, errors, strict=True))


def ours(df, **settings):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vector_codes.compress(df, **settings).collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_is_the_plain_search(spark, parts):
    chance = np.random.default_rng(parts)
    given = np.round(chance.normal(size=(330, 8)), 1).astype(np.float32)  # coarse: many ties
    rows = [(i, v, [None, 1, 2][i % 3]) for i, v in enumerate(given)]
    assert ours(frame(spark, rows).repartition(parts)) == plain(rows)


@pytest.mark.parametrize("seed", range(4))
def test_tree_is_exact(seed):
    chance = np.random.default_rng(seed)
    spread = [3, 50, 10_000, 2**27][seed]
    book = chance.integers(-spread, spread, size=(256, 5))
    book[200:230] = book[:30]  # equal entries: the lower index wins
    parts = np.vstack([chance.integers(-spread, spread, size=(5000, 5)), book, book + 1])
    index, squares = vector_codes.BallTree(book).nearest(parts)
    away = ((parts[:, None].astype(object) - book[None].astype(object)) ** 2).sum(axis=2) if seed == 3 else ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (np.array(away.argmin(axis=1)) == index).all() and (away.min(axis=1) == squares).all()


def test_tree_leaves_out_far_nodes():
    chance = np.random.default_rng(9)
    centres = chance.integers(-10**6, 10**6, size=(16, 6))
    book = np.repeat(centres, 16, axis=0) + chance.integers(-50, 50, size=(256, 6))
    tree = vector_codes.BallTree(book)
    tree.nearest(book)
    assert tree.visited < 0.2 * 256 * 256


def test_edges(spark):
    chance = np.random.default_rng(5)
    good = [(i, chance.normal(size=8).astype(np.float32), i % 2) for i in range(20)]
    good += [(3, good[3][1], 1), (3, good[4][1], None), (None, good[5][1], None)]
    bad = [(50, None, 0), (51, [], 0), (52, [None] * 8, 0), (53, [float("nan")] * 8, 1), (54, [float("-inf")] * 8, 1)]
    assert ours(frame(spark, good + bad).repartition(3)) == plain(good)
    assert ours(frame(spark, good), entries=4, rounds=2) == plain(good, entries=4, rounds=2)


def test_empty(spark):
    found = vector_codes.compress(frame(spark, [(1, None, 1)]))
    assert found.collect() == [] and found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_errors(spark):
    with pytest.raises(Exception, match="cannot be cut"):
        ours(frame(spark, [(1, [1.0, 2.0, 3.0], 1)]))
    with pytest.raises(Exception, match="too large"):
        ours(frame(spark, [(1, [1e30, 2.0, 3.0, 4.0], 1)]))
    with pytest.raises(Exception, match="unlike lengths|entries in one table"):
        ours(frame(spark, [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)]))
