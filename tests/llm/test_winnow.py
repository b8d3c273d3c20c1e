"""Choices against a plain loop over windows, and the match guarantee."""

import hashlib

import numpy as np
import pytest

from kinloom.llm import winnow
from tests.llm.conftest import prose


def brute(text):
    codes = [ord(c) + 1 for c in text]
    if not codes:
        return []
    codes += [0x110000 + 1] * (winnow.K - len(codes))
    grams = [codes[i : i + winnow.K] for i in range(len(codes) - winnow.K + 1)]
    hashes = []
    for gram in grams:
        h = 0
        for c in gram:
            h = (h * 0x9E3779B97F4A7C15 + c) % 2**64
        h ^= h >> 32
        hashes.append(h * 0xD6E8FEB86659FD93 % 2**64 >> 32)
    size = next(w for w in (64, 32, 16, 8) if len(text) >= 8 * w or w == 8)
    size = min(size, len(hashes))
    chosen = set()
    for i in range(len(hashes) - size + 1):
        window = hashes[i : i + size]
        chosen.add(i + max(k for k, h in enumerate(window) if h == min(window)))
    return [(hashes[p], p) for p in sorted(chosen)]


@pytest.mark.parametrize("text", ["", "a", "short text", "x" * 300, prose(4, 200), "日本語" * 60, "ab" * 100])
def test_choices(text):
    hashes, positions = winnow.chosen(text)
    assert list(zip(hashes.tolist(), positions.tolist(), strict=True)) == brute(text)


def test_a_shared_passage_shares_a_choice():
    passage = prose(9, 30)[: winnow.K + winnow.WINDOW - 1]
    a, b = prose(5, 100) + passage + prose(6, 90), prose(7, 50) + passage + prose(8, 20)
    assert set(winnow.chosen(a)[0].tolist()) & set(winnow.chosen(b)[0].tolist())


def test_edits_and_neighbours(documents, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None and r[0] != 7] + [(200 + i, prose(i, 5 * i)) for i in range(60)]
    got = {r["doc_id"]: r for r in winnow.compare_edited(documents(rows).repartition(4)).collect()}
    ordered = sorted(rows)
    assert len(got) == len(rows)
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following, row = text or "", following or "", got[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, nxt = (winnow.chosen(t) for t in (text, edited, following))
        assert row["fingerprint"] == winnow.as_hex(*own) and row["edited_fingerprint"] == winnow.as_hex(*changed)
        jaccard = lambda a, b: 1.0 if not (set(a) | set(b)) else len(set(a) & set(b)) / len(set(a) | set(b))
        assert row["near_edited"] == jaccard(own[0].tolist(), changed[0].tolist())
        assert row["near_next"] == jaccard(own[0].tolist(), nxt[0].tolist())


def test_repeated_null_and_single_rows(documents, edge_rows):
    assert winnow.compare_edited(documents(edge_rows)).count() == len(edge_rows)
    one = winnow.compare_edited(documents([(1, "abcdef")])).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(1, 1.0)]
    assert winnow.compare_edited(documents([])).collect() == []
    assert winnow.fingerprints(documents([(1, None)])).first()["hashes"] == []


def test_half_of_a_short_text_is_still_found(documents):
    rows = [(i, prose(i, 40)[: 50 + i]) for i in range(100)]
    got = winnow.compare_edited(documents(rows)).collect()
    assert all(r["near_edited"] > 0 for r in got)


def test_a_hot_id_is_dealt_out(documents):
    """10,000 rows of one id, two thirds of them one text, beside 50 others; results as by one sorted list."""
    rows = [(7, prose(i % 100 if i % 3 else 0, 12)) for i in range(10_000)] + [(i, prose(i, 30)) for i in range(100, 150)]
    docs = documents(rows).repartition(4)
    given = winnow._stretches(docs, "doc_id", "text")
    sizes = [r["n"] for r in given.groupBy("part").count().withColumnRenamed("count", "n").collect()]
    assert max(sizes) < 0.6 * len(rows) and sum(sizes) <= len(rows) + 4 * len(sizes)
    got = winnow.compare_edited(docs)
    assert got.count() == len(rows)
    own = got.where("doc_id = 7")
    # Equal texts stand together, so all but the last of each are followed by an equal one.
    assert own.where("near_next < 1").count() <= 100
    null = documents([(None, prose(i, 10)) for i in range(300)])
    assert winnow.compare_edited(null).count() == 300


def test_stretches_ascend():
    chance = np.random.default_rng(2)
    keys, ties = chance.integers(0, 6, 3000), chance.integers(0, 1000, 3000)
    keys[keys > 3] = 3
    ties[::3], keys[::3] = 100, 3  # a third are copies of one row
    top = (1 << 63) - 1
    bounds = winnow.Bounds([(0, top), (2, top), (3, 100), (3, 100), (3, 100), (3, 400), (3, top), (5, top)])
    parts = bounds.stretch(keys, ties, chance.integers(0, 1 << 40, 3000))
    order = np.lexsort((parts, ties, keys))
    assert (np.diff(parts[order]) >= 0).all()
    assert len(set(parts[(keys == 3) & (ties == 100)].tolist())) == 3 and len(set(parts[keys == 3].tolist())) == 5
    base = bounds.stretch(keys, ties)
    least = {int(p): min((int(k), int(t)) for k, t, o in zip(keys, ties, base, strict=True) if o == p) for p in set(base.tolist())}
    rows = sorted((int(p), int(k), int(t)) for p, k, t in zip(parts, keys, ties, strict=True))
    following = {p: (k, t) for p, k, t in bounds.followers(least)}
    for i, (p, *_) in enumerate(rows):
        if i + 1 == len(rows) or rows[i + 1][0] != p:
            assert following[p] == rows[(i + 1) % len(rows)][1:]


def test_rows_in_another_order_each_time(documents, spark):
    """A frame whose rows come differently whenever it is computed still gives every row, with the right neighbour."""
    rows = [(i, prose(i, 20)) for i in range(400)] + [(500, prose(i % 5, 12)) for i in range(600)]

    def shuffled(batches):
        import random

        for batch in batches:
            order = list(range(batch.num_rows))
            random.SystemRandom().shuffle(order)
            yield batch.take(__import__("pyarrow").array(order))

    docs = documents(rows).repartition(4)
    docs = docs.mapInArrow(shuffled, docs.schema)
    got = winnow.compare_edited(docs).collect()
    assert len(got) == len(rows)
    stable = winnow.compare_edited(documents(rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in stable)
    by_id = {r["doc_id"]: r for r in got}
    for i in range(399):
        text, following = prose(i, 20), prose(i + 1, 20)
        half = len(text) // 2
        assert by_id[i]["edited_sha256"] == hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()


def test_equal_texts_have_equal_fingerprints(documents):
    got = winnow.compare_edited(documents([(i, prose(1, 90)) for i in range(20)])).collect()
    assert len({r["fingerprint"] for r in got}) == 1
    assert {r["near_next"] for r in got} == {1.0}
    assert isinstance(np.float64(got[0]["near_edited"]).item(), float)
