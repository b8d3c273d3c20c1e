"""Components against all pairs of a small table."""

import random
import re

import numpy as np

from kinloom.llm import jaccard_join
from tests.llm.conftest import prose


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y in range(x):
            b = sets[y][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, len(s), least[find(x)]) for x, (i, s) in enumerate(sets))


def variants(seed, n_groups=12, size=14):
    chance, rows, next_id = random.Random(seed), [], 0
    common = prose(999, 60)
    for g in range(n_groups):
        words = prose(1000 + g, chance.choice([3, 8, 30, 90, 200])).split()
        for _ in range(chance.randrange(1, size)):
            own = list(words)
            for _ in range(chance.choice([0, 0, 1, 1, 2, 4, 9])):
                own[chance.randrange(len(own))] = f"w{chance.randrange(9999)}"
            cut = chance.choice([0, 0, 0, len(own) // 12, len(own) // 6])
            text = " ".join(own[cut:])
            rows.append((next_id, text + (" " + common if chance.random() < 0.3 else "")))
            next_id += chance.randrange(1, 3)
    chance.shuffle(rows)
    return rows


def test_components(documents):
    for seed in range(3):
        rows = variants(seed)
        got = jaccard_join.join_components(documents(rows).repartition(3)).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)


def test_edges(documents, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None]
    got = jaccard_join.join_components(documents(rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)
    with_null = jaccard_join.join_components(documents(edge_rows)).collect()
    assert len(with_null) == len(edge_rows)
    assert jaccard_join.join_components(documents([])).collect() == []


def test_distinct_documents(documents, edge_rows):
    for rows in ([r for r in edge_rows if r[0] is not None], variants(7)):
        docs = documents(rows)
        kept = jaccard_join.distinct_documents(docs)
        assert kept.columns == docs.columns
        expected = sorted({c for i, n, c in brute(rows) if n} | {i for i, n, _ in brute(rows) if not n})
        assert sorted(r["doc_id"] for r in kept.collect()) == expected
    nameless = documents([(None, prose(3, 80)), (None, prose(3, 80)), (None, prose(4, 80)), (2, prose(4, 80))])
    assert sorted(str(r["doc_id"]) for r in jaccard_join.distinct_documents(nameless).collect()) == ["2", "None"]


def test_many_copies_make_few_pairs(documents):
    base = prose(5, 100).split()
    rows = [(i, " ".join([*base[:-1], f"end{i}"])) for i in range(300)]
    got = jaccard_join.join_components(documents(rows)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_payloads_do_not_grow_with_the_fragments():
    chance = np.random.default_rng(0)
    sets = [np.unique(chance.integers(0, 1 << 63, 250, dtype=np.uint64) * np.uint64(2)) for _ in range(4000)]
    size = {}
    for bits in (6, 15):
        fragments, payloads, local = jaccard_join.slice_payloads(sets, bits)
        assert len(set(fragments)) == len(fragments) and local.sum() < 50  # few of 38 bits meet by chance
        size[bits] = sum(map(len, payloads))
    assert size[15] <= 1.3 * size[6]


def test_owners_round_trip():
    chance = np.random.default_rng(1)
    for n in (1, 5, 300, 5000):
        for share in (0.0, 0.001, 0.3, 1.0):
            counts = np.where(chance.random(n) < share, chance.integers(1, 400, n), 0)
            packed = jaccard_join.pack_owners(counts)
            assert jaccard_join.unpack_owners(packed).tolist() == counts.tolist()
            assert len(packed) <= 5 + min(4 * n, counts.sum() + n // 255 + 1)


def test_hot_buckets_are_salted(documents, monkeypatch):
    """The components are the same where every bucket counts as hot."""
    monkeypatch.setattr(jaccard_join, "_hot_buckets", lambda postings: [r["h"] for r in postings.select("h").distinct().collect()])
    rows = variants(11)
    got = jaccard_join.join_components(documents(rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)


def test_equal_rows_with_other_columns_keep_the_same_one(documents):
    docs = documents([(1, prose(3, 50), "en"), (1, prose(3, 50), "de"), (1, prose(3, 50), None)])
    kept = {jaccard_join.distinct_documents(docs.repartition(n)).first()["lang"] for n in (1, 2, 3)}
    assert len(kept) == 1


def test_long_words_are_hashed_but_not_kept():
    clauses = ["日本語の文" * 40 + str(i) for i in range(30)]
    text, seen = " ".join([*clauses, "and", "a", "few", "short", "words"]), {}
    first = jaccard_join.shingle_hashes(text, seen)
    assert sorted(seen) == [b"a", b"and", b"few", b"short", b"words"]
    assert len(first) == 31 and (first == jaccard_join.shingle_hashes(text, seen)).all()
    assert (first == jaccard_join.shingle_hashes(text, {w: jaccard_join.xxhash.xxh3_64_intdigest(w) for w in text.encode().split()})).all()
