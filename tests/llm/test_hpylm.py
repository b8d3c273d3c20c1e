"""Base scores against a plain count; the model's probabilities sum to one and beat the base."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kinloom.llm import hpylm, queries
from kinloom.session import read_table
from tests.llm.conftest import prose


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["<end>"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_base_scores(documents, edge_rows):
    rows = edge_rows + [(100 + i, prose(i, 40)) for i in range(100)]
    got = hpylm.score(documents(rows)).collect()
    assert len(got) == len(rows)
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        own, row = tokens(text), by_id[doc_id]
        assert row["held_out"] == held(doc_id)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(own), sum(t in counts for t in own), n)
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), rel=1e-9)
        assert row["score"] < 0


def fitted(docs, bits=2, hot=None):
    """Unpacked fragments after all rounds, the last sample taken, and the totals."""
    hot = hot or hpylm.HotWords(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    given = docs.selectExpr("doc_id", "text", "false AS held_out")
    state, replies, totals = hpylm.fit(hpylm._cells(given, bits, hot).where("keys IS NOT NULL"), bits, hot)
    out = []
    for row in state.join(replies, "fragment").collect():
        f = hpylm.Fragment.read(row.asDict(), row["replies"])
        f.record(totals)
        out.append(f)
    return out, totals


@pytest.mark.parametrize("split", [False, True])
def test_probabilities_of_a_context_sum_to_one(documents, split):
    """Over all words, seen in the context or not, and the unknown one; in production settings."""
    docs = documents([(i, " the ".join(prose(i, 60).split())) for i in range(60)])
    word = np.uint64(hpylm.xxhash.xxh3_64_intdigest(b"the"))
    fragments, totals = fitted(docs, hot=hpylm.HotWords(np.array([word]), np.array([3])) if split else None)
    if split:
        assert sum(word in f.keys for f in fragments) > 1
    seen, rest = {}, {}
    parents = {}
    for f in fragments:
        p = f.probabilities(totals)
        levels = list(f.levels(totals))
        for w, key in enumerate(f.keys.tolist()):
            parents[key] = [parent[w] for _, parent in levels]
        for k, (w, c) in enumerate(zip(f.keys[f.word].tolist(), f.contexts[f.context].tolist(), strict=True)):
            seen.setdefault(c, {})[w] = p[k]
        for c, key in enumerate(f.contexts.tolist()):
            rest[key] = [left[c] for left, _ in levels]
    assert len(parents) == totals.words
    n = hpylm.SAMPLES
    # What the parent leaves over is the unknown word's.
    unknown = [1 - sum(p[s] for p in parents.values()) for s in range(n)]
    assert all(0 < u < 0.01 for u in unknown)
    for c, own in seen.items():
        others = sum(rest[c][s] * p[s] / n for w, p in parents.items() if w not in own for s in range(n))
        fresh = sum(rest[c][s] * unknown[s] / n for s in range(n))
        assert sum(own.values()) + others + fresh == pytest.approx(1, abs=1e-6)


def stirling(c, t, d):
    if c == 0 or t == 0:
        return float(c == t)
    row = [0.0, 1.0]
    for n in range(1, c):
        row = [0.0, *[row[k - 1] + ((n - d * k) * row[k] if k < len(row) else 0.0) for k in range(1, len(row) + 1)]]
    return row[t]


@pytest.mark.parametrize("d", [0.2, 0.5, 0.9])
def test_chance_to_sit_alone(d):
    for c, t in [(1, 1), (2, 1), (2, 2), (9, 4), (60, 7)]:
        assert hpylm.alone_share(np.array([c]), np.array([t]), d)[0] == pytest.approx(stirling(c - 1, t - 1, d) / stirling(c, t, d), rel=1e-5)
    # Beyond the table, a saddle point takes over.
    c, t = np.full(9, hpylm.TABULATED), np.array([1, 2, 5, 20, 100, 300, 500, 900, 1000])
    exact = hpylm._tabulated(d)[c, t]
    means, tilt = hpylm._saddle(d)
    near = np.minimum(1, (t - 1) * d / (c - 1) * np.interp(np.log(c / t), means, tilt))
    assert np.abs(near - exact).max() < 0.01


def brute(texts, asked, d, d0, sweeps=300, burn=50, seed=0):
    """Chinese restaurants with all their tables kept as lists, one customer moved at a time."""
    chance = random.Random(seed)
    tables, parent = {}, {}  # (context, word) -> sizes; word -> sizes
    number, c0 = Counter(), 0
    customers = []
    for text in texts:
        before = "<start>"
        for w in tokens(text):
            customers.append((before, w))
            before = w
    words = len({w for _, w in customers})
    base = 1 / (words + 1)
    whole = Counter(u for u, _ in customers)
    t0 = 0

    def p0(w):
        return (sum(parent.get(w, [])) - d0 * len(parent.get(w, [])) + (1 + d0 * t0) * base) / (1 + c0)

    def sit(sizes, d, fresh):
        x = chance.random() * (fresh + sum(sizes) - d * len(sizes))
        for k, n in enumerate(sizes):
            x -= n - d
            if x < 0:
                sizes[k] += 1
                return False
        sizes.append(1)
        return True

    def leave(sizes):
        k = chance.choices(range(len(sizes)), sizes)[0]
        sizes[k] -= 1
        if not sizes[k]:
            del sizes[k]
            return True
        return False

    total, n = Counter(), 0
    for sweep in range(sweeps):
        for u, w in customers:
            own = tables.setdefault((u, w), [])
            if sweep and leave(own):
                number[u] -= 1
                c0 -= 1
                t0 -= leave(parent[w])
            if sit(own, d, (1 + d * number[u]) * p0(w)):
                number[u] += 1
                t0 += sit(parent.setdefault(w, []), d0, (1 + d0 * t0) * base)
                c0 += 1
        if sweep >= burn:
            n += 1
            for u, w in set(asked):
                own = tables.get((u, w), [])
                total[u, w] += (sum(own) - d * len(own) + (1 + d * number[u]) * p0(w)) / (1 + whole[u])
    return {pair: x / n for pair, x in total.items()}


def test_samples_agree_with_a_plain_sampler(documents, monkeypatch):
    """Mean log10 probability within 0.01, and each text's within 0.03, of restaurants kept table by table."""
    monkeypatch.setattr(hpylm, "SAMPLES", 8)
    chance = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)]
    weights = [1 / (k + 1) for k in range(30)]
    rows = []
    for i in range(80):
        words = [chance.choices(vocabulary, weights)[0]]
        for _ in range(24):
            k = vocabulary.index(words[-1])
            words.append(vocabulary[(k * 7 + 3) % 30] if chance.random() < 0.5 else chance.choices(vocabulary, weights)[0])
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(hpylm, "LEAST_FRAGMENTS", 2)
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in hpylm.score(documents(rows)).collect()}
    learned = [t for i, t in rows if not held(i)]
    _, totals = fitted(documents([(i, t) for i, t in rows if not held(i)]))
    pairs = {i: list(zip(["<start>", *tokens(t)[:-1]], tokens(t), strict=True)) for i, t in rows}
    p = brute(learned, [x for own in pairs.values() for x in own], totals.discount, totals.parent_discount)
    expected = {i: sum(math.log10(p[x]) for x in own) / len(own) for i, own in pairs.items()}
    gaps = [got[i] - expected[i] for i in expected]
    assert abs(sum(gaps) / len(gaps)) < 0.01
    assert max(map(abs, gaps)) < 0.03


def test_seating_bounds():
    counts = np.array([1, 2, 10, 500])
    tables = hpylm.seat(counts, np.full(4, 0.5), 0.4, np.random.default_rng(0))
    assert tables[0] == 1 and (tables >= 1).all() and (tables <= counts).all()


def test_held_out_text_scores_above_the_base(spark):
    got = queries.op9_lm_score(spark, "/root/testdata/sf0.001")
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    assert got.count() == docs.count()
    rows = got.where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_word_order_matters(documents):
    rows = [(i, "the cat sat on the mat and the dog sat on the rug " * 3) for i in range(60)]
    rows += [(1000, "the cat sat on the mat"), (1001, "mat the on sat cat the")]
    got = {r["doc_id"]: r["score"] for r in hpylm.score(documents(rows)).collect()}
    assert got[1000] > got[1001]


def test_nothing_to_learn_from(documents):
    assert hpylm.score(documents([])).collect() == []
    unseen = next(i for i in range(100) if held(i))
    row = hpylm.score(documents([(unseen, "a b")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)


def test_every_previous_word_is_a_context(documents):
    """600 words that end alike, each always followed by one partner of its own: no class of them can tell the partners."""
    rows = [(i, " ".join(f"{w}aing p{w}ing" for k in range(30) for w in [(i * 30 + k) % 600])) for i in range(200)]
    own = [i for i in range(1000, 2000) if held(i)][:2]
    rows += [(own[0], " ".join(f"{w}aing p{w}ing" for w in range(100))), (own[1], " ".join(f"{w}aing p{w + 100}ing" for w in range(100)))]
    got = {r["doc_id"]: r for r in hpylm.score(documents(rows)).collect()}
    assert got[own[0]]["n_known"] == got[own[1]]["n_known"]
    assert got[own[0]]["score"] > got[own[1]]["score"] + 100  # more than a factor of ten for each pair


def test_a_hot_word_is_split_and_scores_stay(documents):
    """A word of half of all tokens goes to several fragments; counts are those of a plain count."""
    rows = [(i, " the ".join(prose(i, 100).split())) for i in range(400)]
    docs = documents(rows).repartition(6, "doc_id")
    hot = hpylm.hot_words(docs, "text", 4)
    the = np.uint64(hpylm.xxhash.xxh3_64_intdigest(b"the"))
    assert hot.has(np.array([the]))[0] and len(hot.keys) <= 4 << 4
    contexts = np.random.default_rng(0).integers(0, 1 << 63, 1000, dtype=np.uint64)
    dealt = hpylm.fragment_of(np.full(1000, the), contexts, hot, 4)
    assert len(set(dealt.tolist())) > 4
    got = {r["doc_id"]: r for r in hpylm.score(docs).collect()}
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for i, text in rows:
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(text)), rel=1e-9)
        assert got[i]["score"] > got[i]["base_score"]


def test_a_sweep_moves_every_customer():
    counts = np.array([1, 2, 31, 32, 33, 1000, 11_830])
    moves = np.array([hpylm.dealt(counts, turn, 32) for turn in range(32)])
    assert (moves.sum(axis=0) == counts).all() and (np.diff(moves, axis=0) <= 0).all() and (moves.max(axis=0) - moves.min(axis=0) <= 1).all()


def test_moves_until_a_change_have_the_law_of_single_moves():
    """Parent tables of 300 customers after whole sweeps: the mean under S(c, t) w^t."""
    c, d, w, n = 300, 0.4, 2.5, 4000
    logs = np.array([-np.inf, 0.0])  # of S(1, t)
    for k in range(1, c):
        joined = np.log(np.maximum(k - d * np.arange(k + 1), 1e-300)) + logs
        logs = np.logaddexp(np.append(-np.inf, logs), np.append(joined, -np.inf))
    weights = logs + np.arange(c + 1) * math.log(w)
    law = np.exp(weights - weights.max())
    mean = (np.arange(c + 1) * law).sum() / law.sum()
    rng, tables = np.random.default_rng(3), np.full(n, 1)
    for _ in range(12):
        tables = hpylm.reseat(np.full(n, c), tables, d, w, np.full(n, c), rng)
    assert tables.mean() == pytest.approx(mean, rel=0.02)


def test_frequent_pairs_leave_their_first_seats():
    """40 pairs of 2,000 customers, begun with 200 tables each: whole sweeps beside moves made one by one."""
    n, c, t = 40, 2000, 200

    def begun():
        none = np.zeros(0, np.int64)
        totals = hpylm.Totals(n * c, n, float(n * t), float(n), 0.7, 0.5, hpylm.HotWords(none.astype(np.uint64), none), none, none, none)
        one = np.ones(n, np.int64)
        return hpylm.Seating(np.arange(n), np.arange(n), c * one, t * one, one, t * one, np.arange(n, dtype=np.uint64), totals)

    whole, single = begun(), begun()
    for turn in range(2):
        whole.sweep(np.random.default_rng([1, turn]))
        rng = np.random.default_rng([2, turn])
        for _ in range(c):
            single._move(np.arange(n), np.ones(n, np.int64), rng)
        single.sweep_parent(rng)
        for own in (whole, single):
            assert (own.tables == own.opened).all() and (own.served == own.opened).all() and own.all_customers == own.opened.sum() and own.all_tables == own.seated.sum()
    assert whole.opened.mean() < 100 and whole.opened.mean() == pytest.approx(single.opened.mean(), rel=0.15)
