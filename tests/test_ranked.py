"""Ranked pools against scoring every reference."""

import random

import pytest

from kinloom.config import PrepConfig
from kinloom.functions.normalize import clean_records
from kinloom.operators import blocking, ranked, sampling
from kinloom.plans import linkage


def brute(asked, documents, scopes, weights, idf):
    out = set()
    for q, terms in asked.items():
        own, limit = scopes[q]
        scored = []
        for rid, (scope, has) in documents.items():
            hit = [t for t in terms if t in has and t in idf]
            if hit and scope & own:
                scored.append((-round(weights[rid] * sum(idf[t] for t in hit), 9), rid))
        out |= {(q, rid, k) for k, (_, rid) in enumerate(sorted(scored)[:limit], 1)}
    return out


@pytest.mark.parametrize("seed,lengths", [(1, [5, 9, 30]), (2, [7]), (3, list(range(4, 40)))])
def test_is_the_full_ranking(spark, seed, lengths):
    """Rare and very common terms, equal lengths throughout, one-term queries, pools larger than their lists."""
    chance = random.Random(seed)
    terms = [("name", f"w:{i}") for i in range(12)] + [("address", f"w:{i}") for i in range(4)]
    share = {t: [0.9, 0.5, 0.1, 0.02][i % 4] for i, t in enumerate(terms)}
    documents = {rid: ({f"s{rid % 3}", "*"}, {t for t in terms if chance.random() < share[t]}) for rid in range(1, 900)}
    length = {rid: chance.choice(lengths) for rid in documents}
    mean = sum(length.values()) / len(length)
    weights = {rid: 2.2 / (1 + 1.2 * (0.25 + 0.75 * n / mean)) for rid, n in length.items()}
    idf = {t: 1e-6 + 2 * (1 - share[t]) for t in terms[:-1]}
    asked = {q: chance.sample(terms, chance.choice([1, 2, 3, 6])) for q in range(40)} | {40: [terms[0]], 41: terms, 42: [terms[0], terms[4], terms[8]]}
    scopes = {q: (chance.choice([{"*"}, {"s0", "s1"}, {"s2"}, {"s9"}]), chance.choice([1, 5, 20, 2000])) for q in asked}
    make = spark.createDataFrame
    known = ranked.Statistics(
        make([(r, length[r], weights[r]) for r in documents], "rid long, length int, weight double"),
        make([(f, t, x) for (f, t), x in idf.items()], "field string, token string, idf double"),
    )
    postings = make([(rid, f, t, s) for rid, (own, has) in documents.items() for f, t in has for s in own], "rid long, field string, token string, scope string")
    got = ranked.ranked_pool(
        make([(q, f, t) for q, own in asked.items() for f, t in own], "q long, field string, token string"), postings,
        make([(q, s, limit) for q, (own, limit) in scopes.items() for s in own], "q long, scope string, limit int"), known,
    )
    assert {(r["q"], r["r"], r["rank"]) for r in got.collect()} == brute(asked, documents, scopes, weights, idf)


def test_nothing_asked(spark):
    make = spark.createDataFrame
    known = ranked.Statistics(make([], "rid long, length int, weight double"), make([], "field string, token string, idf double"))
    got = ranked.ranked_pool(make([], "q long, field string, token string"), make([], "rid long, field string, token string, scope string"), make([], "q long, scope string, limit int"), known)
    assert got.collect() == []


def test_short_documents_come_first_in_candidates(spark):
    """Of many references that hold the query's word, the ranked order keeps the ones with little else."""
    rows = [("S1-0", "abc", "", "US", 1)] + [(f"S2-{i:02}", "abc " + " ".join(f"word{j}{i}" for j in range(20 - i)), "", "US", 2) for i in range(20)]
    records = clean_records(sampling.dense_numbers(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, source int"), "source", "entity_id"))
    found = {}
    for order in ("rowid", "bm25"):
        config = PrepConfig(hash_bits=12, lexical_pool=4, lexical_top_k=4, block_limit=3, lexical_order=order)
        pairs = linkage.prepare(records, linkage.fit_terms(records, config), config).pairs
        found[order] = {r["candidate_entity_id"] for r in pairs.where("block_B = 1").collect()}
    assert found["rowid"] == {"S2-00", "S2-01", "S2-02"} and found["bm25"] == {"S2-19", "S2-18", "S2-17"}
    with pytest.raises(ValueError):
        PrepConfig(lexical_order="random")
    assert blocking.DIGITS == ranked.DIGITS
