"""Base spans against plain patterns; discoveries from contexts."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from kinloom.llm import pii

ORDER = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True,
        "ip": all(int(x) <= 255 for x in match.split(".")) if kind == "ip" else False,
        "card": 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else False,
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def brute(text):
    spans = [(m.start(), ORDER.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "", re.ASCII) if good(k, m[0])]
    listed = [f"{ORDER[k]}:{s}:{e}" for s, k, e in sorted(spans)]
    return listed, [sum(x.startswith(k + ":") for x in listed) for k in ORDER]


def noise(seed):
    chance = random.Random(seed)
    bits = ["@", ".", "a", "bob", "-", " ", "+", "4", "1.2.3.4", "256", "4111 1111 1111 1111", "+49 (30) 1234567", "x@y.zz", "%", "\n", "é", "00012", "10.0.0.255", "(", ")"]
    return "".join(chance.choice(bits) for _ in range(chance.randrange(1, 60)))


def test_base_spans_are_those_of_the_patterns(documents, edge_rows):
    rows = edge_rows + [(100 + i, noise(i)) for i in range(400)]
    found = pii.extract(documents(rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        row, (listed, counts) = by_id[doc_id], brute(text)
        assert [row[f"n_{k}"] for k in ORDER] == counts, text
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest(), text
        assert set(listed) <= set(row["spans"].split(",")) | set() if listed else True


def test_a_context_of_seeds_discovers_unseen_identifiers(documents):
    rows = [(i, f"some words here and phone: +49 30 {1000000 + 7919 * i} then more") for i in range(40)]
    rows += [(100, "some words here and phone: 030-5551234 then more"), (101, "the year 030-5551235 was long")]
    found = {r["doc_id"]: r["spans"] for r in pii.extract(documents(rows)).collect()}
    assert found[100] == "phone:27:38"
    assert found[101] == ""


def test_clean_prose_has_no_spans(documents):
    found = pii.extract(documents([(i, f"chapter {i} of the book, pages 12-30, in 1998 and 2001.") for i in range(50)])).collect()
    assert {r["spans"] for r in found} == {""}


def test_empty_table(documents):
    assert pii.extract(documents([])).collect() == []


@pytest.mark.parametrize("number,valid", [("4111111111111111", True), ("4111111111111112", False), ("79927398713", True)])
def test_luhn(number, valid):
    assert pii.luhn(number) is valid


def test_patterns_know_whole_words_and_no_identifier_is_too_long():
    long = "x" * 500
    near = pii.context(f"ab{long} tel: 123", len(long) + 8, len(long) + 11)
    far = pii.context(f"cd{long} tel: 123", len(long) + 8, len(long) + 11)
    assert near[0] != far[0] and near[-1] == far[-1] == "tel: _"
    spaced = pii.context("my tel:" + " " * 300 + "123" + "\n" * 200 + "now", 307, 310)
    assert spaced == ["my tel: _", "tel: _ now", "tel: _"]


def test_a_long_identifier_is_discovered(documents):
    long = "a" * 140 + "@localhost"
    rows = [(i, f"please mail: user{i}@example{i}.org today") for i in range(60)] + [(100, f"please mail: {long} today")]
    got = {r["doc_id"]: r["spans"] for r in pii.extract(documents(rows)).collect()}
    assert got[100] == f"email:13:{13 + len(long)}"


def learn_brute(mentions):
    """Believed values by dictionaries: (value, kind) -> belief, from (value, kind, looks, patterns)."""
    edges = Counter((p, v, k, tuple(looks)) for v, k, looks, patterns in mentions for p in patterns)
    totals = Counter()
    for (p, _, _, _), n in edges.items():
        totals[p] += n
    seeds = {(v, k): 1.0 for _, v, k, _ in edges if k}
    believed, confident = dict(seeds), {}
    for _ in range(pii.ROUNDS):
        weight, support = Counter(), {}
        for (p, v, _, _), n in edges.items():
            for (own, kind), belief in believed.items():
                if own == v:
                    weight[p, kind] += n * belief
                    support.setdefault((p, kind), set()).add(v)
        confident = {
            (p, kind): w / (totals[p] + pii.SMOOTHING)
            for (p, kind), w in weight.items()
            if len(support[p, kind]) >= pii.LEAST_SUPPORT and w / (totals[p] + pii.SMOOTHING) >= pii.LEAST_CONFIDENCE
        }
        evidence = {}
        for (p, v, k, looks), n in edges.items():
            for (own, kind), c in confident.items():
                if own == p and k is None and kind in looks:
                    evidence.setdefault((v, kind), []).append((n, math.log(1 - c)))
        # As many mentions as there are, each with the mean doubt of the value's patterns.
        believed = seeds | {key: 1 - math.exp(sum(n for n, _ in own) * sum(d for _, d in own) / len(own)) for key, own in evidence.items()}
    return confident, {key: b for key, b in believed.items() if b >= pii.LEAST_BELIEF}


@pytest.mark.parametrize("seed", range(4))
def test_rounds_are_those_of_dictionaries(spark, seed):
    """Random graphs: patterns of mixed purity, chains that only later rounds reach, repeated mentions."""
    chance = random.Random(seed)
    kinds = list(pii.ORDER)
    pure = {f"p{i}": (chance.choice(kinds), chance.choice([0.7, 0.95, 1.0])) for i in range(10)}
    mentions = []
    for i in range(220):
        own = chance.sample(sorted(pure), chance.randrange(1, 4))
        kind = pure[own[0]][0] if chance.random() < pure[own[0]][1] else chance.choice(kinds)
        seed_kind = kind if chance.random() < 0.8 else None
        mentions += [(f"v{i}", seed_kind, [] if seed_kind else [kind, "card"][: 1 + i % 2], own)] * chance.choice([1, 1, 3])
    for i in range(14):  # values that one confident pattern reaches, and a pattern only they hold up
        mentions += [(f"w{i}", None, ["phone"], ["first", "second"] if i < 12 else ["second"])] * 2
    mentions += [(f"s{i}", "phone", [], ["first"]) for i in range(80)]
    frame = spark.createDataFrame(mentions, "value string, kind string, looks array<string>, patterns array<string>")
    patterns, believed = pii.learn(frame)
    confident, values = learn_brute(mentions)
    found = {(r["pattern"], r["for_kind"]): r["confidence"] for r in patterns.collect()}
    assert found == pytest.approx(confident)
    got = {(r["value"], r["kind"]): r["belief"] for r in believed.collect()}
    assert got == pytest.approx(values)
    assert ("w0", "phone") in values and ("second", "phone") in confident and ("w13", "phone") in values
