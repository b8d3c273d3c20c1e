"""Base rules against plain loops, and the divergence verdict."""

import math
import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kinloom.llm import quality
from kinloom.session import read_table
from tests.llm.conftest import prose


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def test_base_counts(documents, edge_rows):
    rows = edge_rows + [(60, "a b c a b c d # | <>\nx y\nx y\n \n \nx y"), (61, "a b c d " * 40), (62, "a b \x85c \x0b d")]
    got = {r["doc_id"]: r for r in quality.judge(documents(rows), quality.References(np.zeros((0, 8)), [], np.zeros((0, 1)))).collect()}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        row = got[doc_id]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == brute(text), text
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert row["kept"] == (not row["base_failed"])


def test_distance_is_a_distance():
    p, q = np.array([1.0, 0, 3]), np.array([0.0, 2, 0])
    assert quality.js_distance(p, p) == 0
    assert abs(quality.js_distance(p, q) - 1) < 1e-12
    assert abs(quality.js_distance(p, q + p) - quality.js_distance(q + p, p)) < 1e-12


def test_verdict(documents):
    clean = [(i, " ".join(f"the {w} of" for w in prose(i, 60).split()), "en") for i in range(40)]
    junk = [(100, " ".join(f"#{i}|*$%" for i in range(200)), "en")]
    docs = documents(clean + junk)
    references = quality.fit_references(docs)
    kept = {r["doc_id"] for r in quality.judge(docs, references).where("kept").collect()}
    assert kept == set(range(40))
    passed = quality.filter_documents(docs, references)
    assert passed.columns == docs.columns and passed.count() == 40


def test_empty_table(documents):
    docs = documents([])
    assert quality.judge(docs, quality.fit_references(docs)).collect() == []


def test_languages_beyond_the_largest_share_a_reference(documents, monkeypatch):
    monkeypatch.setattr(quality, "MAX_LANGUAGES", 1)
    large = [(i, " ".join(f"the {w} of" for w in prose(i, 60).split()), "en") for i in range(40)]
    small = [(100 + i, " ".join(f"и слово{i}{k} не" for k in range(60)), "ru" if i % 2 else "bg") for i in range(10)]
    docs = documents(large + small)
    references = quality.fit_references(docs)
    assert len(references.chars) == 2
    assert quality.judge(docs, references).where("kept").count() == 50


def test_short_words_and_classes_of_any_script():
    words = "für und слово не και في है 日本 x1 Über langes".split()
    assert [w.decode() for w in quality.short_words([w.encode() for w in words])] == ["für", "und", "не", "και", "في", "है", "日本", "über"]
    seen = {int(np.flatnonzero(quality.class_counts(c.encode()))[0]) for c in "éжλאف日あ한ก—"}
    assert len(seen) == 10


def classes_brute(text):
    """Counts by character class, character by character."""
    counts = [0.0] * quality.LATER
    for c in text:
        first = c.encode()[0]
        if first >= 0xC0:
            kind = 7 + sum(first >= s for s in quality.SCRIPTS)
        elif "a" <= c <= "z" or "A" <= c <= "Z":
            kind = 1 if c >= "a" else 2
        else:
            kind = 3 if c in "0123456789" else 4 if c in " \t\n\v\f\r" else 5 if c in ".,;:?'\"()-" else 6 if c in "#*$%&|<>!=_~^@{}[]\\/+`" else 0
        counts[kind] += 1
    return counts


def distance_brute(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    entropy = lambda h: -sum(x * math.log2(x) for x in h if x > 0)
    return math.sqrt(max(0.0, entropy([(x + y) / 2 for x, y in zip(p, q, strict=True)]) - (entropy(p) + entropy(q)) / 2))


def short_brute(words):
    plain = lambda w: [c for c in w if w.isascii() or unicodedata.category(c)[0] != "M"]
    return [w.lower() for w in words if 0 < len(plain(w)) <= 4 and all(c.isalpha() for c in plain(w))]


def verdicts_brute(rows):
    """doc_id -> (kept, distance of characters, distance of words) of (doc_id, text, lang) rows."""
    split = lambda text: re.findall(r"[^\x20\x09-\x0D]+", text or "")
    good = {}
    for _, text, lang in rows:
        n, chars, symbols, _, repeated = brute(text)
        found = classes_brute(text or "")
        if n >= 50 and repeated * 100 <= 50 * n and 50 * symbols <= chars and found[1] >= found[2]:
            good.setdefault(lang or "", []).append((found, split(text)))
    chars = {lang: [sum(x) for x in zip(*(f for f, _ in own), strict=True)] for lang, own in good.items()}
    counts = {lang: Counter(w for _, words in own for w in short_brute(words)) for lang, own in good.items()}
    top = {lang: dict(sorted(own.items(), key=lambda x: (-x[1], x[0].encode()))[:60]) for lang, own in counts.items()}
    vocabulary = sorted(set().union(*top.values()))
    out = {}
    for doc_id, text, _ in rows:
        n, _, _, _, repeated = brute(text)
        if n < 50 or repeated * 100 > 50 * n:
            out[doc_id] = (False, 1.0, 1.0)
            continue
        by_chars = min(distance_brute(classes_brute(text), own) for own in chars.values())
        by_words = 0.0
        if n >= 80:
            own = Counter(w for w in short_brute(split(text)) if w in set(vocabulary))
            mine = [*(own[w] for w in vocabulary), n - sum(own.values())]
            by_words = 1.0
            for lang, known in top.items():
                all_words = sum(len(words) for _, words in good[lang])
                by_words = min(by_words, distance_brute(mine, [*(known.get(w, 0) for w in vocabulary), all_words - sum(known.values())]))
        out[doc_id] = (by_chars <= 0.19 and by_words <= 0.45, by_chars, by_words)
    return out


def test_verdicts_are_those_of_a_plain_count(spark):
    """All documents of the smallest table, and a very long one, against lists and counters."""
    table = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    long = table.agg(F.max(F.struct(F.length("text"), "text"))["text"]).first()[0]
    docs = table.unionByName(spark.createDataFrame([(-1, " ".join([long, prose(4, 9_000)]), None), (-2, None, None)], table.schema))
    expected = verdicts_brute([tuple(r) for r in docs.collect()])
    got = quality.judge(docs, quality.fit_references(docs)).collect()
    assert len(got) == len(expected)
    for row in got:
        kept, by_chars, by_words = expected[row["doc_id"]]
        assert abs(row["chars_distance"] - by_chars) < 1e-6 and abs(row["words_distance"] - by_words) < 1e-6, row["doc_id"]
        assert row["kept"] == kept
    assert {kept for kept, _, _ in expected.values()} == {True, False}
