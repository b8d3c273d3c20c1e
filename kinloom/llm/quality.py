"""Quality rules by distribution divergence.

Two histograms of a document, over character classes and over the common short words,
are compared with references of each language by the Jensen-Shannon distance; a
document is kept if it is near the reference of at least one language in both. A
document under the base rules' length fails anyway, and the word histogram counts
only from `MIN_COMMON` words on.

References are counted over all documents that pass the base rules, hold at most one
symbol in REFERENCE_SYMBOLS word characters and more small letters than capitals.

Defined cases: null text has no words, so base_failed; an empty table gives an empty
result; where no document passes the base rules there is no reference and the base
rules alone decide; null languages share one reference; repeated rows are judged alike.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.llm.arrow_map import map_text, texts_of, with_row
from kinloom.session import staged, unstage

#: A word is common if it is among so many most frequent short words of its language.
COMMON_WORDS = 60
#: Letters in a short word at most.
SHORT = 4
#: Languages with a reference of their own: the largest ones; all others share one.
MAX_LANGUAGES = 64
#: Greatest distance from the nearest reference, for characters and for words.
MAX_CHARS, MAX_WORDS = 0.19, 0.45
#: Words from which the word histogram is judged.
MIN_COMMON = 80
#: Documents with more symbols than one in so many word characters stay out of references.
REFERENCE_SYMBOLS = 50

_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_LONG, _BOOL = T.LongType(), T.BooleanType()
BASE_FIELDS = [("n_words", _LONG), ("word_chars", _LONG), ("n_symbols", _LONG), ("n_dup_lines", _LONG), ("n_repeat_words", _LONG), ("base_failed", _BOOL)]


#: First bytes at which a further script begins: after Latin marks (C2) Latin letters (C3), phonetic and
#: combining (CA), Greek (CD), Cyrillic (D0), Armenian and Hebrew (D5), Arabic (D8), further Semitic (DC), Indic
#: and Thai (E0), Georgian, Ethiopic and Khmer (E1), punctuation (E2), kana (E3), Han (E4), Hangul (EA), the rest.
SCRIPTS = np.array([0xC3, 0xCA, 0xCD, 0xD0, 0xD5, 0xD8, 0xDC, 0xE0, 0xE1, 0xE2, 0xE3, 0xE4, 0xEA, 0xEE, 0xF0])
LATER = 8 + len(SCRIPTS)


def _class_table() -> np.ndarray:
    """Class of each byte: 0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 sentence mark, 6 symbol,
    from 7 on the first bytes of longer characters by script, LATER a later byte (not counted)."""
    table = np.zeros(256, np.uint8)
    for number, characters in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", _SPACES, ".,;:?'\"()-", _SYMBOLS + "!=_~^@{}[]\\/+`"), 1):
        table[np.frombuffer(characters.encode(), np.uint8)] = number
    table[0xC0:] = np.searchsorted(SCRIPTS, np.arange(0xC0, 0x100), side="right") + 7
    table[0x80:0xC0] = LATER
    return table


_CLASS = _class_table()


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=LATER + 1)[:LATER]


def short_words(words: list[bytes]) -> list[bytes]:
    """The words of at most SHORT letters of any script, lower-cased; combining marks belong to their letters."""
    out = []
    for w in words:
        if len(w) <= SHORT and w.isalpha():  # a to z alone
            out.append(w.lower())
        elif not w.isascii():
            text = w.decode()
            letters = text if text.isalpha() else "".join(c for c in text if unicodedata.category(c)[0] != "M")
            if len(letters) <= SHORT and letters.isalpha():
                out.append(text.lower().encode())
    return out


def base_rules(text: str) -> tuple[list[bytes], tuple[int, int, int, int, int, bool]]:
    """The words and the base counts of one text, without using anything but the text."""
    words = text.encode().split()  # bytes split at the six ASCII white spaces
    n = len(words)
    word_chars = len(text) - sum(map(text.count, _SPACES))
    n_symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    n_dup_lines = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = 0  # words up to here are counted
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return words, (n, word_chars, n_symbols, n_dup_lines, repeated, n < 50 or 100 * repeated > 50 * n)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, so 0 to 1) of the histograms in the last axis."""
    p = p / np.maximum(p.sum(-1, keepdims=True), 1e-12)
    q = q / np.maximum(q.sum(-1, keepdims=True), 1e-12)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
    return np.sqrt(np.clip(parts.sum(-1) / 2, 0.0, 1.0))


class References:
    """Histograms of each language: `chars` (languages x LATER), `words` (languages x vocabulary + 1)."""

    def __init__(self, chars: np.ndarray, vocabulary: list[bytes], words: np.ndarray) -> None:
        self.chars, self.words = chars, words
        self.index = {w: i for i, w in enumerate(vocabulary)}

    def distances(self, raw: bytes, words: list[bytes]) -> tuple[float, float]:
        """From the nearest language, for characters and words; words 0 under the guard."""
        if not len(self.chars):
            return 0.0, 0.0
        by_chars = js_distance(class_counts(raw)[None].astype(float), self.chars)
        if len(words) < MIN_COMMON or not self.index:
            return float(by_chars.min()), 0.0
        get = self.index.get
        other = len(self.index)
        seen = np.bincount([i for w in short_words(words) if (i := get(w)) is not None], minlength=other + 1).astype(float)
        seen[other] = len(words) - seen[:other].sum()
        return float(by_chars.min()), float(js_distance(seen[None], self.words).min())


def fit_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """Counts over all of docs that pass the base rules; what reaches the driver is at most
    (MAX_LANGUAGES + 1) x (COMMON_WORDS + LATER + 1) rows."""
    lang = F.coalesce(F.col(lang_col), F.lit("")).alias("lang")
    item = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("item", T.BinaryType()), T.StructField("n", T.LongType())]))

    def make() -> Callable:
        def work(texts: pa.Array, langs: pa.Array) -> list:
            chars: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(LATER, np.int64))
            totals: Counter = Counter()
            counts: dict[str, Counter] = defaultdict(Counter)
            for text, own in zip(texts_of(texts), langs.to_pylist(), strict=True):
                words, base = base_rules(text)
                if not base[5] and REFERENCE_SYMBOLS * base[2] <= base[1] and (found := class_counts(text.encode()))[1] >= found[2]:
                    chars[own] += found
                    totals[own] += len(words)
                    counts[own].update(short_words(words))
            found = [{"lang": k, "item": b"c%d" % i, "n": int(n)} for k, v in chars.items() for i, n in enumerate(v)]
            found += [{"lang": k, "item": b"n", "n": n} for k, n in totals.items()]
            found += [{"lang": k, "item": b"w" + w, "n": n} for k, v in counts.items() for w, n in v.items()]
            return [[found] + [None] * (len(texts) - 1)]

        return work

    parts = map_text(docs, make, [F.col(text_col), lang], [("found", item)])
    # Read twice below; the texts are counted once.
    counted = staged(parts.select(F.explode("found").alias("f")).groupBy("f.lang", "f.item").agg(F.sum("f.n").alias("n")), "quality-counts")
    kind = F.substring(F.col("item"), 1, 1).cast("string")
    rank = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    largest = counted.where(kind == "n").orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).select("lang")
    own = F.broadcast(largest.withColumn("own", F.lit(True)))  # MAX_LANGUAGES rows
    # All others share the language null; a null lang has become the empty one.
    shared = counted.join(own, "lang", "left").groupBy(F.when(F.col("own"), F.col("lang")).alias("lang"), "item").agg(F.sum("n").alias("n"))
    rows = (
        shared.withColumn("kind", kind)
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= COMMON_WORDS)
        .collect()
    )
    unstage(counted)
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is None, x or ""))
    vocabulary = sorted({bytes(r["item"])[1:] for r in rows if r["kind"] == "w"})
    place = {w: i for i, w in enumerate(vocabulary)}
    chars, words = np.zeros((len(langs), LATER)), np.zeros((len(langs), len(vocabulary) + 1))
    for r in rows:
        i, own = langs.index(r["lang"]), bytes(r["item"])[1:]
        if r["kind"] == "c":
            chars[i, int(own)] = r["n"]
        elif r["kind"] == "n":
            words[i, -1] += r["n"]
        else:
            words[i, place[own]] = r["n"]
            words[i, -1] -= r["n"]
    return References(chars, vocabulary, words)


def _make(references: References) -> Callable[[], Callable]:
    def make() -> Callable:
        def work(texts: pa.Array) -> list:
            rows = []
            for text in texts_of(texts):
                words, base = base_rules(text)
                near = (1.0, 1.0) if base[5] else references.distances(text.encode(), words)
                rows.append((*base, not base[5] and near[0] <= MAX_CHARS and near[1] <= MAX_WORDS, *near))
            return [list(x) for x in zip(*rows, strict=True)]

        return work

    return make


FIELDS = [*BASE_FIELDS, ("kept", _BOOL), ("chars_distance", T.DoubleType()), ("words_distance", T.DoubleType())]


def judge(docs: DataFrame, references: References, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, verdict and distances of every document."""
    return map_text(docs, _make(references), [F.col(text_col)], FIELDS, keep=[F.col(id_col)])


def filter_documents(docs: DataFrame, references: References, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, all columns as they were."""

    def kept(field: Callable[[str], Column]) -> Column:
        return field("kept")

    return with_row(docs, _make(references), [F.col(text_col)], FIELDS, kept)
