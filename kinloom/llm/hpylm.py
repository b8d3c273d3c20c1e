"""Language-model scores by a hierarchical Pitman-Yor model.

Restaurants are contexts: every previous word, and the start of a text, has its own. They
share one parent, the restaurant of words without context, whose base is uniform over all
known words and one that stands for the unknown. Customers are the training tokens. Gibbs
sweeps remove customers and seat them anew, in the restaurants of contexts and in the
parent; a word's probability is the mean of the predictive probabilities of several samples.

Seating. What the model needs of a word in a restaurant is its customers c and tables t.
Given these, a customer sits alone with probability S(c-1, t-1) / S(c, t) in generalised
Stirling numbers, so tables need no sizes (`alone_share`). A move removes one customer (and
its table, and that table's customer in the parent, if it was alone) and seats it again at
an old or a new table. A sweep makes as many moves for a pair as it has customers, one after
the other, which ones being left to chance (random scan), and as many for a word in the parent.
Most moves of a frequent pair change no number of tables; how many such moves come in a row is
drawn at once (`until_change`), so a sweep's work follows the changes, under the same law.

Distribution. Pairs of word and context are dealt to fragments by a hash of the word, those
of a hot word by word and context, so no word is one task. A slice of documents
keeps which pairs each document has and asks each fragment for its distinct pairs, with
their training counts. A fragment adds up the counts, seats its customers with the tables
that all fragments had at the end of the last round, and in the end replies with one
probability for each pair asked for. Rows between slices and fragments, or fragments and
shards of contexts, exist only where they carry a word or context, so there are never more
than those occurrences. Through the driver go only sums over everything and two
numbers for each hot word, of which there are at most two for each fragment.

Defined cases: null or blank text is its end token alone; an empty table gives an empty
result; without training documents every token is unknown; a null id is not held
out; repeated rows count repeatedly. Words are told apart by 64-bit hashes, contexts by the
first 48 of these bits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.llm.arrow_map import text_slices, texts_of
from kinloom.session import ship_package, staged, unstage

#: Text for each fragment, at least so many fragments, and text in a slice.
FRAGMENT_BYTES, LEAST_FRAGMENTS, SLICE_BYTES = 24 << 20, 16, 14 << 20
#: Rounds before the first sample, samples, and sweeps in a round; strength of both levels.
BURN_IN, SAMPLES, SWEEPS, STRENGTH = 2, 3, 1, 1.0
#: Turns in which the moves of a sweep are dealt, so that pairs, and words of the parent, move side by side.
TURNS, PARENT_TURNS = 32, 8
#: Customers for which the chance to sit alone is tabulated; beyond, it comes from a saddle point.
TABULATED = 1024
#: First seating: customers enter one by one up to 50, then this share of those seated at once.
BLOCK = 0.02
_MAX_DOCS = 1 << 15
#: The end token as a word and the start of a text as a context; no word is empty or a line end.
_END, _START = xxhash.xxh3_64_intdigest(b"\n"), xxhash.xxh3_64_intdigest(b"")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: What is left of a hash in a context's key.
_CONTEXT_BITS = 48


# ------------------------------------------------------------------ packed numbers


def _planes(x: np.ndarray) -> bytes:
    """The bytes of the numbers by place: all lowest bytes first."""
    return np.ascontiguousarray(x).view("u1").reshape(len(x), x.itemsize).T.tobytes()


def _numbers(raw: bytes, kind: str, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, "u1", n * size, at).reshape(size, n).T).view(kind).ravel()


def _packed(x: np.ndarray, kind: str, rising: bool = False) -> bytes:
    """The numbers, or their differences where they rise, by byte planes, compressed."""
    x = x.astype(kind)
    x = np.diff(x, prepend=x.dtype.type(0)) if rising else x
    return len(x).to_bytes(8, "little") + pa.compress(_planes(x), codec="zstd", asbytes=True)


def _whole(packed: bytes, kind: str, rising: bool = False) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], n * np.dtype(kind).itemsize, codec="zstd", asbytes=True)
    x = _numbers(raw, kind, n)
    return np.cumsum(x, dtype=kind) if rising else x


def _joined(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _parts(joined: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(joined):
        n = int.from_bytes(joined[at : at + 8], "little")
        out.append(joined[at + 8 : at + 8 + n])
        at += 8 + n
    return out


# ------------------------------------------------------------------ slices and fragments


@dataclass
class HotWords:
    """Words of more than half a fragment's share, by hash, and the power of two of their buckets."""

    keys: np.ndarray
    levels: np.ndarray

    def level(self, words: np.ndarray) -> np.ndarray:
        return np.where(self.has(words), self.levels[self.at(words)], 0) if len(self.keys) else np.zeros(len(words), np.int64)

    def at(self, words: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)

    def has(self, words: np.ndarray) -> np.ndarray:
        return self.keys[self.at(words)] == words if len(self.keys) else np.zeros(len(words), bool)


def fragment_of(words: np.ndarray, contexts: np.ndarray, hot: HotWords, bits: int) -> np.ndarray:
    """The fragment of each pair: by the word, of a hot one by a bucket of contexts too."""
    level = hot.level(words)
    bucket = (contexts >> np.uint64(64 - _CONTEXT_BITS)) & ((np.uint64(1) << level.astype(np.uint64)) - np.uint64(1))
    mixed = (words + bucket * _MIX) * _MIX
    mixed ^= mixed >> np.uint64(31)
    return ((np.where(level > 0, mixed * _MIX, words)) >> np.uint64(64 - bits)).astype(np.int64)


def hot_words(docs: DataFrame, text_col: str, bits: int) -> HotWords:
    """Words with more than half the tokens of an average fragment: at most two for each fragment."""
    share = 2 << bits
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])
    target = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for piece in text_slices(given, 0, SLICE_BYTES):
                found: Counter = Counter({b"\n": piece.num_rows})
                for x in texts_of(piece.column(0)):
                    found.update(x.encode().lower().split())
                total = sum(found.values())
                often = [(w, n) for w, n in found.items() if n * share >= total]
                rows = [(-1, total), *((xxhash.xxh3_64_intdigest(w) >> 1, n) for w, n in often)]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    counted = staged(docs.select(text_col).mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    total = (counted.where("word = -1").first() or [0, 0])[1]
    # The lowest bit of a hash is left out above to keep it a long; both words of such a pair are hot.
    rows = counted.where((F.col("word") >= 0) & (F.col("n") * share >= total)).collect()
    unstage(counted)
    shares = {int(r["word"]): r["n"] * share / total for r in rows}
    both = sorted((key * 2 + bit, max(1, int(np.ceil(np.log2(s + 1)))) + 1) for key, s in shares.items() for bit in (0, 1))
    return HotWords(np.array([k for k, _ in both], np.uint64), np.array([v for _, v in both], np.int64))


def _slice(texts: list[str], trained: np.ndarray, bits: int, hot: HotWords) -> tuple[list[tuple[int, bytes]], bytes, np.ndarray]:
    """(fragment, distinct pairs with training counts) rows, which pairs each text has, and token numbers."""
    local: dict[bytes, int] = {b"\n": 0}
    own: list[np.ndarray] = []
    for x in texts:
        words = x.encode().lower().split()
        try:
            codes = [local[w] for w in words]
        except KeyError:
            codes = [local.setdefault(w, len(local)) for w in words]
        own.append(np.array(codes + [0], np.int32))  # the end token is 0
    keys = np.array([xxhash.xxh3_64_intdigest(w) for w in local], np.uint64)
    lengths = np.array([len(x) for x in own], np.int64)
    tokens = np.concatenate(own)
    del local, own
    order = np.argsort(keys, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    tokens, keys = rank[tokens], keys[order]
    start, width, n = len(keys), len(keys) + 1, len(texts)
    contexts = np.concatenate([[start], tokens[:-1]])
    contexts[np.cumsum(lengths)[:-1]] = start
    context_keys = np.append(keys, np.uint64(_START)) >> np.uint64(64 - _CONTEXT_BITS) << np.uint64(64 - _CONTEXT_BITS)
    codes = (tokens * width + contexts) * n + np.repeat(np.arange(n, dtype=np.int64), lengths)
    del tokens, contexts
    codes, counts = np.unique(codes, return_counts=True)
    docs, codes = (codes % n).astype(np.int32), codes // n
    new = np.concatenate([[True], codes[1:] != codes[:-1]])
    pair = np.cumsum(new) - 1
    word, context = codes[new] // width, codes[new] % width
    del codes, new
    learned = np.bincount(pair, counts * trained[docs], minlength=len(word)).astype(np.int64)
    # Pairs by fragment; only those of hot words leave the order of words.
    fragment = fragment_of(keys[word], context_keys[context], hot, bits)
    order = np.argsort(fragment, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    word, context, learned, fragment = word[order], context[order], learned[order], fragment[order]
    pair = place[pair]
    by_doc = np.argsort(docs.astype(np.int64) * len(word) + pair)
    per_doc = np.bincount(docs, minlength=n)
    entries = _joined([_packed(per_doc, "<u4"), _packed(pair[by_doc], "<i8", True), _packed(counts[by_doc], "<u4")])
    edges = np.append(np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]])), len(fragment))
    rows = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        first = np.diff(word[a:b], prepend=-1) > 0  # words ascend within a fragment
        met, at_context = np.unique(context[a:b], return_inverse=True)
        marked = at_context.astype(np.uint32) | (first.astype(np.uint32) << np.uint32(31))
        parts = [_packed(keys[word[a:b][first]], "<u8", True), _packed(context_keys[met], "<u8", True), _packed(marked, "<u4"), _packed(learned[a:b], "<u4")]
        rows.append((int(fragment[a]), _joined(parts)))
    return rows, entries, lengths


def merged(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words, contexts, codes (word x contexts + context) and training counts of all pairs that
    slices sent, and the places of each slice's pairs among them."""
    parts = [[_whole(x, kind, rising) for x, kind, rising in zip(_parts(p), ("<u8", "<u8", "<u4", "<u4"), (True, True, False, False), strict=True)] for p in payloads]
    keys, contexts = (np.unique(np.concatenate([p[k] for p in parts])) for k in (0, 1))
    codes = []
    for own_keys, own_contexts, marked, _ in parts:
        word = np.cumsum(marked >> np.uint32(31), dtype=np.int64) - 1
        context = (marked & np.uint32(0x7FFFFFFF)).astype(np.int64)
        codes.append(np.searchsorted(keys, own_keys)[word] * len(contexts) + np.searchsorted(contexts, own_contexts)[context])
    unique, at = np.unique(np.concatenate(codes), return_inverse=True)
    counts = np.bincount(at, np.concatenate([p[3] for p in parts]), minlength=len(unique)).astype(np.int64)
    return keys, contexts, unique, counts, np.split(at, np.cumsum([len(c) for c in codes])[:-1])


_FRAGMENT = [T.StructField(n, T.BinaryType()) for n in ("keys", "contexts", "codes", "counts")]
_CELLS = [T.StructField("fragment", T.LongType()), T.StructField("batch", T.LongType()), T.StructField("payload", T.BinaryType())]


def _documents(id_type: T.DataType) -> list[T.StructField]:
    return [T.StructField("ids", T.ArrayType(id_type)), T.StructField("held_out", T.ArrayType(T.BooleanType())), T.StructField("n_tokens", T.ArrayType(T.LongType()))]


def _asked(docs: DataFrame, bits: int, hot: HotWords) -> DataFrame:
    """(fragment, batch, payload) for each slice and fragment; fragment -1 has the slice's documents."""
    schema = T.StructType(_CELLS + _documents(docs.schema["doc_id"].dataType))
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        for given in batches:
            for wide in text_slices(given, 1, SLICE_BYTES):
                for k in range(0, wide.num_rows, _MAX_DOCS):
                    piece = wide.slice(k, _MAX_DOCS)
                    held = piece.column(2).to_pylist()
                    rows, entries, lengths = _slice(texts_of(piece.column(1)), np.array([not h for h in held]), bits, hot)
                    n = len(rows)
                    offsets = pa.array([0] * (n + 1) + [piece.num_rows], pa.int32())
                    arrays = [
                        pa.array([*[f for f, _ in rows], -1], pa.int64()),
                        pa.array([batch] * (n + 1), pa.int64()),
                        pa.array([*[p for _, p in rows], entries], pa.binary()),
                        pa.ListArray.from_arrays(offsets, piece.column(0).cast(target.field("ids").type.value_type)),
                        pa.ListArray.from_arrays(offsets, pa.array(held, pa.bool_())),
                        pa.ListArray.from_arrays(offsets, pa.array(lengths)),
                    ]
                    batch += 1
                    yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, target, strict=True)], schema=target)

    return docs.mapInArrow(run, schema)


def _cells(docs: DataFrame, bits: int, hot: HotWords) -> DataFrame:
    """A row with each fragment's pairs (batch null), rows with the places there of what each
    slice asked for (keys null), and the slices' own rows (fragment -1)."""
    asked = _asked(docs, bits, hot)
    schema = T.StructType(_CELLS + _FRAGMENT + asked.schema.fields[3:])
    target = to_arrow_schema(schema)

    def settled(fragment: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        keys, met, codes, counts, places = merged([payload for _, payload in held])
        arrays = [pa.array([v], f.type) for v, f in zip((fragment, None, None, _packed(keys, "<u8", True), _packed(met, "<u8", True), _packed(codes, "<i8", True), _packed(counts, "<u4")), target, strict=False)]
        yield pa.RecordBatch.from_arrays(arrays + [pa.nulls(1, f.type) for f in list(target)[7:]], schema=target)
        for (batch, _), at in zip(held, places, strict=True):
            arrays = [pa.array([v], f.type) for v, f in zip((fragment, batch, _packed(at, "<u4", True)), target, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays + [pa.nulls(1, f.type) for f in list(target)[3:]], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = -1, []
        for given in batches:
            fragments = given.column(0).to_pylist()
            own = given.filter(pc.less(given.column(0), 0))
            if own.num_rows:
                columns = [own.column(0), own.column(1), own.column(2), *[pa.nulls(own.num_rows, f.type) for f in list(target)[3:7]], *own.columns[3:]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)
            for i, fragment in enumerate(fragments):
                if fragment < 0:
                    continue
                if fragment != current and held:
                    yield from settled(current, held)
                    held = []
                current = fragment
                held.append((given.column(1)[i].as_py(), given.column(2)[i].as_py()))
        if held:
            yield from settled(current, held)

    spread = F.when(F.col("fragment") < 0, F.hash("batch")).otherwise(F.hash("fragment"))
    dealt = asked.withColumn("__to", spread).repartition("__to", "fragment").sortWithinPartitions("fragment", "batch").drop("__to")
    return dealt.mapInArrow(run, schema)


# ------------------------------------------------------------------ seating


@dataclass
class Totals:
    """Numbers over all fragments: training tokens, known words, customers and tables of the
    parent, both discounts, and the parent's customers and tables of each hot word."""

    tokens: int
    words: int
    customers: float
    tables: float
    discount: float
    parent_discount: float
    hot: HotWords
    hot_counts: np.ndarray
    hot_customers: np.ndarray
    hot_tables: np.ndarray


@lru_cache(maxsize=4)
def _tabulated(discount: float) -> np.ndarray:
    """Chances to sit alone for up to TABULATED customers (rows) and tables (columns)."""
    t = np.arange(TABULATED + 1)
    last = np.full(TABULATED + 1, -np.inf)  # log S(1, t)
    last[1] = 0.0
    out = np.zeros((TABULATED + 1, TABULATED + 1), np.float32)
    out[1, 1] = 1.0
    for c in range(2, TABULATED + 1):
        opened = np.concatenate([[-np.inf], last[:-1]])
        with np.errstate(divide="ignore", invalid="ignore"):
            joined = np.log(np.maximum(c - 1 - discount * t, 0)) + last
            both = np.logaddexp(opened, joined)
            out[c] = np.nan_to_num(np.exp(opened - both))
        last = both
    return out


@lru_cache(maxsize=4)
def _saddle(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """log of the mean size of a table whose sizes are tilted by z, and z over their sum, for a grid of z."""
    gap = np.concatenate([np.logspace(-14, -2, 600), np.linspace(0.01, 1, 400)[1:-1]])[::-1]  # 1 - z
    z = 1 - gap
    whole = 1 - gap**discount
    return np.log(z * discount * gap ** (discount - 1) / whole), z / whole


def alone_share(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """Chance that a random one of the customers sits alone, given the number of their tables.

    S(c-1, t-1) / S(c, t): tabulated for up to TABULATED customers. Beyond, sizes of tables
    are independent given their sum, so the tilt z that gives their mean tells the share."""
    small = customers <= TABULATED
    c, t = np.where(small, customers, 1), np.where(small, tables, 1)
    share = _tabulated(discount)[c, t].astype(float)
    if not small.all():
        at = np.flatnonzero(~small)
        means, tilt = _saddle(discount)
        rows = np.interp(np.log(customers[at] / np.maximum(tables[at], 1)), means, tilt)
        share[at] = np.minimum(1.0, (tables[at] - 1) * discount / (customers[at] - 1) * rows)
    return share


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """First seating, from which the sweeps start: tables of so many customers of one dish, whose new-table weight is given."""
    tables = np.minimum(customers, 1).astype(np.int64)
    at = np.flatnonzero(customers > 1)
    c, w, t, n = customers[at], weight[at], np.ones(len(at), np.int64), np.ones(len(at), np.int64)
    while len(at):
        step = np.minimum(np.maximum(1, (n * BLOCK).astype(np.int64)), c - n)
        t += rng.binomial(step, w / (w + n - discount * t))
        n += step
        done = n >= c
        if done.any():
            tables[at[done]] = t[done]
            at, c, w, t, n = (x[~done] for x in (at, c, w, t, n))
    return tables


def dealt(moves: np.ndarray, turn: int, turns: int) -> np.ndarray:
    """How many of so many moves fall to a turn, as evenly as can be, earlier turns first."""
    return np.maximum(0, (moves - turn + turns - 1) // turns)


def until_change(alone: np.ndarray, opens: np.ndarray, left: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of dishes with `left` moves to make: places of those where one of these finds a customer alone (chance `alone`) or else opens
    a table (chance `opens`), which of both the first such move does, and the moves left after it. Moves before it change nothing,
    so their number is geometric."""
    chance = np.clip(alone + (1 - alone) * opens, 1e-300, 1.0)
    once = left == 1
    at = np.flatnonzero(~once)
    made = np.where(rng.random(len(left)) < chance, 1, 2)
    made[at] = rng.geometric(chance[at])
    met = np.flatnonzero(made <= left)
    return met, rng.random(len(met)) * chance[met] < alone[met], left[met] - made[met]


def reseat(customers: np.ndarray, tables: np.ndarray, discount: float, weight: float, moves: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables after so many moves of each dish: a customer is removed and seated again, where a new table weighs `weight`."""
    tables, own = tables.copy(), np.flatnonzero(moves > 0)
    left = moves[own]
    while len(own):
        c, t = customers[own], tables[own]
        fresh = lambda n, c: weight / (weight + c - 1 - discount * n)
        met, alone, left = until_change(alone_share(c, t, discount), fresh(t, c), left, rng)
        own, c, t = own[met], c[met], t[met]
        opens = ~alone | (rng.random(len(own)) < fresh(t - 1, c))
        tables[own] += opens.astype(np.int64) - alone
        own, left = own[left > 0], left[left > 0]
    return tables


def parent_probability(served: np.ndarray, seated: np.ndarray, discount: float, base: float, customers: np.ndarray | float) -> np.ndarray:
    return (np.maximum(served - discount * seated, 0) + base) / (STRENGTH + customers)


class Seating:
    """Customers and tables of one fragment, beside the totals of all.

    word, context, counts: each pair's places and customers; opened: its tables. tables: those of
    each context over all fragments; served, seated: customers and tables of each word in the parent."""

    def __init__(self, word: np.ndarray, context: np.ndarray, counts: np.ndarray, opened: np.ndarray, seated: np.ndarray, tables: np.ndarray, keys: np.ndarray, totals: Totals) -> None:
        self.word, self.context, self.counts, self.opened, self.totals = word, context, counts, opened.copy(), totals
        self.tables, self.all_customers, self.all_tables = tables.copy(), totals.customers, totals.tables
        self.served, self.seated = np.bincount(word, opened, minlength=len(keys)).astype(np.int64), seated.copy()
        hot, at = totals.hot.has(keys), totals.hot.at(keys)
        if hot.any():
            self.served[hot], self.seated[hot] = totals.hot_customers[at[hot]], totals.hot_tables[at[hot]]

    def base(self) -> float:
        """Weight of a new table in the parent."""
        return (STRENGTH + self.totals.parent_discount * self.all_tables) / (self.totals.words + 1)

    def parent(self, served: np.ndarray, seated: np.ndarray, gone: np.ndarray | int = 0) -> np.ndarray:
        """Predictive probabilities of the parent."""
        return parent_probability(served, seated, self.totals.parent_discount, self.base(), self.all_customers - gone)

    def first(self, rng: np.random.Generator) -> None:
        weight = (STRENGTH + self.totals.discount * self.tables[self.context]) * self.parent(self.served, self.seated)[self.word]
        self._take(np.arange(len(self.opened)), seat(self.counts, weight, self.totals.discount, rng) - self.opened, rng)

    def sweep(self, rng: np.random.Generator) -> None:
        at = np.flatnonzero(self.counts > 1)
        for turn in range(TURNS):
            left = dealt(self.counts[at], turn, TURNS)
            at, left = at[left > 0], left[left > 0]
            self._move(at, left, rng)
        self.sweep_parent(rng)

    def sweep_parent(self, rng: np.random.Generator) -> None:
        at = np.flatnonzero(self.served > 1)
        moves = np.maximum(self.served[at], PARENT_TURNS)
        for turn in range(PARENT_TURNS):
            moved = reseat(self.served[at], self.seated[at], self.totals.parent_discount, self.base(), dealt(moves, turn, PARENT_TURNS), rng)
            self.all_tables += int((moved - self.seated[at]).sum())
            self.seated[at] = moved

    def _move(self, own: np.ndarray, left: np.ndarray, rng: np.random.Generator) -> None:
        """Make so many moves of each of the pairs."""
        d = self.totals.discount
        while len(own):
            c, t, w, tables = self.counts[own], self.opened[own], self.word[own], self.tables[self.context[own]]
            fresh = (STRENGTH + d * tables) * self.parent(self.served[w], self.seated[w])
            met, alone, left = until_change(alone_share(c, t, d), fresh / (fresh + c - 1 - d * t), left, rng)
            own, opens = own[met], ~alone
            at = met[alone]  # their own table is gone when they look for a seat
            fresh = (STRENGTH + d * (tables[at] - 1)) * self.parent(self.served[w[at]] - 1, self.seated[w[at]], 1)
            opens[alone] = rng.random(len(at)) * (fresh + c[at] - 1 - d * (t[at] - 1)) < fresh
            self._take(own, opens.astype(np.int64) - alone, rng)
            own, left = own[left > 0], left[left > 0]

    def _take(self, pairs: np.ndarray, change: np.ndarray, rng: np.random.Generator) -> None:
        """Open and close tables of pairs; each is a customer of the parent."""
        at = np.flatnonzero(change)
        pairs, change = pairs[at], change[at]
        self.opened[pairs] += change
        np.add.at(self.tables, self.context[pairs], change)
        if not len(at):
            return
        met, words = np.unique(self.word[pairs], return_inverse=True)
        closed, new = (np.bincount(words[k], np.abs(change[k]), minlength=len(met)).astype(np.int64) for k in (change < 0, change > 0))
        c, t, d = self.served[met], self.seated[met], self.totals.parent_discount
        left = t - rng.binomial(np.minimum(closed, c), alone_share(c, t, d))
        c = c - closed
        left = np.clip(left, np.minimum(c, 1), c)
        chance = self.base() / (self.base() + np.maximum(c - d * left, 0))
        c = c + new
        left = np.clip(left + rng.binomial(new, np.where(c > new, chance, 0.0)), np.minimum(c, 1), np.maximum(c, 0))
        self.all_customers += int(change.sum())
        self.all_tables += int((left - t).sum())
        self.served[met], self.seated[met] = c, left


# ------------------------------------------------------------------ rounds

#: A fragment's pairs and state: tables of pairs and words, customers of contexts, sums of tables
#: over the samples, and for each sample the parent's probabilities and the tables of contexts.
_STATE = T.StructType(
    [T.StructField("fragment", T.LongType()), *_FRAGMENT]
    + [T.StructField(n, T.BinaryType()) for n in ("opened", "seated", "spent", "samples")]
    + [T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("hot", T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("n", T.LongType()), T.StructField("opened", T.LongType())])))]
)


@dataclass
class Fragment:
    """One row of the state, unpacked; `customers` and `tables` of contexts come from the shards' replies."""

    fragment: int
    static: tuple
    keys: np.ndarray
    contexts: np.ndarray
    word: np.ndarray
    context: np.ndarray
    counts: np.ndarray
    opened: np.ndarray
    seated: np.ndarray
    spent: np.ndarray
    samples: list[bytes]
    customers: np.ndarray | None = None
    tables: np.ndarray | None = None

    @classmethod
    def read(cls, row: dict, replies: list[bytes] | None = None) -> Fragment:
        static = tuple(row[f.name] for f in _FRAGMENT)
        keys, contexts = _whole(static[0], "<u8", True), _whole(static[1], "<u8", True)
        codes, counts = _whole(static[2], "<i8", True), _whole(static[3], "<u4").astype(np.int64)
        word, context = codes // max(1, len(contexts)), codes % max(1, len(contexts))
        if row.get("opened") is None:  # before the first round: a table for each pair and for each word
            opened, spent = np.minimum(counts, 1), np.zeros(len(counts), np.int64)
            seated = np.minimum(np.bincount(word, counts, minlength=len(keys)), 1).astype(np.int64)
            samples = []
        else:
            opened, seated, spent = (_whole(row[k], "<u4").astype(np.int64) for k in ("opened", "seated", "spent"))
            samples = _parts(row["samples"])
        out = cls(row["fragment"], static, keys, contexts, word, context, counts, opened, seated, spent, samples)
        if replies is not None:
            both = np.concatenate([_whole(x, "<i8").reshape(2, -1) for x in replies], axis=1)
            out.customers, out.tables = both[0], both[1]
        return out

    def seating(self, totals: Totals) -> Seating:
        return Seating(self.word, self.context, self.counts, self.opened, self.seated, self.tables, self.keys, totals)

    def record(self, totals: Totals) -> None:
        """Take the state, as all fragments left the last round, as a sample."""
        now = self.seating(totals)
        self.spent = self.spent + self.opened
        self.samples = [*self.samples, _joined([np.array([now.base(), now.all_customers], "<f8").tobytes(), *(_packed(x, "<u4") for x in (now.served, now.seated, self.tables))])]

    def levels(self, totals: Totals) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each sample, what contexts leave to the parent and the parent's probability of each word."""
        for sample in self.samples:
            numbers, *whole = _parts(sample)
            base, customers = np.frombuffer(numbers, "<f8")
            served, seated, tables = (_whole(x, "<u4").astype(np.int64) for x in whole)
            yield (STRENGTH + totals.discount * tables) / (STRENGTH + self.customers), parent_probability(served, seated, totals.parent_discount, base, customers)

    def word_counts(self, totals: Totals) -> np.ndarray:
        counts = np.bincount(self.word, self.counts, minlength=len(self.keys)).astype(np.int64)
        hot = totals.hot.has(self.keys)
        if hot.any():
            counts[hot] = totals.hot_counts[totals.hot.at(self.keys[hot])]
        return counts

    def probabilities(self, totals: Totals) -> np.ndarray:
        """Predictive probability of each pair, averaged over the samples."""
        n = len(self.samples)
        p = (self.counts - totals.discount * self.spent / n) / (STRENGTH + self.customers[self.context])
        for left, parent in self.levels(totals):
            p = p + left[self.context] * parent[self.word] / n
        return p

    def row(self, hot: HotWords) -> dict:
        served, counted = (np.bincount(self.word, x, minlength=len(self.keys)) for x in (self.opened, self.counts))
        is_hot = hot.has(self.keys)
        own = ~is_hot
        sums = [self.counts.sum(), (counted[own] > 0).sum(), (self.counts == 1).sum(), (self.counts == 2).sum(), (served[own] == 1).sum(), (served[own] == 2).sum(), self.opened.sum(), self.seated[own].sum()]
        told = [{"at": int(i), "n": int(n), "opened": int(t)} for i, n, t in zip(hot.at(self.keys[is_hot]), counted[is_hot], served[is_hot], strict=True)] if is_hot.any() else []
        state = [_packed(x, "<u4") for x in (self.opened, self.seated, self.spent)]
        return dict(zip(_STATE.names, [self.fragment, *self.static, *state, _joined(self.samples), [float(x) for x in sums], told], strict=True))


def _state_batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    target = to_arrow_schema(_STATE)
    for row in rows:
        yield pa.RecordBatch.from_pylist([row], schema=target)


def _replies(state: DataFrame, bits: int) -> DataFrame:
    """(fragment, replies): customers and tables, over all fragments, of each fragment's contexts in
    ascending order. Contexts meet in shards by hash; a context is there once for each fragment."""
    fields = [T.StructField("shard", T.LongType()), T.StructField("fragment", T.LongType()), T.StructField("contexts", T.BinaryType()), T.StructField("numbers", T.BinaryType())]
    sent_schema, reply_schema = T.StructType(fields), T.StructType([fields[0], fields[1], fields[3]])
    sent, replied = to_arrow_schema(sent_schema), to_arrow_schema(reply_schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for row in given.to_pylist():
                f = Fragment.read(row)
                numbers = np.stack([np.bincount(f.context, x, minlength=len(f.contexts)) for x in (f.counts, f.opened)]).astype("<i8")
                shard = (f.contexts >> np.uint64(64 - bits)).astype(np.int64)
                edges = np.append(np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])), len(shard))
                cut = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                values = [shard[edges[:-1]].tolist(), [f.fragment] * len(cut), [_packed(f.contexts[c], "<u8", True) for c in cut], [_packed(numbers[:, c].ravel(), "<i8") for c in cut]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(values, sent, strict=True)], schema=sent)

    def reply(table: pa.Table) -> pa.Table:
        contexts = [_whole(x, "<u8", True) for x in table["contexts"].to_pylist()]
        numbers = np.concatenate([_whole(x, "<i8").reshape(2, -1) for x in table["numbers"].to_pylist()], axis=1)
        unique, at = np.unique(np.concatenate(contexts), return_inverse=True)
        added = np.stack([np.bincount(at, x, minlength=len(unique)) for x in numbers])[:, at].astype("<i8")
        edges = np.cumsum([0, *map(len, contexts)])
        values = [table["shard"].combine_chunks(), table["fragment"].combine_chunks(), pa.array([_packed(added[:, a:b].ravel(), "<i8") for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())]
        return pa.Table.from_arrays([v.cast(f.type) for v, f in zip(values, replied, strict=True)], schema=replied)

    known = [c for c in ("fragment", *[f.name for f in _FRAGMENT], "opened", "seated", "spent", "samples") if c in state.columns]
    answers = state.select(*known).mapInArrow(send, sent_schema).groupBy("shard").applyInArrow(reply, reply_schema)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("shard", "numbers"))), lambda x: x["numbers"])
    return answers.groupBy("fragment").agg(ordered.alias("replies"))


def _told(state: DataFrame) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """Sums over all fragments, and count and tables of each hot word."""
    sums = state.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    hot = state.select(F.explode("hot").alias("h")).groupBy("h.at").agg(F.sum("h.n").alias("n"), F.sum("h.opened").alias("opened")).collect()
    return np.array([r["x"] for r in sorted(sums, key=lambda r: r["i"])]), {r["at"]: (r["n"], r["opened"]) for r in hot}


def _totals(state: DataFrame, hot: HotWords, before: Totals | None) -> Totals | None:
    """Totals of the state; discounts are told once, by the numbers of single and double counts."""
    sums, told = _told(state)
    if not len(sums):
        return None
    tokens, words, one, two, parent_one, parent_two, opened, seated = sums
    share = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b))) if a else 0.5
    discount, parent_discount = (before.discount, before.parent_discount) if before else (share(one, two), share(parent_one, parent_two))
    counts, customers = (np.array([told.get(i, (0, 0))[k] for i in range(len(hot.keys))], np.int64) for k in (0, 1))
    words = int(words) + int((counts > 0).sum())
    tables = np.clip(before.hot_tables if before else np.minimum(customers, 1), np.minimum(customers, 1), customers)
    out = Totals(int(tokens), words, float(opened), float(seated + tables.sum()), discount, parent_discount, hot, counts, customers, tables)
    rng, at = np.random.default_rng(words), np.flatnonzero(customers > 1)
    for turn in range(PARENT_TURNS):  # the parent's customers of hot words are moved here
        weight = (STRENGTH + parent_discount * out.tables) / (words + 1)
        tables[at] = reseat(customers[at], tables[at], parent_discount, weight, dealt(np.maximum(customers[at], PARENT_TURNS), turn, PARENT_TURNS), rng)
        out.tables = float(seated + tables.sum())
    return out


def fit(fragments: DataFrame, bits: int, hot: HotWords) -> tuple[DataFrame, DataFrame, Totals | None]:
    """The state after BURN_IN + SAMPLES - 1 rounds, replies to it, and the totals; the last sample is still to be recorded."""
    begin = fragments.select("fragment", *[f.name for f in _FRAGMENT])
    target = to_arrow_schema(_STATE)

    def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for row in given.to_pylist():
                yield pa.RecordBatch.from_pylist([Fragment.read(row).row(hot)], schema=target)

    state = staged(begin.mapInArrow(opening, _STATE), "lm-state")
    totals = _totals(state, hot, None)
    for turn in range(1, BURN_IN + SAMPLES):
        now = totals

        def play(batches: Iterator[pa.RecordBatch], turn: int = turn, now: Totals = now) -> Iterator[pa.RecordBatch]:
            for given in batches:
                for row in given.to_pylist():
                    f = Fragment.read(row, row["replies"])
                    if turn > BURN_IN:
                        f.record(now)
                    rng, seating = np.random.default_rng([turn, f.fragment]), f.seating(now)
                    if turn == 1:
                        seating.first(rng)
                    for _ in range(SWEEPS):
                        seating.sweep(rng)
                    f.opened, f.seated = seating.opened, seating.seated
                    yield pa.RecordBatch.from_pylist([f.row(hot)], schema=target)

        if totals is None:
            break
        replies = staged(_replies(state, bits), "lm-replies")
        following = staged(state.drop("sums", "hot").join(replies, "fragment").mapInArrow(play, _STATE), "lm-state")
        unstage(state, replies)
        state, totals = following, _totals(following, hot, totals)
    return state.drop("sums", "hot"), staged(_replies(state, bits), "lm-replies"), totals


# ------------------------------------------------------------------ scores


def _answers(cells: DataFrame, state: DataFrame, replies: DataFrame, totals: Totals) -> DataFrame:
    """(batch, fragment, payload): for what a slice asked of a fragment, in that order, the
    probability of each pair, pairs of each word and its training count."""
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("fragment", T.LongType()), T.StructField("payload", T.BinaryType())])
    target = to_arrow_schema(schema)
    asked = cells.where("fragment >= 0 AND batch IS NOT NULL").select("fragment", "batch", "payload")
    # State and replies come first in each fragment, so what was asked streams through; one shuffle.
    rows = state.withColumn("batch", F.lit(-2).cast("long")).unionByName(replies.withColumn("batch", F.lit(-1).cast("long")), allowMissingColumns=True)
    rows = rows.unionByName(asked, allowMissingColumns=True).repartition("fragment").sortWithinPartitions("fragment", "batch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = p = word = counts = None
        for given in batches:
            out = []
            names, batch = given.schema.names, given.column(given.schema.names.index("batch")).to_pylist()
            for i in range(given.num_rows):
                if batch[i] == -2:
                    state = {n: given.column(k)[i].as_py() for k, n in enumerate(names)}
                    continue
                if batch[i] == -1:
                    f = Fragment.read(state, given.column(names.index("replies"))[i].as_py())
                    f.record(totals)
                    p, word, counts = f.probabilities(totals).astype("<f4"), f.word, f.word_counts(totals)
                    continue
                at = _whole(given.column(names.index("payload"))[i].as_py(), "<u4", True)
                first = np.flatnonzero(np.diff(word[at], prepend=-1))
                parts = [_packed(p[at], "<f4"), _packed(np.diff(np.append(first, len(at))), "<u4"), _packed(counts[word[at[first]]], "<u8")]
                out.append((batch[i], given.column(names.index("fragment"))[i].as_py(), _joined(parts)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out, strict=True), target, strict=True)], schema=target)

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    ship_package(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = max(LEAST_FRAGMENTS - 1, total // FRAGMENT_BYTES).bit_length()
    hot = hot_words(docs, text_col, bits)
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == held, F.lit(False))
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    cells = staged(_cells(given, bits, hot), "lm-cells")
    state, replies, totals = fit(cells.where("keys IS NOT NULL"), bits, hot)
    own = cells.where("fragment = -1").select("batch", "fragment", "payload", "ids", "held_out", "n_tokens")
    rows = own if totals is None else own.unionByName(_answers(cells, state, replies, totals), allowMissingColumns=True)
    tokens, words = (totals.tokens, totals.words) if totals else (0, 0)
    schema = T.StructType(
        [given.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    )
    target = to_arrow_schema(schema)

    def add_up(table: pa.Table) -> pa.Table:
        table = table.sort_by("fragment")  # the slice's own row first, then answers in its order of pairs
        per_doc, pair, count = (_whole(x, kind, rising) for x, kind, rising in zip(_parts(table["payload"][0].as_py()), ("<u4", "<i8", "<u4"), (False, True, False), strict=True))
        answers = [_parts(x) for x in table["payload"].to_pylist()[1:]]
        p = np.concatenate([_whole(a, "<f4") for a, _, _ in answers]).astype(float)
        known = np.concatenate([np.repeat(_whole(c, "<u8"), _whole(n, "<u4")) for _, n, c in answers]).astype(float)
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        sums = lambda x: np.bincount(doc, count * x[pair], minlength=len(per_doc))
        base = np.log10((known + 1) / (tokens + words + 1))
        ids, held, n_tokens = (table[c].combine_chunks()[:1].flatten() for c in ("ids", "held_out", "n_tokens"))
        columns = [ids, held, n_tokens, pa.array(np.rint(sums(known > 0)).astype(np.int64)), pa.array(np.full(len(ids), tokens)), pa.array(sums(base)), pa.array(sums(np.log10(p)))]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return rows.groupBy("batch").applyInArrow(add_up, schema)
