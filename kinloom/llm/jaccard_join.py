"""N-gram Jaccard self-join by vertical partitioning.

Documents are sets of word shingles. The order of all shingles (by hash) is cut into
fragments, and a document into the segments that fall in each.

1. In each fragment, count how many of a document's shingles another document has too, and
   sum the counts by document. One with fewer shared shingles than the similarity asks
   for has no partner; it leaves here. Equal sets are one set from now on. A slice of
   documents sends a fragment its shingles and whose they are, five bytes each at most, so what
   is sent does not depend on the number of fragments.
2. What is left is put in the order of frequency, rarest first. Two similar sets share
   a shingle of their prefixes, and at the first one both have enough left to reach
   the overlap they need. Within such a bucket, sets are first compared with pivots, one
   for each class of sizes and one for each set, so a group of k copies costs about k
   pairs; further rounds take others, twice as many each, and only sets that are still
   in different components.
3. A pair's overlap is counted fragment by fragment, and the partial counts are summed.
4. After PIVOT_ROUNDS, all pairs that share a bucket and are not connected yet are
   compared, so that no component is missed. Pairs already connected need no test,
   since the result is the components.

Defined cases: null or blank text has an empty set, size 0, linked with nothing, its own
component; fewer words than a shingle make one shingle; rows with equal sets are
linked (similarity 1); an empty table gives an empty result; a null id takes part
and its component is the least non-null id, if any. Shingles are told apart by 64-bit
hashes, equal sets by 128-bit ones. Of rows with equal id and text, `distinct_documents`
keeps the one whose columns have the least hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.llm.arrow_map import map_text, text_slices, texts_of
from kinloom.operators.components import connected_components
from kinloom.session import ship_package, staged, unstage

SHINGLE, SIMILARITY = 5, 80
PIVOT_ROUNDS = 6
#: Bytes of text for each fragment of the first step, and at least so many fragments.
FRAGMENT_BYTES, LEAST_FRAGMENTS = 32 << 20, 64
#: Fragments of the sets that are compared; pairs, and bytes of their sets, in one cell of that comparison.
SEGMENTS, CELL_PAIRS, CELL_BYTES = 4, 100_000, 64 << 20
#: A bucket with more than one in HOT_SHARE postings (so fewer than HOT_SHARE are) is dealt to SALTS tasks.
HOT_SHARE, SALTS = 1000, 32
#: Words whose hashes a task keeps, and the longest of them in bytes (some 100 MB in all); longer ones are hashed anew.
KEPT_WORDS, KEPT_BYTES = 500_000, 64
_A, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SHARED = 1  # added to owner numbers, so that 0 says "several documents of this slice"


def shingle_hashes(text: str, words_seen: dict[bytes, int], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode().lower().split()  # ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    try:
        codes = [words_seen[w] for w in words]
    except KeyError:
        codes = []
        for w in words:
            code = words_seen.get(w)
            if code is None:
                code = xxhash.xxh3_64_intdigest(w)
                if len(w) <= KEPT_BYTES:
                    words_seen[w] = code
            codes.append(code)
    given = np.array(codes, np.uint64)
    run = min(size, len(given))
    h = np.full(len(given) - run + 1, run, np.uint64)
    for k in range(run):
        h = (h ^ given[k : len(given) - run + 1 + k]) * _A
        h ^= h >> np.uint64(29)
    h *= _M
    h ^= h >> np.uint64(32)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _slice_sets(texts: pa.Array, size: int, seen: dict[bytes, int]) -> list[np.ndarray]:
    if len(seen) > KEPT_WORDS:
        seen.clear()
    return [shingle_hashes(x, seen, size) for x in texts_of(texts)]


# ---------------------------------------------------------------- 1. shared shingles by fragment


def _short(x: int) -> bytes:
    """A number in as few bytes as it needs, seven bits in each."""
    out = bytearray()
    while x > 127:
        out.append(x & 127 | 128)
        x >>= 7
    return bytes([*out, x])


def _read_short(packed: bytes, at: int) -> tuple[int, int]:
    x = shift = 0
    while packed[at] > 127:
        x |= (packed[at] & 127) << shift
        at, shift = at + 1, shift + 7
    return x | packed[at] << shift, at + 1


def pack_owners(counts: np.ndarray) -> bytes:
    """How often each owner occurs: a number each, or the gaps from one occurrence to the next
    (255: 255 further and on), whichever is shorter."""
    width, total = 1 if counts.max(initial=0) < 256 else 4, int(counts.sum())
    if len(counts) * width <= total + len(counts) // 255:
        return bytes([width]) + _short(len(counts)) + counts.astype(f"<u{width}").tobytes()
    gaps = np.diff(np.repeat(np.arange(len(counts)), counts), prepend=0)
    ends = np.cumsum(gaps // 255 + 1)
    out = np.full(ends[-1] if total else 0, 255, "u1")
    out[ends - 1] = gaps % 255
    return bytes([0]) + _short(len(counts)) + out.tobytes()


def unpack_owners(packed: bytes) -> np.ndarray:
    width, (n, at) = packed[0], _read_short(packed, 1)
    if width:
        return np.frombuffer(packed, f"<u{width}", n, at).astype(np.int64)
    gaps = np.frombuffer(packed, "u1", -1, at)
    return np.bincount(np.cumsum(gaps, dtype=np.int64)[gaps != 255], minlength=n)


def _packed(counts: np.ndarray, codes: np.ndarray) -> bytes:
    """Shingle counts by owner (0: several) and the shingles in that order."""
    owners = pack_owners(counts[1:])
    return _short(int(counts[0])) + _short(len(owners)) + owners + codes.tobytes()


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    several, at = _read_short(payload, 0)
    n, at = _read_short(payload, at)
    return np.concatenate([[several], unpack_owners(payload[at : at + n])]), np.frombuffer(payload, "<u4", -1, at + n)


def slice_payloads(sets: list[np.ndarray], bits: int) -> tuple[list[int], list[bytes], np.ndarray]:
    """Fragments that get a shingle of these sets, what each gets, and the shingles that each set
    shares with another of them."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    codes = np.concatenate(sets) >> np.uint64(32 - bits)  # fragment number above 32 bits of rest
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    new = np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)]
    # A shingle of several documents of this slice is sent once, for all of them.
    several = np.zeros(len(codes), bool)
    several[1:] |= ~new[1:]
    several[:-1] |= ~new[1:]
    local = np.bincount(owner[several], minlength=len(sets))
    codes, owner = codes[new], np.where(several, 0, owner + _SHARED)[new]
    fragment = (codes >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((owner, fragment))
    codes, owner, fragment = codes[order].astype("<u4"), owner[order], fragment[order]
    edges = np.append(np.flatnonzero(np.diff(fragment, prepend=-1)), len(fragment)).tolist()
    met = list(zip(edges[:-1], edges[1:], strict=True))
    return [int(fragment[a]) for a, _ in met], [_packed(np.bincount(owner[a:b], minlength=len(sets) + 1), codes[a:b]) for a, b in met], local


def _fragment_rows(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """Rows (batch, fragment, payload), and for each batch one row with fragment -1 and its documents."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("batch", T.LongType()),
            T.StructField("fragment", T.IntegerType()),
            T.StructField("payload", T.BinaryType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("keys", T.ArrayType(T.LongType())),
            T.StructField("keys2", T.ArrayType(T.LongType())),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("sets", T.ArrayType(T.BinaryType())),
        ]
    )
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, count, seen = TaskContext.get().partitionId() << 32, 0, {}
        for given in batches:
            for piece in text_slices(given, 1):
                sets = _slice_sets(piece.column(1), size, seen)
                fragments, rows, local = slice_payloads(sets, bits)
                n = len(rows)
                marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                nothing = [None] * n
                columns = [
                    [first + count] * (n + 1),
                    [*fragments, -1],
                    [*rows, pack_owners(local)],
                    [*nothing, piece.column(0)],
                    [*nothing, piece.column(2)],
                    [*nothing, piece.column(3)],
                    [*nothing, [len(x) for x in sets]],
                    [*nothing, marks],
                ]
                count += 1
                arrays = []
                for values, field in zip(columns, target, strict=True):
                    if isinstance(values[-1], pa.Array):
                        offsets = pa.array([0] * (n + 1) + [len(values[-1])], pa.int32())
                        arrays.append(pa.ListArray.from_arrays(offsets, values[-1].cast(field.type.value_type)))
                    else:
                        arrays.append(pa.array(values, field.type))
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return docs.mapInArrow(run, schema)


def _shared_in_fragments(rows: DataFrame) -> DataFrame:
    """Fragment by fragment, replace the shingles by how many of each document's are shared."""
    schema = rows.schema
    target = to_arrow_schema(schema)

    def settle(group: list[tuple[int, bytes]], fragment: int) -> pa.RecordBatch:
        parts = [_unpacked(p) for _, p in group]
        codes = np.concatenate([c for _, c in parts])
        order = np.argsort(codes, kind="stable")
        ranked = codes[order]
        same = ranked[1:] == ranked[:-1]
        shared = np.zeros(len(codes), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        out, at = [], 0
        for counts, own in parts:
            owner = np.repeat(np.arange(len(counts)), counts)
            flags = shared[at : at + len(own)]
            at += len(own)
            out.append(pack_owners(np.bincount(owner[flags], minlength=len(counts))[_SHARED:]))
        n = len(group)
        values = [[b for b, _ in group], [fragment] * n, out]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, target, strict=False)] + [pa.nulls(n, f.type) for f in list(target)[3:]], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, bytes]] = []
        current = None
        for given in batches:
            fragments = given.column(1).to_pylist()
            passed = [i for i, f in enumerate(fragments) if f < 0]
            if passed:
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(given.take(pa.array(passed)).columns, target, strict=True)], schema=target)
            for f, batch, payload in zip(fragments, given.column(0).to_pylist(), given.column(2).to_pylist(), strict=True):
                if f < 0:
                    continue
                if f != current and group:
                    yield settle(group, current)
                    group = []
                current = f
                group.append((batch, payload))
        if group:
            yield settle(group, current)

    spread = F.when(F.col("fragment") < 0, F.hash("batch")).otherwise(F.col("fragment"))
    return rows.withColumn("__to", spread).repartition("__to", "fragment").sortWithinPartitions("fragment").drop("__to").mapInArrow(run, schema)


def document_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """doc_id, text keys, set size, set hash and number of shared shingles of every document."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = max(LEAST_FRAGMENTS, total // FRAGMENT_BYTES).bit_length() - 1
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *text_keys(text_col))
    counted = _shared_in_fragments(_fragment_rows(keyed, size, bits))
    schema = T.StructType(
        [
            keyed.schema["doc_id"],
            T.StructField("key", T.LongType()),
            T.StructField("key2", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("sid", T.BinaryType()),
            T.StructField("shared", T.LongType()),
        ]
    )
    target = to_arrow_schema(schema)

    def add_up(table: pa.Table) -> pa.Table:
        info = table.filter(pc.less(table["fragment"], 0))
        shared = sum(unpack_owners(p) for p in table["payload"].to_pylist())
        columns = [info[c].combine_chunks().flatten() for c in ("ids", "keys", "keys2", "sizes", "sets")]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip([*columns, pa.array(shared)], target, strict=True)], schema=target)

    return counted.groupBy("batch").applyInArrow(add_up, schema)


def text_keys(text_col: str) -> list[Column]:
    """A 128-bit key of the text, by which its row is found again."""
    return [F.xxhash64(text_col).alias("key"), F.xxhash64(F.lit(1), text_col).alias("key2")]


# ---------------------------------------------------------------- 2. candidates


def _sets_of(docs: DataFrame, wanted: DataFrame, text_col: str, size: int) -> DataFrame:
    """sid, n and shingles of the wanted sets, read again from their texts."""
    texts = docs.select(F.col(text_col).alias("text"), *text_keys(text_col)).join(wanted, ["key", "key2"], "left_semi")

    def make() -> Callable:
        seen: dict[bytes, int] = {}

        def work(given: pa.Array) -> list:
            sets = _slice_sets(given, size, seen)
            marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            return [marks, [len(s) for s in sets], [s.view(np.int64).tolist() for s in sets]]

        return work

    found = map_text(texts, make, [F.col("text")], [("sid", T.BinaryType()), ("n", T.LongType()), ("shingles", T.ArrayType(T.LongType()))])
    return found.groupBy("sid").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """h, sid, n, rest (shingles from this one on), class: prefixes in order of frequency.

    A shingle of one set only takes a place in the order, the first ones, but no row."""
    tokens = sets.select("sid", "n", F.explode("shingles").alias("h"))
    often = tokens.groupBy("h").agg(F.count("*").alias("times")).where("times > 1")
    common = tokens.join(often, "h")
    ordered = F.array_sort(F.collect_list(F.struct("times", "h")))
    held = common.groupBy("sid", "n").agg(F.count("*").alias("m"), ordered.alias("ordered")).withColumn("single", F.col("n") - F.col("m"))
    # The prefix has n - ceil(n * percent / 100) + 1 places; the n - m single shingles come first.
    held = held.withColumn("places", F.expr(f"CAST(n - (n * {percent} + 99) div 100 + 1 - single AS INT)")).where("places > 0")
    rows = held.select("sid", "n", "single", F.posexplode(F.slice("ordered", F.lit(1), F.col("places"))).alias("pos", "o"))
    # Sets within the similarity differ in size by at most 100 / percent, one class.
    grade = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    return rows.select(F.col("o.h").alias("h"), "sid", "n", (F.col("n") - F.col("single") - F.col("pos")).alias("rest"), grade.alias("class"))


def _hot_buckets(postings: DataFrame) -> list[int]:
    """Buckets of more than one in HOT_SHARE postings; fewer than HOT_SHARE can be."""
    total = postings.count()
    return [r["h"] for r in postings.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") * HOT_SHARE > max(total, 100 * HOT_SHARE)).select("h").collect()]


def _dealt(rows: DataFrame, hot: list[int]) -> DataFrame:
    """rows with a salt by which those of a hot bucket are dealt out."""
    return rows.withColumn("salt", F.when(F.col("h").isin(hot), F.pmod(F.xxhash64("sid"), F.lit(SALTS))).otherwise(F.lit(0).cast("long")))


def _for_all(rows: DataFrame, hot: list[int]) -> DataFrame:
    """rows once for each salt of their bucket."""
    salts = F.when(F.col("h").isin(hot), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return rows.withColumn("salt", F.explode(salts))


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes allow the similarity and both have enough shingles left for the overlap it needs."""
    needed = (F.col(f"{a}.n") + F.col(f"{b}.n")) * percent  # of (100 + percent) parts
    return (
        (F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent)
        & (F.least(f"{a}.rest", f"{b}.rest") * (100 + percent) >= needed)
        & (F.col(f"{a}.sid") != F.col(f"{b}.sid"))
        & (F.col(f"{a}.component") != F.col(f"{b}.component"))
    )


def _pivot_pairs(postings: DataFrame, tried: DataFrame | None, turn: int, percent: int, hot: list[int]) -> DataFrame:
    """2^turn new pairs for each set: with the first, by this round's hash, of the pivots of its
    buckets, in its own and the next smaller class. A bucket has 2^turn pivots; the hash is the
    same in all buckets, so a group of copies shares its pivots."""
    count, first = 1 << turn, lambda sid: F.xxhash64(sid, F.lit(turn))
    at = F.row_number().over(Window.partitionBy("h", "class").orderBy(first("sid"), "sid"))
    pivots = _for_all(postings.withColumn("at", at).where(F.col("at") <= count).select("h", "class", "sid", "n", "rest", "component"), hot).alias("y")
    asked = _dealt(postings.select("h", "sid", "n", "rest", "component", F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("class")), hot).alias("x")
    same = (F.col("x.h") == F.col("y.h")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.class") == F.col("y.class"))
    met = asked.join(pivots, same & _may_link("x", "y", percent))
    met = met.select(F.col("x.sid").alias("own"), F.col("y.sid").alias("pivot"), (F.col("x.n") + F.col("y.n")).alias("size")).distinct()
    if tried is not None:
        done = tried.select(F.col("a").alias("own"), F.col("b").alias("pivot"))
        done = done.unionByName(tried.select(F.col("b").alias("own"), F.col("a").alias("pivot")))
        met = met.join(done, ["own", "pivot"], "left_anti")
    nearest = F.row_number().over(Window.partitionBy("own").orderBy(first("pivot"), "pivot"))
    chosen = met.withColumn("at", nearest).where(F.col("at") <= count)
    return chosen.select(F.least("own", "pivot").alias("a"), F.greatest("own", "pivot").alias("b"), "size").distinct()


def _rest_pairs(postings: DataFrame, percent: int, hot: list[int]) -> DataFrame:
    """All pairs of a bucket that are not connected yet."""
    x, y = _dealt(postings, hot).alias("x"), _for_all(postings, hot).alias("y")
    met = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.sid") < F.col("y.sid")) & _may_link("x", "y", percent))
    return met.select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"), (F.col("x.n") + F.col("y.n")).alias("size")).distinct()


# ---------------------------------------------------------------- 3. overlaps by fragment


def _segments(sets: DataFrame) -> DataFrame:
    """sid, fragment, n and that segment of the set, packed."""

    def make() -> Callable:
        def work(shingles: pa.Array) -> list:
            out = []
            for own in shingles.to_pylist():
                codes = np.sort(np.array(own, np.int64).view(np.uint64))
                edges = np.searchsorted(codes, (np.arange(1, SEGMENTS, dtype=np.uint64) << np.uint64(64 - SEGMENTS.bit_length() + 1)))
                out.append([c.tobytes() for c in np.split(codes, edges)])
            return [out]

        return work

    cut = map_text(sets, make, [F.col("shingles")], [("cut", T.ArrayType(T.BinaryType()))], keep=[F.col("sid"), F.col("n")])
    return cut.select("sid", "n", F.posexplode("cut").alias("fragment", "segment"))


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs whose summed overlaps reach the similarity.

    Pairs are dealt to cells of about CELL_PAIRS, or CELL_BYTES of their sets, so a set of many pairs
    stands in many. A cell
    meets its sets' segments fragment by fragment; the partial counts of a cell are
    one vector for each fragment, and the sum of these decides."""
    n, size = pairs.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    cells = 1 + max(n // CELL_PAIRS, 8 * size // CELL_BYTES)
    dealt = pairs.withColumn("cell", F.pmod(F.hash("a", "b"), F.lit(cells)))
    members = dealt.select("cell", F.col("a").alias("sid")).unionByName(dealt.select("cell", F.col("b").alias("sid"))).distinct()
    left = segments.join(members, "sid").select("fragment", "cell", "sid", "n", "segment")
    listed = dealt.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("pairs"))
    fragments = F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("fragment")
    right = listed.select("cell", F.col("pairs.a").alias("a"), F.col("pairs.b").alias("b"), fragments).toDF("at_cell", "a", "b", "at_fragment")
    ids = T.ArrayType(T.BinaryType())
    partial_schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("a", ids), T.StructField("b", ids), T.StructField("sizes", T.BinaryType()), T.StructField("common", T.BinaryType())])
    partial_target = to_arrow_schema(partial_schema)

    def count(sets: pa.Table, wanted: pa.Table) -> pa.Table:
        held = {s: (np.frombuffer(c, np.uint64), n) for s, c, n in zip(sets["sid"].to_pylist(), sets["segment"].to_pylist(), sets["n"].to_pylist(), strict=True)}
        row = wanted.to_pylist()[0]
        common, sizes = [], []
        for x, y in zip(row["a"], row["b"], strict=True):
            (p, n), (q, m) = held[x], held[y]
            both = np.concatenate([p, q])
            both.sort()
            common.append(int((both[1:] == both[:-1]).sum()))
            sizes.append(n + m)
        # The first fragment's row also says which pairs these are.
        told = (row["a"], row["b"], np.array(sizes, "<i8").tobytes()) if row["at_fragment"] == 0 else (None, None, None)
        values = (row["at_cell"], *told, np.array(common, "<i8").tobytes())
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, partial_target, strict=True)], schema=partial_target)

    partial = left.groupBy("fragment", "cell").cogroup(right.groupBy("at_fragment", "at_cell")).applyInArrow(count, partial_schema)
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    target = to_arrow_schema(schema)

    def decide(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        told = next(r for r in rows if r["sizes"] is not None)
        common = sum(np.frombuffer(r["common"], "<i8") for r in rows)
        links = np.flatnonzero(100 * common >= percent * (np.frombuffer(told["sizes"], "<i8") - common))
        return pa.Table.from_arrays([pa.array([told[c][i] for i in links], f.type) for c, f in zip(("a", "b"), target, strict=True)], schema=target)

    return partial.groupBy("cell").applyInArrow(decide, schema)


def _rooted(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Every document with its keys and set; (sid, root) of the sets that are linked with others."""
    ship_package(docs.sparkSession)
    base = staged(document_sets(docs, id_col, text_col, size), "join-documents")
    partnered = base.where(f"n_shingles > 0 AND 100 * shared >= {percent} * n_shingles")
    wanted = partnered.groupBy("sid").agg(F.min(F.struct("key", "key2")).alias("k")).select("k.*")
    sets = staged(_sets_of(docs, wanted, text_col, size), "join-sets")
    segments = staged(_segments(sets), "join-segments")
    open_ = staged(_prefixes(sets, percent).withColumn("component", F.col("sid")), "join-prefixes")
    tried = components = None
    hot = _hot_buckets(open_)
    turn = 0
    while turn <= PIVOT_ROUNDS:
        # Buckets whose sets are all connected are done.
        mixed = open_.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("h")
        before, open_ = open_, staged(_dealt(open_, hot).join(_for_all(mixed, hot), ["h", "salt"], "left_semi").drop("salt"), "join-open")
        unstage(before)
        if turn < PIVOT_ROUNDS:
            pairs = _pivot_pairs(open_, tried, turn, percent, hot)
        else:
            pairs = _rest_pairs(open_, percent, hot)
            pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "join-pairs")
        if not pairs.head(1):  # no pivot is left to try: compare the rest, if any
            turn = PIVOT_ROUNDS if turn < PIVOT_ROUNDS else turn + 1
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = staged(_linked(pairs, segments, percent), "join-links")
        if found.head(1):
            components, moved = _merged(components, found)
            before, open_ = open_, staged(open_.join(moved, open_["component"] == moved["node"], "left").select("h", "sid", "n", "rest", "class", F.coalesce("end", "component").alias("component")), "join-open")
            unstage(before)
        unstage(found)
        turn += 1
    unstage(sets, segments, open_)
    return base, None if components is None else components.toDF("sid", "root")


def _merged(components: DataFrame | None, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all sets that are not the least of theirs, and how components moved.

    Only new links, between the components as they were, are looked at."""
    if components is not None:
        for c in ("a", "b"):
            was = components.select(F.col("node").alias(c), F.col("component").alias("root"))
            links = links.join(was, c, "left").withColumn(c, F.coalesce("root", c)).drop("root")
    moves = connected_components(links.where("a <> b"))
    ends = moves.select("node", F.col("component").alias("end"))
    if components is None:
        return moves, ends
    further = ends.withColumnRenamed("node", "component")
    kept = components.join(further, "component", "left").select("node", F.coalesce("end", "component").alias("component"))
    out = staged(kept.unionByName(moves), "join-components")
    unstage(components)
    return out, ends


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    base, linked = _rooted(docs, id_col, text_col, size, percent)
    least = base.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    if linked is not None:
        grouped = least.join(linked, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        # Equal components meet by root; only a set's least id goes there, not its documents.
        roots = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
        least = grouped.join(roots, "root").select("sid", "component_id")
    else:
        least = least.withColumnRenamed("least", "component_id")
    in_sets = base.where("n_shingles > 0").join(least, "sid").select("doc_id", "n_shingles", "component_id")
    alone = base.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return in_sets.unionByName(alone)


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """docs with one row of each component: that of the least id (null ids last), then of the
    least text key; all of a component's other rows go, and rows without words all stay."""
    base, linked = _rooted(docs, id_col, text_col, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "key2")).alias("first")
    # Sets first, their components next: only a set's first row goes on.
    chosen = base.where("n_shingles > 0").groupBy("sid").agg(first)
    if linked is not None:
        chosen = chosen.join(linked, "sid", "left").groupBy(F.coalesce("root", "sid").alias("root")).agg(F.min("first").alias("first"))
    kept = staged(chosen.select(*[F.col(f"first.{n}").alias(f"__{n}") for n in ("doc_id", "key", "key2")]), "join-kept")
    words = F.coalesce(F.col(text_col), F.lit("")).rlike("[^ \\t\\n\\x0B\\f\\r]")
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), words.alias("words"), *text_keys(text_col))
    meets = keyed["id"].eqNullSafe(kept["__doc_id"]) & (keyed["key"] == kept["__key"]) & (keyed["key2"] == kept["__key2"])
    single = keyed.where("words").join(kept, meets, "left_semi").groupBy("id", "key", "key2").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return single.select("row.*").unionByName(keyed.where("NOT words").select("row.*"))
