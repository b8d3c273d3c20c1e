"""Document fingerprints by winnowing.

Every run of K code points is hashed by a rolling polynomial; of each WINDOW neighbouring
hashes the least is chosen, the rightmost on ties. Two texts that share a passage
of at least K + window - 1 code points therefore share a chosen hash, and positions are
kept to say where. The window is WINDOW, in texts under 8 x WINDOW code points an eighth of the
length, rounded down to a power of two, LEAST_WINDOW at least; what a larger window chooses, a
smaller one does too, so half of any text of 46 code points or more has a choice of its own.
A text shorter than a gram is one gram.

Defined cases: null is the empty text; the empty text has an empty fingerprint, alike
(1.0) to another empty one only; an empty table gives an empty result; rows with equal
ids follow each other by two text checksums, null ids come first; a single
document is its own next one. Many rows of one id, or copies of one row, are dealt out like any others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.llm.arrow_map import map_text, texts_of
from kinloom.session import ship_package, staged, unstage

#: Code points in a gram (a power of two) and grams in a window (powers of two).
K, WINDOW, LEAST_WINDOW = 16, 64, 8
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_LOW = np.uint64(0xFFFFFFFF)


def _gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all runs of k code points: the polynomial over a run of 2m is put
    together from two runs of m, so log2(k) steps replace the rolling update."""
    h, length, factor = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    while length < k:
        h = h[:-length] * np.uint64(factor) + h[length:]
        factor = factor * factor % (1 << 64)
        length *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(_MIX)
    return h >> np.uint64(32)


def window_of(n_chars: int) -> int:
    return min(WINDOW, max(LEAST_WINDOW, 1 << (max(n_chars, 8) // 8).bit_length() - 1))


def chosen(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions that winnowing chooses, by position."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    window = window_of(len(codes))
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(codes) < K:  # one gram, padded
        codes = np.concatenate([codes, np.full(K - len(codes), 0x110000, np.uint32)])
    hashes = _gram_hashes(codes, K)
    # Hash above, complement of the position below: the least number is the rightmost least hash.
    least = (hashes << np.uint64(32)) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    reach = 1
    while reach < window and len(least) > 1:
        step = min(reach, len(least) - 1)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    least = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return least >> np.uint64(32), _LOW - (least & _LOW)


def as_hex(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Eight digits of hash and eight of position for each choice."""
    out = np.empty((len(hashes), 2), ">u4")
    out[:, 0], out[:, 1] = hashes, positions
    return out.tobytes().hex()


def likeness(a: set[int], b: set[int]) -> float:
    """Jaccard similarity of two sets of chosen hashes."""
    if not a and not b:
        return 1.0
    return len(a & b) / len(a | b)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its fingerprint: arrays of hashes and positions."""

    def make():  # noqa: ANN202
        def work(texts: pa.Array) -> list:
            found = [chosen(x) for x in texts_of(texts)]
            return [[h.astype(np.int64).tolist() for h, _ in found], [p.astype(np.int64).tolist() for _, p in found]]

        return work

    longs = T.ArrayType(T.LongType())
    return map_text(docs, make, [F.col(text_col)], [("hashes", longs), ("positions", longs)], keep=[F.col(id_col)])


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Bounds:
    """Stretches of the order (key, tie): stretch i ends with the i-th bound. A bound that fills several stretches by
    itself is repeated; its rows, which are copies of one another, are then dealt out among these by a salt."""

    def __init__(self, pairs: list[tuple[int, int]]) -> None:
        ends = sorted(pairs)
        self.ends = sorted(set(ends))
        self.copies = [ends.count(e) for e in self.ends] if len(ends) > len(self.ends) else [1] * len(self.ends)
        self.keys = np.array([k for k, _ in self.ends], np.int64)
        self.ties = np.array([t for _, t in self.ends], np.int64)
        #: Number of the first stretch of each bound, and of the one after all bounds.
        self.first = np.concatenate([[0], np.cumsum(self.copies)]).astype(np.int64)

    def rank(self, keys: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """How many bounds stand before each row."""
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        at = low.copy()
        for i in np.flatnonzero(high > low):  # rows of a key that is a bound
            at[i] = low[i] + np.searchsorted(self.ties[low[i] : high[i]], ties[i], "left")
        return at

    def stretch(self, keys: np.ndarray, ties: np.ndarray, salt: np.ndarray | None = None) -> np.ndarray:
        """The number of each row's stretch; without a salt, of the first stretch that it may be in."""
        at = self.rank(keys, ties)
        out = self.first[at]
        if salt is not None:
            for b in [b for b, c in enumerate(self.copies) if c > 1]:
                own = (at == b) & (keys == self.keys[b]) & (ties == self.ties[b])
                out[own] += salt[own] % self.copies[b]
        return out.astype(np.int32)

    def followers(self, least: dict[int, tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(stretch, key, tie) of the row that comes after each stretch, given the least row of those that have one. The
        last is followed by the first of all."""
        out, after = [], least[min(least)] if least else None
        if after is None:
            return []
        for b in range(len(self.ends), -1, -1):
            first = int(self.first[b])
            if b < len(self.ends):
                for p in range(first, first + self.copies[b] - 1):  # followed by one more copy
                    out.append((p, *self.ends[b]))
                out.append((first + self.copies[b] - 1, *after))
            else:
                out.append((first, *after))
            after = least.get(first, after)
        return out


def find_bounds(narrow: DataFrame, parts: int) -> Bounds:
    """Bounds by quantiles of the keys, and of the ties where one key fills several stretches."""
    asked = [i / parts for i in range(1, parts)] or [0.5]
    found = np.array(narrow.agg(F.percentile_approx("key", asked, 20 * parts).alias("cuts")).first()["cuts"] or [], np.int64)
    cuts, times = np.unique(found, return_counts=True)
    hot = {int(k): int(n) for k, n in zip(cuts, times, strict=True) if n > 1}  # fewer than parts / 2
    pairs = [(int(k), (1 << 63) - 1) for k in cuts]
    if hot:
        ties = narrow.where(F.col("key").isin(list(hot))).groupBy("key").agg(F.percentile_approx("tie", asked, 20 * parts).alias("ties"), F.count("*").alias("n")).collect()
        for r in ties:
            # So few stretches that each has 64 rows at least: none stays without a copy.
            n = min(hot[r["key"]], r["n"] // 64)
            at = np.linspace(0, len(r["ties"]) - 1, n + 2).astype(int)[1:-1] if n else []
            pairs += [(r["key"], int(r["ties"][i])) for i in at]
    return Bounds(pairs)


def _stretches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt into contiguous stretches of ids, each followed by the first row of the next
    stretch (the last stretch by the first): columns part, extra, doc_id, text, in order.

    Order and bounds follow from ids and texts alone, so it does not matter if rows come in
    another order when a stage is computed again."""
    spark = docs.sparkSession
    parts = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # 52 bits, which quantiles keep exactly.
    tie = F.shiftleft(F.crc32(text.cast("binary")), 20) + F.pmod(F.xxhash64(text), F.lit(1 << 20))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), tie.alias("tie"), text.alias("text"))
    narrow = staged(rows.select("key", "tie"), "winnow-keys")
    bounds = find_bounds(narrow, parts)

    @F.pandas_udf(T.IntegerType())
    def first_part(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(bounds.stretch(key.to_numpy(), tie.to_numpy()))

    @F.pandas_udf(T.IntegerType())
    def part_of(key: pd.Series, tie: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series(bounds.stretch(key.to_numpy(), tie.to_numpy(), salt.to_numpy()))

    # A row for each stretch reaches the driver.
    least = narrow.withColumn("part", first_part("key", "tie")).groupBy("part").agg(F.min(F.struct("key", "tie")).alias("least")).collect()
    unstage(narrow)
    after = bounds.followers({r["part"]: (r["least"]["key"], r["least"]["tie"]) for r in least})
    wanted = spark.createDataFrame(after, "part int, key long, tie long")
    texts = rows.join(F.broadcast(wanted.select("key", "tie").distinct()), ["key", "tie"]).groupBy("key", "tie").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    columns = ["part", "extra", "key", "tie", "doc_id", "text"]
    extra = wanted.join(texts, ["key", "tie"]).withColumn("extra", F.lit(True)).select(*columns)
    salt = F.monotonically_increasing_id()  # any number will do: copies are alike
    dealt = rows.withColumn("part", part_of("key", "tie", salt)).withColumn("extra", F.lit(False)).select(*columns).unionByName(extra).repartition(parts, "part")
    return dealt.sortWithinPartitions("part", "extra", "key", "tie").select("part", "extra", "doc_id", "text")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text, with both likenesses."""
    ship_package(docs.sparkSession)
    given = _stretches(docs, id_col, text_col)
    text, real = T.StringType(), T.DoubleType()
    schema = T.StructType(
        [given.schema["doc_id"], T.StructField("n_chars", T.LongType())]
        + [T.StructField(n, text) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [T.StructField(n, real) for n in ("near_edited", "near_next")]
    )
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row that waits for its next one
        for batch in batches:
            rows = []
            for part, extra, doc_id, own in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if last is not None and last[0] != part:
                    raise RuntimeError(f"stretch {last[0]} has no following row")
                if extra and last is None:
                    continue  # nothing in this stretch
                hashes, positions = chosen(own)
                members = set(hashes.tolist())
                if last is not None:
                    _, before, body, mark, had = last
                    other = edited(body, own)
                    other_hashes, other_positions = chosen(other)
                    rows.append((before, len(body), hashlib.sha256(other.encode()).hexdigest(), mark, as_hex(other_hashes, other_positions), likeness(had, set(other_hashes.tolist())), likeness(had, members)))
                last = None if extra else (part, doc_id, own, as_hex(hashes, positions), members)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)
        if last is not None:
            raise RuntimeError(f"stretch {last[0]} has no following row")

    return given.mapInArrow(run, schema)
