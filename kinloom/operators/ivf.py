"""Approximate neighbours: inverted lists of product-quantised codes, one index for each partition.

Each partition (country and source) has coarse centres and codebooks of its own, fitted side by side, a task for
each, on a bounded sample. A reference is kept as its list and `pq_m` bytes: the vector's offset from the list's
centre, cut into pq_m parts, each named by the nearest of 256 entries. A query looks into its nearest lists, adds up
one table look-up for each byte, and the best `ann_shortlist` are ranked by true cosine.

Work is dealt in blocks. Lists of one partition are put together in bins of about BLOCK codes, large ones are split, and so are
the queries that a bin meets; a task sees one block of each. Models travel to blocks by shuffle, so none is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinloom.config import DenseConfig
from kinloom.session import ship_package, staged, unstage

#: Codes of a block, and queries of one.
BLOCK, ASKED = 16_384, 2_048
#: Entries of a codebook: what a byte can name.
ENTRIES = 256
ROUNDS = 10
#: Queries whose look-up tables are held at once.
TABLES = 128


def matrix(column: pa.ChunkedArray, dtype: type = np.float32) -> np.ndarray:
    """The vectors of a list column as rows."""
    flat = pc.list_flatten(column)
    return np.asarray(flat.to_numpy(zero_copy_only=False) if isinstance(flat, pa.Array) else flat.to_numpy(), dtype).reshape(len(column), -1)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, by blocks."""
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[at : at + 8192] @ centres.T - half, axis=1) for at in range(0, len(x), 8192)] or [np.zeros(0, np.int64)])


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres after ROUNDS rounds from k random rows; a centre left without rows goes to the row farthest from its own."""
    chance = np.random.default_rng(seed)
    centres = x[chance.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros(centres.shape, np.float64)
        np.add.at(sums, own, x)
        full = counts > 0
        centres[full] = (sums[full] / counts[full, None]).astype(x.dtype)
        if not full.all():
            far = np.argsort(-((x - centres[own]) ** 2).sum(axis=1), kind="stable")[: (~full).sum()]
            centres[~full] = x[far]
    return centres


def parts_of(x: np.ndarray, m: int) -> np.ndarray:
    """(m, rows, width)"""
    if x.shape[1] % m:
        raise ValueError(f"pq_m = {m} must divide the dimension, which is {x.shape[1]}")
    return np.ascontiguousarray(x.reshape(len(x), m, -1).transpose(1, 0, 2))


def fit_index(x: np.ndarray, lists: int, m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Coarse centres, and for each of m parts the entries of its codebook (m, ENTRIES at most, width)."""
    centres = k_means(x, lists, seed)
    offsets = parts_of(x - centres[nearest(x, centres)], m)
    return centres, np.stack([k_means(p, min(ENTRIES, len(p)), seed + 1 + i) for i, p in enumerate(offsets)])


def codes_of(x: np.ndarray, centres: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """List and code of each row."""
    own = nearest(x, centres)
    offsets = parts_of(x - centres[own], len(books))
    return own, np.stack([nearest(p, b) for p, b in zip(offsets, books, strict=True)], axis=1).astype(np.uint8)


def _blocks(n: Column, size: int) -> Column:
    return F.ceil(n / size).cast("int")


def _numbers(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


_MODEL = "part string, lists int, dimension int, centres binary, books binary"


def fit(references: DataFrame, sizes: DataFrame, config: DenseConfig) -> DataFrame:
    """A model for each partition: one row, of lists x dimension + 256 x dimension numbers.

    A partition's sample is chosen by hash and has about ann_training_rows rows at most; it is what one task holds. There
    are min(nlist, sample / 40) lists."""
    share = F.least(F.lit(1.0), config.ann_training_rows / F.col("n"))
    sample = references.join(F.broadcast(sizes), "part").where(F.pmod(F.xxhash64("r", F.lit(config.seed)), F.lit(1_000_000)) < share * 1_000_000)  # a row for each partition

    def own(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("r")  # the same model however the rows arrive
        x = matrix(rows["embedding"])
        centres, books = fit_index(x, min(config.nlist, max(1, len(x) // 40)), config.pq_m, config.seed)
        return pa.table({"part": [rows["part"][0].as_py()], "lists": pa.array([len(centres)], pa.int32()), "dimension": pa.array([x.shape[1]], pa.int32()), "centres": [centres.tobytes()], "books": [books.tobytes()]})

    return sample.select("part", "r", "embedding").groupBy("part").applyInArrow(own, _MODEL)


def _model_of(row: pa.Table, m: int) -> tuple[np.ndarray, np.ndarray]:
    dimension = row["dimension"][0].as_py()
    centres = np.frombuffer(row["centres"][0].as_py(), np.float32).reshape(-1, dimension)
    return centres, np.frombuffer(row["books"][0].as_py(), np.float32).reshape(m, -1, dimension // m)


def encode(references: DataFrame, sizes: DataFrame, models: DataFrame, config: DenseConfig) -> DataFrame:
    """(part, r, list, code): pq_m bytes beside the two numbers."""
    blocks = F.broadcast(sizes.select("part", _blocks(F.col("n"), BLOCK).alias("blocks")))  # a row for each partition
    left = references.join(blocks, "part").select("part", F.pmod(F.xxhash64("r"), F.col("blocks")).cast("int").alias("block"), "r", "embedding")
    right = models.join(blocks, "part").select("part", _numbers(F.col("blocks")).alias("block"), "dimension", "centres", "books")
    schema = "part string, r long, list int, code binary"

    def own(rows: pa.Table, model: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({"part": pa.array([], pa.string()), "r": pa.array([], pa.int64()), "list": pa.array([], pa.int32()), "code": pa.array([], pa.binary())})
        lists, codes = codes_of(matrix(rows["embedding"]), *_model_of(model, config.pq_m))
        return pa.table({"part": rows["part"], "r": rows["r"], "list": pa.array(lists.astype(np.int32)), "code": pa.array([c.tobytes() for c in codes], pa.binary())})

    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(own, schema)


def bins_of(codes: DataFrame) -> DataFrame:
    """(part, list, n, bin, blocks): neighbouring lists share a bin of about BLOCK codes; a bin of more has several blocks."""
    by = Window.partitionBy("part").orderBy("list").rowsBetween(Window.unboundedPreceding, -1)  # at most nlist rows
    sizes = codes.groupBy("part", "list").agg(F.count("*").alias("n"))
    placed = sizes.withColumn("bin", (F.coalesce(F.sum("n").over(by), F.lit(0)) / BLOCK).cast("int"))
    return placed.withColumn("blocks", _blocks(F.sum("n").over(Window.partitionBy("part", "bin")), BLOCK))


_PROBES = "part string, q long, bin int, blocks int, lists array<int>, coarse array<float>"


def probe(queries: DataFrame, models: DataFrame, bins: DataFrame, config: DenseConfig) -> DataFrame:
    """A row for each query and bin that it looks into: the nprobe nearest lists with rows, and more until they hold ann_top_k."""
    held = bins.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("list", "n", "bin", "blocks"))).alias("held"))  # nlist entries at most
    sizes = queries.groupBy("part").agg(_blocks(F.count("*"), ASKED).alias("asked"))
    blocks = F.broadcast(sizes)  # a row for each partition
    left = queries.join(blocks, "part").select("part", F.pmod(F.xxhash64("q"), F.col("asked")).cast("int").alias("block"), "q", "embedding")
    right = models.join(held, "part").join(blocks, "part").select("part", _numbers(F.col("asked")).alias("block"), "dimension", "centres", "books", "held")

    def own(rows: pa.Table, model: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(model):
            centres, _ = _model_of(model, config.pq_m)
            held = model["held"][0].as_py()
            index, sizes, bins, blocks = (np.array([h[k] for h in held]) for k in ("list", "n", "bin", "blocks"))
            products = matrix(rows["embedding"]) @ centres[index].T
            ranked = np.argsort(-(products - (centres[index] ** 2).sum(axis=1) / 2), axis=1, kind="stable")
            reach = np.argmax(np.cumsum(sizes[ranked], axis=1) >= min(config.ann_top_k, sizes.sum()), axis=1) + 1
            part = rows["part"][0].as_py()
            for i, (q, enough) in enumerate(zip(rows["q"].to_pylist(), reach, strict=True)):
                chosen = np.sort(ranked[i, : max(config.nprobe, enough)])
                for b in np.unique(bins[chosen]):
                    some = chosen[bins[chosen] == b]
                    out.append((part, q, int(b), int(blocks[some[0]]), index[some].tolist(), products[i, some].tolist()))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32())]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(["part", "q", "bin", "blocks", "lists", "coarse"], columns, kinds, strict=True)})

    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(own, _PROBES)


def scan_block(vectors: np.ndarray, lists: list, coarse: list, own: np.ndarray, codes: np.ndarray, ids: np.ndarray, books: np.ndarray, shortlist: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the query, ids, scores): of the codes in its lists, the best `shortlist` by centre and table look-ups."""
    order = np.lexsort((ids, own))
    own, codes, ids = own[order], codes[order], ids[order]
    flat = codes.astype(np.int64) + np.arange(codes.shape[1]) * books.shape[1]
    for at in range(0, len(vectors), TABLES):
        some = parts_of(vectors[at : at + TABLES], len(books))
        tables = np.einsum("mqw,mew->qme", some, books).reshape(some.shape[1], -1)
        for i, table in enumerate(tables, at):
            begins, ends = np.searchsorted(own, lists[i], "left"), np.searchsorted(own, lists[i], "right")
            rows = np.concatenate([np.arange(b, e) for b, e in zip(begins, ends, strict=True)])
            if not len(rows):
                continue
            scores = np.repeat(np.asarray(coarse[i], np.float32), ends - begins) + table[flat[rows]].sum(axis=1)
            best = np.lexsort((ids[rows], -scores))[:shortlist]
            yield i, ids[rows[best]], scores[best]


def nearest_in_block(vectors: np.ndarray, lists: list, own: np.ndarray, ids: np.ndarray, held: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the query, ids, cosines): of the vectors in its lists, the k nearest, ties by id."""
    every = np.unique(own)
    for at in range(0, len(vectors), TABLES):
        products = vectors[at : at + TABLES] @ held.T
        for i, row in enumerate(products, at):
            if not np.isin(every, lists[i]).all():
                row[~np.isin(own, lists[i])] = -np.inf
            some = np.flatnonzero(np.isfinite(row))
            if len(some) > k:
                some = some[row[some] >= np.partition(row[some], -k)[-k] - 1e-9]
            cosines = np.einsum("j,ij->i", vectors[i], held[some])
            best = np.lexsort((ids[some], -cosines))[:k]
            if len(best):
                yield i, ids[some[best]], cosines[best]


def shortlists(queries: DataFrame, codes: DataFrame, models: DataFrame, bins: DataFrame, config: DenseConfig, vectors_of: DataFrame | None = None) -> DataFrame:
    """(q, r, part): each query's ann_shortlist best codes in its partition.

    With `vectors_of` (r, embedding) of the references, where no shortlist cuts anything: (q, r, part, cosine) of the ann_top_k
    nearest of each block; its rows then bring their vectors along, and no pair but these leaves it."""
    probes = staged(probe(queries, models, bins, config), "ivf-probes")
    key = ["part", "bin", "block", "asked"]
    counts = staged(probes.groupBy("part", "bin").agg(_blocks(F.count("*"), ASKED).alias("groups"), F.max("blocks").alias("blocks")), "ivf-bins")
    left = probes.drop("blocks").join(counts, ["part", "bin"]).withColumn("asked", F.pmod(F.xxhash64("q"), F.col("groups")).cast("int")).withColumn("block", _numbers(F.col("blocks")))
    left = left.select(*key, "q", "lists", "coarse").join(queries.select("part", "q", "embedding"), ["part", "q"])
    met = bins.select("part", "list", "bin").join(counts, ["part", "bin"])
    right = codes.join(met, ["part", "list"]).withColumn("block", F.pmod(F.xxhash64("r"), F.col("blocks")).cast("int")).withColumn("asked", _numbers(F.col("groups")))
    if vectors_of is not None:
        return _whole_blocks(left, right.select(*key, "r", "list").join(vectors_of.select("r", F.col("embedding").alias("vector")), "r").select(*key, "r", "list", "vector"), key, config)
    # The codebooks come to each block as one more row, without an id.
    tables = models.select("part", "books").join(counts, "part").withColumn("block", _numbers(F.col("blocks"))).withColumn("asked", _numbers(F.col("groups")))
    right = right.select(*key, "r", "list", "code").unionByName(tables.select(*key, F.lit(None).cast("long").alias("r"), F.lit(None).cast("int").alias("list"), F.col("books").alias("code")))
    empty = {"q": pa.array([], pa.int64()), "r": pa.array([], pa.int64()), "part": pa.array([], pa.string()), "score": pa.array([], pa.float32())}

    def own(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or len(held) < 2:
            return pa.table(empty)
        asked, is_model = asked.sort_by("q"), pc.is_null(held["r"])
        vectors = matrix(asked["embedding"])
        books = np.frombuffer(held.filter(is_model)["code"][0].as_py(), np.float32).reshape(config.pq_m, -1, vectors.shape[1] // config.pq_m)
        rows = held.filter(pc.invert(is_model))
        codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(rows), -1)
        found = list(scan_block(vectors, asked["lists"].to_pylist(), asked["coarse"].to_pylist(), rows["list"].to_numpy(), codes, rows["r"].to_numpy(), books, config.ann_shortlist))
        if not found:
            return pa.table(empty)
        q = asked["q"].to_numpy()
        each = np.concatenate([np.full(len(ids), q[i]) for i, ids, _ in found])
        part = asked["part"][0].as_py()
        return pa.table({"q": pa.array(each), "r": pa.array(np.concatenate([ids for _, ids, _ in found])), "part": pa.array([part] * len(each)), "score": pa.array(np.concatenate([s for _, _, s in found]).astype(np.float32))})

    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(own, "q long, r long, part string, score float")
    at = F.row_number().over(Window.partitionBy("q", "part").orderBy(F.desc("score"), "r"))
    return met.withColumn("at", at).where(F.col("at") <= config.ann_shortlist).select("q", "r", "part")


def _whole_blocks(left: DataFrame, right: DataFrame, key: list[str], config: DenseConfig) -> DataFrame:
    kinds = {"q": pa.int64(), "r": pa.int64(), "part": pa.string(), "cosine": pa.float64()}

    def own(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):
            return pa.table({c: pa.array([], kind) for c, kind in kinds.items()})
        vectors, q, part = matrix(asked["embedding"], np.float64), asked["q"].to_numpy(), asked["part"][0].as_py()
        found = list(nearest_in_block(vectors, asked["lists"].to_pylist(), held["list"].to_numpy(), held["r"].to_numpy(), matrix(held["vector"], np.float64), config.ann_top_k))
        values = {"q": [x for i, ids, _ in found for x in [q[i]] * len(ids)], "r": [x for _, ids, _ in found for x in ids], "cosine": [x for _, _, c in found for x in c]}
        values["part"] = [part] * len(values["q"])
        return pa.table({c: pa.array(values[c], kind) for c, kind in kinds.items()})

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(own, "q long, r long, part string, cosine double")


def cosines(pairs: DataFrame, queries: DataFrame, references: DataFrame) -> DataFrame:
    """(q, r, part, cosine) of pairs of unit vectors, by Arrow batches."""
    left = queries.select("q", "part", F.col("embedding").alias("a"))
    right = references.select("r", F.col("embedding").alias("b"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = pa.Table.from_batches([batch.slice(at, 1024)])
                a, b = matrix(some["a"], np.float64), matrix(some["b"], np.float64)
                yield pa.RecordBatch.from_arrays([*[some[c].combine_chunks() for c in ("q", "r", "part")], pa.array(np.einsum("ij,ij->i", a, b))], names=["q", "r", "part", "cosine"])

    return pairs.join(right, "r").join(left, ["q", "part"]).select("q", "r", "part", "a", "b").mapInArrow(own, "q long, r long, part string, cosine double")


@dataclass(frozen=True)
class Index:
    """What a search needs besides the vectors for the final ranking; pq_m + 12 bytes and the partition's name a reference."""

    models: DataFrame
    codes: DataFrame
    bins: DataFrame

    def save(self, folder: str) -> None:
        for name in ("models", "codes", "bins"):
            getattr(self, name).write.mode("errorifexists").option("compression", "zstd").parquet(f"{folder}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Index:
        return cls(*[spark.read.parquet(f"{folder}/{name}") for name in ("models", "codes", "bins")])


def _own(df: DataFrame, key: str, on: str) -> DataFrame:
    return df.select(F.col(on).cast("string").alias("part"), key, "embedding")


def build(references: DataFrame, config: DenseConfig, on: str = "part") -> Index:
    """An index of every reference (r, `on`, embedding of length one), fitted on a sample of each partition."""
    ship_package(references.sparkSession)
    given = _own(references, "r", on)
    sizes = staged(given.groupBy("part").agg(F.count("*").alias("n")), "ivf-sizes")
    models = staged(fit(given, sizes, config), "ivf-models")
    codes = staged(encode(given, sizes, models, config), "ivf-codes")
    unstage(sizes)
    return Index(models, codes, staged(bins_of(codes), "ivf-lists"))


def search(index: Index, queries: DataFrame, references: DataFrame, config: DenseConfig, on: str = "part") -> DataFrame:
    """(q, r, cosine, rank, `on`): about the ann_top_k nearest of each query in its partition, by true cosine, ties by r.

    Where a query's partition has k references, it gets k."""
    q, r = _own(queries, "q", on), _own(references, "r", on)
    largest = index.bins.groupBy("part").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    whole = largest <= config.ann_shortlist  # no shortlist cuts anything
    met = staged(shortlists(q, index.codes, index.models, index.bins, config, r if whole else None), "ivf-shortlists")
    at = F.row_number().over(Window.partitionBy("q", "part").orderBy(F.desc("cosine"), "r"))
    kind = dict(references.dtypes)[on]
    scored = met if whole else cosines(met, q, r)
    return scored.withColumn("rank", at).where(F.col("rank") <= config.ann_top_k).select("q", "r", "cosine", "rank", F.col("part").cast(kind).alias(on))


def top_k(queries: DataFrame, references: DataFrame, config: DenseConfig, on: str = "part") -> DataFrame:
    """An index built for this one search."""
    index = build(references, config, on)
    found = search(index, queries, references, config, on)
    unstage(index.models, index.codes, index.bins)  # the search has staged its shortlists
    return found
