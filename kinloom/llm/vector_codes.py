"""Product codes of embeddings: vectors in equal parts, each part named by the nearest of its position's entries.

Entries are found by a ball tree over each position's codebook. A node holds a centre and a radius that is
rounded up; a batch of parts goes down the tree, nearer child first, and a node is left out only where its rounded lower
bound is above the best distance so far. A bound equal to the best is visited, so that ties are seen; in
the leaves distances are whole numbers, compared as such, ties to the lower index. The result is thus
the exact one, whatever the tree looks like.

Codebooks are fitted on all rows: a round assigns every part, adds up parts by entry within each partition, and
Spark sums these by position and entry. What reaches the driver are the codebooks, whose size is set by parameters.

Defined cases. Rows whose vector is null, empty, or holds a null or non-finite entry are left out. Vectors of
unlike lengths, a length that the parts do not divide, and entries so large that a squared distance does not fit a long, are
errors. An empty table, or one without usable vectors, gives no rows. Codebooks start from the rows of the smallest
ids (null ids last; of equal ids the lesser vector first); with fewer rows than entries they are as long as there
are rows. Repeated rows each count and are each coded. Null labels sum together; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.llm.vectors import matrices, usable_rows, whole
from kinloom.session import ship_package, staged

#: Entries of a leaf of the ball tree.
LEAF = 16
#: Parts that go down the tree together.
BATCH = 4096
#: Relative and absolute slack of radii and bounds, far above the rounding of distances below 2^31.
SLACK, LEAST = 1e-9, 1e-6


@dataclass
class _Node:
    centre: np.ndarray
    radius: float
    #: A leaf has the indices of its entries, ascending; another node has two children.
    entries: np.ndarray | None = None
    children: tuple[_Node, _Node] | None = None


class BallTree:
    """Nearest entries of a codebook of whole numbers, exactly."""

    def __init__(self, codebook: np.ndarray) -> None:
        self.codebook = codebook
        self.root = self._node(np.arange(len(codebook)))
        self.visited = 0

    def _node(self, own: np.ndarray) -> _Node:
        points = self.codebook[own].astype(float)
        centre = points.mean(axis=0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(axis=1)).max()) * (1 + SLACK) + LEAST
        if len(own) <= LEAF:
            return _Node(centre, radius, entries=np.sort(own))
        # Split across the line through two far entries, at its median.
        far = points[((points - centre) ** 2).sum(axis=1).argmax()]
        other = points[((points - far) ** 2).sum(axis=1).argmax()]
        order = np.argsort(points @ (other - far), kind="stable")
        half = len(own) // 2
        return _Node(centre, radius, children=(self._node(own[order[:half]]), self._node(own[order[half:]])))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each part's nearest entry (ties: the lower) and the squared distance."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        index = np.zeros(len(parts), np.int64)
        for at in range(0, len(parts), BATCH):
            some = slice(at, at + BATCH)
            self._search(self.root, parts[some], parts[some].astype(float), np.arange(len(parts[some])), best[some], index[some])
        return index, best

    def _search(self, node: _Node, parts: np.ndarray, floats: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if node.entries is not None:
            self.visited += len(rows) * len(node.entries)
            away = parts[rows][:, None, :] - self.codebook[node.entries][None]
            squares = np.einsum("rej,rej->re", away, away)
            nearest = squares.argmin(axis=1)  # the first: entries ascend
            found, least = node.entries[nearest], squares[np.arange(len(rows)), nearest]
            better = (least < best[rows]) | ((least == best[rows]) & (found < index[rows]))
            best[rows[better]], index[rows[better]] = least[better], found[better]
            return
        left, right = node.children
        to_left, to_right = (np.sqrt(((floats[rows] - child.centre) ** 2).sum(axis=1)) for child in (left, right))
        near = to_left <= to_right
        for child, own in ((left, near), (right, ~near)):
            if own.any():
                self._search(child, parts, floats, rows[own], best, index)
        for child, distance, own in ((right, to_right, near), (left, to_left, ~near)):
            bound = (distance - child.radius) * (1 - SLACK) - LEAST
            open_ = own & (bound <= np.sqrt(best[rows].astype(float)))
            if open_.any():
                self._search(child, parts, floats, rows[open_], best, index)


def _split(matrix: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, width)"""
    rows, dimension = matrix.shape
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} entries cannot be cut into {parts} equal parts")
    return matrix.reshape(rows, parts, dimension // parts)


def _scaled(matrix: np.ndarray, scale: float) -> np.ndarray:
    limit = np.sqrt(2.0**60 / matrix.shape[1])
    return whole(matrix * scale, limit, f"{scale:g} times it must stay below {limit:.3g}")


def first_vectors(given: DataFrame, count: int, scale: float) -> np.ndarray:
    """The scaled vectors of the `count` smallest ids, ascending. A task passes on so many at most, and so does each
    lane of 64 tasks; the last task sees what the lanes pass on."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("__vector")]
    lane = Window.partitionBy("__lane").orderBy(*order)
    kept = given.withColumn("__lane", (F.spark_partition_id() / 64).cast("int")).withColumn("__nth", F.row_number().over(lane)).where(F.col("__nth") <= count)
    rows = kept.orderBy(*order).limit(count).select("vec_id", "__vector").collect()
    if len({len(r["__vector"]) for r in rows}) > 1:
        raise ValueError("vectors of unlike lengths in one table")
    found = _scaled(np.array([r["__vector"] for r in rows]), scale) if rows else np.empty((0, 0), np.int64)
    # Ids decide first; of equal ids the lesser scaled vector stands first.
    order_of = sorted(range(len(rows)), key=lambda i: (rows[i]["vec_id"] is None, rows[i]["vec_id"] or 0, found[i].tolist()))
    return found[order_of]


def fit_codebooks(given: DataFrame, parts: int, entries: int, rounds: int, scale: float) -> np.ndarray | None:
    """(parts, entries, width) whole numbers; None where there are no vectors."""
    start = first_vectors(given, entries, scale)
    if not len(start):
        return None
    books = np.ascontiguousarray(_split(start, parts).transpose(1, 0, 2))
    width = books.shape[2]
    schema = "position int, entry int, n long, sums array<long>"
    target = to_arrow_schema(T.StructType.fromDDL(schema))
    for _ in range(rounds):

        def added(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            trees = [BallTree(b) for b in books]
            counts = np.zeros(books.shape[:2], np.int64)
            sums = np.zeros(books.shape, np.int64)
            for _, m in matrices(batches, 0, parts * width):
                cut = _split(_scaled(m, scale), parts)
                for p, tree in enumerate(trees):
                    own, _ = tree.nearest(cut[:, p])
                    counts[p] += np.bincount(own, minlength=books.shape[1])
                    np.add.at(sums[p], own, cut[:, p])
            position, entry = np.nonzero(counts)
            if len(position):
                rows = pa.FixedSizeListArray.from_arrays(pa.array(sums[position, entry].ravel()), width)
                yield pa.RecordBatch.from_arrays([pa.array(position.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[position, entry]), rows.cast(target.field("sums").type)], schema=target)

        partial = given.select("__vector").mapInArrow(added, schema)
        totals = partial.groupBy("position", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums"))
        books = books.copy()
        for row in totals.collect():  # parts x entries rows at most
            books[row["position"], row["entry"]] = np.array([s // row["n"] for s in row["sums"]], np.int64)
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(given: DataFrame, books: np.ndarray, scale: float, keep: list[str]) -> DataFrame:
    """The columns `keep` of a frame of usable vectors with `code` and `error`."""
    parts, entries, width = books.shape
    digits = max(2, -(-(entries - 1).bit_length() // 4))
    source = given.select(*keep, "__vector")
    schema = T.StructType([*source.schema.fields[: len(keep)], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [BallTree(b) for b in books]
        names = [f"{i:0{digits}x}" for i in range(entries)]
        for piece, m in matrices(batches, len(keep), parts * width):
            cut = _split(_scaled(m, scale), parts)
            found = [tree.nearest(cut[:, p]) for p, tree in enumerate(trees)]
            codes = ["".join(names[i] for i in own) for own in zip(*(index.tolist() for index, _ in found), strict=True)]
            columns = [*piece.columns[:-1], pa.array(codes), pa.array(sum(best for _, best in found))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return source.mapInArrow(run, schema)


def compress(table: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """A row for each usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    ship_package(table.sparkSession)
    columns = [table[f"`{id_col}`"].alias("vec_id"), table[f"`{label_col}`"].alias("__label")]
    given = usable_rows(table, vector_col, *columns)
    books = fit_codebooks(given.select("vec_id", "__vector"), parts, entries, rounds, scale)
    if books is None:
        none = table.select(table[f"`{id_col}`"].alias("vec_id")).where(F.lit(False))
        return none.select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    coded = staged(encode(given, books, scale, ["vec_id", "__label"]), "codes")
    # A row for each label; whether it is small enough to broadcast is Spark's to measure.
    labels = coded.groupBy("__label").agg(F.sum("error").alias("label_error")).withColumnRenamed("__label", "__of")
    joined = coded.join(labels, F.col("__label").eqNullSafe(F.col("__of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
