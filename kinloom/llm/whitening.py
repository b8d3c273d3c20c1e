"""Whitening of embeddings by hierarchical merging of singular value decompositions.

A partition keeps the count, the exact sums (so the mean) and all singular values and vectors of its
centred rows. Two such summaries merge by stacking both scaled bases, appending one row that corrects
for the difference of the means, and decomposing again; no dimension is ever cut, so the merge
loses nothing but rounding. Summaries meet sixteen at a time, level by level, in Spark; what reaches the
driver is one summary, whose size the dimension alone bounds.

An entry c counts as x = floor(scale * c) + shift. The covariance has divisor n.

Defined cases. Rows whose vector is null, empty, or holds a null or non-finite entry are left out. Vectors of
unlike lengths are an error, as is an entry too large for its scaled value to be exact. An empty
table, or one without usable vectors, gives no rows. Repeated rows and null ids are rows like others.
A component without variance (rank below the dimension, all rows equal, a single row) has `whitened` null,
stays out of `identity_error`, and its share `explained` is 0 (null where no component has variance).
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.llm.vectors import matrices, one_row_each, usable_rows, whole
from kinloom.session import ship_package, staged

#: Summaries that meet in one merge task.
FAN_IN = 16
#: Scaled entries stay below this, so that sums over a block are exact.
LIMIT = 2.0**40
_REST = "n long, sums array<{0}>, singular array<double>, vectors array<double>"


@dataclass(frozen=True)
class Summary:
    """n rows of sums `sums`; singular values and (row-wise) vectors of the centred rows."""

    n: int
    sums: np.ndarray  # Python integers for exact sums, else floats
    singular: np.ndarray
    vectors: np.ndarray

    def fields(self) -> dict:
        return {"n": self.n, "sums": self.sums.tolist(), "singular": self.singular.tolist(), "vectors": self.vectors.ravel().tolist()}

    @classmethod
    def of(cls, n: int, sums: list, singular: list, vectors: list) -> Summary:
        return cls(n, np.array(sums, object), np.array(singular, float), np.array(vectors, float).reshape(len(singular), len(sums)))


def _decomposed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, singular, vectors = np.linalg.svd(rows, full_matrices=False)
    return singular, vectors


def summary_of(block: np.ndarray) -> Summary:
    """The summary of a block of rows; of whole numbers, the centring is exact up to one division."""
    n = len(block)
    sums = block.sum(axis=0)
    centred = (n * block - sums) / n if block.dtype.kind == "i" else block - sums / n
    return Summary(n, np.array(sums.tolist(), object), *_decomposed(centred))


def merge(a: Summary, b: Summary) -> Summary:
    """The summary of all rows of both."""
    if len(a.sums) != len(b.sums):
        raise ValueError(f"vectors of {len(a.sums)} and of {len(b.sums)} entries in one table")
    between = ((a.sums * b.n - b.sums * a.n) / (a.n * b.n)).astype(float)  # whole numbers: exact but for this division
    correction = np.sqrt(a.n * (b.n / (a.n + b.n))) * between
    stacked = np.vstack([a.singular[:, None] * a.vectors, b.singular[:, None] * b.vectors, correction])
    return Summary(a.n + b.n, a.sums + b.sums, *_decomposed(stacked))


def merge_all(summaries: Iterator[Summary]) -> Summary | None:
    total = None
    for own in summaries:
        total = own if total is None else merge(total, own)
    return total


def summarise(vectors: DataFrame, prepare: Callable[[np.ndarray], np.ndarray], exact: bool) -> Summary | None:
    """The summary of prepare(vectors) over the whole frame: a summary for each partition, then merges by
    levels in Spark. None where there are no rows."""
    rest = _REST.format("long" if exact else "double")

    def leaf(blocks: Iterator[np.ndarray]) -> dict | None:
        total = merge_all(map(summary_of, blocks))
        return total and total.fields()

    def joined(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])  # the same order whatever arrives first
        total = merge_all(Summary.of(r["n"], r["sums"], r["singular"], r["vectors"]) for r in rows)
        return pa.Table.from_pylist([{"part": rows[0]["part"] // FAN_IN, **total.fields()}], schema=target)

    target = to_arrow_schema(T.StructType.fromDDL("part int, " + rest))
    level = staged(one_row_each(vectors, leaf, rest, prepare), "whitening")
    last = level.agg(F.max("part").alias("last")).first()["last"]
    while last:
        level = level.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(joined, "part int, " + rest)
        last //= FAN_IN
    row = level.first()
    return row and Summary.of(row["n"], row["sums"], row["singular"], row["vectors"])


@dataclass(frozen=True)
class Whitening:
    """Mean and components of the fit list, with the eigenvalues of its covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    #: Components with variance; the others cannot be scaled to one.
    rank: int
    scale: float
    shift: int

    def scaled(self, vectors: np.ndarray) -> np.ndarray:
        return scaled(vectors, self.scale, self.shift)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: as 64-bit numbers where they fit, else as Python's."""
        base = np.array([int(s) // self.n for s in self.sums], np.int64)
        rest = np.array([int(s) % self.n for s in self.sums], object)
        near = x - base
        if near.size and (float(np.abs(near).max()) + 1) * self.n < 2.0**62:
            return self.n * near - rest.astype(np.int64)
        return near.astype(object) * self.n - rest

    def deviations(self, x: np.ndarray) -> list[int]:
        d = self.centred(x)
        if d.dtype.kind == "i" and d.size and float(np.abs(d).max()) ** 2 * d.shape[1] >= 2.0**62:
            d = d.astype(object)
        return (d * d).sum(axis=1).tolist()

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The coordinates along the components that have variance, each of variance one."""
        away = (self.centred(x) / self.n).astype(float)
        return away @ self.components[: self.rank].T / np.sqrt(self.eigenvalues[: self.rank])


def scaled(vectors: np.ndarray, scale: float, shift: int) -> np.ndarray:
    return whole(scale * vectors, LIMIT, f"{scale:g} times it must stay below 2^40") + shift


def fit(vectors: DataFrame, components: int, scale: float, shift: int) -> Whitening | None:
    """The whitening of a frame of usable vectors (`__vector`), None where it is empty."""
    ship_package(vectors.sparkSession)
    total = summarise(vectors, lambda m: scaled(m, scale, shift), exact=True)
    if total is None:
        return None
    own, dimension = total.vectors[:components], len(total.sums)
    wanted = min(components, dimension)
    spread = total.singular**2
    if len(own) < wanted:  # fewer rows than components: complete the basis
        basis = np.linalg.svd(total.vectors, full_matrices=True)[2]
        own = np.vstack([own, basis[len(total.singular) : wanted]])
        spread = np.append(spread, np.zeros(wanted - len(spread)))
    sign = np.sign(own[np.arange(len(own)), np.abs(own).argmax(axis=1)])
    trace = spread.sum()
    floor = total.singular[0] * max(total.n, dimension) * np.finfo(float).eps if total.n > 1 else np.inf
    rank = int((np.sqrt(spread[:wanted]) > max(floor, 1e-9)).sum())
    shares = spread[:wanted] / trace if rank else np.full(wanted, np.nan)
    return Whitening(total.n, total.sums, own * sign[:, None], spread[:wanted] / total.n, shares, rank, scale, shift)


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the whitened rows' covariance minus the identity, in absolute value."""
    if not model.rank:
        return None
    total = summarise(vectors, lambda m: model.whitened(model.scaled(m)), exact=False)
    basis = total.singular[:, None] * total.vectors
    return float(np.abs(basis.T @ basis / total.n - np.eye(model.rank)).max())


def whiten(table: DataFrame, components: int = 32, scale: float = 64.0, shift: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: vec_id, component (from 1, by falling variance), n, deviation
    (decimal: it grows with the square of n), whitened, explained, identity_error."""
    given = usable_rows(table, vector_col, table[f"`{id_col}`"].alias("vec_id"))
    fields = [given.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0))]
    fields += [T.StructField(n, T.DoubleType()) for n in ("whitened", "explained", "identity_error")]
    schema = T.StructType(fields)
    model = fit(given, components, scale, shift)
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    error = identity_error(given, model)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.components)
        for piece, m in matrices(batches, 1, model.components.shape[1]):
            x, rows = model.scaled(m), len(m)
            values = np.full((rows, k), np.nan)
            values[:, : model.rank] = model.whitened(x)
            each = np.repeat(np.arange(rows), k)
            deviations = pa.array([Decimal(v) for v in model.deviations(x)], pa.decimal128(38, 0))
            columns = [
                piece.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)),
                deviations.take(pa.array(each)),
                pa.array(values.ravel(), pa.float64(), from_pandas=True),
                pa.array(np.tile(model.explained, rows), pa.float64(), from_pandas=True),
                pa.array([error] * (rows * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return given.mapInArrow(run, schema)
