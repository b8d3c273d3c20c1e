"""Batches of vectors as whole-number matrices: what the operators on embeddings share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A matrix handed to an operator holds at most so many entries, or one vector.
CELLS = 1 << 19


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite."""
    v = vector.cast("array<double>")
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def usable_rows(table: DataFrame, vector_col: str, *others: Column) -> DataFrame:
    """`others` beside the vectors (last, as doubles) of the rows that can be used."""
    vector = table[f"`{vector_col}`"]
    return table.where(usable(vector)).select(*others, vector.cast("array<double>").alias("__vector"))


def matrices(batches: Iterator[pa.RecordBatch], column: int, dimension: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches, each with its vectors as a matrix; vectors of unlike lengths are an error."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            if dimension is None:
                dimension = len(batch.column(column)[at])
            piece = batch.slice(at, max(1, CELLS // dimension))
            own = piece.column(column)
            lengths = np.diff(own.offsets.to_numpy())
            if (lengths != dimension).any():
                raise ValueError(f"vectors of {dimension} and of {int(lengths[lengths != dimension][0])} entries in one table")
            yield piece, own.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            at += piece.num_rows


def whole(scaled: np.ndarray, limit: float, what: str) -> np.ndarray:
    """Floors as 64-bit numbers; sizes of `limit` or more are an error."""
    floors = np.floor(scaled)
    if floors.size and np.abs(floors).max() >= limit:
        raise OverflowError(f"a vector entry is too large: {what}")
    return floors.astype(np.int64)


def one_row_each(table: DataFrame, work: Callable[[Iterator[np.ndarray]], dict | None], schema: str, prepare: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """A row (`part` and what `work` returns) for each partition of a frame of vectors that has any."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL("part int, " + schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(prepare(m) for _, m in matrices(batches, 0))
        if found is not None:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), **found}], schema=target)

    return table.select("__vector").mapInArrow(run, "part int, " + schema)
