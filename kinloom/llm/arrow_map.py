"""Whole-text transforms as Arrow map tasks: the one shape most operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.session import ship_package

#: A slice handed to an operator holds about this many bytes of text, or one longer document.
SLICE_BYTES = 8 << 20


def text_slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice has at most `limit` bytes in the text column (or one row)."""
    if batch.nbytes <= limit or batch.num_rows < 2:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from text_slices(batch.slice(0, half), column, limit)
    yield from text_slices(batch.slice(half), column, limit)


def map_text(
    docs: DataFrame,
    make: Callable[[], Callable[..., list]],
    inputs: list[Column],
    fields: list[tuple[str, T.DataType]],
    keep: list[Column] | None = None,
) -> DataFrame:
    """Append `fields`, computed from `inputs`, to the columns `keep`.

    `make()` runs once in each task and returns the slice function: it gets one Arrow
    array for each input and returns one array or list for each field. Kept columns
    pass through untouched.
    """
    ship_package(docs.sparkSession)
    keep = keep or []
    kept = [c.alias(f"__k{i}") for i, c in enumerate(keep)]
    given = docs.select(*kept, *[c.alias(f"__i{i}") for i, c in enumerate(inputs)])
    n = len(kept)
    schema = T.StructType(given.schema.fields[:n] + [T.StructField(f"__o{i}", kind) for i, (_, kind) in enumerate(fields)])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in text_slices(batch, n):
                made = work(*piece.columns[n:])
                arrays = [c.cast(f.type) for c, f in zip(piece.columns[:n], target, strict=False)]
                arrays += [x.cast(f.type) if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) for x, f in zip(made, list(target)[n:], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    out = given.mapInArrow(run, schema)
    names = [docs.select(c).columns[0] for c in keep] + [name for name, _ in fields]
    return out.toDF(*names) if len(set(names)) == len(names) else out.select(*[F.col(c).alias(name) for c, name in zip(out.columns, names, strict=True)])


def with_row(docs: DataFrame, make: Callable, inputs: list[Column], fields: list[tuple[str, T.DataType]], keep_if: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
    """The documents, every column as it was, for which `keep_if` holds on the computed fields."""
    tagged = map_text(docs, make, inputs, [(f"__v_{name}", kind) for name, kind in fields], keep=[F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row")])
    return tagged.where(keep_if(lambda name: F.col(f"__v_{name}"))).select("__row.*")


def texts_of(array: pa.Array) -> list[str]:
    """Python strings; null is the empty text."""
    return [x or "" for x in array.to_pylist()]
