"""Token ids in files of independent zstandard frames, and their reader.

A file is a valid zstandard file in the public seekable format:

    frame of document 0 | frame of document 1 | ... | index | seek table

Each document is one frame of its own (its ids, end id included, little-endian, 16 bits wide where the vocabulary
allows, else 32) with zstandard's checksum of its content. The index is a skippable frame that names the file's place and
its documents' ids. The seek table, a skippable frame at the very end, has the compressed size,
size and checksum of each frame (the index counts as one without content), so a reader goes from the last nine bytes
to the frames that it wants and decompresses no other.

Files stand in ascending id order: rows are dealt by range on (id, hash of the text), null ids first, and a task cuts its stretch
into files of bounded size at document borders. They are written by Spark's text writer, a file a row: the line
separator is the seek table's last four bytes. So Spark's own commit decides which attempt's files count when a task runs
twice or an executor is lost, in any file system that Spark can write. They are read through Spark's
binary reader. A catalog beside them, a row for each file, tells which ids and which stretch of tokens a file holds.

Defined cases. Null and empty texts are the end id alone. Repeated rows each get a frame; of equal ids the order is that
of the texts' hashes. An empty table leaves an empty folder that reads as no rows. A very long document has a file
of its own size; other columns are not read. A damaged frame is an error for those who ask for its document, and
only for them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.llm.arrow_map import text_slices, texts_of
from kinloom.llm.packing import worker_tokenizer
from kinloom.session import ship_package

#: Compressed bytes at which a task begins another file.
FILE_BYTES = 8 << 20
LEVEL = 3

# Fixed values of the public zstandard formats: skippable frames, the seek table's and the footer's magic numbers,
# and the descriptor's bit for checksums.
SKIPPABLE, SEEK_TABLE, FOOTER, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: Version of the index; then part, number within the part, bytes of an id, documents, ids before the file in its part.
_INDEX = struct.Struct("<IIIIQQ")
VERSION = 1
CATALOG = "catalog"
FRAMES = "frames"


class FileBuilder:
    """One file in memory, document by document."""

    def __init__(self, part: int, number: int, width: int, before: int) -> None:
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.place, self.width, self.before = (part, number), width, before
        self.frames: list[bytes] = []
        self.sizes: list[int] = []
        self.doc_ids: list[int | None] = []
        self.compressed = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.frames.append(frame)
        self.sizes.append(len(ids))
        self.doc_ids.append(doc_id)
        self.compressed += len(frame)

    def tokens(self) -> int:
        return sum(self.sizes) // self.width

    def finish(self) -> bytes:
        """The whole file."""
        body = _INDEX.pack(VERSION, *self.place, self.width, len(self.frames), self.before)
        body += np.array([i or 0 for i in self.doc_ids], "<i8").tobytes() + np.array([i is None for i in self.doc_ids], np.uint8).tobytes()
        index = struct.pack("<II", SKIPPABLE, len(body)) + body
        table = np.zeros((len(self.frames) + 1, 3), "<u4")
        table[:-1, 0] = [len(f) for f in self.frames]
        table[:-1, 1] = self.sizes
        table[:-1, 2] = [int.from_bytes(f[-4:], "little") for f in self.frames]  # a frame ends with its checksum
        table[-1, 0] = len(index)
        footer = struct.pack("<IBI", len(table), CHECKSUMS, FOOTER)
        return b"".join([*self.frames, index, struct.pack("<II", SEEK_TABLE, table.nbytes + len(footer)), table.tobytes(), footer])


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, content: bytes) -> None:
        import zstandard

        self.decompressor, self.error = zstandard.ZstdDecompressor(), zstandard.ZstdError
        self.content = memoryview(content)
        count, flags, magic = struct.unpack("<IBI", self.content[-9:])
        if magic != FOOTER or flags != CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        start = len(content) - 9 - 12 * count
        if start < 8 or struct.unpack("<II", self.content[start - 8 : start]) != (SEEK_TABLE, 12 * count + 9):
            raise ValueError("the seek table does not fit the file")
        table = np.frombuffer(self.content[start:-9], "<u4").reshape(count, 3)
        ends = np.cumsum(table[:, 0].astype(np.int64))
        if ends[-1] != start - 8:
            raise ValueError("the seek table does not fit the file")
        self.begins, self.ends, self.checksums = ends - table[:, 0], ends, table[:, 2]
        body = self.content[int(self.begins[-1]) + 8 : int(ends[-1])]
        version, self.part, self.number, self.width, n, self.before = _INDEX.unpack(body[: _INDEX.size])
        if version != VERSION or n != count - 1:
            raise ValueError("an index of another version or another file")
        ids = np.frombuffer(body[_INDEX.size : _INDEX.size + 8 * n], "<i8").tolist()
        unknown = np.frombuffer(body[_INDEX.size + 8 * n :], np.uint8)
        self.doc_ids = [None if u else i for i, u in zip(ids, unknown, strict=True)]
        self.counts = table[:-1, 1].astype(np.int64) // self.width
        #: Ids before each document in the file's part.
        self.starts = self.before + np.cumsum(self.counts) - self.counts

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document, checked against both checksums."""
        frame = self.content[int(self.begins[k]) : int(self.ends[k])]
        if int.from_bytes(frame[-4:], "little") != self.checksums[k]:
            raise ValueError(f"document {self.doc_ids[k]}: the frame is not that of the seek table")
        try:
            plain = self.decompressor.decompress(frame)
        except self.error as e:
            raise ValueError(f"document {self.doc_ids[k]}: {e}") from e
        if len(plain) != self.counts[k] * self.width:
            raise ValueError(f"document {self.doc_ids[k]}: {len(plain)} bytes where {self.counts[k] * self.width} belong")
        return np.frombuffer(plain, "<u2" if self.width == 2 else "<u4").astype("<u4")


def write_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, file_bytes: int = FILE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all documents below `folder`; returns the catalog."""
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    given = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    # Texts are shuffled once and encoded in place, so nothing is encoded twice for the ranges' sample.
    dealt = given.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    target = to_arrow_schema(T.StructType.fromDDL("content binary"))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_tokenizer(tokenizer_path, end_id), TaskContext.get().partitionId()
        width = encoder.dtype.itemsize
        own = FileBuilder(part, 0, width, 0)
        # The writer adds the last four bytes, as its line separator.
        row = lambda: pa.RecordBatch.from_arrays([pa.array([own.finish()[:-4]], pa.binary())], schema=target)
        for batch in batches:
            for piece in text_slices(batch, 1):
                for doc_id, x in zip(piece.column(0).to_pylist(), texts_of(piece.column(1)), strict=True):
                    if own.compressed >= file_bytes:
                        yield row()
                        own = FileBuilder(part, own.place[1] + 1, width, own.before + own.tokens())
                    own.add(doc_id, encoder.encode(x))
        if own.frames:
            yield row()

    rows = dealt.mapInArrow(files, "content binary").select(F.col("content").cast("string"))
    tail = struct.pack("<I", FOOTER).decode("latin-1")
    rows.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", tail).option("compression", "none").text(f"{folder}/{FRAMES}")
    _describe(spark, folder).write.parquet(f"{folder}/{CATALOG}")
    return read_catalog(spark, folder)


def _contents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).where("length > 0")


def _describe(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog, from the files' own tails; nothing is decompressed."""
    schema = "path string, part int, number int, documents long, tokens long, before long, first_id long, last_id long, has_null boolean"
    target = to_arrow_schema(T.StructType.fromDDL(schema))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                own = FileReader(content.as_py())
                known = [i for i in own.doc_ids if i is not None]
                row = dict(zip(target.names, (path.as_py(), own.part, own.number, len(own.doc_ids), int(own.counts.sum()), own.before, known[0] if known else None, known[-1] if known else None, len(known) < len(own.doc_ids)), strict=True))
                yield pa.RecordBatch.from_pylist([row], schema=target)

    own = _contents(spark, f"{folder}/{FRAMES}").select("path", "content").mapInArrow(tails, schema)
    # Ids before a part: a running sum over one row for each part, which is one for each task of the writer.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = own.groupBy("part").agg(F.sum("tokens").alias("total")).select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return own.join(F.broadcast(parts), "part").select("path", "part", "number", "documents", "tokens", "base", (F.col("base") + F.col("before")).alias("start"), "first_id", "last_id", "has_null")


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each file: path, part, number, documents, tokens, base (ids before its part), start (before it), ids."""
    return spark.read.parquet(f"{folder}/{CATALOG}")


def read_files(spark: SparkSession, folder: str, doc_ids: Iterable[int | None] | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) from the files: of all documents, or of those asked for, in which case
    only files that may hold them are opened and only their frames decompressed."""
    ship_package(spark)
    catalog = read_catalog(spark, folder)
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is None:
        contents = _contents(spark, f"{folder}/{FRAMES}")
    else:
        known = sorted(i for i in wanted if i is not None)
        holds = F.exists(F.lit(known).cast("array<long>"), lambda i: (i >= F.col("first_id")) & (i <= F.col("last_id")))
        asked = catalog.where((F.lit(None in wanted) & F.col("has_null")) | F.coalesce(holds, F.lit(False)))
        paths = [r["path"] for r in asked.select("path").collect()]  # the files of the request, not of the corpus
        contents = _contents(spark, paths) if paths else _contents(spark, f"{folder}/{FRAMES}").where(F.lit(False))
    fields = [T.StructField("part", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in ("doc_id", "local", "n_tokens", "ids_crc32")]]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    schema = T.StructType(fields)
    target = to_arrow_schema(schema)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                own = FileReader(content.as_py())
                asked = [k for k, i in enumerate(own.doc_ids) if wanted is None or i in wanted]
                for at in range(0, len(asked), 1024):
                    some = asked[at : at + 1024]
                    read = [own.ids(k) for k in some]
                    columns = [[own.part] * len(some), [own.doc_ids[k] for k in some], own.starts[some], own.counts[some], [zlib.crc32(x.tobytes()) for x in read]]
                    columns += [read] * with_ids
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    found = contents.select("content").mapInArrow(frames, schema)
    bases = F.broadcast(catalog.select("part", "base").distinct())  # a row for each task of the writer
    return found.join(bases, "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
