"""Packing by concatenating and cutting.

Documents are tokenised once; each partition counts its ids, prefix sums over the
partition totals give every document a global offset, and windows of `length` ids
are cut from the one long stream. A document that crosses a window's end leaves one
piece in each window, so only the last sequence of the corpus is padded.

Defined cases: null or empty text is the end id alone; an empty table gives no
pieces; repeated rows are packed each; a document longer than a window gives as many
pieces as windows it touches; other columns are not read.
"""

from __future__ import annotations

import functools
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.llm.arrow_map import text_slices, texts_of
from kinloom.session import ship_package, staged

#: Bytes of words and ids kept in a worker's cache; beyond them it is emptied and filled again.
CACHE_BYTES = 96 << 20
#: What an entry takes besides the word itself and its ids.
ENTRY_BYTES = 140

# Within a word of these characters the tokenizer's normaliser only lower-cases, so the
# splitting rule can be applied here and each part be given to the model itself.
_PLAIN = re.compile(r"[!-~ß-öø-ÿ]+")
# A text of nothing but these bytes (letters up to U+00FF, white space, stops and commas)
# is lower-cased and cut as a whole; its words then share one cache entry for any spelling.
_SIMPLE = bytes([*range(65, 91), *range(97, 123), *b" .,\n", 0xC3, *range(0x80, 0xC0)])
_RUNS = ("..", ".,", ",.", ",,", "×", "÷")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class WordTokenizer:
    """Ids by the tokenizer, a word at a time: its rules never look across white space. A text
    with one of the vocabulary's added tokens is given to the tokenizer as a whole.

    Ids come packed as 16-bit numbers where the vocabulary allows, else as 32-bit ones.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        # Added tokens stand for themselves wherever they occur, across the rules for words.
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.end = np.array([end_id], self.dtype).tobytes()
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"": b""}
        self.held = 0

    def _remember(self, cache: dict[str, bytes], word: str, ids: bytes) -> bytes:
        size = sys.getsizeof(word) + len(ids) + ENTRY_BYTES
        if self.held + size > CACHE_BYTES:
            self.words.clear()
            self.parts.clear()
            self.words[""] = self.parts[""] = b""
            self.held = 0
        if size <= CACHE_BYTES:
            cache[word] = ids
            self.held += size
        return ids

    def _part(self, part: str) -> bytes:
        letters = self.letters
        shown = part if part.isascii() else "".join([letters[b] for b in part.encode()])
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _word(self, word: str) -> bytes:
        lower = word.lower()
        if not _PLAIN.fullmatch(lower) or (not word.isascii() and "ẞ" in word):
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()
        out = []
        for part in _PARTS.findall(lower):
            ids = self.parts.get(part)
            if ids is None:
                ids = self._remember(self.parts, part, self._part(part))
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The packed ids of a whole text with the end id."""
        if any(token in text for token in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.dtype).tobytes() + self.end
        if not text.encode().translate(None, _SIMPLE) and not any(run in text for run in _RUNS):
            words, cache, make = text.lower().replace("\n", " ").replace(".", " . ").replace(",", " , ").split(" "), self.parts, self._part
        else:
            words, cache, make = text.replace("\n", " ").split(" "), self.words, self._word
        found = list(map(cache.get, words))
        at, missing = 0, found.count(None)
        for _ in range(missing):
            at = found.index(None, at)
            ids = cache.get(words[at])
            found[at] = self._remember(cache, words[at], make(words[at])) if ids is None else ids
        return b"".join(found) + self.end


@functools.lru_cache(maxsize=1)
def worker_tokenizer(path: str, end_id: int) -> WordTokenizer:
    """One for all tasks of a Python worker, so that its words stay known."""
    return WordTokenizer(path, end_id)


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, the packed ids, their count and the place in the partition's own stream."""
    ship_package(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [given.schema["doc_id"], T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType())]
    )
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = worker_tokenizer(tokenizer_path, end_id), TaskContext.get().partitionId(), 0
        width = encoder.dtype.itemsize
        for batch in batches:
            for piece in text_slices(batch, 1):
                ids = [encoder.encode(x) for x in texts_of(piece.column(1))]
                counts = np.array([len(x) // width for x in ids], np.int64)
                local = at + np.cumsum(counts) - counts
                at += int(counts.sum())
                n = len(ids)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.full(n, part, np.int32)), pa.array(local), pa.array(counts), pa.array(np.full(n, width, np.int32)), pa.array(ids, pa.binary())], schema=target)

    return given.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, if asked for, the ids themselves."""
    # Staged: the offsets below must belong to the very partitions that were counted.
    parts = staged(tokenized(docs, tokenizer_path, end_id, id_col, text_col), "pack-ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("part").agg(F.max(F.col("local") + F.col("doc_tokens")).alias("total"))
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = parts.join(F.broadcast(offsets), "part").select(  # a row for each input partition
        "doc_id", (F.col("base") + F.col("local")).alias("at"), "doc_tokens", "width", "ids"
    )
    fields = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    schema = T.StructType([placed.schema["doc_id"], *fields])
    target = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, 4):
                rows: list[tuple] = []
                for i, (at, count, width, packed) in enumerate(zip(*(piece.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True)):
                    ids = np.frombuffer(packed, "<u2" if width == 2 else "<u4").astype("<u4")
                    start = 0
                    while start < count:  # a boundary record at each end of a window
                        sequence, offset = divmod(at + start, length)
                        size = min(length - offset, count - start)
                        own = ids[start : start + size]
                        rows.append((i, start, size, zlib.crc32(own.tobytes()), count, sequence, offset) + ((own.tolist(),) if with_ids else ()))
                        start += size
                columns = list(zip(*rows, strict=True))
                arrays = [piece.column(0).take(pa.array(columns[0], pa.int64()))]
                arrays += [pa.array(x, f.type) for x, f in zip(columns[1:], list(target)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return placed.mapInArrow(cut, schema)
