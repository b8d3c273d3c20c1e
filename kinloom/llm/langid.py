"""Language identification by a byte convolutional network.

A text is folded to BYTES classes a byte, cut into windows of WINDOW bytes (the last one
padded), and each window goes through filters of several widths, max pooling and
a softmax layer. A document's probabilities are the mean over all its windows,
weighted by the bytes in each. The network is trained in numpy on a bounded,
hash-chosen sample of labelled rows.

Defined cases: null text, or text without a letter, is `und` with score 0; without any
labelled row every text is `und`; an empty table gives an empty result; a null id is
not held out and not learned from; repeated rows get the same answer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.llm.arrow_map import map_text, texts_of, with_row

#: The bound on labelled rows: so many documents a language, in all, and windows a document. Where
#: there are more languages than TRAIN_TOTAL / TRAIN_ROWS, each gets fewer documents.
TRAIN_ROWS, TRAIN_TOTAL, TRAIN_WINDOWS = 300, 19_200, 8
WINDOW, WIDTHS, FILTERS, EMBEDDING, BYTES = 256, (2, 3, 4), 16, 8, 64
EPOCHS, BATCH, RATE, SEED = 5, 32, 0.004, 7
#: Windows computed at a time.
CHUNK = 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def _fold_table() -> np.ndarray:
    """Bytes to classes: 0 padding and other marks, 1-26 letters in either case, 27 digits, 28 first
    bytes of longer characters, 29-60 later bytes (their case bit dropped), 61 white space."""
    table = np.zeros(256, np.uint8)
    for i in range(26):
        table[65 + i] = table[97 + i] = 1 + i
    table[48:58] = 27
    table[0xC0:] = 28
    table[0x80:0xC0] = 29 + (np.arange(64) & 31)
    table[[9, 10, 11, 12, 13, 32]] = 61
    return table


_FOLD = _fold_table()


def windows_of(text: str) -> np.ndarray:
    """Folded windows of the whole text, at least one."""
    raw = _FOLD[np.frombuffer(text.encode(), np.uint8)]
    out = np.zeros(max(1, -(-len(raw) // WINDOW)) * WINDOW, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(-1, WINDOW)


class ByteCNN:
    """Parameters of the network; `scores` applies it, `fit` trains it."""

    def __init__(self, languages: list[str], seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.embedding = rng.normal(0, 0.5, (BYTES, EMBEDDING)).astype(np.float32)
        self.filters = [rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self.offsets = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]

    def _tables(self) -> list[list[np.ndarray]]:
        """Responses by class for each place in a filter; two places share a table over pairs.
        Summing them is the convolution, since an input byte has only BYTES values."""
        out = []
        for filters in self.filters:
            single = [self.embedding @ place for place in filters]
            pairs = [(a[:, None] + b[None]).reshape(BYTES * BYTES, FILTERS) for a, b in zip(single[::2], single[1::2], strict=False)]
            out.append(pairs + single[len(single) // 2 * 2 :])
        return out

    def _responses(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> list[np.ndarray]:
        codes = windows.astype(np.int32)
        pairs = codes[:, :-1] * BYTES + codes[:, 1:]
        out = []
        for width, parts in zip(WIDTHS, tables, strict=True):
            length = WINDOW - width + 1
            total = None
            for k, table in enumerate(parts):
                at = (codes if len(table) == BYTES else pairs)[:, 2 * k : 2 * k + length]
                found = table.take(at, axis=0)
                total = found if total is None else np.add(total, found, out=total)
            out.append(total)
        return out

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        logits = pooled @ self.dense + self.bias
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        return logits / logits.sum(1, keepdims=True)

    def scores(self, windows: np.ndarray, tables: list[list[np.ndarray]] | None = None) -> np.ndarray:
        tables = tables or self._tables()
        out = []
        for k in range(0, len(windows), CHUNK):
            responses = self._responses(windows[k : k + CHUNK], tables)
            pooled = np.concatenate([np.maximum(r.max(1) + b, 0) for r, b in zip(responses, self.offsets, strict=True)], axis=1)
            out.append(self._softmax(pooled))
        return np.concatenate(out)

    def fit(self, windows: np.ndarray, labels: np.ndarray) -> ByteCNN:
        rng = np.random.default_rng(SEED)
        params = [self.embedding, self.dense, self.bias, *self.filters, *self.offsets]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for k in range(0, len(order), BATCH):
                step += 1
                gradients = self._gradients(windows[order[k : k + BATCH]], labels[order[k : k + BATCH]])
                for p, g, m, v in zip(params, gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        responses = self._responses(windows, self._tables())
        best = [r.argmax(1) for r in responses]
        raw = [np.take_along_axis(r, b[:, None], 1)[:, 0] + o for r, b, o in zip(responses, best, self.offsets, strict=True)]
        pooled = np.maximum(np.concatenate(raw, axis=1), 0)
        delta = self._softmax(pooled)
        delta[np.arange(len(labels)), labels] -= 1
        delta /= len(labels)
        back = (delta @ self.dense.T) * (pooled > 0)
        d_embedding, d_filters, d_offsets = np.zeros_like(self.embedding), [], []
        for i, (width, filters) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            d = np.zeros_like(filters)
            for k in range(width):  # only the pooled places carry a gradient
                codes = np.take_along_axis(windows, best[i] + k, 1)
                d[k] = np.einsum("bfe,bf->ef", self.embedding[codes], own)
                np.add.at(d_embedding, codes, own[:, :, None] * filters[k].T[None])
            d_filters.append(d)
            d_offsets.append(own.sum(0))
        return [d_embedding, pooled.T @ delta, delta.sum(0), *d_filters, *d_offsets]


def remainder(id_col: str, modulus: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteCNN | None:
    """Learn from labelled rows whose id's checksum is not held out; None without any.

    At most TRAIN_TOTAL x TRAIN_WINDOWS windows of WINDOW bytes reach the driver. A language's
    documents are those of the least hashes of id and text, whatever the partitions; of more
    than TRAIN_TOTAL languages, the largest give one document each."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (remainder(id_col, 4) != 2))
    sizes = labelled.groupBy(F.col(lang_col).alias("l")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(TRAIN_TOTAL).collect()
    if not sizes:
        return None
    spark, wanted, span = docs.sparkSession, min(TRAIN_ROWS, TRAIN_TOTAL // len(sizes)), 1 << 40
    # Twice as many as wanted are drawn by hash, 40 more at least, or all, before they are ranked: of so
    # many expected, none at all or too few come with a chance below 1e-12.
    draws = max(2 * wanted, wanted + 40)
    shares = spark.createDataFrame([(r["l"], span if r["n"] <= 10 * draws else int(span * draws / r["n"])) for r in sizes], "l string, share long")
    order = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(SEED))
    drawn = labelled.select(F.col(lang_col).alias("l"), F.col(text_col).alias("text"), order.alias("order")).join(F.broadcast(shares), "l").where(F.pmod("order", F.lit(span)) < F.col("share"))
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("l").orderBy("order")))
    sample = ranked.where(F.col("rank") <= wanted).select("l", "text")

    def make() -> Callable:
        def work(texts: pa.Array) -> list:
            out = []
            for text in texts_of(texts):
                found = windows_of(text)
                picked = np.unique(np.linspace(0, len(found) - 1, TRAIN_WINDOWS).astype(int))
                out.append(found[picked].tobytes())
            return [out]

        return work

    cut = map_text(sample, make, [F.col("text")], [("windows", T.BinaryType())], keep=[F.col("l")])
    rows = sorted((r["l"], bytes(r["windows"])) for r in cut.collect())
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    cuts = [np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for _, w in rows]
    labels = np.repeat([languages.index(lang) for lang, _ in rows], [len(c) for c in cuts])
    return ByteCNN(languages).fit(np.concatenate(cuts), labels)


def _make(model: ByteCNN | None) -> Callable[[], Callable]:
    def make() -> Callable:
        tables = model._tables() if model else None

        def work(texts: pa.Array) -> list:
            given = texts_of(texts)
            if not model:
                return [[UNKNOWN] * len(given), [0.0] * len(given)]
            cuts = [windows_of(x) for x in given]
            ends = np.cumsum([len(c) for c in cuts])
            windows = np.concatenate(cuts)
            weight = (windows != 0).sum(1) + 1e-3
            by_window = model.scores(windows, tables) * weight[:, None]
            starts = np.concatenate([[0], ends[:-1]])
            total = np.add.reduceat(by_window, starts, axis=0) / np.add.reduceat(weight, starts)[:, None]
            best = total.argmax(1)
            langs, scores = [], []
            for i, text in enumerate(given):
                known = _LETTER.search(text) is not None
                langs.append(model.languages[best[i]] if known else UNKNOWN)
                scores.append(min(1.0, float(total[i, best[i]])) if known else 0.0)
            return [langs, scores]

        return work

    return make


FIELDS = [("lang_pred", T.StringType()), ("score", T.DoubleType())]


def identify(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    held_out = F.coalesce(remainder(id_col, 4) == 2, F.lit(False)).alias("held_out")
    return map_text(docs, _make(model), [F.col(text_col)], FIELDS, keep=[F.col(id_col), held_out])


def filter_documents(docs: DataFrame, model: ByteCNN | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents in a known language with at least that score, all columns as they were."""

    def known(field: Callable[[str], Column]) -> Column:
        return (field("lang_pred") != UNKNOWN) & (field("score") >= least)

    return with_row(docs, _make(model), [F.col(text_col)], FIELDS, known)
