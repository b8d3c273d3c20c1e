"""Byte-level BPE by recursive DuckDB queries inside each partition.

A partition's texts are cut by the pattern; the distinct pieces that are no token
themselves become token-position rows in DuckDB. Each step of a recursive query joins the
rows with the merge table and contracts every piece's leftmost pair of least rank,
until no pair is left; ordered aggregation then gives each piece's ids and decodes them.
Texts are put together from their pieces.

A contraction takes a step of the query, so a piece of more than BLOCK bytes is cut into
overlapping blocks, which are contracted side by side and joined at a token that both
neighbours show at the same place. That is exact: a token sequence is the encoding of its
bytes if and only if each two neighbours in it are the encoding of theirs (until a merge
crosses a boundary, the tokens on both sides see the same merges as they would alone), and
each two neighbours of the joined sequence stand in one block. Where two blocks
have no token in common, the later one is widened to the left.

Defined cases: null or empty text has no ids (n_tokens 0, hashes of nothing); an
empty table gives an empty result; repeated rows are encoded alike.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.llm.arrow_map import map_text, texts_of

#: Longest block of a piece, in bytes; each begins in the middle of the one before.
BLOCK = 48
#: Pieces in one recursive query, and its rows over all steps (a step keeps a row for each token).
CHUNK, ROWS = 20_000, 4_000_000
#: Bytes of pieces and runs, with what is known of them, that a worker keeps from slice to slice.
CACHE_BYTES = 384 << 20
#: What an entry takes besides its texts.
ENTRY_BYTES = 160

# One row for each token: its place, the next row's place and token. A step finds each live
# piece's best pair (rank, place, next place packed in one number, so the minimum is the
# leftmost of least rank), widens the row there and drops the row after it. Pieces
# without a pair leave the recursion with live = false.
_CONTRACT = """
WITH RECURSIVE state(piece, pos, after, tok, nxt, live) AS (
  SELECT piece, pos, after, tok, nxt, true FROM starts
  UNION ALL
  (WITH best AS MATERIALIZED (
     SELECT piece, min((m.rank::BIGINT << 44) | (s.pos::BIGINT << 22) | s.after) AS cut
     FROM state s JOIN merges m ON m.pair = (s.tok::BIGINT << 32) | s.nxt
     WHERE s.live GROUP BY piece),
   dropped AS (
     SELECT s.piece, s.after, s.nxt FROM state s JOIN best b ON b.piece = s.piece AND s.pos = b.cut & 4194303
     WHERE s.live)
   SELECT s.piece, s.pos,
     CASE WHEN s.pos = (b.cut >> 22) & 4194303 THEN d.after ELSE s.after END,
     CASE WHEN s.pos = (b.cut >> 22) & 4194303 THEN (b.cut >> 44)::INTEGER ELSE s.tok END,
     CASE WHEN s.pos = (b.cut >> 22) & 4194303 THEN d.nxt WHEN s.after = (b.cut >> 22) & 4194303 THEN (b.cut >> 44)::INTEGER ELSE s.nxt END,
     b.cut IS NOT NULL
   FROM state s LEFT JOIN best b ON b.piece = s.piece LEFT JOIN dropped d ON d.piece = s.piece
   WHERE s.live AND (b.cut IS NULL OR s.pos <> b.cut & 4194303))
)
SELECT piece, string_agg(shown, ',' ORDER BY pos) AS tokens
FROM state JOIN vocabulary USING (tok) WHERE NOT live
GROUP BY piece ORDER BY piece
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def batches(raw: list[bytes]) -> Iterator[list[bytes]]:
    """Byte strings for one query each: at most CHUNK, and ROWS rows over all its steps."""
    part: list[bytes] = []
    rows = 0
    for x in raw:
        if part and (len(part) == CHUNK or rows + len(x) ** 2 > ROWS):
            yield part
            part, rows = [], 0
        part.append(x)
        rows += len(x) ** 2
    if part:
        yield part


def grid(raw: bytes) -> list[tuple[int, int]]:
    """The blocks of a long piece, each half over the one before."""
    return [(at, min(at + BLOCK, len(raw))) for at in range(0, len(raw) - BLOCK // 2, BLOCK // 2)]


_ENCODERS: dict[tuple[str, str], DuckBpe] = {}


def worker_encoder(ranks_path: str, pattern: str) -> DuckBpe:
    """The worker process's encoder: later tasks find the pieces of earlier ones."""
    key = (ranks_path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = DuckBpe(load_ranks(ranks_path), pattern)
    return _ENCODERS[key]


class DuckBpe:
    """Encoder of a worker: a DuckDB connection with the merge table, and a cache of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import duckdb
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes_to_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(a << 32 | b, rank) for token, rank in ranks.items() for i in range(1, len(token)) if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        for name, table in (
            ("merges", pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "rank": pa.array([r for _, r in pairs], pa.int32())})),
            ("vocabulary", pa.table({"tok": pa.array(list(self.tokens), pa.int32()), "shown": [f"{rank}:{token.hex()}" for rank, token in self.tokens.items()]})),
        ):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        #: piece -> ids as text and decoded bytes; the same for runs of pieces, see _cut; block -> ids
        self.pieces: dict[str, tuple[str, bytes]] = {}
        self.blocks: dict[bytes, list[int]] = {}
        self.run_ids: dict[str, str] = {}
        self.run_bytes: dict[str, bytes] = {}
        self.odd: set[str] = set()
        self.held = 0

    def _contract(self, raw: list[bytes]) -> Iterator[tuple[list[str], bytes]]:
        """The ids of each byte string and the bytes decoded from them."""
        lengths = np.array([len(x) for x in raw], np.int32)
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        piece = np.repeat(np.arange(len(raw), dtype=np.int32), lengths)
        pos = np.arange(len(piece), dtype=np.int32) - starts[piece]
        tok = self.bytes_to_ids[np.frombuffer(b"".join(raw), np.uint8)]
        last = pos == lengths[piece] - 1
        self.db.register("starts", pa.table({"piece": piece, "pos": pos, "after": pa.array(pos + 1, mask=last), "tok": tok, "nxt": pa.array(np.append(tok[1:], np.int32(0)), mask=last)}))
        found = self.db.sql(_CONTRACT).to_arrow_table()
        self.db.unregister("starts")
        for line in found.column("tokens").to_pylist():
            tokens = [t.partition(":") for t in line.split(",")]
            yield [t[0] for t in tokens], bytes.fromhex("".join([t[2] for t in tokens]))

    def _learn_blocks(self, blocks: set[bytes]) -> None:
        fresh = [block for block in blocks if block not in self.blocks]
        for part in batches(fresh):
            self.blocks.update((block, list(map(int, ids))) for block, (ids, _) in zip(part, self._contract(part), strict=True))

    def _placed(self, raw: bytes, start: int, end: int) -> list[tuple[int, int]]:
        """The tokens of a block and their places in the whole."""
        self._learn_blocks({raw[start:end]})
        out = []
        for tok in self.blocks[raw[start:end]]:
            out.append((start, tok))
            start += len(self.tokens[tok])
        return out

    def _joined_blocks(self, raw: bytes) -> list[int]:
        """The ids of a long piece."""
        out = self._placed(raw, 0, BLOCK)
        for at, end in grid(raw)[1:]:
            start, reach = at, BLOCK
            while True:
                block = self._placed(raw, start, end)
                first = bisect_left(out, (start, -1))
                there = {token: i for i, token in enumerate(out[first:], first + 1)}
                shared = next((i for i, token in enumerate(block) if token in there), None)
                if shared is not None:
                    out[there[block[shared]] :] = block[shared + 1 :]
                    break
                if start == 0:
                    out = block
                    break
                # From a token of the joined part on, and each time twice as far back.
                start = out[bisect_left(out, (end - reach + 1, -1)) - 1][0] if end > reach else 0
                reach *= 2
        return [tok for _, tok in out]

    def _keep(self, piece: str, ids: str, decoded: bytes) -> None:
        self.pieces[piece] = (ids, decoded)
        self.held += ENTRY_BYTES + sys.getsizeof(piece) + len(ids) + len(decoded)

    def _learn(self, pieces: set[str]) -> None:
        rest, long = [], []
        for piece in pieces:
            if piece not in self.pieces:
                raw = piece.encode()
                rank = self.ranks.get(raw)
                if rank is not None:
                    self._keep(piece, str(rank), self.tokens[rank])
                elif len(raw) > BLOCK:
                    long.append(raw)
                else:
                    rest.append(raw)
        for part in batches(rest):
            for raw, (ids, decoded) in zip(part, self._contract(part), strict=True):
                self._keep(raw.decode(), ",".join(ids), decoded)
        self._learn_blocks({raw[start:end] for raw in long for start, end in grid(raw)})
        for raw in long:
            ids = self._joined_blocks(raw)
            self._keep(raw.decode(), ",".join(map(str, ids)), b"".join([self.tokens[i] for i in ids]))
        self.blocks.clear()

    def _cut(self, text: str) -> list[str] | None:
        """The text cut before each space and around each line end. Where white space stands
        alone between other characters the pattern always cuts there, so the pattern can then
        be applied to each run by itself; None where that does not hold."""
        if "\x00" in text or any(x in text for x in ("  ", " \n", "\n ", "\n\n")) or text[:1].isspace() or text[-1:].isspace():
            return None
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def encode(self, texts: list[str]) -> list[tuple[str, int, bytes]]:
        """For each text: its ids joined by commas, their number, and the bytes decoded from them."""
        if self.held > CACHE_BYTES:
            for kept in (self.pieces, self.run_ids, self.run_bytes, self.odd):
                kept.clear()
            self.held = 0
        runs = [self._cut(t) for t in texts]
        fresh = set().union(*[r for r in runs if r]) - self.run_ids.keys() - self.odd
        cuts = {}
        for run in fresh:
            if run == "\n" or run.removeprefix(" ") == run.strip():
                cuts[run] = self.pattern.findall(run)
            else:  # it begins or ends with other white space, which may touch its neighbour's
                self.odd.add(run)
                self.held += ENTRY_BYTES + sys.getsizeof(run)
        whole = {i: self.pattern.findall(t) for i, t in enumerate(texts) if runs[i] is None or (self.odd and not self.odd.isdisjoint(runs[i]))}
        self._learn({p for own in (*cuts.values(), *whole.values()) for p in own})
        for run, own in cuts.items():
            ids, decoded = self.run_ids[run], self.run_bytes[run] = self._join(own)
            self.held += ENTRY_BYTES + sys.getsizeof(run) + len(ids) + len(decoded)
        out = []
        for i, own in enumerate(runs):
            if i in whole:
                ids, decoded = self._join(whole[i])
            else:
                ids, decoded = ",".join(map(self.run_ids.__getitem__, own)), b"".join(map(self.run_bytes.__getitem__, own))
            out.append((ids, ids.count(",") + 1 if ids else 0, decoded))
        return out

    def _join(self, pieces: list[str]) -> tuple[str, bytes]:
        if len(pieces) == 1:
            return self.pieces[pieces[0]]
        known = [self.pieces[p] for p in pieces]
        return ",".join([k[0] for k in known]), b"".join([k[1] for k in known])


FIELDS = [("n_tokens", T.LongType()), ("ids", T.StringType()), ("decoded", T.BinaryType())]
DIGESTS = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Each document's ids (joined by commas) and its bytes decoded from them, or the
    SHA-256 digests of both."""

    def make() -> Callable:
        bpe = worker_encoder(ranks_path, pattern)

        def work(texts: pa.Array) -> list:
            ids, counts, decoded = (list(x) for x in zip(*bpe.encode(texts_of(texts)), strict=True))
            if digests:
                ids = [hashlib.sha256(x.encode()).hexdigest() for x in ids]
                decoded = [hashlib.sha256(x).hexdigest() for x in decoded]
            return [counts, ids, decoded]

        return work

    return map_text(docs, make, [F.col(text_col)], DIGESTS if digests else FIELDS, keep=[F.col(id_col)])
