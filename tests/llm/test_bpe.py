"""Against the tokenizer library, and the round trip."""

import base64
import hashlib
import random
import sys

import public_tokenizers
import pytest
import tiktoken

from kinloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(seed):
    chance = random.Random(seed)
    bits = ["the", "Ünï", " ", "  ", "\n", "\n\n", " \n", "\t", "123", "'s", "don't", "日本", " ", "!?", "\U0001f600", "<|endoftext|>", "\x00", " ", "é", "\r\n", "zzqx"]
    return "".join(chance.choice(bits) for _ in range(chance.randrange(0, 50)))


def test_ids_are_the_librarys(documents, edge_rows, library):
    rows = edge_rows + [(100 + i, noise(i)) for i in range(500)] + [(900, "ab" * 4000), (901, "é" * 700), (902, "".join(chr(97 + i * i % 23) for i in range(60_000)))]
    got = bpe.encode_decode(documents(rows), PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        ids = library.encode_ordinary(text or "")
        row = by_id[doc_id]
        assert row["ids"] == ",".join(map(str, ids)), repr(text)[:200]
        assert row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == (text or "").encode()


def test_digests_and_empty_table(documents, library):
    row = bpe.encode_decode(documents([(1, "hello world")]), PATH, public_tokenizers.PATTERN, digests=True).first()
    ids = ",".join(map(str, library.encode_ordinary("hello world")))
    assert row["ids_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(b"hello world").hexdigest()
    assert bpe.encode_decode(documents([]), PATH, public_tokenizers.PATTERN, digests=True).collect() == []


def long_pieces():
    chance = random.Random(5)
    letters = ["abcdet", "aab", "eéö", "日本語の", "the and ing er".replace(" ", ""), "ACGT"]
    yield from ("".join(chance.choice(own) for _ in range(chance.randrange(40, 1500))) for own in letters for _ in range(12))
    yield from ("a" * 3001, "ab" * 2000 + "c", "=" * 1999, "é" * 700, "x" + "a" * 517, "-_" * 700, "日" * 999)


@pytest.mark.parametrize("block", [16, 48, 128])
def test_joined_blocks_are_one_piece(library, monkeypatch, block):
    """Small blocks share no token with their neighbours now and then, and are widened."""
    monkeypatch.setattr(bpe, "BLOCK", block)
    encoder = bpe.DuckBpe(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    pieces = {p for text in long_pieces() for p in encoder.pattern.findall(text[: 60 * block])}
    assert any(len(p.encode()) > 3 * block for p in pieces)
    encoder._learn(pieces)
    for piece in pieces:
        ids, decoded = encoder.pieces[piece]
        assert ids == ",".join(map(str, library.encode_ordinary(piece))), piece[:80]
        assert decoded == piece.encode()


def test_batches_bound_the_rows_of_a_query():
    raw = [b"x" * n for n in (128,) * 600 + (3,) * 50_000]
    parts = list(bpe.batches(raw))
    assert [x for part in parts for x in part] == raw
    assert all(len(p) <= bpe.CHUNK and sum(len(x) ** 2 for x in p) <= bpe.ROWS for p in parts)


def test_the_cache_counts_bytes(library, monkeypatch):
    """Clauses without spaces are long: the bound holds whatever the length of an entry."""
    monkeypatch.setattr(bpe, "CACHE_BYTES", 200_000)
    encoder = bpe.DuckBpe(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    chance = random.Random(7)
    for _ in range(12):
        texts = ["".join(chr(chance.randrange(0x4E00, 0x9FA5)) for _ in range(n)) + " é" for n in (3, 90, 400) * 8]
        for text, (ids, n, decoded) in zip(texts, encoder.encode(texts), strict=True):
            assert list(map(int, ids.split(","))) == library.encode_ordinary(text) and n == ids.count(",") + 1
            assert decoded == text.encode()
        really = sum(sys.getsizeof(x) for p, own in encoder.pieces.items() for x in (p, *own))
        assert really / 2 < encoder.held < 200_000 + 300_000
        assert not encoder.blocks
