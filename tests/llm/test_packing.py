"""Pieces put together again are the tokenizer's ids."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def noise(seed):
    chance = random.Random(seed)
    bits = ["the", "Ünï", " ", "  ", "\n", "\t", "123", "'s", "don't", "'LL", "日本", " ", "...", ",.", "!?", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "é", "ẞ", "×", "İ", "ﬁ", "é", "\x00"]
    return "".join(chance.choice(bits) for _ in range(chance.randrange(0, 50)))


def test_encoder_is_the_library(library):
    encoder = packing.WordTokenizer(PATH, 1)
    for text in [noise(i) for i in range(3000)] + ["", "Plain words. And, again", "a" * 3000, ". , .,", "a<|endoftext|>b", "<|startoftext|>", "x <|endoftext|> y"]:
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library(text), repr(text)


def test_pieces(documents, edge_rows, library):
    rows = [r for r in edge_rows if r[0] is not None] + [(100 + i, noise(i)) for i in range(200)] + [(400, "a <|endoftext|> b")]
    pieces = packing.pack(documents(rows).repartition(3), PATH, with_ids=True).collect()
    # Repeated rows have equal ids and texts, so the pieces of one id hold whole copies.
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) > 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append(p)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(sum(n for _, n in own) < 2048 for own in by_sequence.values()) <= 1
    for doc_id, text in rows:
        ids = library(text)
        copies = sum(i == doc_id for i, _ in rows)
        own = sorted(by_doc[doc_id], key=lambda p: (p["sequence_id"], p["offset"]))
        assert [x for p in own for x in p["ids"]] == ids * copies
        assert {p["doc_tokens"] for p in own} == {len(ids)}
        if copies == 1:
            assert [p["start"] for p in own] == np.cumsum([0, *(p["length"] for p in own[:-1])]).tolist()


def test_null_ids_are_packed(documents, edge_rows, library):
    pieces = packing.pack(documents(edge_rows), PATH).where("doc_id IS NULL").collect()
    assert sum(p["length"] for p in pieces) == sum(len(library(t)) for i, t in edge_rows if i is None)


def test_empty_table(documents):
    assert packing.pack(documents([]), PATH).collect() == []
