"""Files read back are the tokenizer's ids; what is not asked for is not decompressed."""

import io
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from kinloom.llm import token_files
from tests.llm.test_packing import noise

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def frames(folder):
    home = folder.removeprefix("file://") + "/frames"
    return sorted(f"{home}/{n}" for n in os.listdir(home) if n.startswith("part-") and os.path.getsize(f"{home}/{n}"))


def test_round_trip(documents, edge_rows, library, tmp_path):
    rows = edge_rows + [(100 + 3 * i, noise(i)) for i in range(200)]
    folder = f"file://{tmp_path}/files"
    catalog = token_files.write_files(documents(rows).repartition(3), folder, PATH, file_bytes=4000).collect()
    assert len(catalog) == len(frames(folder)) > 5
    found = sorted(token_files.read_files(documents(rows).sparkSession, folder, with_ids=True).collect(), key=lambda r: r["start"])
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert order == sorted(order) and len(found) == len(rows)
    at = 0
    for r in found:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    key = lambda pairs: sorted((i is not None, i or 0, ids) for i, ids in pairs)
    assert key((r["doc_id"], r["ids"]) for r in found) == key((i, library(t)) for i, t in rows)
    assert sum(c["tokens"] for c in catalog) == at and sum(c["documents"] for c in catalog) == len(rows)


def test_files_are_plain_zstandard(documents, library, tmp_path):
    rows = [(i, noise(i)) for i in range(50)]
    folder = f"file://{tmp_path}/files"
    token_files.write_files(documents(rows).coalesce(1), folder, PATH, file_bytes=1 << 30)
    (path,) = frames(folder)
    content = open(path, "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
    assert np.frombuffer(whole, "<u2").tolist() == [x for i, t in rows for x in library(t)]
    own = token_files.FileReader(content)
    assert own.doc_ids == list(range(50)) and own.ids(17).tolist() == library(rows[17][1])


def test_damage_hurts_one_document(documents, library, tmp_path):
    spark = documents([]).sparkSession
    rows = [(i, noise(i) + " some words") for i in range(60)]
    folder = f"file://{tmp_path}/files"
    token_files.write_files(documents(rows).coalesce(1), folder, PATH, file_bytes=1 << 30)
    (path,) = frames(folder)
    content = bytearray(open(path, "rb").read())
    own = token_files.FileReader(bytes(content))
    content[int(own.ends[30]) - 8] ^= 0x55
    os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    open(path, "wb").write(content)
    asked = token_files.read_files(spark, folder, [29, 31, 59, 1000], with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in asked} == {i: library(rows[i][1]) for i in (29, 31, 59)}
    with pytest.raises(Exception, match="document 30"):
        token_files.read_files(spark, folder, [30]).collect()
    with pytest.raises(Exception, match="document 30"):
        token_files.read_files(spark, folder).collect()
    with pytest.raises(ValueError, match="seek table"):
        token_files.FileReader(bytes(content[:-1]))


def test_only_the_files_asked_for_are_opened(documents, edge_rows, tmp_path):
    spark = documents([]).sparkSession
    rows = edge_rows + [(100 + i, noise(i) * 5) for i in range(100)]
    folder = f"file://{tmp_path}/files"
    catalog = token_files.write_files(documents(rows), folder, PATH, file_bytes=3000)
    whole = {(r["doc_id"], r["start"]): r for r in token_files.read_files(spark, folder).collect()}
    asked = token_files.read_files(spark, folder, [150, None])
    opened = {os.path.basename(x["path"]) for x in catalog.collect() if x["has_null"] or (x["first_id"] or 0) <= 150 <= (x["last_id"] or 0)}
    assert {os.path.basename(f) for f in asked.inputFiles() if "/frames/" in f} == opened and len(opened) <= 3 < catalog.count()
    assert {(r["doc_id"], r["start"]): r for r in asked.collect()} == {k: r for k, r in whole.items() if k[0] in (150, None)}
    assert token_files.read_files(spark, folder, [99999]).collect() == []


def test_empty_table(documents, tmp_path):
    folder = f"file://{tmp_path}/files"
    assert token_files.write_files(documents([]), folder, PATH).collect() == []
    assert token_files.read_files(documents([]).sparkSession, folder).collect() == []


def test_word_cache_is_bounded_in_bytes(library, monkeypatch):
    from kinloom.llm import packing

    monkeypatch.setattr(packing, "CACHE_BYTES", 20_000)
    encoder = packing.WordTokenizer(PATH, 2)
    for i in range(40):
        text = " ".join(f"w{i}x{j}" + "漢字" * (j % 50) for j in range(60))
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library(text)
        assert encoder.held <= 20_000
