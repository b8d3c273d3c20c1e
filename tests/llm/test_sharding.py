"""Shards against a plain loop over the order of ids."""

import zlib

import pytest

from kinloom.llm import sharding
from tests.llm.conftest import prose


def brute(rows, shards):
    sized = sorted((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows)
    total, before, slots, out = sum(s for *_, s in sized), 0, {}, []
    for i, crc, size in sized:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i, size, crc, shard, slots[shard]))
        before += size
    return out


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards(documents, edge_rows, shards):
    rows = [r for r in edge_rows if r[0] is not None] + [(100 + i, prose(i, i % 70)) for i in range(300)]
    got = sharding.shard_by_bytes(documents(rows).repartition(5), shards).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got) == sorted(brute(rows, shards))
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}


def test_balance_and_null_ids(documents):
    rows = [(None, prose(i, 20)) for i in range(50)] + [(i, prose(i, 20)) for i in range(950)]
    got = sharding.shard_by_bytes(documents(rows)).collect()
    sizes = [0] * 16
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert len(got) == 1000
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)
    assert {r["shard"] for r in got if r["doc_id"] is None} == {0}


def test_plan_has_no_python(documents):
    plan = sharding.shard_by_bytes(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(documents):
    assert sharding.shard_by_bytes(documents([])).collect() == []
