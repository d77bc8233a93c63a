import random
import zlib

import pytest

from posttags.llm import sharding
from tests.llm.conftest import table


def greedy(sizes, capacity):
    shards, filled = 1, 0
    for size in sizes:
        if size > capacity:
            return 10**9
        if filled + size > capacity:
            shards, filled = shards + 1, 0
        filled += size
    return shards


def smallest(sizes, shards):
    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if greedy(sizes, middle) <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("hold, width", [(100_000, 64), (0, 3), (0, 64), (20, 5)])
def test_smallest_capacity_equals_plain_search(spark, hold, width):
    rnd = random.Random(hold + width)
    sizes = [rnd.choice([1, 2, 5, 30, 400]) * rnd.randint(1, 9) for _ in range(150)]
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    frame = spark.createDataFrame([(e,) for e in ends], "end_bytes bigint")
    got, cuts = sharding.smallest_capacity(frame, ends[-1], max(sizes), 7, hold, width)
    assert got == smallest(sizes, 7)
    edges = [0, *cuts, ends[-1]]
    assert len(edges) <= 8 and all(b - a <= got for a, b in zip(edges, edges[1:]))


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards(spark, messy, shards):
    rows = [*messy, *((30_000 + i, "hot text") for i in range(2000))]
    got = sharding.shard_by_bytes(table(spark, rows), shards).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((i or -1) for i, _ in rows)
    texts = {i: t for i, t in rows if i is not None}
    where, slots, filled = {}, {}, {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        if r.doc_id is not None:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
            where.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
        filled[r.shard] = filled.get(r.shard, 0) + r.size
    assert all(len(found) == 1 for found in where.values())
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    total, groups = sum(filled.values()), {}
    for i, t in rows:
        groups[t or ""] = groups.get(t or "", 0) + len((t or "").encode()) + 1
    largest = max(groups.values())
    assert max(filled.values()) <= max(largest, total / shards + sorted(groups.values())[-2])


def test_empty_table(spark):
    assert sharding.shard_by_bytes(table(spark, []), 16).collect() == []


def test_peel_takes_what_exceeds_a_fair_share():
    assert sharding.peel([50, 30, 5], 100, 4) == 2
    assert sharding.peel([10, 10], 100, 4) == 0
    assert sharding.peel([100], 100, 1) == 0
