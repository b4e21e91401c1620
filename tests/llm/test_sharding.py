import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from smelter.llm import sharding
from smelter.llm.sharding import cuts, shard_documents


def smallest_capacity(sizes, shards):
    def fits(capacity):
        n, room = 1, capacity
        for size in sizes:
            if size > capacity:
                return False
            if size > room:
                n, room = n + 1, capacity
            room -= size
        return n <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def group_sizes(rows):
    sums = defaultdict(int)
    for r in rows.collect():
        sums[r["place"]] += r["size"]
    return [sums[p] for p in sorted(sums)]


@pytest.mark.parametrize("shards", [1, 3, 7, 24])
def test_shards_are_contiguous_complete_and_of_the_smallest_capacity(docs, corpus, clashing, shards):
    rows = shard_documents(clashing(docs), shards).collect()
    assert sorted(r["text_crc32"] for r in rows) == sorted(zlib.crc32((t or "").encode()) for _, t, *_ in corpus)
    sums, slots, groups = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in groups.values())
    placed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("place"), (F.octet_length(F.coalesce("text", F.lit(""))) + 8).alias("size"))
    assert max(sums.values()) == smallest_capacity(group_sizes(sharding.large_first(placed, shards)), shards)


@pytest.mark.parametrize("seed", range(4))
def test_cells_are_divided_until_the_cuts_are_exact(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "FIRST_BITS", 3)
    monkeypatch.setattr(sharding, "CELLS", 16)
    draw = random.Random(seed)
    sizes = {draw.randrange(-(2**63), 2**63) >> draw.choice([0, 0, 40]): draw.choice([1, 5, 100, 3000]) for _ in range(400)}
    rows = spark.createDataFrame(list(sizes.items()), "place LONG, size LONG")
    begins = cuts(rows, 6)
    assert begins == sorted(begins) and len(begins) <= 5
    sums = defaultdict(int)
    for place, size in sizes.items():
        sums[sum(place >= b for b in begins)] += size
    assert max(sums.values()) == smallest_capacity([sizes[p] for p in sorted(sizes)], 6)


def test_one_large_group_leaves_the_others_even(spark):
    rows = [(i, f"text {i}" * 5) for i in range(600)] + [(1000 + i, "copied" * 10) for i in range(300)]
    found = shard_documents(spark.createDataFrame(rows, "doc_id LONG, text STRING"), 6).groupBy("shard").agg(F.sum("size").alias("s"), F.min("text_crc32").alias("c")).collect()
    others = sorted(r["s"] for r in found)[:-1]
    assert len(found) == 6 and others[-1] < 1.5 * others[0]


def test_an_empty_table_has_no_shards(no_docs):
    assert shard_documents(no_docs).collect() == []
