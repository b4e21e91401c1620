"""Shards of nearly equal size, by the smallest feasible capacity over an ordered row of groups.

Rows of equal text are a group, which no cut divides. The groups lie in the order of their text's hash, after the few that
are large beside a shard. A capacity is
feasible if cutting greedily, each shard as long as it fits, needs no more shards than given; the smallest feasible one
is found by binary search, and the cuts are made there. Where one large group decides the capacity, the other shards share
the rest as equally as it allows.

The driver never holds the groups. It works on a bounded number of cells, intervals of the hash: taking cells as
infinitely divisible gives a lower bound of the capacity and of each cut, taking them as whole an upper bound. Only the
cells where a cut may lie are divided further, by one aggregation of the stored sizes, until the cells there are single
groups. Then both bounds are the exact minimum. Two texts of the same 64-bit hash are one group.

Rows are numbered within a shard by buckets of their ids, so neither a shard nor a large group goes through one task.
A null text is sized and grouped like an empty one. Null ids and repeated rows are numbered like any others, in some
order. Extra columns aren't read. An empty table gives an empty result; empty shards are possible with few groups.
"""

from __future__ import annotations

import bisect
import itertools
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.shared import needed, stored

OVERHEAD = 8
FIRST_BITS = 14
CELLS = 1 << 17
MOST_LARGE = 2048
BUCKET_ROWS = 50_000
MOST_BUCKETS = 100_000


class Cell(NamedTuple):
    """Groups with ``low <= hash < high``."""

    low: int
    high: int
    size: int
    single: bool


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per document."""
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.coalesce("text", F.lit(""))
    rows = needed(docs, {"doc_id": "long", "text": "string"}).select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("place")
    )
    rows = large_first(stored(rows, "sizes"), shards)
    shard = _after(F.col("place"), cuts(rows, shards))
    law = F.lit("bytes").alias("law")
    return _numbered(rows.withColumn("shard", shard)).select("doc_id", "size", "text_crc32", law, "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def large_first(rows: DataFrame, shards: int) -> DataFrame:
    """Move groups that fill a good part of a shard to the front, by falling size, so that the others share evenly.

    Only ``MOST_LARGE`` groups can be that large, which bounds the collected and broadcast rows. All others keep the order
    of their hash, of which 63 bits are left.
    """
    least = rows.agg(F.sum("size")).first()[0]
    least = (least or 0) / (shards * max(1, MOST_LARGE // shards))
    sums = rows.groupBy("place").agg(F.sum("size").alias("total")).filter(F.col("total") > least)
    found = sorted((-r["total"], r["place"]) for r in sums.collect()) if shards <= MOST_LARGE else []
    width = 1 << (64 - FIRST_BITS)
    front = rows.sparkSession.createDataFrame([(place, -(1 << 63) + i * width) for i, (_, place) in enumerate(found)], "large long, front long")
    joined = rows.join(F.broadcast(front), rows["place"] == front["large"], "left")
    return joined.withColumn("place", F.coalesce("front", F.shiftright("place", 1))).drop("large", "front")


def cuts(rows: DataFrame, shards: int) -> list[int]:
    """The hashes at which shards 1, 2, ... begin; fewer than ``shards - 1`` if that many aren't needed."""
    cells = _cells(rows, F.shiftright("place", 64 - FIRST_BITS), 64 - FIRST_BITS)
    while cells:
        low = _smallest(cells, shards, divisible=True)
        high = _smallest(cells, shards, divisible=False)
        open_cells = _undecided(cells, low, high, shards)
        if not open_cells:
            return _balanced(cells, high, shards)
        cells = _divided(rows, cells, open_cells)
    return []


def _cells(rows: DataFrame, cell: Column, bits: int) -> list[Cell]:
    """Sums of bounded many cells, of ``2**bits`` hashes each, that partial sums make small before the shuffle."""
    sums = rows.groupBy(cell.alias("cell")).agg(F.sum("size").alias("size"), (F.min("place") == F.max("place")).alias("single"))
    return sorted(Cell(r["cell"] << bits, (r["cell"] + 1) << bits, r["size"], r["single"]) for r in sums.collect())


def _divided(rows: DataFrame, cells: list[Cell], places: list[int]) -> list[Cell]:
    """The cells with those at ``places``, all of one width, cut into equal parts."""
    width = (cells[places[0]].high - cells[places[0]].low).bit_length() - 1
    widest = [i for i in places if (cells[i].high - cells[i].low).bit_length() - 1 == width]
    more = max(1, (CELLS // len(widest)).bit_length() - 1)
    bits = max(0, width - more)
    wanted = rows.sparkSession.createDataFrame([(cells[i].low >> width,) for i in widest], "wide long")
    inside = rows.join(F.broadcast(wanted), F.shiftright("place", width) == F.col("wide"), "left_semi")
    parts = _cells(inside, F.shiftright("place", bits), bits)
    gone = set(widest)
    return sorted([c for i, c in enumerate(cells) if i not in gone] + parts)


def _greedy(cells: list[Cell], capacity: int, most: int, divisible: bool = False) -> tuple[list[int], bool]:
    """Where greedy shards of a capacity begin, and whether ``most`` of them are enough."""
    begins, room = [], capacity
    for cell in cells:
        size = cell.size
        if size <= room:
            room -= size
            continue
        if divisible and not cell.single:
            size -= room
            shards, rest = divmod(size, capacity) if capacity else (most, 0)
            shards += rest > 0
            if len(begins) + shards >= most:
                return begins, False
            begins += [cell.high] * shards
            room = shards * capacity - size
        else:
            if size > capacity or len(begins) + 1 >= most:
                return begins, False
            begins.append(cell.low)
            room = capacity - size
    return begins, True


def _smallest(cells: list[Cell], shards: int, divisible: bool) -> int:
    low, high = 0, sum(c.size for c in cells)
    while low < high:
        middle = (low + high) // 2
        if _greedy(cells, middle, shards, divisible)[1]:
            high = middle
        else:
            low = middle + 1
    return low


def _balanced(cells: list[Cell], capacity: int, shards: int) -> list[int]:
    """Cuts within the capacity, each as near as the rest allows to an equal share of what is left.

    The rest always fits into the shards left: it did before, and a later cut only leaves less.
    """
    upto = [0, *itertools.accumulate(c.size for c in cells)]

    def fits(at: int, left: int) -> bool:
        for _ in range(left):
            if at == len(cells):
                return True
            at = max(at, bisect.bisect_right(upto, upto[at] + capacity) - 1)
        return at == len(cells)

    begins, at = [], 0
    for left in range(shards - 1, 0, -1):
        if at == len(cells):
            break
        last = bisect.bisect_right(upto, upto[at] + capacity) - 1
        share = upto[at] + (upto[-1] - upto[at]) / (left + 1)
        near = max(at + 1, bisect.bisect_left(upto, share))
        if near > at + 1 and share - upto[near - 1] < upto[near] - share:
            near -= 1
        near = min(near, last)
        at = bisect.bisect_left(range(near, last), True, key=lambda i: fits(i, left)) + near
        if at < len(cells):
            begins.append(cells[at].low)
    return begins


def _undecided(cells: list[Cell], low: int, high: int, shards: int) -> list[int]:
    """Divisible cells in which some greedy cut may lie for a capacity from ``low`` to ``high``.

    The k-th shard begins no earlier than with the lower capacity and whole cells left out when they don't fit, and no
    later than with the higher capacity and every cell divisible.
    """
    before = [0]
    for cell in cells:
        before.append(before[-1] + cell.size)
    found: set[int] = set()
    first = last = 0
    start = end = 0  # sizes before the earliest and the latest place of the cut
    for _ in range(shards - 1):
        start, end = start + low, end + high
        while first < len(cells) and before[first + 1] <= start:
            first += 1
        while last < len(cells) and before[last + 1] <= end:
            last += 1
        found.update(i for i in range(first, min(last + 1, len(cells))) if not cells[i].single and cells[i].high - cells[i].low > 1)
        start = before[first] if first < len(cells) else before[-1]
        if end >= before[-1] and start >= before[-1]:
            break
    if low == high and _greedy(cells, high, shards)[1] and not found:
        return []
    return sorted(found)


def _after(place: Column, begins: list[int]) -> Column:
    """Number of cuts at or before a hash."""
    bounded = [F.lit(b) for b in begins if b < 1 << 63]
    total = F.lit(0)
    for begin in bounded:
        total = total + (place >= begin).cast("int")
    return total


def _numbered(rows: DataFrame) -> DataFrame:
    """Gapless ``slot`` from 0 in every shard: numbers within a bucket of ids, after those of the buckets before it."""
    per_shard = rows.groupBy("shard").agg(F.count("*").alias("n")).collect()  # one row per shard
    largest = max((r["n"] for r in per_shard), default=0)
    buckets = max(1, min(largest // BUCKET_ROWS + 1, MOST_BUCKETS // max(1, len(per_shard))))
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "place"), F.lit(buckets)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = F.broadcast(counts.select("shard", "bucket", (F.sum("n").over(upto) - F.col("n")).alias("before")))  # MOST_BUCKETS rows at most
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "place")
    return placed.withColumn("at", F.row_number().over(order)).join(offsets, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("at") - 1)
