"""Packing of tokenized documents into windows of a fixed capacity.

A document is cut into full windows, which are done, and a rest in pieces of at most ``PIECE`` tokens. The pieces of about
``WINDOWS`` windows are then dealt out by multiway differencing: every piece starts as a partial partition of its own;
the two partitions with the largest differences between their windows are merged, the fullest window of one with the
emptiest of the other, until one is left. Its windows are nearly equal. If one exceeds the capacity, the window count
rises by one and the pieces are dealt out anew, so no token is lost.

Every partition is packed on its own, in the order read, and holds one group of pieces in memory at a time. A null text
has only the end token. Rows with equal or null ids are packed like any others. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from smelter.llm.shared import map_batches, needed
from smelter.llm.tokens import memory
from smelter.llm.words import text_bytes

CAPACITY = 2048
PIECE = 512
WINDOWS = 256
END = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differenced(sizes: list[int], windows: int) -> list[list[int]]:
    """Places of ``sizes`` dealt out into ``windows`` lists with near-equal sums."""
    left, right = [], []  # children of the inner nodes; node i + 1 is the piece i
    n = len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(windows, np.int64), np.zeros(windows, np.int64)
        sums[0], nodes[0] = size, i + 1
        heap.append((-size if windows > 1 else 0, i, sums, nodes))  # sums fall
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, more, others = heapq.heappop(heap)
        sums, others = sums + more[::-1], others[::-1]
        both = np.flatnonzero((nodes > 0) & (others > 0))
        merged = np.maximum(nodes, others)
        left.extend(nodes[both].tolist())
        right.extend(others[both].tolist())
        merged[both] = n + 1 + np.arange(len(left) - len(both), len(left))
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums - sums[-1], merged[order]))
        made += 1
    result: list[list[int]] = []
    for top in heap[0][3].tolist() if heap else []:
        members, open_nodes = [], [top] if top else []
        while open_nodes:
            node = open_nodes.pop()
            if node > n:
                open_nodes += (right[node - n - 1], left[node - n - 1])
            else:
                members.append(node - 1)
        result.append(members)
    return result


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows, no larger than the capacity; as few as differencing reaches it with."""
    count = -(-sum(sizes) // capacity)
    while True:
        dealt = differenced(sizes, count)
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return [w for w in dealt if w]
        count += 1


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, piece: int = PIECE, windows: int = WINDOWS) -> DataFrame:
    """One row per piece: where it comes from, what it holds, and where it lies."""
    if not 0 < piece <= capacity or windows < 1:
        raise ValueError("a piece has at least one token and at most the capacity; a group at least one window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = memory(tokenizer, "ids", lambda ids: array("I", ids).tobytes()).of
        end = np.array([END], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        rest: list[tuple] = []
        waiting = 0

        def dealt() -> None:
            nonlocal sequence
            for window in windows_of([x[2] for x in rest], capacity):
                offset = 0
                for i in window:
                    rows.append((*rest[i], sequence, offset))
                    offset += rest[i][2]
                sequence += 1

        def written() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                ids = b"".join(ids_of(raw[a:b].tobytes().split())) + end
                n, start = len(ids) // 4, 0
                while start < n:
                    length = capacity if n - start >= capacity else min(piece, n - start)
                    row = (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n)
                    if length == capacity:
                        rows.append((*row, sequence, 0))
                        sequence += 1
                    else:
                        rest.append(row)
                        waiting += length
                    start += length
                if waiting >= windows * capacity:
                    dealt()
                    rest, waiting = [], 0
                if len(rows) > 20_000:
                    yield written()
        if rest:
            dealt()
        if rows:
            yield written()

    return map_batches(needed(docs, {"doc_id": "long", "text": "string"}), run, SCHEMA)
