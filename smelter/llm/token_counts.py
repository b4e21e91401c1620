"""Token counts of texts at every prefix, by dynamic programming over the pieces that are tokenized independently.

The count at the end of a piece is the count at the end of the piece before it, plus the piece's own. The table of a
document holds the byte place and the count for every piece's end, so that length, truncation and budget questions are
answered from it without encoding the text again. A piece of more than ``LONGEST_REMEMBERED`` bytes, as texts without white
space are, has an entry at the ends of its tokens too. Counts are those of the library for the text cut at that place.

Null texts are empty: no bytes, no tokens, empty table. Ids and repeated rows pass through, extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.shared import map_batches, needed
from smelter.llm.tokens import LONGEST_REMEMBERED, is_byte_level, memory, token_ends, units
from smelter.llm.words import text_bytes

ROWS = 500


def prefix_table(text: bytes, tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the pieces, and of the tokens in long ones, in bytes, and the token count of the text up to each."""
    pieces, known = units(text), memory(tokenizer, "count", len)
    sizes, counts = np.fromiter(map(len, pieces), np.int64, len(pieces)), np.fromiter(known.of(pieces), np.int64, len(pieces))
    ends, totals = np.cumsum(sizes), np.cumsum(counts)
    long = np.flatnonzero(sizes > LONGEST_REMEMBERED)
    if not len(long) or not is_byte_level(tokenizer):
        return ends, totals
    table, done = [], 0
    for i in long:
        places, n = token_ends(pieces[i], known.tokenizer, int(counts[i]))
        table += [(ends[done:i], totals[done:i]), (ends[i] - sizes[i] + places, totals[i] - counts[i] + n)]
        done = i + 1
    table.append((ends[done:], totals[done:]))
    return np.concatenate([x for x, _ in table]), np.concatenate([x for _, x in table])


def tokens_up_to(text: bytes, place: int, table: tuple[np.ndarray, np.ndarray], tokenizer: str) -> int:
    """Token count of ``text[:place]``: looked up, or if the table hasn't the place, with the piece that it cuts encoded."""
    ends, counts = table
    at = int(np.searchsorted(ends, place, "right"))
    start, before = (int(ends[at - 1]), int(counts[at - 1])) if at else (0, 0)
    if start < place and at < len(ends):  # the entry before may lie inside the piece
        start = max(x for x in np.cumsum([0, *map(len, units(text))]).tolist() if x <= place)
        before = int(counts[np.searchsorted(ends, start)]) if start else 0
    return before + (sum(memory(tokenizer, "count", len).of([text[start:place]])) if place > start else 0)


def token_prefixes(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """``doc_id, n_bytes, ends, counts`` per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, ROWS):
                part = batch.slice(row, ROWS)
                raw, offsets = text_bytes(part.column("text"))
                data = raw.tobytes()
                tables = [prefix_table(data[a:b], tokenizer) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                places = np.concatenate(([0], np.cumsum([len(x) for x, _ in tables]))).astype(np.int32)
                ends, counts = (pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate([t[i] for t in tables]), pa.int64())) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), ends, counts], names=["doc_id", "n_bytes", "ends", "counts"])

    docs = needed(docs, {"doc_id": "long", "text": "string"})
    return map_batches(docs, run, "doc_id long, n_bytes long, ends array<long>, counts array<long>")


def whole(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.try_element_at(counts, F.lit(-1)), F.lit(0).cast("long"))


def bytes_within(ends: Column, counts: Column, budget: int) -> Column:
    """Length in bytes of the longest run of whole entries, from the start, with at most ``budget`` tokens."""
    return F.coalesce(F.try_element_at(ends, F.nullif(F.size(F.filter(counts, lambda c: c <= budget)), F.lit(0))), F.lit(0).cast("long"))


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` and the bytes that fit into the limit."""
    table = token_prefixes(docs, tokenizer)
    n = whole(F.col("counts"))
    return table.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"), bytes_within(F.col("ends"), F.col("counts"), limit).alias("bytes_in_limit"))
