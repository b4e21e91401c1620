"""Words of whole texts as 64-bit numbers, for a whole Arrow batch at once.

A word is a run of bytes other than blank and 0x09-0x0D. UTF-8 never uses these bytes inside a character, so the bytes
can be scanned without decoding. A word's number hashes its bytes (A-Z lower-cased), eight at a time, each step mixing all
bits of what came before; long words, which are rare, take BLAKE2b. Two words get the same number with a probability of about
2**-64 per pair, and no rule of word structure makes it more likely.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_LONG = 64


def _is_separator() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    table[65:91] += np.uint64(32)
    return table + np.uint64(1)


SEPARATOR = _is_separator()
LOWERED = _lowered()  # each byte in lower case, and one
LOWER_BYTES = (LOWERED - np.uint64(1)).astype(np.uint8)


class Chunk(NamedTuple):
    """Neighbouring texts of a batch: rows ``first_row`` up to ``first_row + len(first_word) - 1``.

    Text ``i`` has the words ``first_word[i]`` up to ``first_word[i + 1]``; ``starts`` and ``ends`` are places in ``data``.
    """

    first_row: int
    first_word: np.ndarray
    numbers: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each begins; a null text is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, places, data = texts.buffers()
    if len(texts) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def scan(texts: pa.Array) -> Iterator[Chunk]:
    """All words of a batch of texts, in chunks of about ``CHUNK_BYTES`` or of one longer text."""
    raw, offsets = text_bytes(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        data, places = raw[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        starts, ends = _spans(data, places)
        yield Chunk(row, np.searchsorted(starts, places), _numbers(data, starts, ends), starts, ends, data)
        row = to


def _spans(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(SEPARATOR[data], out=inside[1:-1])
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[places] = True
    starts = inside[1:-1] & (~inside[:-2] | begins[:-1])
    ends = inside[1:-1] & (~inside[2:] | begins[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


#: The lowest bytes of a little-endian block, by their number.
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    numbers = mix(lengths.astype(np.uint64) * _LENGTH)
    lowered = np.concatenate((LOWER_BYTES[data], np.zeros(8, np.uint8)))
    blocks = np.ndarray((len(data) + 1,), dtype="<u8", buffer=lowered, strides=(1,))  # the eight bytes from each place on
    left = np.flatnonzero(lengths <= _LONG)
    for at in range(0, _LONG, 8):
        left = left[lengths[left] > at]
        if not len(left):
            break
        block = blocks[starts[left] + at] & _FIRST[np.minimum(lengths[left] - at, 8)]
        numbers[left] = mix((numbers[left] ^ block) * _STEP + _LENGTH)
    for i in np.flatnonzero(lengths > _LONG):
        word = lowered[starts[i] : ends[i]]
        numbers[i] = np.frombuffer(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), dtype="<u8")[0]
    return numbers
