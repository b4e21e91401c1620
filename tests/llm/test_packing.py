import random
import zlib

import numpy as np
import pytest

from smelter.llm.packing import differenced, pack, windows_of
from smelter.llm.tokens import load, memory, plain_encoder

TOKENIZER = "word_bpe_49k.json"


def test_pieces_hold_every_token_once_and_windows_keep_the_capacity(docs, corpus, clashing):
    library = load(TOKENIZER)
    rows = pack(clashing(docs), capacity=256, piece=64, windows=8).collect()
    expected = sorted((i is None, i or 0, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, *_ in corpus)
    ids = {}
    for none, i, tokens in expected:
        ids.setdefault(None if none else i, []).append(tokens)
    assert sum(r["length"] for r in rows) == sum(len(x[2]) for x in expected)
    for r in rows:
        pieces = [t[r["start"] : r["start"] + r["length"]] for t in ids[r["doc_id"]] if len(t) == r["doc_tokens"]]
        assert r["ids_crc32"] in [zlib.crc32(np.array(p, dtype="<u4").tobytes()) for p in pieces]
    by_window = {}
    for r in rows:
        by_window.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for window in by_window.values():
        at = 0
        for offset, length in sorted(window):
            assert offset == at
            at += length
        assert at <= 256


def test_an_empty_table_has_no_pieces(no_docs):
    assert pack(no_docs).collect() == []


@pytest.mark.parametrize("n", [1, 2, 9, 300])
def test_differencing_places_every_piece_once_in_near_equal_windows(n):
    draw = random.Random(n)
    sizes = [draw.choice([512, draw.randint(1, 512)]) for _ in range(n)]
    windows = windows_of(sizes)
    assert sorted(i for w in windows for i in w) == list(range(n))
    assert max(sum(sizes[i] for i in w) for w in windows) <= 2048
    assert len(windows) <= -(-sum(sizes) // 2048) * 1.02 + 1


def test_differencing_reaches_the_known_result():
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in differenced([8, 7, 6, 5, 4], 2)) == [14, 16]
    assert differenced([], 3) == []


def test_windows_rise_when_pieces_do_not_fit():
    assert len(windows_of([600, 600, 600], capacity=1000)) == 3


PIECES = ["the", "Thonre.", "don't", "l'été", "ÉTÉ", "x2y", "a--b", "'s", "''re", "ß", "<|endoftext|>", "日本", "İB", "a" * 300, "\x01", "é", "ﬁ", "²", "µ", "🙂"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_fast_merging_gives_the_library_s_ids(name):
    library, found = load(name), memory(name, "test", tuple).of([x.encode() for x in PIECES])
    assert [list(x) for x in found] == [library.encode(x, add_special_tokens=False).ids for x in PIECES]
    assert plain_encoder(name) is not None
