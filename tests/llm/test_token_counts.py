import random

import pytest

from smelter.llm.token_counts import prefix_table, token_counts, token_prefixes, tokens_up_to
from smelter.llm.tokens import load

NAME = "byte_bpe_50k.json"
TEXTS = ["", " ", "a  b\n\n c's we'll  ", "<|endoftext|> x <|endoftext|>", "x  y  z　", "\x1c a \x1f\x1f b", "É  é ́a", "日本 語 " * 5, "😀😀 '''s ''re", "\tA\x85 b", "the of\r\n\r\n  and"]


def test_counts_are_the_library_s(docs, corpus, clashing):
    library = load(NAME)
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(clashing(docs)).collect())
    expected = []
    for i, t, *_ in corpus:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i is None, i or 0, len((t or "").encode()), n, n > 512))
    assert found == sorted(expected)


@pytest.mark.parametrize("text", TEXTS)
def test_every_prefix_has_the_library_s_count(text):
    library, table = load(NAME), prefix_table(text.encode(), NAME)
    for i in range(len(text) + 1):
        prefix = text[:i]
        assert tokens_up_to(text.encode(), len(prefix.encode()), table, NAME) == len(library.encode(prefix, add_special_tokens=False).ids)


def test_budgets_are_answered_from_the_table(spark):
    rng = random.Random(2)
    text = " ".join(rng.choices(["the", "thonre", "of", "ountion."], k=400))
    row = token_counts(spark.createDataFrame([(1, text)], "doc_id LONG, text STRING"), limit=100).first()
    library, kept = load(NAME), text.encode()[: row["bytes_in_limit"]].decode()
    assert len(library.encode(kept, add_special_tokens=False).ids) <= 100 < row["n_tokens"]
    longer = " ".join(text.split()[: len(kept.split()) + 1])
    assert len(library.encode(longer, add_special_tokens=False).ids) > 100


RARE = ["le mot\u00a0: the of\u00a0\u00a0 and  \u3000x !\x1c y\x1c\u2009 z\u0085 q", "日本語の文章、中国語。" * 12 + "\u00a0\u3000 'll'll" + "漢字かな" * 20]


@pytest.mark.parametrize("text", [*TEXTS, *RARE])
def test_every_entry_of_a_table_has_the_library_s_count(text):
    library, raw = load(NAME), text.encode()
    for i in range(len(text) + 1):
        place = len(text[:i].encode())
        assert tokens_up_to(raw, place, prefix_table(raw, NAME), NAME) == len(library.encode(text[:i], add_special_tokens=False).ids)
    for end, count in zip(*prefix_table(raw, NAME), strict=True):
        assert count == len(library.encode(raw[:end].decode(), add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["un mot\u00a0: " * 400, "日本語の文章中国語漢字" * 200])
def test_rare_white_space_and_unspaced_texts_fill_their_budget(spark, text):
    row = token_counts(spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")).first()
    kept = text.encode()[: row["bytes_in_limit"]].decode()
    assert 500 < len(load(NAME).encode(kept, add_special_tokens=False).ids) <= 512 < row["n_tokens"]


def test_an_empty_table_has_no_counts(no_docs):
    assert token_prefixes(no_docs).collect() == [] == token_counts(no_docs).collect()
