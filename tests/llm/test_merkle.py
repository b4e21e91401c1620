import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from smelter.llm import merkle
from smelter.llm.merkle import manifest
from tests.llm.conftest import DOCS

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return digest(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def grown(nodes):
    """All levels of a tree over the nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    """Per level, the nodes before and after the ancestor of leaf ``i``."""
    found = []
    for level in levels[:-1]:
        run, at = level[i // 16 * 16 : i // 16 * 16 + 16], i % 16
        found.append((run[:at], run[at + 1 :]))
        i //= 16
    return found


def expected(rows):
    first = lambda x: (x is not None, x if x is not None else 0)
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (first(r[0]), leaf(*r)))
        trees[s] = grown([leaf(*r) for r in by_source[s]])
    top = grown([trees[s][-1][0] for s in names])
    found = []
    for t, s in enumerate(names):
        for i, row in enumerate(by_source[s]):
            proof = siblings(trees[s], i) + siblings(top, t)
            doc_id, text, *rest = row
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                text = text.translate(LOWER)
            node = leaf(doc_id, text, *rest)
            for before, after in proof:
                node = digest(*before, node, *after)
            all_siblings = digest(*[x for before, after in proof for x in before + after])
            root = top[-1][0]
            found.append((doc_id, trees[s][0][i], trees[s][-1][0], root, all_siblings, node, node == root))
    return sorted(found, key=repr)


def proofs(df):
    return sorted(map(tuple, manifest(df).collect()), key=repr)


def many(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i, f"Text {i} é", "en" if i % 3 else None, None if s == 0 else f"s{s}", i) for i, s in ((i, min(rng.randrange(2 * sources), sources)) for i in rng.sample(range(n * 3), n))]


def test_the_corpus_of_all_tests(docs, corpus, clashing):
    assert proofs(docs) == expected(corpus)
    assert proofs(clashing(docs).repartition(5)) == expected(corpus)


@pytest.mark.parametrize("n, sources", [(1, 1), (2, 1), (16, 1), (17, 1), (257, 1), (300, 3), (700, 40), (400, 300)])
@pytest.mark.parametrize("bits", [2, 12])
def test_trees_of_all_shapes(spark, monkeypatch, n, sources, bits):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits + 3)
    rows = many(n, sources)
    found = proofs(spark.createDataFrame(rows, DOCS))
    assert found == expected(rows)
    assert {r[-1] for r in found if zlib.crc32(str(r[0]).encode()) % 5} <= {True}


def test_equal_rows_are_leaves_of_their_own(spark):
    rows = many(50, 3) + [(7, "Same", "en", "s1", 4)] * 200 + [(None, None, None, None, None)] * 40 + [(7, "Other", "en", "s1", 4)]
    assert proofs(spark.createDataFrame(rows, DOCS).repartition(3)) == expected(rows)


def test_joins_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(merkle, "small_side", lambda df: df)
    rows = many(300, 20)
    assert proofs(spark.createDataFrame(rows, DOCS)) == expected(rows)


def test_only_changed_texts_fail(spark):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(["no capitals here", "Capital", None, ""] * 30)]
    for doc_id, *_, verified in proofs(spark.createDataFrame(rows, DOCS)):
        assert verified == (zlib.crc32(str(doc_id).encode()) % 5 != 0 or doc_id % 4 != 1)


def test_a_partition_asks_only_for_what_its_leaves_do_not_give(spark):
    ranges = spark.createDataFrame([(0, 0, 0, 31, 300), (1, 0, 32, 40, 300), (2, 1, 0, 0, 1)], "block long, tree long, low long, high long, n long")
    found = {}
    for r in merkle._missing(ranges).collect():
        found.setdefault(r["block"], set()).add((r["level"], r["idx"]))
    assert found[0] == {(1, i) for i in range(2, 16)} | {(2, 1), (3, 0)}
    assert found[1] == {(0, i) for i in range(41, 48)} | {(1, i) for i in range(16) if i != 2} | {(2, 1), (3, 0)}
    assert found[2] == {(0, 0)}


def test_empty_tables_have_no_proofs(no_docs):
    assert manifest(no_docs).collect() == []


def test_places_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    found = merkle.numbered(df, [F.col("x").asc()], "place").collect()
    assert all(r["x"] == r["place"] for r in found) and len(found) == 1000
