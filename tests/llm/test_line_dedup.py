import hashlib
import random

import pytest

from smelter.llm import line_dedup
from smelter.llm.line_dedup import line_report, without_repeats
from tests.llm.conftest import DOCS

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def expected_texts(rows, least=5):
    """Per row the lines before, those dropped and the text left, by the rule itself."""
    holders = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(doc_id)
    keeper = {k: max(ids, key=lambda i: (i is not None, i)) for k, ids in holders.items() if len(ids) >= least}
    found = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        found.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def report(spark, df):
    return sorted(map(tuple, line_report(df).collect()), key=repr)


def digests(texts):
    return sorted([(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in texts], key=repr)


@pytest.fixture
def repeating():
    rng = random.Random(5)
    common = [f"{i} a line of the footer that many pages É Share, number {'x' * (i + 5)}" for i in range(12)]
    edge = ["y" * 40, "z" * 39, "é" * 40]
    rows = []
    for i in range(80):
        lines = [f"own line {i} {j} " + "w" * rng.randint(0, 60) for j in range(rng.randint(0, 6))]
        for line in rng.sample(common + edge, rng.randint(0, 8)):
            line = rng.choice([line, line.upper().replace("É", "É"), f" \t{line}\r", f"\x0b{line}\x0c"])
            lines.insert(rng.randint(0, len(lines)), line)
            if rng.random() < 0.2:
                lines.append(line)
        rows.append((i, "\n".join(lines), "en", "a", 0))
    rows += [(3, rows[3][1], "en", "a", 0), (None, rows[4][1], "en", "a", 0), (None, rows[5][1], None, None, None), (7, rows[9][1], "en", "a", 0)]
    rows += [(100, None, None, None, None), (101, "", None, None, None), (102, "\n\n", None, None, None), (103, "\n".join(common), "en", "b", 0), (104, "\n" + common[0] + "\n", "en", "b", 0)]
    return rows


def test_reports_are_those_of_the_rule(spark, repeating, clashing):
    expected = digests(expected_texts(repeating))
    assert report(spark, spark.createDataFrame(repeating, DOCS)) == expected
    assert report(spark, clashing(spark.createDataFrame(repeating, DOCS)).repartition(7)) == expected
    assert sum(n for _, _, n, _ in expected) > 100


def test_the_corpus_of_all_tests(spark, docs, corpus):
    assert report(spark, docs) == digests(expected_texts(corpus))


def test_joins_by_shuffle_give_the_same(spark, repeating, monkeypatch):
    monkeypatch.setattr(line_dedup, "small_side", lambda df: df)
    monkeypatch.setattr(line_dedup, "BROADCAST_POSITIONS", -1)
    assert report(spark, spark.createDataFrame(repeating, DOCS)) == digests(expected_texts(repeating))


def test_texts_keep_their_other_columns(spark, repeating, clashing):
    df = clashing(spark.createDataFrame(repeating, DOCS))
    kept = without_repeats(df)
    assert kept.columns == df.columns
    found = sorted([(r["doc_id"], r["text"], r["source"], r["key"]) for r in kept.collect()], key=repr)
    texts = [(t[0], t[3] if row[1] is not None else None, row[3], 1) for t, row in zip(expected_texts(repeating), repeating, strict=True)]
    assert found == sorted(texts, key=repr)


def test_a_line_in_four_documents_stays_and_in_five_goes(spark):
    line = "q" * 45
    rows = [(i, f"{line}\nrest {i}", "en", "a", 0) for i in range(4)]
    assert {r["n_dropped"] for r in line_report(spark.createDataFrame(rows, DOCS)).collect()} == {0}
    rows.append((9, line, "en", "a", 0))
    found = {r["doc_id"]: r["n_dropped"] for r in line_report(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {0: 1, 1: 1, 2: 1, 3: 1, 9: 0}


def test_a_document_of_very_many_lines(spark):
    shared = [f"{i:06d} " + "shared line of boilerplate text, many times over" for i in range(20_000)]
    rows = [(i, "\n".join(shared), "en", "a", 0) for i in range(5)]
    rows.append((0, "\n".join(x for line in shared for x in (line, "own")), "en", "a", 0))
    assert report(spark, spark.createDataFrame(rows, DOCS)) == digests(expected_texts(rows))


def test_empty_tables_stay_empty(no_docs, clashing):
    assert line_report(no_docs).collect() == []
    assert without_repeats(clashing(no_docs)).collect() == []
