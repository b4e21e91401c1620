import glob
import re

import pytest

import corpus_pipeline
from smelter.llm.oracles import ORACLES
from smelter.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, docs, clashing):
    current, counts = clashing(docs), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, SF)
        assert after.columns == current.columns
        counts.append(after.count())
        current = after
    assert counts[0] < docs.count() and counts[1] < counts[0]


def test_one_row_of_each_group_stays_whatever_the_ids(spark, rng_words):
    import random

    a, b, c, d = (" ".join(rng_words(random.Random(i), 80)) for i in range(4))
    texts = [(3, a), (3, a), (8, a + " end"), (None, a), (None, b), (None, b), (None, b + " end"), (9, c), (5, c), (5, d), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in texts], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    kept = [(r["doc_id"], (r["text"] or "").removesuffix(" end")) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert sorted(kept, key=repr) == sorted([(3, a), (None, b), (5, c), (5, d), (7, ""), (7, "")], key=repr)


@pytest.mark.parametrize("position", range(4))
def test_stages_take_empty_tables(spark, no_docs, position):
    assert corpus_pipeline.STAGES[position][1](spark, no_docs, SF).collect() == []


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    with duckdb.connect() as connection:
        for path in glob.glob(f"{SF}/*.parquet"):
            connection.sql(f"CREATE VIEW {path.split('/')[-1].removesuffix('.parquet')} AS SELECT * FROM '{path}'")
        expected = connection.sql(ORACLES[name])
        columns = sorted(expected.columns)
        found = QUERIES[name](spark, SF)
        assert sorted(found.columns) == columns
        rows = sorted(map(repr, (tuple(r[c] for c in columns) for r in found.collect())))
        assert rows == sorted(map(repr, expected.select(*columns).fetchall()))


def test_the_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())
