import datetime as dt

from smelter.operators.latest import latest_record

DDL = "k INT, d DATE, v STRING"
OLD, NEW = dt.date(2020, 1, 1), dt.date(2021, 1, 1)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_takes_the_greatest_date_and_drops_null_keys(frame):
    df = frame([(1, OLD, "a"), (1, NEW, "b"), (1, None, "c"), (2, None, "d"), (None, NEW, "e")], DDL)
    assert found(latest_record(df, "k", "d")) == [(1, NEW, "b"), (2, None, "d")]


def test_keeps_one_null_key_row_on_request(frame):
    df = frame([(None, OLD, "a"), (None, NEW, "b"), (1, OLD, "c")], DDL)
    assert found(latest_record(df, "k", "d", keep_null_key=True)) == [(1, OLD, "c"), (None, NEW, "b")]


def test_ties_are_broken_the_same_way_in_any_row_order(frame):
    rows = [(1, NEW, v) for v in "bcadz"]
    results = {str(found(latest_record(frame(r, DDL).repartition(3), "k", "d"))) for r in (rows, rows[::-1])}
    assert results == {str([(1, NEW, "z")])}


def test_named_ties_come_before_the_other_columns(frame):
    df = frame([(1, NEW, "z", 1), (1, NEW, "a", 2)], DDL + ", seq INT")
    assert found(latest_record(df, "k", "d", ["seq"])) == [(1, NEW, "a", 2)]


def test_is_idempotent(frame):
    df = frame([(i % 7, dt.date(2020, 1, 1 + i % 5), str(i)) for i in range(100)], DDL)
    once = latest_record(df, "k", "d")
    assert found(latest_record(once, "k", "d")) == found(once)


def test_rows_are_cut_to_one_per_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CAST(id % 3 AS INT) AS k", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS d")
    plan = latest_record(df, "k", "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("Exchange hashpartitioning") == 1
