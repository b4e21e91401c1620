import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from smelter.operators import surrogate
from smelter.operators.surrogate import collapse_copies, surrogate_key


def literal(df, id_column):
    """The plain form: one task numbers everything."""
    return df.withColumn("k", F.row_number().over(Window.orderBy(F.col(id_column).asc_nulls_first())).cast("bigint"))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def spans(df):
    return found(df.groupBy("id").agg(F.min("k"), F.max("k"), F.count("k")))


def test_equals_the_literal_window_for_unique_ids(frame):
    ids = [None, -(2**31), 2**31 - 1, 0, -1, 65535, 65536, -65536, -65537, 7, 1_000_000]
    df = frame([(i, str(i)) for i in ids], "id INT, v STRING")
    assert found(surrogate_key(df, "id", "k")) == found(literal(df, "id"))


def test_equals_the_literal_window_over_many_cells(spark):
    df = spark.range(50_000).select((F.col("id") * 977 - 20_000_000).cast("int").alias("id"), F.lit("x").alias("v"))
    got = surrogate_key(df, "id", "k")
    want = literal(df, "id")
    assert got.join(want, ["id", "k"]).count() == 50_000
    assert got.count() == 50_000


@pytest.mark.parametrize("limit", [100, 100_000])
def test_repeated_ids_get_dense_keys_within_the_literal_span(spark, monkeypatch, limit):
    monkeypatch.setattr(surrogate, "CELL_ROWS", limit)  # the table's one cell is divided, or not
    # a third of the rows hold one id
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).cast("int").alias("id"),
        F.col("id").alias("v"),
    )
    got = surrogate_key(df, "id", "k").cache()
    assert [r.k for r in got.select("k").orderBy("k").collect()] == list(range(1, 9_001))
    assert spans(got) == spans(literal(df, "id"))
    assert got.select("id", "v").exceptAll(df).count() == 0


@pytest.mark.parametrize("limit", [100, 100_000])
def test_copies_are_counted_cut_into_chunks_and_restored(spark, monkeypatch, limit):
    monkeypatch.setattr(surrogate, "CHUNK", 16)
    monkeypatch.setattr(surrogate, "CELL_ROWS", limit)
    df = spark.range(2_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 40).cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise((F.col("id") % 4).cast("string")).alias("v"),
    )
    got = surrogate_key(collapse_copies(df, "n"), "id", "k", "n").cache()
    assert got.columns == ["id", "v", "k"]
    assert [r.k for r in got.select("k").orderBy("k").collect()] == list(range(1, 2_001))
    assert spans(got) == spans(literal(df, "id"))
    assert got.select("id", "v").exceptAll(df).count() == 0


def test_hot_and_ordinary_cells_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(surrogate, "CELL_ROWS", 1_000)
    n = F.col("id")
    hot = [F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, 70_000), F.when(n % 5 == 2, 70_001)]
    df = spark.range(12_000).select(F.coalesce(*hot, (n * 613 - 3_000_000)).cast("int").alias("id"), n.alias("v"))
    df = df.withColumn("id", F.when(F.col("v") % 5 != 0, F.col("id")))  # a fifth of the ids are NULL
    got = surrogate_key(df, "id", "k").cache()
    assert [r.k for r in got.select("k").orderBy("k").collect()] == list(range(1, 12_001))
    assert spans(got) == spans(literal(df, "id"))


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_no_window_partition_is_over_the_limit(spark, monkeypatch, kind):
    monkeypatch.setattr(surrogate, "CELL_ROWS", 500)
    n = F.col("id")
    df = spark.range(30_000).select(F.when(n % 3 == 0, 9).otherwise(n).cast(kind).alias("id"), n.alias("v"))
    rows = surrogate._chunked(df, ["id", "v"], None).select("*", F.col("id").cast("bigint").alias("_slot"), F.xxhash64("id", "v", "_chunk").alias("_hash"))
    cells = surrogate._cells(rows, 16)
    assert all(c.rows <= 500 or c.single for c in cells)
    sizes = surrogate._placed(rows, cells).groupBy("_cell", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * 500


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_limits_do_not_change_a_key(spark, monkeypatch, kind):
    n = F.col("id")
    df = spark.range(3_000).select(F.when(n % 3 == 0, 5).otherwise(n * n % 1000 - 300).cast(kind).alias("id"), (n % 700).alias("v"))
    copies = collapse_copies(df, "n")
    want = found(surrogate_key(copies, "id", "k", "n"))
    for rows, bits, chunk in ((10, 16, 65536), (200, 3, 65536), (64, 5, 65536)):
        for name, value in (("CELL_ROWS", rows), ("CELL_BITS", bits), ("CHUNK", chunk)):
            monkeypatch.setattr(surrogate, name, value)
        assert found(surrogate_key(copies, "id", "k", "n")) == want


def test_bigint_ids_over_the_whole_range(frame):
    ids = [None, -(2**63) + 1, 2**63 - 1, 0, -1, 2**40, 2**40 + 1, -(2**40), 7]
    df = frame([(i, str(i)) for i in ids], "id BIGINT, v STRING")
    assert found(surrogate_key(df, "id", "k")) == found(literal(df, "id"))


def test_all_ids_null(frame):
    df = frame([(None, "a"), (None, "b")], "id INT, v STRING")
    assert sorted(r.k for r in surrogate_key(df, "id", "k").collect()) == [1, 2]


def test_empty_table(frame):
    assert surrogate_key(frame([], "id INT, v STRING"), "id", "k").count() == 0


def test_only_whole_ids_are_taken(frame):
    with pytest.raises(TypeError, match="whole number"):
        surrogate_key(frame([("1",)], "id STRING"), "id", "k")


def test_no_task_gets_the_whole_table(spark):
    """The rows are only shuffled by cell and part."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select(F.col("id").cast("int"), F.col("id").cast("string").alias("v"))
        plan = surrogate_key(df, "id", "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange SinglePartition" not in plan and "Exchange hashpartitioning(_cell" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
