import datetime as dt

import pytest
from pyspark.sql import functions as F

from smelter.operators import keymap
from smelter.operators.keymap import MAP_SCHEMA, lacking_keys, members
from smelter.plans.live import keys_of, store_keys
from smelter.plans.pipeline import build_gold, build_live_gold, build_silver, rows_of
from smelter.schemas import BRONZE, GOLD, GOLD_OBJECTS, SILVER

DAY = dt.date(2013, 6, 1)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def loaded(warehouse, tables):
    for table, df in tables.items():
        warehouse.overwrite(BRONZE, table, df)
    build_silver(warehouse, DAY)
    return warehouse


@pytest.mark.parametrize("chunk", [2, 65536])
def test_members_and_their_keys(spark, frame, monkeypatch, chunk):
    monkeypatch.setattr(keymap, "CHUNK", chunk)
    rows = frame([(5, 1), (None, 3), (5, 2), (9, 1)], "id INT, n BIGINT")
    all_members = members(rows, "id", "n")
    assert found(all_members) == found(frame([(5, 1), (5, 2), (5, 3), (None, 1), (None, 2), (None, 3), (9, 1)], "id BIGINT, copy BIGINT"))
    first = lacking_keys(all_members, spark.createDataFrame([], MAP_SCHEMA)).cache()
    assert sorted(r.key for r in first.collect()) == list(range(1, 8))
    assert {r.key for r in first.filter("id = 5").collect()} == {4, 5, 6} and first.filter("id = 9").first().key == 7
    more = lacking_keys(members(frame([(5, 3), (None, 3), (9, 2), (1, 1)], "id INT, n BIGINT"), "id", "n"), first)
    assert found(more) == [(1, 1, 8), (9, 2, 9)]


def test_views_equal_a_stored_build_and_follow_silver(loaded, frame):
    build_gold(loaded)
    stored = {t: found(loaded.read(GOLD, t)) for t in GOLD_OBJECTS}
    build_live_gold(loaded)
    assert {t: found(loaded.read(GOLD, t)) for t in GOLD_OBJECTS} == stored
    old = {r.customer_id: r.customer_key for r in loaded.read(GOLD, "dim_customers").collect()}

    added = frame([(-5, "NEW", "N"), (77, "NEWER", "N")], "cust_id INT, cust_key STRING, cust_firstname STRING")
    loaded.append(SILVER, "crm_cust_info", added, added.columns)
    sale = frame([("SO9", "HL-1", -5, 20130201)], "sls_ord_num STRING, sls_prd_key STRING, sls_cust_id INT, sls_order_dt INT")
    loaded.append(SILVER, "crm_sales_details", sale, sale.columns)
    fresh = {r.customer_id: r.customer_key for r in loaded.read(GOLD, "dim_customers").collect()}
    assert fresh == old | {-5: len(old) + 1, 77: len(old) + 2}
    fact = loaded.read(GOLD, "fact_sales").filter("order_number = 'SO9'").first()
    assert (fact.customer_key, fact.order_date) == (len(old) + 1, dt.date(2013, 2, 1))

    store_keys(loaded)
    store_keys(loaded)
    assert {r.customer_id: r.customer_key for r in loaded.read(GOLD, "dim_customers").collect()} == fresh
    assert loaded.read(GOLD, keys_of("dim_customers")).count() == len(fresh)


def test_rows_of_a_repeated_id_have_keys_of_their_own(loaded):
    loaded.append(SILVER, "erp_loc_a101", loaded.read(SILVER, "erp_loc_a101").withColumn("cntry", F.lit("Peru")), ["cid", "cntry"])
    build_live_gold(loaded)
    keys = [r.customer_key for r in loaded.read(GOLD, "dim_customers").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1)) and len(keys) > 3


def test_customers_and_sales_in_buckets_join_without_a_shuffle(spark, loaded):
    build_gold(loaded, buckets=4)
    fact, customers = (loaded.read(GOLD, rows_of(t)) for t in ("fact_sales", "dim_customers"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = fact.join(customers.select("customer_key", "country"), "customer_key")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == fact.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    build_gold(loaded)
    assert loaded.read(GOLD, "fact_sales").count() == 3


def test_bucketed_tables_are_read_by_file_splits_with_all_rows(spark, loaded):
    build_gold(loaded, buckets=4)
    table = rows_of("fact_sales")
    by_files = loaded.read_files(GOLD, table)
    plan = by_files.groupBy("customer_key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan  # not one task a bucket: the grouping shuffles splits of the files
    assert sorted(by_files.collect(), key=repr) == sorted(loaded.read(GOLD, table).collect(), key=repr)
