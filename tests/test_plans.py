"""Shape of the physical plans: what reaches the scan, what is shuffled, and what happens to hot keys."""

import re

import pytest
from pyspark.sql import functions as F

from smelter.operators import checks as k
from smelter.plans.gold import fact_sales, product_rows
from smelter.plans.quality import layer_summary
from smelter.plans.silver import silver_sales
from smelter.schemas import EXTRACTS
from smelter.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The live views number the members that have no stored key yet in one task, as their module says.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"live_gold"}))
def test_no_cross_join_no_python_and_no_whole_table_in_one_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas"):
        assert bad not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:  # partial aggregates of a whole-table count, or a limit
            below = lines[i + 1] + lines[i + 2]
            assert "keys=[]" in below or "LocalLimit" in below, below


@pytest.fixture
def parquet_tables(spark, folder, tables):
    for t, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{t}")
    return {t: spark.read.parquet(f"{folder}/{t}") for t in tables}


def test_checks_read_their_columns_only_and_push_their_filters(parquet_tables):
    plan = plan_of(k.repeated_keys(parquet_tables["crm_cust_info"], "cust_id"))
    assert "ReadSchema: struct<cust_id:int>" in plan
    plan = plan_of(k.invalid_due_dates(parquet_tables["crm_sales_details"]))
    assert "ReadSchema: struct<sls_due_dt:int>" in plan
    plan = plan_of(k.inverted_products(parquet_tables["crm_prd_info"]).select("prd_id"))
    assert "ReadSchema: struct<prd_id:int,prd_start_dt:timestamp_ntz,prd_end_dt:timestamp_ntz>" in plan
    assert "IsNotNull(prd_end_dt)" in plan


def test_the_suite_scans_each_table_once(parquet_tables):
    plan = plan_of(layer_summary(parquet_tables))
    assert plan.count("FileScan parquet") == 5


def test_products_of_unique_ids_are_not_collapsed(tables):
    counted = [plan_of(product_rows(tables["crm_prd_info"], tables["erp_px_cat_g1v2"], unique_ids=u)).count("Exchange hashpartitioning") for u in (False, True)]
    assert counted[1] < counted[0]


def test_fact_reads_two_columns_of_each_dimension(spark, folder, tables, gold):
    for name in ("dim_customers", "dim_products"):
        gold[name].write.mode("overwrite").parquet(f"{folder}/{name}")
    stored = [spark.read.parquet(f"{folder}/{name}") for name in ("dim_customers", "dim_products")]
    plan = plan_of(fact_sales(tables["crm_sales_details"], *stored))
    assert "ReadSchema: struct<customer_key:bigint,customer_id:int>" in plan
    assert "ReadSchema: struct<product_key:bigint,product_number:string>" in plan


@pytest.fixture
def skewed(spark):
    """Shuffled joins only, with limits so low that a test table counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_sales(spark, rows=60_000):
    """A third of all sales are of one customer and one product."""
    hot = F.col("id") % 3 == 0
    n = F.col("id") % 900
    sales = spark.range(0, rows, 1, 16).select(
        F.concat(F.lit("SO"), F.col("id")).alias("sls_ord_num"),
        F.when(hot, "P7").otherwise(F.concat(F.lit("P"), n)).alias("sls_prd_key"),
        F.when(hot, 7).otherwise(n).cast("int").alias("sls_cust_id"),
        *[F.lit(20130101).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        *[F.lit(1).alias(c) for c in ("sls_sales", "sls_quantity", "sls_price")],
    )
    assert sales.columns == EXTRACTS["crm_sales_details"].columns
    return sales


def skew_splits(plan):
    return len(re.findall(r"SortMergeJoin\(skew=true\)|ShuffledHashJoin\(skew=true\)", plan.split("== Initial Plan")[0]))


def test_hot_customer_and_product_are_split_in_the_fact(skewed):
    customers = skewed.range(900).select((F.col("id") + 1).alias("customer_key"), F.col("id").cast("int").alias("customer_id"))
    products = skewed.range(900).select((F.col("id") + 1).alias("product_key"), F.concat(F.lit("P"), "id").alias("product_number"))
    fact = fact_sales(hot_sales(skewed), customers, products)
    assert len(fact.collect()) == 60_000
    assert skew_splits(plan_of(fact)) == 2


def test_hot_customer_and_product_are_split_in_silver_and_in_the_orphan_checks(skewed):
    customers = skewed.range(900).select(F.col("id").cast("int").alias("cust_id"))
    products = skewed.range(900).select(F.concat(F.lit("AA-BB-P"), "id").alias("prd_key"))
    sales = hot_sales(skewed)
    kept = silver_sales(sales, products, customers)
    assert len(kept.collect()) == 60_000
    assert skew_splits(plan_of(kept)) == 2
    few = k.sales_without_customer(sales, customers.filter("cust_id <> 7"))
    assert len(few.collect()) == 20_067  # the hot third, and 67 of the rest
    assert skew_splits(plan_of(few)) == 1


def test_the_fact_is_not_shuffled_to_look_for_its_dimensions(skewed):
    fact = skewed.range(1000).select(F.col("id").alias("customer_key"), (F.col("id") % 7).alias("product_key"), F.lit("SO").alias("order_number"))
    customers, products = skewed.range(1, 900).select(F.col("id").alias("customer_key")), skewed.range(7).select(F.col("id").alias("product_key"))
    missing = k.disconnected_facts(fact, customers, products)
    assert "Exchange hashpartitioning" not in plan_of(missing) and missing.count() == 101
