import datetime as dt
import os
import tempfile

import pytest

from smelter.__main__ import main
from smelter.plans.pipeline import build_gold, build_silver, rows_of, run_pipeline
from smelter.plans.profiles import CI
from smelter.schemas import AUDIT_COLUMN, BRONZE, EXTRACTS, GOLD, GOLD_OBJECTS, SILVER
from smelter.sources.extracts import write_extract
from smelter.sources.tables import Warehouse

DAY = dt.date(2013, 6, 1)
COUNTS = {"dim_customers": 3, "dim_products": 2, "fact_sales": 3}


@pytest.fixture(scope="module")
def place():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="module")
def stored(spark, clean_layers, place):
    """One run over clean extracts: its warehouse and its result."""
    for table, df in clean_layers[0].items():
        write_extract(df, table, place)
    prefix = os.path.basename(place).replace("-", "_") + "_"
    warehouse = Warehouse(spark, f"{place}/tables", prefix)
    return warehouse, run_pipeline(warehouse, place, DAY)


def gold_counts(warehouse):
    return {t: warehouse.read(GOLD, t).count() for t in GOLD_OBJECTS}


def test_run(stored):
    warehouse, run = stored
    assert run.audit.filter("status = 'LOADED'").count() == 7
    assert run.gate.filter("failed = 1").count() == 0
    assert gold_counts(warehouse) == COUNTS
    assert all(AUDIT_COLUMN in warehouse.read(SILVER, t).columns for t in EXTRACTS)


def test_fact_is_stored_by_order_year(stored):
    fact = stored[0].read(GOLD, rows_of("fact_sales"))
    assert "order_year" not in stored[0].read(GOLD, "fact_sales").columns
    plan = fact.filter("order_year = 2013")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert sorted((r.order_number, r.order_year) for r in fact.collect()) == [
        ("SO1", 2013), ("SO2", 2013), ("SO3", None),
    ]


def test_a_second_run_replaces_and_a_broken_one_is_stopped(stored, tables, place, capsys):
    warehouse, _ = stored
    arguments = ["--base-path", place, "--location", warehouse.location, "--prefix", warehouse.prefix]
    arguments += ["--as-of", "2013-06-01"]
    assert main(arguments) == 0
    assert "LOADED" in capsys.readouterr().out
    assert gold_counts(warehouse) == COUNTS

    write_extract(tables["crm_cust_info"].limit(0), "crm_cust_info", place)
    assert main([*arguments, "--profile", "ci", "--reset"]) == 1
    assert "no rows" in capsys.readouterr().err


def test_ci_profile_repeats_sales_per_product_version(warehouse, tables):
    for table, df in tables.items():
        warehouse.overwrite(BRONZE, table, df)
    warehouse.overwrite(BRONZE, "crm_prd_info", tables["crm_prd_info"].unionByName(tables["crm_prd_info"]))
    build_silver(warehouse, DAY, CI)
    assert warehouse.read(SILVER, "crm_sales_details").count() == 6


def test_the_stored_fact_is_not_shuffled_after_its_joins(warehouse, tables, monkeypatch):
    for table, df in tables.items():
        warehouse.overwrite(BRONZE, table, df)
    build_silver(warehouse, DAY)
    written = {}
    overwrite = warehouse.overwrite
    monkeypatch.setattr(warehouse, "overwrite", lambda layer, table, df, *args, **more: (written.update({table: df}), overwrite(layer, table, df, *args, **more)))
    build_gold(warehouse)
    plan = written[rows_of("fact_sales")]._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" not in plan.upper() and gold_counts(warehouse) == COUNTS
