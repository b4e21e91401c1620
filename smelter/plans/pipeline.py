"""The whole run: extracts to bronze, silver, gold, and the gate."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.plans.bronze import EMPTY, KEEP, load_bronze, load_rejects
from smelter.plans.gold import dim_customers, dim_products, fact_sales
from smelter.plans.live import create_live_views, store_keys
from smelter.plans.profiles import PRODUCTION, Profile
from smelter.plans.quality import gate, verdict
from smelter.plans.silver import silver_customers, silver_passthrough, silver_products, silver_sales
from smelter.schemas import BRONZE, EXTRACTS, GOLD, GOLD_OBJECTS, LAYERS, SILVER, silver_schema
from smelter.session import run_together
from smelter.sources.tables import Warehouse, with_load_time

ORDER_YEAR = "order_year"
BUCKET_KEY = "customer_key"


@dataclass(frozen=True)
class Run:
    audit: DataFrame
    gate: DataFrame


def build_silver(
    warehouse: Warehouse,
    as_of: dt.date | None = None,
    profile: Profile = PRODUCTION,
    loaded_at: dt.datetime | None = None,
) -> None:
    """Replace the six silver tables, in their declared schemas. Sales are matched against the silver tables just written, not against plans."""
    bronze = {t: warehouse.read(BRONZE, t) for t in EXTRACTS}
    tables = {
        "crm_cust_info": silver_customers(bronze["crm_cust_info"], as_of),
        "crm_prd_info": silver_products(bronze["crm_prd_info"], profile),
        **{t: silver_passthrough(bronze[t], t) for t in ("erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2")},
    }

    def store(table: str, df: DataFrame) -> None:
        warehouse.refresh(SILVER, table, silver_schema(table), with_load_time(df, loaded_at))

    run_together(warehouse.spark, [partial(store, t, df) for t, df in tables.items()])
    products, customers = warehouse.read(SILVER, "crm_prd_info"), warehouse.read(SILVER, "crm_cust_info")
    store("crm_sales_details", silver_sales(bronze["crm_sales_details"], products, customers, profile))


def rows_of(name: str) -> str:
    """The stored table behind a gold view."""
    return f"{name}_rows"


def build_live_gold(warehouse: Warehouse) -> None:
    """Keys for new members, and the views that follow silver; stored gold tables are left as they are."""
    store_keys(warehouse)
    create_live_views(warehouse)


def build_gold(warehouse: Warehouse, profile: Profile = PRODUCTION, buckets: int = 0) -> None:
    """Replace the gold tables and the views that users query by name.

    With ``buckets`` the customer dimension and the fact are stored by customer key in as many buckets, so that joins of the two
    need no shuffle. A bucket is read by one task: choose it where no customer holds much of the sales.

    Dimensions come first, so the fact reads their keys; the fact is stored in a folder per order year. The views show the
    described columns only.
    """
    silver = {t: warehouse.read(SILVER, t) for t in EXTRACTS}
    dimensions = {
        "dim_customers": dim_customers(silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"]),
        "dim_products": dim_products(silver["crm_prd_info"], silver["erp_px_cat_g1v2"], unique_ids=profile.latest_products_only),
    }
    layout = {"dim_customers": {"buckets": buckets, "bucket_by": BUCKET_KEY}} if buckets else {}
    run_together(
        warehouse.spark,
        [partial(warehouse.overwrite, GOLD, rows_of(t), df, **layout.get(t, {})) for t, df in dimensions.items()],
    )
    stored = [warehouse.read(GOLD, rows_of(t)) for t in dimensions]
    fact = fact_sales(silver["crm_sales_details"], *stored)
    dated = fact.withColumn(ORDER_YEAR, F.year("order_date"))
    if buckets:
        warehouse.overwrite(GOLD, rows_of("fact_sales"), dated, [ORDER_YEAR], buckets, BUCKET_KEY)
    else:  # the tasks of the last join write their rows: the fact, with a row per product version, isn't shuffled once more
        warehouse.overwrite(GOLD, rows_of("fact_sales"), dated, [ORDER_YEAR])
    for name, df in {**dimensions, "fact_sales": fact}.items():
        warehouse.create_view(GOLD, name, rows_of(name), df.columns)


def gate_tables(warehouse: Warehouse) -> dict[str, dict[str, DataFrame | None]]:
    names = {BRONZE: EXTRACTS, SILVER: EXTRACTS, GOLD: GOLD_OBJECTS}
    return {layer: {t: warehouse.find(layer, t) for t in names[layer]} for layer in LAYERS}


def run_pipeline(
    warehouse: Warehouse,
    base_path: str = "datasets",
    as_of: dt.date | None = None,
    profile: Profile = PRODUCTION,
    reset: bool = False,
    enforce: bool = True,
    on_error: str = "raise",
    on_reject: str = KEEP,
    on_failure: str = EMPTY,
    loaded_at: dt.datetime | None = None,
    lowest_cost: int | None = None,
    live_gold: bool = False,
    buckets: int = 0,
) -> Run:
    """Load, cleanse, model and check. Raises ``GateFailed`` on silver or gold violations unless ``enforce`` is off.

    ``on_error``, ``on_reject`` and ``on_failure`` are the load's policies, ``loaded_at`` the time stamped on silver rows, and
    ``lowest_cost`` the gate's lowest good cost in place of the profile's. With ``live_gold`` the gold views follow silver
    under keys that stay from run to run; otherwise they show the rows stored by this run, under dense keys, in ``buckets`` by
    customer if given.
    """
    warehouse.create_namespaces(reset)
    audit = load_bronze(warehouse, base_path, on_error, on_reject, on_failure)
    build_silver(warehouse, as_of, profile, loaded_at)
    if live_gold:
        build_live_gold(warehouse)
    else:
        build_gold(warehouse, profile, buckets)
    batch = audit.select("batch_id").first()["batch_id"]
    rejects = load_rejects(warehouse, batch)
    checks = gate(warehouse.spark, **gate_tables(warehouse), as_of=as_of, profile=profile, rejects=rejects, lowest_cost=lowest_cost)
    results = warehouse.spark.createDataFrame(checks.collect(), checks.schema)  # one row per check; run them once
    if enforce:
        verdict(results)
    return Run(audit, results)
