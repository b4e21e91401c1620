"""Gold views that follow silver: no rows are copied, and keys come from stored maps.

The views are persistent and read the silver tables whenever they are queried, so appended rows show at once. A member that
its map lacks already has the key that ``store_keys`` will give it: the ones after the greatest, in order of the ids. Only
these members are numbered in one task; ``store_keys`` after a load keeps them few. Rows of one id are told apart by content.
"""

from __future__ import annotations

from functools import partial

from smelter.functions.cleansing import PRODUCT_LINE, UNKNOWN
from smelter.functions.dates import FIRST_YEAR_DAY, LAST_YEAR_DAY
from smelter.functions.keys import CATEGORY_LENGTH, CUSTOMER_KEY_LENGTH, PRODUCT_NUMBER_START
from smelter.operators.keymap import MAP_SCHEMA, lacking_keys, members
from smelter.plans.gold import COPIES, customer_rows, product_rows
from smelter.schemas import EXTRACTS, GOLD, SILVER
from smelter.session import run_together
from smelter.sources.tables import Warehouse


def keys_of(dimension: str) -> str:
    """The stored key map of a dimension."""
    return f"{dimension}_keys"


def store_keys(warehouse: Warehouse) -> None:
    """Give keys to the members of both dimensions that have none yet; all others keep theirs."""
    silver = {t: warehouse.read(SILVER, t) for t in EXTRACTS}
    customers = customer_rows(silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"])
    products = product_rows(silver["crm_prd_info"], silver["erp_px_cat_g1v2"])

    def extend(dimension: str, rows, id_column: str) -> None:
        name = keys_of(dimension)
        if not warehouse.exists(GOLD, name):
            warehouse.create_table(GOLD, name, MAP_SCHEMA)
        warehouse.append(GOLD, name, lacking_keys(members(rows, id_column, COPIES), warehouse.read(GOLD, name)), MAP_SCHEMA.names)

    run_together(warehouse.spark, [partial(extend, "dim_customers", customers, "cust_id"), partial(extend, "dim_products", products, "prd_id")])


def create_live_views(warehouse: Warehouse) -> None:
    """The three gold objects as views over silver and the key maps."""
    for table in (keys_of("dim_customers"), keys_of("dim_products")):
        if not warehouse.exists(GOLD, table):
            warehouse.create_table(GOLD, table, MAP_SCHEMA)
    for view, text in (("dim_customers", _customers(warehouse)), ("dim_products", _products(warehouse)), ("fact_sales", _fact(warehouse))):
        warehouse.spark.sql(f"CREATE OR REPLACE VIEW {warehouse.name(GOLD, view)} AS {text}")


def _keyed(rows: str, columns: dict[str, str], id_column: str, key_column: str, key_map: str) -> str:
    """The rows with their keys: stored ones, and after the greatest those of members without one."""
    listed = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    names = ", ".join(columns)
    return f"""
WITH numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {id_column} ORDER BY XXHASH64({names}), {names}) AS _copy FROM (SELECT {listed} FROM {rows})),
keyed AS (
  SELECT n.*, m.key AS _key FROM numbered n LEFT JOIN {key_map} m ON m.id <=> CAST(n.{id_column} AS BIGINT) AND m.copy = n._copy)
SELECT _key AS {key_column}, {names} FROM keyed WHERE _key IS NOT NULL
UNION ALL
SELECT (SELECT COALESCE(MAX(key), 0) FROM {key_map}) + ROW_NUMBER() OVER (ORDER BY {id_column} NULLS FIRST, _copy), {names}
FROM keyed WHERE _key IS NULL"""


def _customers(warehouse: Warehouse) -> str:
    c, e, a = (warehouse.name(SILVER, t) for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101"))
    rows = f"""{c} c
  LEFT JOIN {e} e ON RTRIM(RIGHT(e.cid, {CUSTOMER_KEY_LENGTH})) = RTRIM(c.cust_key)
  LEFT JOIN {a} a ON RTRIM(REPLACE(a.cid, '-', '')) = RTRIM(c.cust_key)"""
    columns = {
        "customer_id": "c.cust_id",
        "customer_number": "c.cust_key",
        "first_name": "TRIM(c.cust_firstname)",
        "last_name_hash": "UPPER(SHA2(ENCODE(TRIM(c.cust_lastname), 'UTF-16LE'), 256))",
        "marital_status": "c.cust_marital_status",
        "gender": f"COALESCE(NULLIF(c.cust_gender, '{UNKNOWN}'), e.gen)",
        "birth_date": "e.bdate",
        "country": "a.cntry",
        "customer_create_date": "c.cust_create_date",
        "cust_is_future": "c.cust_is_future",
    }
    return _keyed(rows, columns, "customer_id", "customer_key", warehouse.name(GOLD, keys_of("dim_customers")))


def _products(warehouse: Warehouse) -> str:
    p, x = (warehouse.name(SILVER, t) for t in ("crm_prd_info", "erp_px_cat_g1v2"))
    rows = f"{p} p LEFT JOIN {x} x ON RTRIM(x.id) = RTRIM(REPLACE(SUBSTRING(p.prd_key, 1, {CATEGORY_LENGTH}), '-', '_'))"
    labels = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in PRODUCT_LINE.items())
    columns = {
        "product_id": "p.prd_id",
        "product_number": f"SUBSTRING(p.prd_key, {PRODUCT_NUMBER_START})",
        "product_name": "TRIM(p.prd_nm)",
        "product_cost": "COALESCE(p.prd_cost, 0)",
        "product_line": f"CASE UPPER(TRIM(p.prd_line)) {labels} ELSE TRIM(p.prd_line) END",
        "product_start_date": "p.prd_start_dt",
        "product_end_date": "p.prd_end_dt",
        "category": "x.cat",
        "subcategory": "x.subcat",
        "maintenance": "x.maintenance",
    }
    return _keyed(rows, columns, "product_id", "product_key", warehouse.name(GOLD, keys_of("dim_products")))


def _day(column: str) -> str:
    return f"CASE WHEN {column} BETWEEN {FIRST_YEAR_DAY} AND {LAST_YEAR_DAY} THEN TRY_TO_DATE(CAST({column} AS STRING), 'yyyyMMdd') END"


def _fact(warehouse: Warehouse) -> str:
    customers, products = (warehouse.name(GOLD, t) for t in ("dim_customers", "dim_products"))
    return f"""
SELECT sls_ord_num AS order_number, customer_key, product_key, {_day("sls_order_dt")} AS order_date, {_day("sls_ship_dt")} AS ship_date,
  {_day("sls_due_dt")} AS due_date, sls_sales AS sales_amount, sls_quantity AS quantity, sls_price AS price
FROM {warehouse.name(SILVER, "crm_sales_details")} s
  JOIN (SELECT customer_key, customer_id FROM {customers}) c ON c.customer_id = s.sls_cust_id
  JOIN (SELECT product_key, product_number FROM {products}) p ON RTRIM(p.product_number) = RTRIM(s.sls_prd_key)"""
