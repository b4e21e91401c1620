"""Silver tables: cleansed and standardised rows, without the load time (the sink adds it)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions.cleansing import (
    GENDER,
    MARITAL_STATUS,
    PRODUCT_LINE,
    UNKNOWN,
    code_label,
    end_or_null,
    future_flag,
    number_or_default,
)
from smelter.functions.keys import comparable, product_number
from smelter.operators.latest import latest_record
from smelter.plans.profiles import PRODUCTION, Profile
from smelter.schemas import EXTRACTS, FUTURE_COLUMN


def silver_customers(bronze: DataFrame, as_of: dt.date | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Latest record per customer, names trimmed, codes spelled out, future dates flagged."""
    return latest_record(bronze, "cust_id", "cust_create_date", ties).select(
        "cust_id",
        "cust_key",
        F.trim("cust_firstname").alias("cust_firstname"),
        F.trim("cust_lastname").alias("cust_lastname"),
        code_label(F.col("cust_marital_status"), MARITAL_STATUS, UNKNOWN).alias("cust_marital_status"),
        code_label(F.col("cust_gender"), GENDER, UNKNOWN).alias("cust_gender"),
        "cust_create_date",
        future_flag(F.col("cust_create_date"), as_of).alias(FUTURE_COLUMN),
    )


def silver_products(bronze: DataFrame, profile: Profile = PRODUCTION, ties: Sequence[str] = ()) -> DataFrame:
    """Products with repaired costs and date ranges.

    Production keeps the latest record per product, trims the key and spells out the product line; CI keeps every row
    with its key and its trimmed line code.
    """
    production = profile.latest_products_only
    rows = latest_record(bronze, "prd_id", "prd_start_dt", ties) if production else bronze
    line = F.col("prd_line")
    return rows.select(
        "prd_id",
        F.trim("prd_key").alias("prd_key") if production else "prd_key",
        F.trim("prd_nm").alias("prd_nm"),
        number_or_default(F.col("prd_cost"), profile.lowest_cost, profile.default_cost).alias("prd_cost"),
        (code_label(line, PRODUCT_LINE) if profile.label_product_lines else F.trim(line)).alias("prd_line"),
        "prd_start_dt",
        end_or_null(F.col("prd_start_dt"), F.col("prd_end_dt")).alias("prd_end_dt"),
    )


def silver_sales(
    bronze: DataFrame, products: DataFrame, customers: DataFrame, profile: Profile = PRODUCTION
) -> DataFrame:
    """Sales of existing products by existing customers; ``products`` and ``customers`` are silver tables.

    Production keeps each sale once. CI repeats a sale for every version of its product, as an inner join does.
    """
    numbers = products.select(comparable(product_number(F.col("prd_key"))).alias("_number"))
    how = "inner" if profile.sales_per_product_version else "left_semi"
    sold = bronze.join(numbers, comparable(bronze.sls_prd_key) == numbers._number, how)
    return sold.join(customers, sold.sls_cust_id == customers.cust_id, "left_semi").select(
        *EXTRACTS["crm_sales_details"].columns
    )


def silver_passthrough(bronze: DataFrame, table: str) -> DataFrame:
    """The ERP tables go through as they are."""
    return bronze.select(*EXTRACTS[table].columns)


def silver_layer(
    bronze: dict[str, DataFrame], as_of: dt.date | None = None, profile: Profile = PRODUCTION
) -> dict[str, DataFrame]:
    """All six silver tables from the six bronze ones."""
    customers = silver_customers(bronze["crm_cust_info"], as_of)
    products = silver_products(bronze["crm_prd_info"], profile)
    return {
        "crm_cust_info": customers,
        "crm_prd_info": products,
        "crm_sales_details": silver_sales(bronze["crm_sales_details"], products, customers, profile),
        **{t: silver_passthrough(bronze[t], t) for t in ("erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2")},
    }
