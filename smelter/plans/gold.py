"""Gold star: two dimensions with dense surrogate keys and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions.cleansing import PRODUCT_LINE, code_label, known_or
from smelter.functions.dates import int_to_date
from smelter.functions.keys import (
    category_id,
    comparable,
    customer_key_of_dashed,
    customer_key_of_suffix,
    product_number,
    pseudonym,
)
from smelter.operators.latest import latest_record
from smelter.operators.surrogate import collapse_copies, surrogate_key

COPIES = "_copies"


def _lookup(table: DataFrame, key, *columns: str) -> DataFrame:
    """Distinct ``(_key, columns)`` with their number of copies, so that a key held by much of the table is one row."""
    return collapse_copies(table.select(comparable(key).alias("_key"), *columns).filter(F.col("_key").isNotNull()), "_n")


def _left_join_counted(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join that multiplies the row's copies instead of repeating the row."""
    joined = df.join(lookup, comparable(df[key]) == lookup._key, "left")
    return joined.withColumn(COPIES, F.col(COPIES) * F.coalesce("_n", F.lit(1))).drop("_key", "_n")


def customer_rows(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers with their ERP columns, and the number of rows of the dimension that each stands for."""
    base = customers.select(
        "cust_id",
        "cust_key",
        F.trim("cust_firstname").alias("cust_firstname"),
        F.trim("cust_lastname").alias("cust_lastname"),
        "cust_marital_status",
        "cust_gender",
        "cust_create_date",
        "cust_is_future",
        F.lit(1).cast("bigint").alias(COPIES),
    )
    base = _left_join_counted(
        base, _lookup(demographics, customer_key_of_suffix(F.col("cid")), "bdate", "gen"), "cust_key"
    )
    return _left_join_counted(base, _lookup(locations, customer_key_of_dashed(F.col("cid")), "cntry"), "cust_key")


def dim_customers(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers with ERP birth date, gender and country; the last name as a hash.

    One row per customer, or one per match where an ERP table repeats a customer.
    """
    base = customer_rows(customers, demographics, locations)
    return surrogate_key(base, "cust_id", "customer_key", COPIES).select(
        "customer_key",
        F.col("cust_id").alias("customer_id"),
        F.col("cust_key").alias("customer_number"),
        F.col("cust_firstname").alias("first_name"),
        pseudonym(F.col("cust_lastname")).alias("last_name_hash"),
        F.col("cust_marital_status").alias("marital_status"),
        known_or(F.col("cust_gender"), F.col("gen")).alias("gender"),
        F.col("bdate").alias("birth_date"),
        F.col("cntry").alias("country"),
        F.col("cust_create_date").alias("customer_create_date"),
        "cust_is_future",
    )


def product_rows(products: DataFrame, categories: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Products with their category, and the number of rows of the dimension that each stands for."""
    base = products.select(
        "prd_id",
        "prd_key",
        F.trim("prd_nm").alias("prd_nm"),
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        code_label(F.col("prd_line"), PRODUCT_LINE).alias("prd_line"),
        "prd_start_dt",
        "prd_end_dt",
        category_id(F.col("prd_key")).alias("_category"),
    )
    base = base.withColumn(COPIES, F.lit(1).cast("bigint")) if unique_ids else collapse_copies(base, COPIES)
    return _left_join_counted(base, _lookup(categories, F.col("id"), "cat", "subcat", "maintenance"), "_category")


def dim_products(
    products: DataFrame, categories: DataFrame, current_version_only: bool = False, unique_ids: bool = False
) -> DataFrame:
    """Products with their category.

    A product number may have several versions, each a row with its own key, so a fact repeats a sale per version.
    ``current_version_only`` keeps the latest version of each number, under the same key as in the full dimension.
    ``unique_ids`` says that no product id repeats, as in a build of latest records; copies then needn't be counted.
    """
    base = product_rows(products, categories, unique_ids)
    dimension = surrogate_key(base, "prd_id", "product_key", COPIES).select(
        "product_key",
        F.col("prd_id").alias("product_id"),
        product_number(F.col("prd_key")).alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("prd_cost").alias("product_cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("product_start_date"),
        F.col("prd_end_dt").alias("product_end_date"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
    )
    if not current_version_only:
        return dimension
    return latest_record(dimension, "product_number", "product_start_date", ["product_key"])


def fact_sales(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with the dimensions' keys; a sale is repeated for every version of its product.

    Customers come first: that shuffle then carries each sale once. The product dimension is the one that may fit a
    broadcast, which Spark decides by its size; it then needs no further shuffle.
    """
    c = customers.select("customer_key", "customer_id")
    p = products.select("product_key", "product_number")
    return (
        sales.join(c, sales.sls_cust_id == c.customer_id)
        .join(p, comparable(sales.sls_prd_key) == comparable(p.product_number))
        .select(
            F.col("sls_ord_num").alias("order_number"),
            "customer_key",
            "product_key",
            int_to_date(F.col("sls_order_dt")).alias("order_date"),
            int_to_date(F.col("sls_ship_dt")).alias("ship_date"),
            int_to_date(F.col("sls_due_dt")).alias("due_date"),
            F.col("sls_sales").alias("sales_amount"),
            F.col("sls_quantity").alias("quantity"),
            F.col("sls_price").alias("price"),
        )
    )


def gold_layer(silver: dict[str, DataFrame], unique_ids: bool = False) -> dict[str, DataFrame]:
    """The three gold objects from the six silver tables."""
    customers = dim_customers(silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"])
    products = dim_products(silver["crm_prd_info"], silver["erp_px_cat_g1v2"], unique_ids=unique_ids)
    return {
        "dim_customers": customers,
        "dim_products": products,
        "fact_sales": fact_sales(silver["crm_sales_details"], customers, products),
    }


def sales_by_country_and_category(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per customer country and product category.

    The fact is first summed by its two keys, so each later join moves one row per key pair instead of one per sale.
    """
    pairs = fact.groupBy("customer_key", "product_key").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("sales_amount").alias("sales"),
        F.sum("quantity").alias("quantity"),
    )
    return (
        pairs.join(customers.select("customer_key", "country"), "customer_key")
        .join(products.select("product_key", "category"), "product_key")
        .groupBy("country", "category")
        .agg(
            F.sum("lines").alias("order_lines"),
            F.sum("sales").alias("sales_amount"),
            F.sum("quantity").alias("quantity"),
        )
    )
