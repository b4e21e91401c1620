"""The six source tables, derived from the TPC-H-like test tables.

The test tables are clean, so dirt is added by arithmetic on ids. Each text is valid in Spark SQL and in DuckDB once the
table names are filled in; only the two-versions relation is spelled differently. Numbers are never cut: product numbers
grow beyond their six digits, and customer keys have nine hexadecimal ones, for 68 billion customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession



def padded(text: str, width: int) -> str:
    return f"LPAD({text}, CAST(GREATEST({width}, LENGTH({text})) AS INT), '0')"


CUSTOMER = padded("HEX({c}c_custkey)", 9)
PRODUCT = "CONCAT('P', " + padded("CAST(({p}partkey - {p}partkey % 2) AS STRING)", 6) + ")"
CATEGORY = "CONCAT(CASE p_partkey % 4 WHEN 0 THEN 'AC' WHEN 1 THEN 'CO' WHEN 2 THEN 'BI' ELSE 'XX' END, '{dash}', LPAD(CAST(p_partkey % 37 AS STRING), 2, '0'))"

TEXTS = {
    "crm_cust_info": """
SELECT CASE WHEN c.c_custkey % 97 = 0 THEN NULL ELSE CAST(c.c_custkey AS INT) END AS cust_id,
  CONCAT('A', """ + CUSTOMER.format(c="c.") + """, CASE WHEN c.c_custkey % 31 = 0 THEN ' ' ELSE '' END) AS cust_key,
  CONCAT(CASE WHEN c.c_custkey % 7 = 0 THEN '  ' ELSE '' END, c.c_mktsegment,
    CASE WHEN c.c_custkey % 5 = 0 THEN ' ' ELSE '' END) AS cust_firstname,
  CONCAT(c.c_name, CASE WHEN c.c_custkey % 3 = 0 THEN ' ' ELSE '' END) AS cust_lastname,
  CASE c.c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 's ' WHEN 2 THEN NULL ELSE 'X' END AS cust_marital_status,
  CASE c.c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN ' m' WHEN 2 THEN 'M' WHEN 3 THEN NULL ELSE '' END AS cust_gender,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS cust_create_date,
  o.o_orderkey AS src_seq
FROM {customer} c LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey""",
    "crm_prd_info": """
SELECT CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE CAST(p_partkey AS INT) END AS prd_id,
  CONCAT(""" + CATEGORY.format(dash="-") + """, '-', """ + PRODUCT.format(p="p_") + """) AS prd_key,
  CONCAT(p_name, CASE WHEN p_partkey % 9 = 0 THEN ' ' ELSE '' END) AS prd_nm,
  CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN -5 ELSE CAST(FLOOR(p_retailprice) AS INT) END
    AS prd_cost,
  CASE p_partkey % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'R ' WHEN 2 THEN 's' WHEN 3 THEN 'T' WHEN 4 THEN NULL
    ELSE ' Custom ' END AS prd_line,
  CASE n WHEN 0 THEN CAST('2011-07-01' AS DATE) ELSE CAST('2013-07-01' AS DATE) END AS prd_start_dt,
  CASE p_partkey % 3 WHEN 0 THEN CAST('2007-12-28' AS DATE) WHEN 1 THEN CAST('2014-06-30' AS DATE) ELSE NULL END
    AS prd_end_dt
FROM {part} {versions}
WHERE n = 0 OR p_partkey % 25 = 0""",
    "crm_sales_details": """
SELECT CONCAT('SO', CAST(l_orderkey AS STRING)) AS sls_ord_num,
  CASE WHEN l_partkey % 60 = 0 THEN 'P-NONE'
    ELSE """ + PRODUCT.format(p="l_") + """ END AS sls_prd_key,
  CAST(CASE WHEN l_orderkey % 50 = 0 THEN -1 ELSE o_custkey END AS INT) AS sls_cust_id,
  CASE WHEN l_orderkey % 40 = 0 THEN 0 WHEN l_orderkey % 41 = 0 THEN 32154
    ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) END AS sls_order_dt,
  CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) AS sls_ship_dt,
  CAST(CASE WHEN l_orderkey % 43 = 0 THEN 0 ELSE year(CAST(l_shipdate AS DATE) + 7) * 10000
    + month(CAST(l_shipdate AS DATE) + 7) * 100 + day(CAST(l_shipdate AS DATE) + 7) END AS INT) AS sls_due_dt,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(FLOOR(l_extendedprice / l_quantity) * l_quantity AS INT) END
    AS sls_sales,
  CAST(l_quantity AS INT) AS sls_quantity,
  CASE WHEN l_linenumber = 6 THEN -1 ELSE CAST(FLOOR(l_extendedprice / l_quantity) AS INT) END AS sls_price
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey""",
    "erp_cust_az12": """
SELECT CONCAT(CASE WHEN c_custkey % 10 = 9 THEN 'NASX' ELSE 'NASA' END, """ + CUSTOMER.format(c="") + """) AS cid,
  CASE c_custkey % 40 WHEN 0 THEN CAST('1916-02-10' AS DATE) WHEN 1 THEN CAST('2999-01-01' AS DATE) WHEN 2 THEN NULL
    ELSE CAST('1971-10-06' AS DATE) END AS bdate,
  CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE NULL END AS gen
FROM {customer}""",
    "erp_loc_a101": """
SELECT CONCAT(CASE WHEN c_custkey % 10 = 8 THEN 'X-' ELSE 'A-' END, """ + CUSTOMER.format(c="") + """) AS cid,
  CASE WHEN c_custkey % 11 = 0 THEN '' ELSE n_name END AS cntry
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey""",
    "erp_px_cat_g1v2": """
SELECT DISTINCT CONCAT(CASE WHEN p_partkey % 4 = 3 THEN 'Z' ELSE '' END, """ + CATEGORY.format(dash="_") + """) AS id,
  CASE p_partkey % 4 WHEN 0 THEN 'Accessories' WHEN 1 THEN 'Components' WHEN 2 THEN 'Bikes' ELSE 'Clothing' END AS cat,
  CONCAT(CASE WHEN p_partkey % 37 % 5 = 0 THEN ' ' ELSE '' END, 'Line ', CAST(p_partkey % 37 AS STRING)) AS subcat,
  CONCAT(CASE p_partkey % 37 % 2 WHEN 0 THEN 'Yes' ELSE 'No' END,
    CASE WHEN p_partkey % 37 % 7 = 0 THEN ' ' ELSE '' END) AS maintenance
FROM {part}""",
}

INPUTS = {
    "crm_cust_info": ("customer", "orders"),
    "crm_prd_info": ("part",),
    "crm_sales_details": ("lineitem", "orders"),
    "erp_cust_az12": ("customer",),
    "erp_loc_a101": ("customer", "nation"),
    "erp_px_cat_g1v2": ("part",),
}

TIE = ["src_seq"]  # not a source column: orders customer records of one date


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One bronze table, as a plan over the test tables."""
    text = TEXTS[table].replace("{versions}", "LATERAL VIEW explode(array(0, 1)) v AS n")
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in INPUTS[table]})


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six bronze tables, without the tie-breaking column."""
    return {t: source(spark, sf_dir, t).drop(*TIE) for t in TEXTS}


def duckdb_text(table: str) -> str:
    names = {t: t for t in INPUTS[table]}
    return TEXTS[table].format(versions="CROSS JOIN (VALUES (0), (1)) AS v(n)", **names)
