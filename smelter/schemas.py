"""Declared tables: column names, types and text lengths, in file order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
LAYERS = (BRONZE, SILVER, GOLD)

AUDIT_COLUMN = "dwh_create_date"
FUTURE_COLUMN = "cust_is_future"


@dataclass(frozen=True)
class Extract:
    """One source file: where it lies below the base folder and what its columns are."""

    folder: str
    file: str
    schema: T.StructType
    max_length: dict[str, int]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def path(self, base_path: str) -> str:
        return "/".join([base_path.rstrip("/\\"), self.folder, self.file])


INT, DATE, DATETIME, TEXT = T.IntegerType(), T.DateType(), T.TimestampNTZType(), T.StringType()


def columns_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Source files, column order, types and text lengths.
EXTRACTS: dict[str, Extract] = {
    "crm_cust_info": Extract(
        "source_crm",
        "cst_info.csv",
        columns_of(
            cust_id=INT,
            cust_key=TEXT,
            cust_firstname=TEXT,
            cust_lastname=TEXT,
            cust_marital_status=TEXT,
            cust_gender=TEXT,
            cust_create_date=DATE,
        ),
        {"cust_key": 50, "cust_firstname": 50, "cust_lastname": 50, "cust_marital_status": 50, "cust_gender": 10},
    ),
    "crm_prd_info": Extract(
        "source_crm",
        "prd_info.csv",
        columns_of(
            prd_id=INT,
            prd_key=TEXT,
            prd_nm=TEXT,
            prd_cost=INT,
            prd_line=TEXT,
            prd_start_dt=DATETIME,
            prd_end_dt=DATETIME,
        ),
        {"prd_key": 50, "prd_nm": 50, "prd_line": 50},
    ),
    "crm_sales_details": Extract(
        "source_crm",
        "sales_details.csv",
        columns_of(
            sls_ord_num=TEXT,
            sls_prd_key=TEXT,
            sls_cust_id=INT,
            sls_order_dt=INT,
            sls_ship_dt=INT,
            sls_due_dt=INT,
            sls_sales=INT,
            sls_quantity=INT,
            sls_price=INT,
        ),
        {"sls_ord_num": 50, "sls_prd_key": 50},
    ),
    "erp_cust_az12": Extract(
        "source_erp", "CST_AZ12.csv", columns_of(cid=TEXT, bdate=DATE, gen=TEXT), {"cid": 50, "gen": 10}
    ),
    "erp_loc_a101": Extract("source_erp", "LOC_A101.csv", columns_of(cid=TEXT, cntry=TEXT), {"cid": 50, "cntry": 50}),
    "erp_px_cat_g1v2": Extract(
        "source_erp",
        "PX_CAT_G1V2.csv",
        columns_of(id=TEXT, cat=TEXT, subcat=TEXT, maintenance=TEXT),
        {"id": 50, "cat": 50, "subcat": 50, "maintenance": 50},
    ),
}

GOLD_OBJECTS = ("dim_customers", "dim_products", "fact_sales")


def silver_schema(table: str) -> T.StructType:
    """The extract's columns, the future flag for customers, and the load time."""
    schema = T.StructType(list(EXTRACTS[table].schema.fields))
    if table == "crm_cust_info":
        schema = schema.add(FUTURE_COLUMN, T.IntegerType())
    return schema.add(AUDIT_COLUMN, T.TimestampType())
