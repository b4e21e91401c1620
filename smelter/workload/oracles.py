"""The same queries as plain SQL for DuckDB, by query name."""

from __future__ import annotations

from smelter.schemas import EXTRACTS
from smelter.workload.adapters import TEXTS, duckdb_text

ERP = ("erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2")

# ---- cleansed tables as common table expressions -------------------------------------------------------------

LABELS = {
    "marital": "CASE UPPER(TRIM({c})) WHEN 'M' THEN 'Married' WHEN 'S' THEN 'Single' ELSE 'n/a' END",
    "gender": "CASE UPPER(TRIM({c})) WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'n/a' END",
    "line": "CASE UPPER(TRIM({c})) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales' "
    "WHEN 'T' THEN 'Touring' ELSE TRIM({c}) END",
}
MARITAL = LABELS["marital"].format(c="cust_marital_status")
GENDER = LABELS["gender"].format(c="cust_gender")
LINE = LABELS["line"].format(c="prd_line")
FUTURE = "CAST(CASE WHEN cust_create_date > DATE '2000-01-01' THEN 1 ELSE 0 END AS INTEGER)"
END = "CASE WHEN prd_end_dt < prd_start_dt THEN NULL ELSE prd_end_dt END"
COST = "CASE WHEN prd_cost IS NULL OR prd_cost < 0 THEN 0 ELSE prd_cost END"
COST_CI = "CASE WHEN prd_cost IS NULL OR prd_cost <= 0 THEN 1 ELSE prd_cost END"


def hashed(c: str) -> str:
    """SHA-256 of the UTF-16LE bytes; right for ASCII text, which the test names are."""
    return rf"upper(sha256(unhex(regexp_replace(hex(encode({c})), '(..)', '\100', 'g'))))"


def as_date(c: str) -> str:
    return f"CAST(try_strptime(CAST(NULLIF({c}, 0) AS VARCHAR), '%Y%m%d') AS DATE)"


LATEST_CUSTOMER = """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id
  ORDER BY cust_create_date DESC NULLS LAST, src_seq DESC NULLS LAST) AS rn FROM crm_cust_info{where}) WHERE rn = 1"""
LATEST_PRODUCT = """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY prd_id
  ORDER BY prd_start_dt DESC NULLS LAST, prd_key DESC NULLS LAST, prd_nm DESC NULLS LAST, prd_cost DESC NULLS LAST,
  prd_line DESC NULLS LAST, prd_end_dt DESC NULLS LAST) AS rn FROM crm_prd_info WHERE prd_id IS NOT NULL) WHERE rn = 1"""
LATEST_CUSTOMER_NULL = LATEST_CUSTOMER.format(where="")
LATEST_CUSTOMER = LATEST_CUSTOMER.format(where=" WHERE cust_id IS NOT NULL")

CLEAN_CUSTOMER_COLUMNS = f"""cust_id, cust_key, TRIM(cust_firstname) AS cust_firstname,
  TRIM(cust_lastname) AS cust_lastname, {MARITAL} AS cust_marital_status, {GENDER} AS cust_gender, cust_create_date,
  {FUTURE} AS cust_is_future"""

DERIVED = {
    "s_cust": f"SELECT {CLEAN_CUSTOMER_COLUMNS} FROM ({LATEST_CUSTOMER})",
    "s_prd": f"""SELECT prd_id, TRIM(prd_key) AS prd_key, TRIM(prd_nm) AS prd_nm, {COST} AS prd_cost, {LINE} AS prd_line,
  prd_start_dt, {END} AS prd_end_dt FROM ({LATEST_PRODUCT})""",
    "s_prd_ci": f"""SELECT prd_id, prd_key, TRIM(prd_nm) AS prd_nm, {COST_CI} AS prd_cost, TRIM(prd_line) AS prd_line,
  prd_start_dt, {END} AS prd_end_dt FROM crm_prd_info""",
    "s_sales": """SELECT s.* FROM crm_sales_details s
  WHERE EXISTS (SELECT 1 FROM s_prd p WHERE RTRIM(SUBSTRING(p.prd_key, 7)) = RTRIM(s.sls_prd_key))
  AND EXISTS (SELECT 1 FROM s_cust c WHERE c.cust_id = s.sls_cust_id)""",
    "s_sales_ci": """SELECT s.* FROM crm_sales_details s JOIN s_prd_ci p ON RTRIM(SUBSTRING(p.prd_key, 7)) = RTRIM(s.sls_prd_key)
  WHERE EXISTS (SELECT 1 FROM s_cust c WHERE c.cust_id = s.sls_cust_id)""",
    "g_cust": f"""SELECT ROW_NUMBER() OVER (ORDER BY cust_id NULLS FIRST) AS customer_key, cust_id AS customer_id,
  cust_key AS customer_number, TRIM(cust_firstname) AS first_name, {hashed("TRIM(cust_lastname)")} AS last_name_hash,
  cust_marital_status AS marital_status, COALESCE(NULLIF(cust_gender, 'n/a'), gen) AS gender, bdate AS birth_date,
  cntry AS country, cust_create_date AS customer_create_date, cust_is_future
FROM s_cust c LEFT JOIN erp_cust_az12 e ON RTRIM(RIGHT(e.cid, 10)) = RTRIM(c.cust_key)
  LEFT JOIN erp_loc_a101 l ON RTRIM(REPLACE(l.cid, '-', '')) = RTRIM(c.cust_key)""",
    "g_fact": f"""SELECT sls_ord_num AS order_number, customer_key, product_key, {as_date("sls_order_dt")} AS order_date,
  {as_date("sls_ship_dt")} AS ship_date, {as_date("sls_due_dt")} AS due_date, sls_sales AS sales_amount,
  sls_quantity AS quantity, sls_price AS price
FROM s_sales JOIN g_cust ON customer_id = sls_cust_id JOIN g_prd ON RTRIM(product_number) = RTRIM(sls_prd_key)""",
    "g_prd_now": """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_number
  ORDER BY product_start_date DESC NULLS LAST, product_key DESC) AS rn FROM g_prd) WHERE rn = 1""",
}
for suffix in ("", "_ci"):
    DERIVED[f"g_prd{suffix}"] = f"""SELECT ROW_NUMBER() OVER (ORDER BY prd_id NULLS FIRST) AS product_key,
  prd_id AS product_id, SUBSTRING(prd_key, 7) AS product_number, TRIM(prd_nm) AS product_name,
  COALESCE(prd_cost, 0) AS product_cost, {LINE} AS product_line, prd_start_dt AS product_start_date,
  prd_end_dt AS product_end_date, cat AS category, subcat AS subcategory, maintenance
FROM s_prd{suffix} LEFT JOIN erp_px_cat_g1v2 ON RTRIM(id) = RTRIM(REPLACE(SUBSTRING(prd_key, 1, 5), '-', '_'))"""

def sql(body: str, *names: str) -> str:
    """The query with the named derived tables and all source tables before it."""
    tables = {t: duckdb_text(t).strip() for t in TEXTS} | {n: DERIVED[n] for n in names}
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in tables.items()) + "\n" + body


def records(tables: dict[str, tuple[str, list[str]]]) -> str:
    """``(table_name, record)`` of each relation, with the given field expressions joined into one text."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, CONCAT_WS('|', "
        + ", ".join(f"COALESCE(CAST({e} AS VARCHAR), '~')" for e in fields)
        + f") AS record FROM {relation}"
        for name, (relation, fields) in tables.items()
    )


def stored(table: str, text_rule: str = "{c}") -> list[str]:
    """Field expressions of a source table in its declared types, with a rule for text columns."""
    fields = []
    for f in EXTRACTS[table].schema.fields:
        kind = f.dataType.simpleString()
        rules = {"string": text_rule.format(c=f.name), "timestamp_ntz": f"CAST({f.name} AS TIMESTAMP)"}
        fields.append(rules.get(kind, f.name))
    return fields


def union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


# ---- gate ----------------------------------------------------------------------------------------------------


def check(layer: str, table: str, name: str, count: str, fails: bool) -> str:
    severity = "error" if fails else "warning"
    failed = "CAST(CASE WHEN n > 0 THEN 1 ELSE 0 END AS INTEGER)" if fails else "0"
    return (
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS check_name, '{severity}' AS severity, "
        f"n AS violations, {failed} AS failed FROM (SELECT CAST({count} AS BIGINT) AS n)"
    )


def counted(relation: str, where: str) -> str:
    return f"(SELECT COUNT(*) FROM {relation} WHERE {where})"


def gate(
    bad_cost: str, products: str, sales: str, gold_products: str, fact: str, customers: str = "s_cust", missing: str = "",
    rejected: str = "",
) -> str:
    """Gate results; ``missing`` names a gold object that isn't there, ``rejected`` counts the load's broken rows."""
    parts = [] if not rejected else [check("bronze", "load_rejects", "rejected rows", rejected, False)]
    parts += [
        check(
            "bronze",
            "crm_cust_info",
            "duplicate or null key",
            "(SELECT COUNT(*) FROM (SELECT cust_id FROM crm_cust_info GROUP BY cust_id "
            "HAVING COUNT(*) > 1 OR cust_id IS NULL))",
            False,
        ),
        check(
            "bronze",
            "crm_prd_info",
            "bad cost",
            counted("crm_prd_info", "prd_cost IS NULL OR prd_cost <= 0"),
            False,
        ),
        check(
            "bronze", "crm_prd_info", "end before start", counted("crm_prd_info", "prd_end_dt < prd_start_dt"), False
        ),
        check(
            "bronze",
            "crm_sales_details",
            "sales differ from quantity times price",
            counted("crm_sales_details", "sls_sales <> CAST(sls_quantity AS BIGINT) * sls_price"),
            False,
        ),
        check(
            "bronze",
            "erp_cust_az12",
            "birth date out of range",
            counted("erp_cust_az12", "bdate < DATE '1924-01-01' OR bdate > DATE '2026-01-01'"),
            False,
        ),
        check(
            "silver",
            "crm_cust_info",
            "null key",
            f"(SELECT COUNT(DISTINCT 1) FROM {customers} WHERE cust_id IS NULL)",
            True,
        ),
        check(
            "silver",
            "crm_cust_info",
            "duplicate key",
            f"(SELECT COUNT(*) FROM (SELECT cust_id FROM {customers} GROUP BY cust_id HAVING COUNT(*) > 1))",
            True,
        ),
        check("silver", "crm_prd_info", "bad cost", counted(products, f"prd_cost IS NULL OR {bad_cost}"), True),
        check("silver", "crm_prd_info", "end before start", counted(products, "prd_end_dt < prd_start_dt"), True),
        check(
            "silver",
            "crm_sales_details",
            "without customer",
            f"(SELECT COUNT(*) FROM {sales} WHERE NOT EXISTS (SELECT 1 FROM {customers} c WHERE c.cust_id = sls_cust_id))",
            True,
        ),
        check(
            "silver",
            "crm_sales_details",
            "without product",
            f"(SELECT COUNT(*) FROM {sales} WHERE NOT EXISTS (SELECT 1 FROM {products} p "
            "WHERE RTRIM(SUBSTRING(p.prd_key, 7)) = RTRIM(sls_prd_key)))",
            True,
        ),
    ]
    for layer, table in [("silver", t) for t in ("crm_cust_info", "crm_prd_info", "crm_sales_details")] + [
        ("gold", t) for t in ("dim_customers", "dim_products", "fact_sales")
    ]:
        parts.append(check(layer, table, "missing", "1" if table == missing else "0", True))
    for table, relation in (("dim_customers", "g_cust"), ("dim_products", gold_products), ("fact_sales", fact)):
        if table == missing:
            continue
        empty = f"(SELECT CASE WHEN EXISTS (SELECT 1 FROM {relation}) THEN 0 ELSE 1 END)"
        parts.append(check("gold", table, "no rows", empty, True))
    return union(*parts)


# ---- suite ---------------------------------------------------------------------------------------------------


def suite(customers: str, products: str, sales: str) -> str:
    counts = {
        "customer_key": f"(SELECT cust_id FROM {customers} GROUP BY cust_id HAVING COUNT(*) > 1 OR cust_id IS NULL)",
        "customer_key_untrimmed": f"{customers} WHERE cust_key <> TRIM(cust_key)",
        "product_key": f"(SELECT prd_id FROM {products} GROUP BY prd_id HAVING COUNT(*) > 1 OR prd_id IS NULL)",
        "product_name_untrimmed": f"{products} WHERE prd_nm <> TRIM(prd_nm)",
        "product_cost": f"{products} WHERE prd_cost < 0 OR prd_cost IS NULL",
        "product_range": f"{products} WHERE prd_end_dt < prd_start_dt",
        "sales_due_date": f"{sales} WHERE {INVALID_DUE}",
        "sales_date_order": f"{sales} WHERE sls_order_dt > sls_ship_dt OR sls_order_dt > sls_due_dt",
        "sales_amount": f"(SELECT DISTINCT sls_sales, sls_quantity, sls_price FROM {sales} WHERE {INCONSISTENT})",
        "birth_date": f"(SELECT DISTINCT bdate FROM erp_cust_az12 WHERE {ODD_BIRTH})",
        "category_untrimmed": f"erp_px_cat_g1v2 WHERE {UNTRIMMED_CATEGORY}",
    }
    return union(*[f"SELECT '{n}' AS check_name, COUNT(*) AS violations FROM {r}" for n, r in counts.items()])


INVALID_DUE = (
    "sls_due_dt <= 0 OR LENGTH(CAST(sls_due_dt AS VARCHAR)) <> 8 OR sls_due_dt > 20500101 OR sls_due_dt < 19000101"
)
INCONSISTENT = (
    "sls_sales <> CAST(sls_quantity AS BIGINT) * sls_price OR sls_sales IS NULL OR sls_quantity IS NULL "
    "OR sls_price IS NULL OR sls_sales <= 0 OR sls_quantity <= 0 OR sls_price <= 0"
)
ODD_BIRTH = "bdate < DATE '1924-01-01' OR bdate > DATE '2026-01-01'"
UNTRIMMED_CATEGORY = "cat <> TRIM(cat) OR subcat <> TRIM(subcat) OR maintenance <> TRIM(maintenance)"

S_ALL = ("s_cust", "s_prd", "s_sales")
STAR = (*S_ALL, "g_cust", "g_prd", "g_fact")
COUNTS = {t: f"(SELECT COUNT(*) FROM {t})" for t in TEXTS}

DERIVED["g_cust_more"] = f"""SELECT * FROM g_cust UNION ALL
SELECT (SELECT COUNT(*) FROM g_cust) + ROW_NUMBER() OVER (ORDER BY -s_suppkey), CAST(-s_suppkey AS INT), CONCAT('S', CAST(s_suppkey AS VARCHAR)),
  TRIM(s_name), {hashed("TRIM(s_name)")}, 'n/a', NULL, NULL, NULL, NULL, CAST(0 AS INT) FROM supplier"""
DERIVED["g_fact_ci"] = DERIVED["g_fact"].replace("FROM s_sales ", "FROM s_sales_ci ").replace("g_prd", "g_prd_ci")

DISCONNECTED = """SELECT f.*, CAST(CASE WHEN c.customer_key IS NULL THEN 1 ELSE 0 END AS INTEGER) AS no_customer,
  CAST(CASE WHEN p.product_key IS NULL THEN 1 ELSE 0 END AS INTEGER) AS no_product
FROM g_fact f LEFT JOIN g_cust c ON c.customer_key = f.customer_key LEFT JOIN {products} p
  ON p.product_key = f.product_key
WHERE p.product_key IS NULL OR c.customer_key IS NULL"""

REPEATED = "SELECT {key}, COUNT(*) AS row_count FROM {table} GROUP BY {key} HAVING COUNT(*) > 1"

CLEAN_FIELDS = {
    t: stored(t, "TRIM({c})") for t in EXTRACTS if t != "crm_cust_info"
}

DERIVED["results"] = gate(
    "prd_cost < 0", "crm_prd_info", "crm_sales_details", "(SELECT 1 WHERE false)", "crm_sales_details", "crm_cust_info",
    "dim_customers", "(SELECT COUNT(*) FROM crm_cust_info WHERE cust_id % 10 = 0)",
)
VERDICT = """SELECT '*', '*', 'failed checks', 'error', CAST(SUM(failed) AS BIGINT), CAST(LEAST(SUM(failed), 1) AS INTEGER)
FROM results"""

# Labels are no codes, so cleaning them again makes them unknown.
UNLABELLED = [f"CASE WHEN {c} IN ('M', 'S', 'F') THEN 'never' ELSE 'n/a' END" for c in ("cust_marital_status", "cust_gender")]

REJECTED = "(SELECT COUNT(*) FROM crm_cust_info WHERE cust_id % 10 = 0)"
LOAD_FAILED = union(
    f"SELECT 'crm_cust_info' AS table_name, {COUNTS['crm_cust_info']} - {REJECTED} AS rows_loaded, {REJECTED} AS rows_rejected, "
    f"'REJECTS' AS status, CAST(NULL AS VARCHAR) AS error_condition, {COUNTS['crm_cust_info']} - {REJECTED} AS rows_held",
    *[
        f"SELECT '{t}', {COUNTS[t]}, 0, 'LOADED', NULL, {COUNTS[t]}"
        for t in TEXTS if t not in ("crm_cust_info", "erp_loc_a101")
    ],
    "SELECT 'erp_loc_a101', 0, 0, 'FAILED', 'PATH_NOT_FOUND', 0",
    f"SELECT '*', {' + '.join(c for t, c in COUNTS.items() if t != 'erp_loc_a101')} - {REJECTED}, {REJECTED}, 'FAILED', NULL, {REJECTED}",
)

LOAD_AUDIT = union(
    *[f"SELECT '{t}' AS table_name, {n} AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected, 'LOADED' AS status, true AS timed"
      for t, n in COUNTS.items()],
    f"SELECT '*', {' + '.join(COUNTS.values())}, CAST(0 AS BIGINT), 'LOADED', true",
)
AUDITED = (f"({LOAD_AUDIT})", ["table_name", "rows_loaded", "rows_rejected", "status"])
CHECKED = ["layer", "table_name", "check_name", "severity", "violations", "failed"]
GOLD_FIELDS = {
    "dim_customers": (
        "g_cust",
        ["customer_key", "customer_id", "customer_number", "first_name", "last_name_hash", "marital_status", "gender",
         "birth_date", "country", "customer_create_date", "cust_is_future"],
    ),
    "dim_products": (
        "g_prd",
        ["product_key", "product_id", "product_number", "product_name", "product_cost", "product_line",
         "CAST(product_start_date AS TIMESTAMP)", "CAST(product_end_date AS TIMESTAMP)", "category", "subcategory",
         "maintenance"],
    ),
    "fact_sales": (
        "g_fact",
        ["order_number", "customer_key", "product_key", "order_date", "ship_date", "due_date", "sales_amount", "quantity",
         "price"],
    ),
}


def from_extracts(text: str) -> str:
    """A query over tables that went through extracts, which hold no empty text."""
    loc = duckdb_text("erp_loc_a101").strip()
    return text.replace(loc, f"SELECT cid, NULLIF(cntry, '') AS cntry FROM ({loc})", 1)


def ran(gate_text: str) -> tuple[str, list[str]]:
    """Gate results of a run as of the flag's date."""
    return f"({gate_text.replace('2026-01-01', '2000-01-01')})", CHECKED


STORED = [f"bronze.{t}" for t in (*EXTRACTS, "load_audit", "load_rejects")] + [f"silver.{t}" for t in EXTRACTS]
STORED += [f"gold.{t}" for name in GOLD_FIELDS for t in (name, f"{name}_rows")]

ORACLES: dict[str, str] = {
    # sources, sinks and tables
    "bronze_csv_roundtrip": sql(records({t: (t, stored(t, "NULLIF({c}, '')")) for t in EXTRACTS})),
    "load_audit": sql(LOAD_AUDIT),
    "load_audit_failed": sql(LOAD_FAILED),
    "catalog_tables": sql(
        union(
            *[
                f"SELECT 'bronze' AS layer, '{t}' AS table_name, CAST({i} AS INTEGER) AS position, "
                f"'{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, {COUNTS[t]} AS row_count"
                for t, e in EXTRACTS.items()
                for i, f in enumerate(e.schema.fields, start=1)
            ]
        )
    ),
    "silver_append": sql(records({t: (t, [*stored(t), "TIMESTAMP '2026-01-02 03:04:05'"]) for t in ERP})),
    "schema_evolve": sql(
        "SELECT cust_id, cust_create_date, CAST(0 AS INTEGER) AS cust_is_future FROM s_cust "
        "UNION ALL SELECT cust_id, cust_create_date, cust_is_future FROM s_cust",
        "s_cust",
    ),
    # column rules
    "code_map_default": sql(
        f"SELECT src_seq, {MARITAL} AS cust_marital_status, {GENDER} AS cust_gender FROM crm_cust_info"
    ),
    "code_map_passthrough": sql(f"SELECT prd_id, prd_start_dt, {LINE} AS prd_line FROM crm_prd_info"),
    "trim_names": sql(
        "SELECT src_seq, TRIM(cust_firstname) AS cust_firstname, TRIM(cust_lastname) AS cust_lastname FROM crm_cust_info"
    ),
    "future_flag": sql(f"SELECT src_seq, cust_create_date, {FUTURE} AS cust_is_future FROM crm_cust_info"),
    "future_flag_now": sql(
        "SELECT src_seq, cust_create_date + 10950 AS cust_create_date, CAST(CASE WHEN cust_create_date + 10950 > current_date THEN 1 "
        "ELSE 0 END AS INTEGER) AS cust_is_future FROM crm_cust_info"
    ),
    "cost_default": sql(
        f"SELECT prd_id, prd_start_dt, {COST} AS production_cost, {COST_CI} AS ci_cost FROM crm_prd_info"
    ),
    "range_repair": sql(f"SELECT prd_id, prd_start_dt, {END} AS prd_end_dt FROM crm_prd_info"),
    "fact_dates": sql(
        f"SELECT sls_ord_num, {as_date('sls_order_dt')} AS order_date, {as_date('sls_ship_dt')} AS ship_date, "
        f"{as_date('sls_due_dt')} AS due_date FROM crm_sales_details"
    ),
    "source_priority": sql(
        "SELECT cust_id, COALESCE(NULLIF(cust_gender, 'n/a'), gen) AS gender FROM s_cust "
        "LEFT JOIN erp_cust_az12 ON RTRIM(RIGHT(cid, 10)) = RTRIM(cust_key)",
        "s_cust",
    ),
    "key_conform": sql(
        union(
            "SELECT 'suffix' AS kind, cid AS source_key, RIGHT(cid, 10) AS common_key FROM erp_cust_az12",
            "SELECT 'dashed', cid, REPLACE(cid, '-', '') FROM erp_loc_a101",
            "SELECT 'category', prd_key, REPLACE(SUBSTRING(prd_key, 1, 5), '-', '_') FROM crm_prd_info",
            "SELECT 'number', prd_key, SUBSTRING(prd_key, 7, LENGTH(prd_key)) FROM crm_prd_info",
        )
    ),
    "hash_pii": sql(f"SELECT src_seq, {hashed('TRIM(cust_lastname)')} AS last_name_hash FROM crm_cust_info"),
    # latest records, keys, cleansing
    "latest_customer": sql(LATEST_CUSTOMER),
    "latest_customer_null_key": sql(LATEST_CUSTOMER_NULL),
    "latest_product": sql(LATEST_PRODUCT),
    "surrogate_key": "SELECT o_orderkey AS id, o_custkey, "
    "ROW_NUMBER() OVER (ORDER BY o_orderkey) AS surrogate_key FROM orders",
    "surrogate_key_repeated": sql(
        "SELECT sls_cust_id, MIN(k) AS first_key, MAX(k) AS last_key, COUNT(k) AS key_count FROM (SELECT sls_cust_id, "
        "ROW_NUMBER() OVER (ORDER BY sls_cust_id NULLS FIRST) AS k FROM crm_sales_details) GROUP BY sls_cust_id"
    ),
    "generic_clean": sql(
        f"SELECT {CLEAN_CUSTOMER_COLUMNS.replace('cust_key,', 'TRIM(cust_key) AS cust_key,')}, src_seq "
        f"FROM ({LATEST_CUSTOMER})"
    ),
    "generic_clean_layer": sql(
        records(
            {
                "crm_cust_info": (
                    f"(SELECT {CLEAN_CUSTOMER_COLUMNS} FROM ({LATEST_CUSTOMER}))",
                    ["cust_id", "TRIM(cust_key)", "cust_firstname", "cust_lastname", "cust_marital_status",
                     "cust_gender", "cust_create_date", "cust_is_future"],
                ),
                **{t: (t, fields) for t, fields in CLEAN_FIELDS.items()},
            }
        )
    ),
    "generic_clean_silver": sql(
        records(
            {
                "crm_cust_info": (
                    f"(SELECT * REPLACE ({FUTURE} AS cust_is_future) FROM s_cust)",
                    ["cust_id", "TRIM(cust_key)", "cust_firstname", "cust_lastname", *UNLABELLED, "cust_create_date", "cust_is_future"],
                ),
                "crm_prd_info": (
                    "s_prd", ["prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"]
                ),
                "crm_sales_details": ("s_sales", CLEAN_FIELDS["crm_sales_details"]),
                **{t: (t, CLEAN_FIELDS[t]) for t in ERP},
                "nations": ("nation", ["n_nationkey", "TRIM(n_name)"]),
            }
        ),
        *S_ALL,
    ),
    "top_customers": sql(
        "SELECT cust_id, cust_firstname, cust_lastname, cust_gender, cust_is_future FROM s_cust ORDER BY cust_id LIMIT 10",
        "s_cust",
    ),
    # silver
    "silver_customers": sql("SELECT * FROM s_cust", "s_cust"),
    "silver_products": sql("SELECT * FROM s_prd", "s_prd"),
    "silver_products_ci": sql("SELECT * FROM s_prd_ci", "s_prd_ci"),
    "silver_sales": sql("SELECT * FROM s_sales", *S_ALL),
    "silver_sales_ci": sql("SELECT * FROM s_sales_ci", "s_cust", "s_prd_ci", "s_sales_ci"),
    # gold
    "dim_customers": sql("SELECT * FROM g_cust", "s_cust", "g_cust"),
    "dim_products": sql("SELECT * FROM g_prd", "s_prd", "g_prd"),
    "dim_products_ci": sql(
        "SELECT product_id, MIN(product_key) AS first_key, MAX(product_key) AS last_key FROM g_prd_ci GROUP BY product_id",
        "s_prd_ci",
        "g_prd_ci",
    ),
    "dim_products_current": sql("SELECT * FROM g_prd_now", "s_prd", "g_prd", "g_prd_now"),
    "fact_sales": sql("SELECT * FROM g_fact", *STAR),
    "fact_sales_current": sql(
        "SELECT * FROM g_fact WHERE product_key IN (SELECT product_key FROM g_prd_now)", *STAR, "g_prd_now"
    ),
    "star_report": sql(
        "SELECT country, category, COUNT(*) AS order_lines, CAST(SUM(sales_amount) AS BIGINT) AS sales_amount, "
        "CAST(SUM(quantity) AS BIGINT) AS quantity FROM g_fact JOIN g_cust USING (customer_key) "
        "JOIN g_prd USING (product_key) GROUP BY country, category",
        *STAR,
    ),
    "gold_views": sql(records(GOLD_FIELDS), *STAR),
    "stable_keys": sql(
        "SELECT CAST(customer_id AS BIGINT) AS customer_id, customer_key FROM g_cust UNION ALL SELECT -s_suppkey, "
        "(SELECT COUNT(*) FROM g_cust) + ROW_NUMBER() OVER (ORDER BY -s_suppkey) FROM supplier",
        "s_cust",
        "g_cust",
    ),
    "live_gold": sql(
        records({"before": ("g_cust_more", GOLD_FIELDS["dim_customers"][1]), **GOLD_FIELDS, "dim_customers": ("g_cust_more", GOLD_FIELDS["dim_customers"][1])}),
        *STAR,
        "g_cust_more",
    ),
    "latest_customer_merged": sql(LATEST_CUSTOMER),
    "dq_suite_increments": sql(
        suite(*[f"(SELECT * FROM {t} UNION ALL SELECT * FROM {t})" for t in ("crm_cust_info", "crm_prd_info", "crm_sales_details")])
    ),
    # the whole run
    "pipeline_run": from_extracts(
        sql(
            records({"audit": AUDITED, "gate": ran(gate("prd_cost < 0", "s_prd", "s_sales", "g_prd", "g_fact", rejected="0")), **GOLD_FIELDS}),
            *STAR,
        )
    ),
    "pipeline_run_ci": from_extracts(
        sql(
            records(
                {
                    "audit": AUDITED,
                    "gate": ran(gate("prd_cost <= 0", "s_prd_ci", "s_sales_ci", "g_prd_ci", "g_fact_ci", rejected="0")),
                    "dim_customers": GOLD_FIELDS["dim_customers"],
                    "dim_products": (
                        "(SELECT product_id, MIN(product_key) AS first_key, MAX(product_key) AS last_key FROM g_prd_ci GROUP BY product_id)",
                        ["product_id", "first_key", "last_key"],
                    ),
                    "fact_sales": (
                        "g_fact_ci JOIN g_prd_ci USING (product_key)",
                        ["order_number", "customer_key", "product_number", "order_date", "sales_amount"],
                    ),
                    "stored": (f"(VALUES {', '.join(f"('{t}')" for t in STORED)}) v(name)", ["name"]),
                }
            ),
            "s_cust", "s_prd_ci", "s_sales_ci", "g_cust", "g_prd_ci", "g_fact_ci",
        )
    ),
    # quality
    "dq_key_customer": sql(REPEATED.format(key="cust_id", table="crm_cust_info") + " OR cust_id IS NULL"),
    "dq_key_product": sql(REPEATED.format(key="prd_id", table="crm_prd_info") + " OR prd_id IS NULL"),
    "dq_untrimmed": sql(
        records(
            {
                "crm_cust_info": ("crm_cust_info WHERE cust_key <> TRIM(cust_key)", ["cust_key"]),
                "crm_prd_info": ("crm_prd_info WHERE prd_nm <> TRIM(prd_nm)", ["prd_nm"]),
                "erp_px_cat_g1v2": (
                    f"erp_px_cat_g1v2 WHERE {UNTRIMMED_CATEGORY}",
                    ["id", "cat", "subcat", "maintenance"],
                ),
            }
        )
    ),
    "dq_cost": sql("SELECT prd_cost FROM crm_prd_info WHERE prd_cost < 0 OR prd_cost IS NULL"),
    "dq_product_range": sql("SELECT * FROM crm_prd_info WHERE prd_end_dt < prd_start_dt"),
    "dq_invalid_dates": sql(
        f"SELECT NULLIF(sls_due_dt, 0) AS sls_due_dt FROM crm_sales_details WHERE {INVALID_DUE}"
    ),
    "dq_date_order": sql(
        "SELECT * FROM crm_sales_details WHERE sls_order_dt > sls_ship_dt OR sls_order_dt > sls_due_dt"
    ),
    "dq_sales_consistency": sql(
        f"SELECT DISTINCT sls_sales, sls_quantity, sls_price FROM crm_sales_details WHERE {INCONSISTENT}"
    ),
    "dq_birthdate": sql(f"SELECT DISTINCT bdate FROM erp_cust_az12 WHERE {ODD_BIRTH}"),
    "profile_values": sql(
        union(
            "SELECT DISTINCT 'marital_status' AS profile, cust_marital_status AS value FROM crm_cust_info",
            "SELECT DISTINCT 'product_line', prd_line FROM crm_prd_info",
            "SELECT DISTINCT 'gender', gen FROM erp_cust_az12",
            "SELECT DISTINCT 'country', cntry FROM erp_loc_a101",
            "SELECT DISTINCT 'maintenance', maintenance FROM erp_px_cat_g1v2",
        )
        + "\nORDER BY profile, value NULLS FIRST"
    ),
    "profile_values_silver": sql(
        union(
            "SELECT DISTINCT 'marital_status' AS profile, cust_marital_status AS value FROM s_cust",
            "SELECT DISTINCT 'product_line', prd_line FROM s_prd",
            "SELECT DISTINCT 'gender', gen FROM erp_cust_az12",
            "SELECT DISTINCT 'country', cntry FROM erp_loc_a101",
            "SELECT DISTINCT 'maintenance', maintenance FROM erp_px_cat_g1v2",
        )
        + "\nORDER BY profile, value NULLS FIRST",
        "s_cust",
        "s_prd",
    ),
    "dq_orphan_customer": sql(
        "SELECT s.* FROM crm_sales_details s LEFT JOIN s_cust c ON c.cust_id = s.sls_cust_id WHERE c.cust_id IS NULL",
        "s_cust",
    ),
    "dq_orphan_product": sql(
        "SELECT s.* FROM crm_sales_details s LEFT JOIN s_prd p ON RTRIM(SUBSTRING(p.prd_key, 7)) = RTRIM(s.sls_prd_key) "
        "WHERE p.prd_key IS NULL",
        "s_prd",
    ),
    "dq_suite_bronze": sql(suite("crm_cust_info", "crm_prd_info", "crm_sales_details")),
    "dq_suite_silver": sql(suite("s_cust", "s_prd", "s_sales"), *S_ALL),
    "dq_gold_keys": sql(
        records(
            {
                "dim_customers": (f"({REPEATED.format(key='customer_key', table='g_cust')})", ["customer_key", "row_count"]),
                "dim_products": (f"({REPEATED.format(key='product_key', table='g_prd')})", ["product_key", "row_count"]),
            }
        ),
        "s_cust",
        "s_prd",
        "g_cust",
        "g_prd",
    ),
    "dq_gold_product_number": sql(REPEATED.format(key="product_number", table="g_prd"), "s_prd", "g_prd"),
    "dq_gold_ref": sql(DISCONNECTED.format(products="g_prd"), *STAR),
    "dq_gold_ref_current": sql(DISCONNECTED.format(products="g_prd_now"), *STAR, "g_prd_now"),
    "dq_gate": sql(gate("prd_cost < 0", "s_prd", "s_sales", "g_prd", "g_fact"), *STAR),
    "dq_gate_ci": sql(
        gate("prd_cost <= 0", "s_prd_ci", "s_sales_ci", "g_prd_ci", "g_fact_ci"),
        "s_cust", "s_prd_ci", "s_sales_ci", "g_cust", "g_prd_ci", "g_fact_ci",
    ),
    "dq_gate_literal": sql(gate("prd_cost <= 0", "s_prd", "s_sales", "g_prd", "g_fact"), *STAR),
    "dq_gate_dirty": sql(f"SELECT * FROM results UNION ALL {VERDICT}", "results"),
}
ORACLES["star_report_bucketed"] = ORACLES["star_report"]
