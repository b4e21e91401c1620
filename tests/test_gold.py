import datetime as dt

from smelter.functions.keys import pseudonym
from smelter.plans.gold import dim_customers, dim_products, fact_sales, sales_by_country_and_category

DAY = dt.date(2013, 1, 1)


def found(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_star(gold):
    assert found(gold["dim_customers"], "customer_key", "customer_id", "gender", "birth_date", "country") == [
        (1, 1, "Female", dt.date(1980, 2, 3), "France"),
        (2, 2, "Male", None, "Japan"),
        (3, 3, "Male", None, None),
    ]
    assert found(gold["dim_products"], "product_key", "product_number", "product_line", "category") == [
        (1, "HL-1", "Other Sales", "Accessories"),
        (2, "BK-7", "Mountain", "Bikes"),
    ]
    assert found(gold["fact_sales"], "order_number", "customer_key", "product_key", "order_date", "sales_amount") == [
        ("SO1", 1, 1, dt.date(2013, 1, 5), 24),
        ("SO2", 2, 2, dt.date(2013, 1, 6), 900),
        ("SO3", 3, 1, None, 12),
    ]
    report = sales_by_country_and_category(gold["fact_sales"], gold["dim_customers"], gold["dim_products"])
    assert found(report) == sorted(
        [("France", "Accessories", 1, 24, 2), ("Japan", "Bikes", 1, 900, 1), (None, "Accessories", 1, 12, 1)], key=str
    )


def test_columns(gold):
    assert gold["dim_customers"].columns == [
        "customer_key", "customer_id", "customer_number", "first_name", "last_name_hash", "marital_status", "gender",
        "birth_date", "country", "customer_create_date", "cust_is_future",
    ]
    assert gold["dim_products"].columns == [
        "product_key", "product_id", "product_number", "product_name", "product_cost", "product_line",
        "product_start_date", "product_end_date", "category", "subcategory", "maintenance",
    ]
    assert gold["fact_sales"].columns == [
        "order_number", "customer_key", "product_key", "order_date", "ship_date", "due_date", "sales_amount",
        "quantity", "price",
    ]


def test_last_name_is_hashed(gold, evaluate):
    hashed = evaluate(pseudonym, ["Lee", "Ray", "Fox"], "STRING")
    assert [r.last_name_hash for r in gold["dim_customers"].orderBy("customer_key").collect()] == hashed


def test_repeated_erp_rows_repeat_the_customer(silver, frame):
    """As a left join does: 2 copies and 1 other row, times 2 locations."""
    customers = silver["crm_cust_info"]
    erp = frame(
        [("NASAW00000001", DAY, "Male")] * 2 + [("XXAW00000001", None, "Female"), (None, DAY, "Male")],
        "cid STRING, bdate DATE, gen STRING",
    )
    places = frame([("AW-00000001", "France"), ("A-W00000001", "Spain")], "cid STRING, cntry STRING")
    dim = dim_customers(customers, erp, places).cache()
    assert sorted(r.customer_key for r in dim.collect()) == list(range(1, 9))
    assert found(dim.filter("customer_id = 1"), "birth_date", "country") == sorted(
        [(DAY, "France")] * 2 + [(DAY, "Spain")] * 2 + [(None, "France"), (None, "Spain")], key=str
    )
    assert found(dim.filter("customer_id > 1"), "customer_key", "customer_id") == [(7, 2), (8, 3)]


def test_versions_of_a_product(tables, frame):
    versions = frame(
        [
            (1, "AC-HE-P1", "v1", None, None, dt.datetime(2011, 1, 1), None),
            (2, "AC-HE-P1", "v2", 5, "Custom ", dt.datetime(2013, 1, 1), None),
            (3, "XX-YY-P2", "other", 6, "M", dt.datetime(2012, 1, 1), None),
        ],
        "prd_id INT, prd_key STRING, prd_nm STRING, prd_cost INT, prd_line STRING, prd_start_dt TIMESTAMP_NTZ, "
        "prd_end_dt TIMESTAMP_NTZ",
    )
    every = dim_products(versions, tables["erp_px_cat_g1v2"]).cache()
    current = dim_products(versions, tables["erp_px_cat_g1v2"], current_version_only=True).cache()
    assert found(every, "product_key", "product_id", "product_cost", "product_line", "category") == [
        (1, 1, 0, None, "Accessories"), (2, 2, 5, "Custom", "Accessories"), (3, 3, 6, "Mountain", None),
    ]
    assert found(current, "product_key", "product_name") == [(2, "v2"), (3, "other")]

    customers = frame([(1, 7)], "customer_key BIGINT, customer_id INT")
    sales = frame(
        [("a", "P1", 7, 20130105, 32154, 0, 4, 2, 2)],
        "sls_ord_num STRING, sls_prd_key STRING, sls_cust_id INT, sls_order_dt INT, sls_ship_dt INT, sls_due_dt INT, "
        "sls_sales INT, sls_quantity INT, sls_price INT",
    )
    assert found(fact_sales(sales, customers, every), "product_key", "ship_date", "due_date") == [
        (1, None, None), (2, None, None),
    ]
    assert found(fact_sales(sales, customers, current), "product_key") == [(2,)]
