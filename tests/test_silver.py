import datetime as dt

from smelter.plans.profiles import CI, PRODUCTION
from smelter.plans.silver import silver_customers, silver_products, silver_sales
from smelter.schemas import EXTRACTS

DAY, LATER = dt.date(2013, 1, 1), dt.date(2014, 1, 1)
START, BEFORE, AFTER = dt.datetime(2012, 7, 1), dt.datetime(2011, 1, 1), dt.datetime(2014, 1, 1)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_customers(frame):
    df = frame(
        [
            (1, "AW1 ", "  Ann ", "Lee ", " m", "f", DAY),
            (1, "AW1 ", "Anna", "Lee-Ray", "S", "F", LATER),
            (None, "AW9", "No", "Id", "M", "M", DAY),
            (2, "AW2", None, None, None, "x", None),
        ],
        EXTRACTS["crm_cust_info"].schema,
    )
    assert found(silver_customers(df, as_of=DAY)) == [
        (1, "AW1 ", "Anna", "Lee-Ray", "Single", "Female", LATER, 1),
        (2, "AW2", None, None, "n/a", "n/a", None, 0),
    ]


PRODUCTS = [
    (1, " AC-HE-P1 ", " Old ", 5, "R ", BEFORE, None),
    (1, " AC-HE-P1 ", " New ", None, "R ", START, BEFORE),
    (2, "AC-HE-P2", "Two", -5, "Custom ", START, AFTER),
    (3, "AC-HE-P3", "Three", 0, None, START, None),
    (None, "AC-HE-P4", "None", 1, "M", START, None),
]


def test_products_in_production(frame):
    df = frame(PRODUCTS, EXTRACTS["crm_prd_info"].schema)
    assert found(silver_products(df, PRODUCTION)) == [
        (1, "AC-HE-P1", "New", 0, "Road", START, None),
        (2, "AC-HE-P2", "Two", 0, "Custom", START, AFTER),
        (3, "AC-HE-P3", "Three", 0, None, START, None),
    ]


def test_products_in_ci(frame):
    df = frame(PRODUCTS, EXTRACTS["crm_prd_info"].schema)
    assert found(silver_products(df, CI)) == sorted(
        [
            (1, " AC-HE-P1 ", "Old", 5, "R", BEFORE, None),
            (1, " AC-HE-P1 ", "New", 1, "R", START, None),
            (2, "AC-HE-P2", "Two", 1, "Custom", START, AFTER),
            (3, "AC-HE-P3", "Three", 1, None, START, None),
            (None, "AC-HE-P4", "None", 1, "M", START, None),
        ],
        key=str,
    )


def test_sales_need_a_product_and_a_customer(frame):
    products = frame([(1, "AC-HE-P1"), (2, "AC-HE-P1"), (3, "AC-HE-P2")], "prd_id INT, prd_key STRING")
    customers = frame([(7,), (8,), (None,)], "cust_id INT")
    sale = lambda n, number, customer: (n, number, customer, 1, 2, 3, 4, 5, 6)
    sales = frame(
        [sale("a", "P1", 7), sale("b", "P2", 8), sale("c", "P9", 7), sale("d", "P1", 9), sale("e", "P1", None)],
        EXTRACTS["crm_sales_details"].schema,
    )
    assert [r[0] for r in found(silver_sales(sales, products, customers))] == ["a", "b"]
    # CI repeats a sale for each version of its product
    assert [r[0] for r in found(silver_sales(sales, products, customers, CI))] == ["a", "a", "b"]


def test_all_six_tables(tables, silver):
    assert set(silver) == set(EXTRACTS)
    assert {t: df.count() for t, df in silver.items()} == {t: df.count() for t, df in tables.items()}
