import datetime as dt

import pytest

from smelter.operators import checks as k
from smelter.plans.profiles import CI, PRODUCTION
from smelter.plans.quality import GateFailed, gate, gold_checks, layer_checks, layer_profiles, layer_summary, suite_summary, verdict
from smelter.plans.silver import silver_layer

DAY = dt.date(2013, 6, 1)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repeated_keys(frame):
    df = frame([(1,), (1,), (2,), (None,)], "a INT")
    assert found(k.repeated_keys(df, "a")) == [(1, 2), (None, 1)]
    assert found(k.repeated_keys(df, "a", null_breaks=False)) == [(1, 2)]
    assert found(k.repeated_keys(frame([(1,), (2,)], "a INT"), "a")) == []


def test_untrimmed_rows(frame):
    df = frame([("a", "b"), (" a", "b"), ("a", "b "), (None, " b"), (None, None)], "x STRING, y STRING")
    assert found(k.untrimmed_rows(df, ["x", "y"])) == [(" a", "b"), ("a", "b "), (None, " b")]


def test_product_checks(frame):
    a, b = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    df = frame([(0, a, b), (-1, b, a), (None, a, None), (5, a, a)], "prd_cost INT, prd_start_dt DATE, prd_end_dt DATE")
    assert found(k.bad_costs(df)) == [(-1,), (None,)]
    assert found(k.bad_costs(df, lowest=1)) == [(-1,), (0,), (None,)]
    assert found(k.inverted_products(df)) == [(-1, b, a)]


def test_sales_date_checks(frame):
    ddl = "sls_order_dt INT, sls_ship_dt INT, sls_due_dt INT"
    good, zero, short = (20130101, 20130102, 20130103), (20130101, 20130102, 0), (20130101, 20130102, 2013010)
    late, nothing = (20130105, 20130102, 20130109), (None, None, None)
    df = frame([good, zero, short, late, nothing], ddl)
    assert found(k.invalid_due_dates(df)) == [(2013010,), (None,)]  # 0 is shown as NULL
    assert found(k.late_orders(df)) == sorted([zero, short, late], key=str)


def test_sales_amounts(frame):
    ddl = "sls_sales INT, sls_quantity INT, sls_price INT"
    bad = [(9, 2, 5), (None, 2, 5), (10, None, 5), (10, 2, None), (0, 0, 5), (-10, 2, -5), (1, 2147483647, 2147483647)]
    df = frame([(10, 2, 5), *bad, bad[0]], ddl)
    assert found(k.inconsistent_triples(df)) == sorted(bad, key=str)


def test_birth_dates(frame):
    days = [dt.date(1923, 12, 31), dt.date(1924, 1, 1), DAY, dt.date(2013, 6, 2), None, dt.date(2013, 6, 2)]
    df = frame([(d,) for d in days], "bdate DATE")
    assert found(k.odd_birth_dates(df, DAY)) == [(days[0],), (days[3],)]


def test_orphans(frame):
    sales = frame([("P1", 1), ("P2", 2), (None, None)], "sls_prd_key STRING, sls_cust_id INT")
    customers = frame([(1,), (1,), (None,)], "cust_id INT")
    products = frame([("AA-BB-P1",), ("AA-BB-P1",), (None,)], "prd_key STRING")
    assert found(k.sales_without_customer(sales, customers)) == [("P2", 2), (None, None)]
    assert found(k.sales_without_product(sales, products)) == [("P2", 2), (None, None)]


def test_disconnected_facts(frame):
    fact = frame([("a", 1, 1), ("b", 1, 9), ("c", 9, 1), ("d", 9, 9)], "order_number STRING, customer_key INT, product_key INT")
    c, p = frame([(1,)], "customer_key INT"), frame([(1,)], "product_key INT")
    assert found(k.disconnected_facts(fact, c, p)) == [("b", 1, 9, 0, 1), ("c", 9, 1, 1, 0), ("d", 9, 9, 1, 1)]


KEYS = [None, None, 0, 1, 1, 1, 63, 64, 64, -1, -64, -65, 2**40, 2**63 - 1, -(2**63)]


@pytest.mark.parametrize("most", [k.BROADCAST_ROWS, 0])
def test_disconnected_facts_are_those_of_left_joins(frame, monkeypatch, most):
    """Repeated, missing, negative and far keys, and keys of all dimensions missing."""
    monkeypatch.setattr(k, "BROADCAST_ROWS", most)
    wanted = [*KEYS, 2, 62, 65, -2, -63, 2**40 + 1]
    fact = frame([(f"{a}/{b}", a, b) for a in wanted for b in wanted], "order_number STRING, customer_key BIGINT, product_key BIGINT")
    for c_keys, p_keys in ((KEYS, KEYS[2:5] + [7, 7]), ([1, 64], KEYS[6:]), ([], [1])):
        c, p = frame([(x,) for x in c_keys], "customer_key BIGINT"), frame([(x,) for x in p_keys], "product_key BIGINT")
        want = [
            (name, a, b, int(a not in c_keys or a is None), int(b not in p_keys or b is None))
            for name, a, b in map(tuple, fact.collect())
            for _ in range((a is not None and c_keys.count(a) or 1) * (b is not None and p_keys.count(b) or 1))
        ]
        assert found(k.disconnected_facts(fact, c, p)) == sorted([w for w in want if w[3] or w[4]], key=str)


def test_one_pass_per_table_counts_what_the_single_checks_find(tables, frame):
    dirty = dict(tables)
    dirty["crm_cust_info"] = dirty["crm_cust_info"].unionAll(dirty["crm_cust_info"].selectExpr("cust_id", "' x'", *[c for c in dirty["crm_cust_info"].columns[2:]]))
    dirty["crm_sales_details"] = dirty["crm_sales_details"].unionAll(dirty["crm_sales_details"].selectExpr(*dirty["crm_sales_details"].columns[:5], "0", "0", "sls_quantity", "sls_price"))
    want = found(suite_summary(layer_checks(dirty, DAY)))
    assert found(layer_summary(dirty, DAY)) == want
    assert sum(n for _, n in want) > 5


def test_suite_finds_nothing_in_clean_tables(silver, gold):
    assert {n for _, n in found(suite_summary(layer_checks(silver, DAY)))} == {0}
    checks = gold_checks(gold["dim_customers"], gold["dim_products"], gold["fact_sales"])
    assert {n for _, n in found(suite_summary(checks))} == {0}


def test_profiles_are_sorted_with_null_first(tables):
    got = [tuple(r) for r in layer_profiles(tables).collect()]
    assert got == [
        ("country", "France"), ("country", "Japan"), ("gender", "Female"), ("gender", "Male"),
        ("maintenance", "No"), ("maintenance", "Yes"), ("marital_status", "M"), ("marital_status", "S"),
        ("product_line", "M"), ("product_line", "S"),
    ]


def results(df):
    return {(r.layer, r.table_name, r.check_name): (r.severity, r.violations, r.failed) for r in df.collect()}


def test_gate_passes_clean_tables(spark, tables, silver, gold):
    got = gate(spark, tables, silver, gold, DAY)
    verdict(got)
    assert len(results(got)) == 20 and {v[1:] for v in results(got).values()} == {(0, 0)}


def test_bronze_only_warns(spark, tables, silver, gold, frame):
    dirty = dict(tables)
    dirty["crm_cust_info"] = tables["crm_cust_info"].unionByName(tables["crm_cust_info"])
    dirty["erp_cust_az12"] = frame([("X", dt.date(1900, 1, 1), None)], "cid STRING, bdate DATE, gen STRING")
    got = gate(spark, dirty, silver, gold, DAY)
    verdict(got)
    assert results(got)["bronze", "crm_cust_info", "duplicate or null key"] == ("warning", 3, 0)
    assert results(got)["bronze", "erp_cust_az12", "birth date out of range"] == ("warning", 1, 0)


def test_gate_fails_on_silver_and_gold(spark, tables, silver, frame):
    silver["crm_cust_info"] = silver["crm_cust_info"].filter("cust_id = 1").unionByName(
        silver["crm_cust_info"].filter("cust_id = 1")
    )
    silver["crm_prd_info"] = silver["crm_prd_info"].selectExpr(
        "prd_id", "prd_key", "prd_nm", "-1 AS prd_cost", "prd_line", "prd_end_dt AS prd_start_dt", "prd_start_dt AS prd_end_dt"
    ).filter("prd_id = 11")
    gold = {"dim_customers": frame([], "a INT"), "dim_products": None, "fact_sales": frame([(1,)], "a INT")}
    got = gate(spark, tables, silver, gold, DAY)
    failed = {key: v[1] for key, v in results(got).items() if v[2]}
    assert failed == {
        ("silver", "crm_cust_info", "duplicate key"): 1,
        ("silver", "crm_prd_info", "bad cost"): 1,
        ("silver", "crm_prd_info", "end before start"): 1,
        ("silver", "crm_sales_details", "without customer"): 2,
        ("silver", "crm_sales_details", "without product"): 2,
        ("gold", "dim_customers", "no rows"): 1,
        ("gold", "dim_products", "missing"): 1,
    }
    with pytest.raises(GateFailed, match="7 checks failed"):
        verdict(got)


def test_missing_tables_skip_their_content_checks(spark):
    got = results(gate(spark, {}, {}, {}))
    assert len(got) == 6 and {v for v in got.values()} == {("error", 1, 1)}


@pytest.mark.parametrize(("profile", "cost"), [(PRODUCTION, 0), (CI, 1)])
def test_gate_takes_the_profile_s_own_repairs(spark, tables, gold, profile, cost):
    """A missing cost becomes the profile's default, which its gate accepts."""
    tables["crm_prd_info"] = tables["crm_prd_info"].selectExpr(
        "prd_id", "prd_key", "prd_nm", "CAST(NULL AS INT) AS prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"
    )
    silver = silver_layer(tables, DAY, profile)
    assert {r.prd_cost for r in silver["crm_prd_info"].collect()} == {cost}
    verdict(gate(spark, tables, silver, gold, DAY, profile))
