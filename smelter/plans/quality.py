"""Quality suite of a layer, and the gate over all three."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.dates import is_invalid_day
from smelter.functions.keys import comparable, product_number
from smelter.operators import checks as k
from smelter.plans.profiles import PRODUCTION, Profile
from smelter.schemas import BRONZE, GOLD, GOLD_OBJECTS, SILVER

WARNING, ERROR = "warning", "error"
RESULT_COLUMNS = ("layer", "table_name", "check_name", "severity", "violations", "failed")

Tables = dict[str, DataFrame | None]
Rules = dict[str, Column]


class GateFailed(RuntimeError):
    """The gate found violations of silver or gold rules."""


# ---- suite ---------------------------------------------------------------------------------------------------


def layer_checks(tables: dict[str, DataFrame], as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Rows that break each rule, by check name; ``tables`` are the six bronze or the six silver tables."""
    customers, products = tables["crm_cust_info"], tables["crm_prd_info"]
    sales, categories = tables["crm_sales_details"], tables["erp_px_cat_g1v2"]
    return {
        "customer_key": k.repeated_keys(customers, "cust_id"),
        "customer_key_untrimmed": k.untrimmed_rows(customers, ["cust_key"]).select("cust_key"),
        "product_key": k.repeated_keys(products, "prd_id"),
        "product_name_untrimmed": k.untrimmed_rows(products, ["prd_nm"]).select("prd_nm"),
        "product_cost": k.bad_costs(products),
        "product_range": k.inverted_products(products),
        "sales_due_date": k.invalid_due_dates(sales),
        "sales_date_order": k.late_orders(sales),
        "sales_amount": k.inconsistent_triples(sales),
        "birth_date": k.odd_birth_dates(tables["erp_cust_az12"], as_of),
        "category_untrimmed": k.untrimmed_rows(categories, ["cat", "subcat", "maintenance"]),
    }


# The columns whose values are listed for review.
PROFILED = {
    "marital_status": ("crm_cust_info", "cust_marital_status"),
    "product_line": ("crm_prd_info", "prd_line"),
    "gender": ("erp_cust_az12", "gen"),
    "country": ("erp_loc_a101", "cntry"),
    "maintenance": ("erp_px_cat_g1v2", "maintenance"),
}


def layer_profiles(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct values of the profiled columns as ``(profile, value)``, sorted."""
    frames = [
        k.value_profile(tables[table], column).select(F.lit(name).alias("profile"), F.col(column).alias("value"))
        for name, (table, column) in PROFILED.items()
    ]
    return union_frames(frames).orderBy("profile", "value")


def gold_checks(customers: DataFrame, products: DataFrame, fact: DataFrame) -> dict[str, DataFrame]:
    return {
        "customer_key": k.repeated_keys(customers, "customer_key", null_breaks=False),
        "product_key": k.repeated_keys(products, "product_key", null_breaks=False),
        "fact_connected": k.disconnected_facts(fact, customers, products),
    }


def suite_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """Number of offending rows per check."""
    return union_frames(
        [
            df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
            for name, df in checks.items()
        ]
    )


def layer_summary(tables: dict[str, DataFrame], as_of: dt.date | None = None) -> DataFrame:
    """``suite_summary`` of ``layer_checks``, with one scan per table.

    All row rules of a table are counted in one aggregation per key or value that the other rules group by; what is left
    to shuffle is one row per key.
    """
    plans = summary_plans(tables, as_of)
    return union_frames([totals_of(groups_of(tables[t], keys, rows), rows, groups) for t, keys, rows, groups in plans])


def summary_plans(tables: dict[str, DataFrame], as_of: dt.date | None = None) -> list[tuple[str, list[str], Rules, Rules]]:
    """For each of the tables that has checks: what its rows are grouped by, the rules of rows and those of groups."""
    untrimmed = k.any_untrimmed
    plans = {
        "crm_cust_info": lambda: (
            ["cust_id"],
            {"customer_key_untrimmed": untrimmed(["cust_key"])},
            {"customer_key": _breaks_key("cust_id")},
        ),
        "crm_prd_info": lambda: (
            ["prd_id"],
            {
                "product_name_untrimmed": untrimmed(["prd_nm"]),
                "product_cost": k.bad_cost(0),
                "product_range": k.inverted_range("prd_start_dt", "prd_end_dt"),
            },
            {"product_key": _breaks_key("prd_id")},
        ),
        "crm_sales_details": lambda: (
            ["sls_sales", "sls_quantity", "sls_price"],
            {"sales_due_date": is_invalid_day(F.col("sls_due_dt")), "sales_date_order": k.ordered_late()},
            {"sales_amount": k.inconsistent_sales()},
        ),
        "erp_cust_az12": lambda: (["bdate"], {}, {"birth_date": k.birth_out_of_range(as_of)}),
        "erp_px_cat_g1v2": lambda: ([], {"category_untrimmed": untrimmed(["cat", "subcat", "maintenance"])}, {}),
    }
    return [(t, *plan()) for t, plan in plans.items() if t in tables]


def _breaks_key(key: str) -> Column:
    return (F.col("_rows") > 1) | F.col(key).isNull()


def groups_of(df: DataFrame, keys: list[str], row_rules: Rules) -> DataFrame:
    """Per group its rows and the rows that break each rule, from one scan; these numbers add up over loads."""
    counts = [F.count(F.when(rule, 1)).alias(name) for name, rule in row_rules.items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *counts)


def totals_of(groups: DataFrame, row_rules: Rules, group_rules: Rules) -> DataFrame:
    """Rows that break each row rule, and groups that break each group rule."""
    totals = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in row_rules]
    totals += [F.count(F.when(rule, 1)).alias(name) for name, rule in group_rules.items()]
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in (*row_rules, *group_rules)])
    return groups.agg(*totals).select(F.explode(pairs).alias("c")).select("c.check_name", "c.violations")


# ---- gate ----------------------------------------------------------------------------------------------------


def gate(
    spark: SparkSession,
    bronze: Tables,
    silver: Tables,
    gold: Tables,
    as_of: dt.date | None = None,
    profile: Profile = PRODUCTION,
    rejects: DataFrame | None = None,
    lowest_cost: int | None = None,
) -> DataFrame:
    """One row per check: layer, table, check, severity, number of violations, and 1 if the check fails the gate.

    ``rejects`` are the rows that the load could not take. The lowest good cost of silver is the profile's own floor,
    so that no build fails on its own repairs, unless ``lowest_cost`` names another; the literal rule is 1.

    Bronze checks only warn, since raw data may be dirty; silver and gold ones fail. A table that is missing (``None``)
    fails its existence check and its other checks are left out. The checks of one table share one pass over it.
    """
    lowest = profile.lowest_cost if lowest_cost is None else lowest_cost
    frames: list[DataFrame] = []

    if rejects is not None:
        frames.append(_measure(rejects, BRONZE, "load_rejects", WARNING, {"rejected rows": F.lit(True)}))

    if (t := bronze.get("crm_cust_info")) is not None:
        keys = k.repeated_keys(t, "cust_id")
        frames.append(_measure(keys, BRONZE, "crm_cust_info", WARNING, {"duplicate or null key": F.lit(True)}))
    if (t := bronze.get("crm_prd_info")) is not None:
        frames.append(
            _measure(
                t,
                BRONZE,
                "crm_prd_info",
                WARNING,
                {"bad cost": k.bad_cost(1), "end before start": k.inverted_range("prd_start_dt", "prd_end_dt")},
            )
        )
    if (t := bronze.get("crm_sales_details")) is not None:
        rules = {"sales differ from quantity times price": k.wrong_product()}
        frames.append(_measure(t, BRONZE, "crm_sales_details", WARNING, rules))
    if (t := bronze.get("erp_cust_az12")) is not None:
        rules = {"birth date out of range": k.birth_out_of_range(as_of)}
        frames.append(_measure(t, BRONZE, "erp_cust_az12", WARNING, rules))

    customers, products, sales = (silver.get(t) for t in ("crm_cust_info", "crm_prd_info", "crm_sales_details"))
    if customers is not None:
        per_key = customers.groupBy("cust_id").agg(F.count(F.lit(1)).alias("row_count"))
        frames.append(
            _measure(
                per_key,
                SILVER,
                "crm_cust_info",
                ERROR,
                {"null key": F.col("cust_id").isNull(), "duplicate key": F.col("row_count") > 1},
            )
        )
    if products is not None:
        frames.append(
            _measure(
                products,
                SILVER,
                "crm_prd_info",
                ERROR,
                {"bad cost": k.bad_cost(lowest), "end before start": k.inverted_range("prd_start_dt", "prd_end_dt")},
            )
        )
    if sales is not None and customers is not None:
        known = customers.select(F.col("cust_id").alias("_key"))
        frames.append(_orphans(sales, F.col("sls_cust_id"), known, "without customer"))
    if sales is not None and products is not None:
        known = products.select(comparable(product_number(F.col("prd_key"))).alias("_key"))
        frames.append(_orphans(sales, comparable(F.col("sls_prd_key")), known, "without product"))

    for name in GOLD_OBJECTS:
        if (t := gold.get(name)) is not None:
            empty = t.select(F.lit(1).alias("_one")).limit(1).agg(F.count(F.lit(1)).alias("_n"))
            frames.append(_measure(empty, GOLD, name, ERROR, {"no rows": F.col("_n") == 0}))

    frames.append(_existence(spark, silver, gold))
    return union_frames(frames)


def failed_checks(results: DataFrame) -> DataFrame:
    """The verdict as one more row of results: how many checks failed."""
    total = results.agg(F.coalesce(F.sum(F.col("failed").cast("bigint")), F.lit(0)).alias("violations"))
    whole = [F.lit("*").alias(c) for c in ("layer", "table_name")]
    return total.select(*whole, F.lit("failed checks").alias("check_name"), F.lit(ERROR).alias("severity"), "violations", F.least(F.col("violations"), F.lit(1)).cast("int").alias("failed"))


def verdict(results: DataFrame) -> None:
    """Raise ``GateFailed`` if any check of the gate failed."""
    failed = results.filter("failed = 1").collect()  # at most one row per check
    if failed:
        lines = [f"{r.layer}.{r.table_name}: {r.check_name} ({r.violations})" for r in failed]
        raise GateFailed(f"{len(failed)} checks failed: " + "; ".join(lines))


def _measure(df: DataFrame, layer: str, table: str, severity: str, rules: dict[str, Column]) -> DataFrame:
    """Count the rows that break each rule, all in one pass, as one result row per rule."""
    counts = df.agg(*[F.count(F.when(rule, 1)).alias(f"_{i}") for i, rule in enumerate(rules.values())])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(f"_{i}").alias("violations")) for i, n in enumerate(rules)]
    )
    return counts.select(F.explode(pairs).alias("c")).select(
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        "c.check_name",
        F.lit(severity).alias("severity"),
        "c.violations",
        F.when((F.col("c.violations") > 0) & F.lit(severity == ERROR), 1).otherwise(0).alias("failed"),
    )


def _orphans(sales: DataFrame, key: Column, known: DataFrame, check: str) -> DataFrame:
    """Number of sales whose key is unknown. Sales are counted per key first, so the join moves each key once."""
    per_key = sales.groupBy(key.alias("_sold")).agg(F.count(F.lit(1)).alias("_lines"))
    unknown = per_key.join(known, per_key._sold == known._key, "left_anti")
    total = unknown.agg(F.coalesce(F.sum("_lines"), F.lit(0)).alias("violations"))
    return total.select(
        F.lit(SILVER).alias("layer"),
        F.lit("crm_sales_details").alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(ERROR).alias("severity"),
        "violations",
        F.when(F.col("violations") > 0, 1).otherwise(0).alias("failed"),
    )


def _existence(spark: SparkSession, silver: Tables, gold: Tables) -> DataFrame:
    wanted = [(SILVER, t, silver) for t in ("crm_cust_info", "crm_prd_info", "crm_sales_details")]
    wanted += [(GOLD, t, gold) for t in GOLD_OBJECTS]
    missing = [(layer, t, int(tables.get(t) is None)) for layer, t, tables in wanted]
    return spark.createDataFrame(
        [(layer, t, "missing", ERROR, n, n) for layer, t, n in missing],
        "layer STRING, table_name STRING, check_name STRING, severity STRING, violations BIGINT, failed INT",
    )


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
