"""Quality checks: each takes a table and returns the rows that break the rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import mul, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.cleansing import is_untrimmed, today
from smelter.functions.dates import is_invalid_day
from smelter.functions.keys import comparable, product_number
from smelter.session import written_once

# Fixed value: the earliest birth date taken as real.
EARLIEST_BIRTH = dt.date(1924, 1, 1)

WORD_BITS = 6  # 64 keys a word
BROADCAST_ROWS = 1_000_000


# ---- rules as conditions -------------------------------------------------------------------------------------


def any_untrimmed(columns: Sequence[str]) -> Column:
    return reduce(or_, [is_untrimmed(F.col(c)) for c in columns])


def bad_cost(lowest: int) -> Column:
    return F.col("prd_cost").isNull() | (F.col("prd_cost") < lowest)


def inverted_range(start: str, end: str) -> Column:
    return F.col(end) < F.col(start)


def ordered_late() -> Column:
    order = F.col("sls_order_dt")
    return (order > F.col("sls_ship_dt")) | (order > F.col("sls_due_dt"))


def wrong_product() -> Column:
    """Sales that differ from quantity times price. The product is a BIGINT, so it cannot overflow."""
    return F.col("sls_sales") != F.col("sls_quantity").cast("bigint") * F.col("sls_price")


def inconsistent_sales() -> Column:
    """Wrong product, or one of the three missing or not positive."""
    return reduce(
        or_,
        [F.col(c).isNull() | (F.col(c) <= 0) for c in ("sls_sales", "sls_quantity", "sls_price")],
        wrong_product(),
    )


def birth_out_of_range(as_of: dt.date | None) -> Column:
    born = F.to_date("bdate")
    return (born < F.lit(EARLIEST_BIRTH)) | (born > today(as_of))


# ---- rows that break a rule ----------------------------------------------------------------------------------


def repeated_keys(df: DataFrame, key: str, null_breaks: bool = True) -> DataFrame:
    """Keys held by more than one row, with their row count; the NULL key too where it ``null_breaks`` the rule.

    Counts are added up before the shuffle, so a key with much of the table costs one row per task.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    breaks = F.col("row_count") > 1
    return counts.filter(breaks | F.col(key).isNull() if null_breaks else breaks)


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, NULL included."""
    return df.select(column).distinct()


def untrimmed_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(any_untrimmed(columns))


def bad_costs(products: DataFrame, lowest: int = 0) -> DataFrame:
    return products.filter(bad_cost(lowest)).select("prd_cost")


def inverted_products(products: DataFrame) -> DataFrame:
    return products.filter(inverted_range("prd_start_dt", "prd_end_dt"))


def invalid_due_dates(sales: DataFrame) -> DataFrame:
    due = F.col("sls_due_dt")
    return sales.filter(is_invalid_day(due)).select(F.nullif(due, F.lit(0)).alias("sls_due_dt"))


def late_orders(sales: DataFrame) -> DataFrame:
    return sales.filter(ordered_late())


def inconsistent_triples(sales: DataFrame) -> DataFrame:
    """Distinct triples, in order."""
    triple = ["sls_sales", "sls_quantity", "sls_price"]
    return sales.filter(inconsistent_sales()).select(*triple).distinct().orderBy(*triple)


def odd_birth_dates(demographics: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return demographics.filter(birth_out_of_range(as_of)).select("bdate").distinct()


def sales_without_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales rows whose customer does not exist; those with a NULL customer included."""
    return sales.join(customers, sales.sls_cust_id == customers.cust_id, "left_anti")


def sales_without_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales rows whose product number does not exist; those with a NULL number included."""
    numbers = products.select(comparable(product_number(F.col("prd_key"))).alias("_number"))
    return sales.join(numbers, comparable(sales.sls_prd_key) == numbers._number, "left_anti")


def disconnected_facts(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fact rows that miss a dimension, with a 0/1 column for each.

    A row that misses one dimension is there as often as the other one holds its key, as left joins give it. The fact isn't
    shuffled where the dimensions' keys are dense: see ``_key_words``, which are counted when this is called.
    """
    rows, missing, repeats = fact, {}, []
    for name, dimension in (("customer", customers), ("product", products)):
        key = F.col(f"{name}_key").cast("bigint")
        words, repeated = _key_words(dimension, f"{name}_key", f"_{name}")
        rows = rows.join(words, F.shiftright(key, WORD_BITS) == F.col(f"_{name}_word"), "left")
        held = F.call_function("shiftright", F.col(f"_{name}_bits"), _place(key)).bitwiseAND(F.lit(1)) == 1
        missing[name] = ~F.coalesce(held, F.lit(False))
        if repeated:
            repeats.append(F.coalesce(F.try_element_at(F.col(f"_{name}_copies"), key), F.lit(1)))
    found = rows.filter(reduce(or_, missing.values()))
    if repeats:
        found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), reduce(mul, repeats))))
    return found.select(*fact.columns, *[m.cast("int").alias(f"no_{name}") for name, m in missing.items()])


def _key_words(dimension: DataFrame, key: str, name: str) -> tuple[DataFrame, bool]:
    """A dimension's whole-number keys as sets of bits, a row per 64 consecutive numbers, and whether any key repeats.

    Beside its bits a row has the numbers of rows of those keys that repeat. Up to ``BROADCAST_ROWS`` rows and repeated keys
    are broadcast, which dense keys of 64 million members are; beyond, they join as any other table.
    """
    number = F.col(key).cast("bigint")
    counts = dimension.filter(number.isNotNull()).groupBy(number.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(F.col("_key")))
    several = F.collect_list(F.when(F.col("_n") > 1, F.struct("_key", "_n")))
    words = counts.groupBy(F.shiftright("_key", WORD_BITS).alias(f"{name}_word")).agg(
        F.bit_or(bit).alias(f"{name}_bits"), F.map_from_entries(several).alias(f"{name}_copies")
    )
    words, _ = written_once(words, "key_words")
    size = words.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size(f"{name}_copies")), F.lit(0)).alias("repeated")).first()
    few = size["rows"] + size["repeated"] <= BROADCAST_ROWS
    return (F.broadcast(words) if few else words), size["repeated"] > 0


def _place(key: Column) -> Column:
    """The key's place among the bits of its word."""
    return key.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
