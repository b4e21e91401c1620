"""Cleansing driven by column names and types, for any table of a layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.functions.cleansing import GENDER, MARITAL_STATUS, UNKNOWN, code_label, future_flag
from smelter.operators.latest import latest_record
from smelter.plans.bronze import AUDIT_TABLE, REJECTS_TABLE
from smelter.schemas import AUDIT_COLUMN, BRONZE, FUTURE_COLUMN
from smelter.sources.tables import Warehouse

# Columns taken as a table's key, and the date that orders its records.
KEY_COLUMNS = ("cust_id", "id", "cid", "prd_id", "sls_id", "order_id")
RECORD_DATE = "cust_create_date"

Rule = tuple[Callable[[T.StructField], bool], Callable[[T.StructField, dt.date | None], list[Column]]]


def _named(*names: str) -> Callable[[T.StructField], bool]:
    return lambda field: field.name.lower() in names


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _trimmed(field, as_of):
    return [F.trim(field.name).alias(field.name)]


def _labelled(labels):
    return lambda field, as_of: [code_label(F.col(field.name), labels, UNKNOWN).alias(field.name)]


def _dated(field, as_of):
    return [F.col(field.name), future_flag(F.col(field.name), as_of).alias(FUTURE_COLUMN)]


# The first rule that fits a column applies; a column that none fits stays as it is.
RULES: Sequence[Rule] = (
    (_named("cust_marital_status"), _labelled(MARITAL_STATUS)),
    (_named("cust_gender"), _labelled(GENDER)),
    (_named(RECORD_DATE), _dated),
    (_is_text, _trimmed),
)


def key_column(df: DataFrame, candidates: Sequence[str] = KEY_COLUMNS) -> str | None:
    """The table's first column that is named like a key."""
    return next((c for c in df.columns if c in candidates), None)


def clean(
    df: DataFrame,
    as_of: dt.date | None = None,
    rules: Sequence[Rule] = RULES,
    ties: Sequence[str] = (),
    keep_null_key: bool = False,
) -> DataFrame:
    """Clean every column by its rule; where the table has a key and a record date, keep the latest record per key."""
    key = key_column(df)
    if key is not None and RECORD_DATE in df.columns:
        df = latest_record(df, key, RECORD_DATE, ties, keep_null_key)
    columns: list[Column] = []
    dated = RECORD_DATE in (c.lower() for c in df.columns)
    for field in df.schema.fields:
        if dated and field.name.lower() == FUTURE_COLUMN:
            continue  # an earlier flag is replaced
        rule = next((apply for fits, apply in rules if fits(field)), None)
        columns += rule(field, as_of) if rule else [F.col(field.name)]
    return df.select(*columns)


def clean_layer(warehouse: Warehouse, layer: str = BRONZE, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """The cleaned form of every table that the catalog lists in a layer, but for the load's own records."""
    own = (AUDIT_TABLE, REJECTS_TABLE)
    return {t: clean(warehouse.read(layer, t).drop(AUDIT_COLUMN), as_of) for t in warehouse.tables(layer) if t not in own}
