"""Builds from increments: latest records and quality summaries that take in a load without reading earlier ones again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.operators.latest import latest_record
from smelter.plans.quality import groups_of, summary_plans, totals_of, union_frames
from smelter.session import written_once
from smelter.sources.tables import Warehouse

PART = "key_part"
PARTS = 64


def merge_latest(
    warehouse: Warehouse, layer: str, table: str, batch: DataFrame, key: str, order: str, ties: Sequence[str] = (), parts: int = PARTS
) -> None:
    """Take a batch into a stored table of latest records, as if all batches had come at once.

    The table is partitioned by a hash of the key into ``parts`` folders, a number that stays with it. Only folders that the
    batch has keys of are read and replaced. A record's rank is a total order over its columns, so the latest of the stored
    record and the batch is the latest of all. The table is created by the first batch; it must be merged by one writer at a time.
    """
    part = F.pmod(F.hash(key), F.lit(parts)).alias(PART)
    new = latest_record(batch, key, order, ties)
    if not warehouse.exists(layer, table):
        warehouse.overwrite(layer, table, new.select("*", part).hint("rebalance", F.col(PART)), [PART])
        return
    touched = [r[0] for r in batch.filter(F.col(key).isNotNull()).select(part).distinct().collect()]  # at most ``parts``
    if not touched:
        return
    columns = batch.columns
    held = warehouse.read(layer, table).filter(F.col(PART).isin(touched)).select(*columns)
    merged = latest_record(held.unionByName(new.select(*columns)), key, order, ties)
    merged, _ = written_once(merged.select("*", part).hint("rebalance", F.col(PART)), "merged")  # the table can't be read while it is replaced
    warehouse.replace_partitions(layer, table, merged)


def latest_rows(warehouse: Warehouse, layer: str, table: str) -> DataFrame:
    return warehouse.read(layer, table).drop(PART)


def summary_table(table: str) -> str:
    return f"summary_{table}"


def add_to_summary(warehouse: Warehouse, layer: str, tables: dict[str, DataFrame], as_of: dt.date | None = None) -> None:
    """Count a load's rows for the quality suite and keep the counts; ``tables`` may be some of the layer's.

    What is kept is one row per load and group (key, value triple or birth date), with its number of rows and of rule
    breaks. These numbers add up over loads, which distinct counts and repeated keys alone wouldn't.
    """
    for table, keys, row_rules, _ in summary_plans(tables, as_of):
        groups = groups_of(tables[table], keys, row_rules)
        name = summary_table(table)
        if not warehouse.exists(layer, name):
            warehouse.create_table(layer, name, groups.schema)
        warehouse.append(layer, name, groups, groups.columns)


def summary(warehouse: Warehouse, layer: str, schemas: dict[str, DataFrame], as_of: dt.date | None = None) -> DataFrame:
    """The suite's violations over all loads counted so far, from the kept counts alone.

    ``schemas`` are frames with the tables' columns; none of their rows is read.
    """
    found = []
    for table, keys, row_rules, group_rules in summary_plans(schemas, as_of):
        kept = warehouse.read(layer, summary_table(table))
        sums = [F.sum(c).alias(c) for c in ("_rows", *row_rules)]
        found.append(totals_of(kept.groupBy(*keys).agg(*sums), row_rules, group_rules))
    return union_frames(found)
