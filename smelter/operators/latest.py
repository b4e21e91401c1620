"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_record(
    df: DataFrame,
    key: str,
    order: str,
    ties: Sequence[str] = (),
    keep_null_key: bool = False,
) -> DataFrame:
    """The row with the greatest ``order`` for each ``key``; NULL dates come last.

    ``ties`` decide between equal dates, greatest first, and after them all other columns, so that the choice never
    depends on row order: a recomputed task picks the same row. Spark cuts each map partition to one row per key before
    the shuffle (``WindowGroupLimit``), so a key that holds much of the table costs one row per task.
    """
    first = [order, *ties]
    rest = [c for c in df.columns if c != key and c not in first]
    ranking = [F.col(c).desc_nulls_last() for c in first + rest]
    rows = df if keep_null_key else df.filter(F.col(key).isNotNull())
    return (
        rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*ranking)))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
