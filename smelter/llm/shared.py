"""Tables in the cluster's shared folder, and broadcasts of a checked size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.session import new_folder, ship_package, shuffles_go

BROADCAST_ROWS = 1_000_000
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there, and a lost executor loses nothing."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    with shuffles_go(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` returned, once no frame that is still to be evaluated reads them."""
    for table in tables:
        jvm, session = table.sparkSession._jvm, table.sparkSession._jsparkSession
        place = jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
        place.getFileSystem(session.sessionState().newHadoopConf()).delete(place, True)


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow``, with this package at hand for the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def small_side(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A join side of a few numbers per row: broadcast if it has at most ``rows`` rows, else shuffled as any other.

    Counts the rows, so hand in something stored.
    """
    return F.broadcast(keys) if keys.count() <= rows else keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def needed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The named columns, cast to the given types, whatever else the table has; a missing one is null."""
    have = set(df.columns)
    return df.select(*[(df[c] if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def free_names(df: DataFrame, *wanted: str) -> Iterator[str]:
    """For each wanted column name, one that the table doesn't have (case aside)."""
    taken = {c.lower() for c in df.columns}
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        yield name
