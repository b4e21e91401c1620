"""Surrogate keys that stay: a stored map of ids to keys, to which later loads only add.

A map has one row per member of a dimension, ``id``, ``copy`` (1 for the only row of an id, and on from there for ids with
several) and ``key``. Members that it lacks get the keys after its greatest one, in order of their ids; so the first map is
dense and in id order like ``surrogate_key``, and no later load changes a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.operators.surrogate import surrogate_key
from smelter.schemas import columns_of

MAP_SCHEMA = columns_of(id=T.LongType(), copy=T.LongType(), key=T.LongType())
CHUNK = 65536


def members(rows: DataFrame, id_column: str, copies: str) -> DataFrame:
    """``id, copy`` for every row that the rows' copies stand for.

    Counts are added up before the shuffle. An id with very many rows is cut into chunks that are dealt to all tasks before
    they are written out.
    """
    sums = rows.groupBy(F.col(id_column).cast("bigint").alias("id")).agg(F.sum(F.col(copies).cast("bigint")).alias("n"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / CHUNK).cast("bigint"))
    chunks = sums.select("id", "n", F.explode(starts).alias("chunk")).repartition("id", "chunk")
    last = F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK)
    return chunks.select("id", F.explode(F.sequence(F.col("chunk") * CHUNK + 1, last)).alias("copy"))


def lacking_keys(found: DataFrame, key_map: DataFrame) -> DataFrame:
    """Rows to add to the map: the members it lacks, numbered after its greatest key."""
    known = key_map.select(F.col("id").alias("_id"), F.col("copy").alias("_copy"))
    lacking = found.join(known, found["id"].eqNullSafe(known["_id"]) & (found["copy"] == known["_copy"]), "left_anti")
    greatest = key_map.agg(F.max("key")).first()[0] or 0
    return surrogate_key(lacking, "id", "_number").select("id", "copy", (F.col("_number") + greatest).alias("key"))
