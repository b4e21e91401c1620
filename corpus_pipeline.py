"""The corpus pipeline: quality rules, near duplicates, mixing to target weights, packing into windows.

Every stage takes the documents that the one before it kept, as a table written and read again, and works on all of them.
Stages before the last return the columns of ``documents``, whatever else a table has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.mixing import mix
from smelter.llm.ngram_join import jaccard_components
from smelter.llm.packing import pack
from smelter.llm.quality_rules import kept_documents
from smelter.llm.shared import free_names, needed, small_side, stored
from smelter.session import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id: five words, 0.8.

    Rows are compared by a key of their own, so rows that repeat an id, or have none, are documents like all others; of a
    group's rows with the smallest id one stays, and one without id only if none has an id.
    """
    key, other = free_names(docs, "row_key", "group_node")
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    keyed = needed(rows, {key: "long", "text": "string"}).withColumnRenamed(key, "doc_id")
    groups = stored(jaccard_components(keyed, width=5, p=80, q=100).select("doc_id", "component_id"), "groups")
    # A component's own node is in it, so the groups of several rows are those of the others.
    several = groups.filter("doc_id <> component_id").select("component_id").distinct()
    ids = needed(rows, {key: "long", "doc_id": "long"}).select(F.col(key).alias("row"), F.col("doc_id").alias("id"))
    members = groups.join(several, "component_id").select("component_id", F.col("doc_id").alias("row")).join(ids, "row")
    members = stored(members.select("component_id", "row", F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("rank")), "members")
    stay = members.groupBy("component_id").agg(F.min("rank")["row"].alias("stays"))
    others = stored(members.join(stay, "component_id").filter("row <> stays").select(F.col("row").alias(other)), "others")
    return rows.join(small_side(others), rows[key] == others[other], "left_anti").drop(key)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says."""
    return mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can't express the components of the second stage over whole tables, nor the tokenizer of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
