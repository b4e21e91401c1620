"""Mixing the sources of a corpus to target weights, by repetition rates.

The sizes (words) are added up per source. Targets share out the total by weight; no target exceeds ``LIMIT`` times its
source, and what is cut off there is shared out again by weight. A source's rate is its target over its size: every
document is taken floor(rate) times, and once more if a number drawn from its id's hash is below the rate's fraction.

The sums are added up in each task before the shuffle; one row per source then goes through one task, so the number of
sources has to fit there, the number of documents doesn't matter. The rates are stored and joined to the rows; up to the
number of them that a broadcast may have, no document moves.

A null text has no words and is taken as its source's rate says. A null source is a source, last in order. Rows that
repeat an id draw the same number. A source without words has target 0 and isn't taken. Extra columns, also of the names
used here, are carried along by ``mix``. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.shared import free_names, needed, small_side, stored

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    """Runs of characters other than blank and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def drawn(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone: 52 bits of a digest."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(SEED)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources whose limit is reached first, as the level of size per weight rises, are the ones with the smallest source
    size per weight; so one ordered pass finds the level at which the uncapped ones share what the capped ones leave.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*map(F.lit, WEIGHTS))[((F.row_number().over(by_name) - 1) % len(WEIGHTS)).cast("int")]
    weighed = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * LIMIT)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    # The level if exactly the sources before this one were capped.
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = weighed.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    # The first source that isn't capped sets the level for itself and all after it.
    final = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(every)["level"]
    return levels.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * final).alias("target"))


def copies(target: Column, source_size: Column, doc_id: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (drawn(doc_id) < rate - F.floor(rate)).cast("long")).cast("long")


def repetitions(docs: DataFrame) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes of it."""
    sized = needed(docs, {"doc_id": "long", "text": "string", "source": "string"}).select("doc_id", "source", word_count(F.col("text")).alias("size"))
    rates = small_side(stored(targets(sized).withColumnRenamed("source", "of_source"), "rates"))
    joined = sized.join(rates, sized["source"].eqNullSafe(rates["of_source"]), "left")
    n = copies(F.col("target"), F.col("source_size"), F.col("doc_id"))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken"), n.alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns."""
    rate_source, rate_size, rate_target, copy = free_names(docs, "rate_source", "rate_size", "rate_target", "copy")
    sizes = needed(docs, {"text": "string", "source": "string"}).select("source", word_count(F.col("text")).alias("size"))
    rates = small_side(stored(targets(sizes).toDF(rate_source, rate_size, rate_target), "rates"))
    source = docs["source"].cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    doc_id = docs["doc_id"] if "doc_id" in docs.columns else F.lit(None)
    joined = docs.join(rates, source.eqNullSafe(rates[rate_source]))
    n = copies(F.col(rate_target), F.col(rate_size), doc_id)
    return joined.select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(1), n.cast("int"))).alias(copy)).drop(copy)
