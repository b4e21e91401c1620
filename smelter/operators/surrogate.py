"""Dense surrogate keys 1..n in id order, without sorting the table in one task.

A plain ``row_number() OVER (ORDER BY id)`` moves all rows to a single task. Here the id axis is cut into cells of
consecutive ids whose rows are few enough to be numbered in one task each, and a running total over the cells gives each
cell's first number:

1. Write the rows once. Their number and the span of their ids are observed in that write, so the input is evaluated a
   single time; all that follows reads the stored rows, and the counts read the id column alone.
2. Count the rows per cell: the span in parts of equal width, as many as the number of rows asks for. Partial counts are
   added up before the shuffle.
3. A cell with too many rows is divided further, by as many counts again, until it is small or holds a single id. All
   counts together stay within ``MOST_CELLS``, so the driver can keep them and a broadcast can carry them.
4. A single id with too many rows is split by a hash of the rows' content into as many parts as its count asks for.

Rows of equal id are ordered by that hash, and then by their content, on every path; so the keys don't depend on where
cells or parts are cut. Copies of one row can be handed in as a count (``collapse_copies``); it is cut into chunks, which
step 4 spreads like other rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.session import written_once

CELL_BITS = 16
CELL_ROWS = 1 << 18
CELLS_PER_LIMIT = 16
MOST_CELLS = 1 << 18
CHUNK = 65536
NULL_SLOT = -(2**63)  # sorts before every id


class Cell(NamedTuple):
    """Ids with the same ``slot >> shift``."""

    low: int
    shift: int
    rows: int
    single: bool


def collapse_copies(df: DataFrame, count_column: str) -> DataFrame:
    """Distinct rows with their number of copies; the partial count runs before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count_column))


def surrogate_key(df: DataFrame, id_column: str, key_column: str, copies: str | None = None) -> DataFrame:
    """Add ``key_column``: 1..n by ascending ``id_column``, NULL first.

    ``copies`` names a column with the number of copies that each row stands for; the result has them all, numbered,
    without that column. The frame is evaluated once, when this is called. The least BIGINT counts as NULL does.
    """
    kind = df.schema[id_column].dataType
    if not isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        raise TypeError(f"{id_column} must be a whole number")
    payload = [c for c in df.columns if c != copies]
    number = F.col(id_column).cast("bigint")
    known = F.when(number != NULL_SLOT, number)
    total = F.sum(F.col(copies).cast("bigint")) if copies else F.count(F.lit(1))
    df, facts = written_once(df, "numbered", low=F.min(known), high=F.max(known), rows=total)
    rows = _chunked(df, payload, copies)
    slot = F.coalesce(number, F.lit(NULL_SLOT))
    rows = rows.select("*", slot.alias("_slot"), F.xxhash64(*payload, "_chunk").alias("_hash"))
    placed = _placed(rows, _cells(rows, _shift(**facts)))

    rank = Window.partitionBy("_cell", "_part").orderBy("_slot", "_hash", *payload, "_chunk")
    upto = rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.col("_before") + F.sum("_rows").over(upto) - F.col("_rows") + 1
    if copies is None:
        return placed.select(*payload, first.alias(key_column))
    numbered = placed.select(*payload, "_rows", first.alias("_first"))
    return numbered.select(*payload, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_rows") - 1)).alias(key_column))


def _chunked(df: DataFrame, payload: list[str], copies: str | None) -> DataFrame:
    """Rows with a weight of at most ``CHUNK`` copies each."""
    if copies is None:
        return df.select(*payload, F.lit(0).cast("bigint").alias("_chunk"), F.lit(1).cast("bigint").alias("_rows"))
    n = F.col(copies).cast("bigint")
    last = F.floor((n - 1) / CHUNK).cast("bigint")
    chunks = df.select(*payload, n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_chunk"))
    rest = F.col("_n") - F.col("_chunk") * CHUNK
    return chunks.select(*payload, "_chunk", F.least(F.lit(CHUNK).cast("bigint"), rest).alias("_rows"))


def _shift(low: int | None, high: int | None, rows: int | None) -> int:
    """The shift that leaves cells of a fraction of the limit if ids are spread evenly, and no more than 65,536 of them."""
    if low is None or high is None:
        return 0
    bits = min(CELL_BITS, ((rows or 0) * CELLS_PER_LIMIT // CELL_ROWS).bit_length())
    return max(0, (high - low).bit_length() - bits)


def _counted(rows: DataFrame, shift: int) -> list[Cell]:
    cell = F.shiftright("_slot", shift)
    sums = rows.groupBy(cell.alias("low")).agg(F.sum("_rows").alias("rows"), (F.min("_slot") == F.max("_slot")).alias("single"))
    return [Cell(r["low"], shift, r["rows"], r["single"]) for r in sums.collect()]  # bounded, see above


def _cells(rows: DataFrame, shift: int) -> list[Cell]:
    """Cells in id order, each with a bounded number of rows or with a single id."""
    cells = open_cells = _counted(rows, shift)
    limit = _limit(cells)
    while heavy := [c for c in open_cells if c.rows > limit and not c.single]:
        finer = max(0, heavy[0].shift - max(1, CELL_BITS - len(heavy).bit_length()))
        wanted = rows.sparkSession.createDataFrame([(c.low,) for c in heavy], "_wanted BIGINT")
        inside = rows.join(F.broadcast(wanted), F.shiftright("_slot", heavy[0].shift) == F.col("_wanted"), "left_semi")
        open_cells = _counted(inside, finer)
        gone = set(heavy)
        cells = [c for c in cells if c not in gone] + open_cells
    return sorted(cells, key=lambda c: c.low << c.shift)


def _limit(cells: list[Cell]) -> int:
    """Rows per cell: few enough for one task, and so many that there can't be more heavy cells than we can list."""
    return max(CELL_ROWS, sum(c.rows for c in cells) * 8 // MOST_CELLS)


def _placed(rows: DataFrame, cells: list[Cell]) -> DataFrame:
    """Rows with their cell, their part of it, and the number of rows before that part."""
    limit, before, listed = _limit(cells), 0, []
    for i, c in enumerate(cells):
        bits = (-(-c.rows // limit) - 1).bit_length() if c.rows > limit else 0
        listed.append((c.shift, c.low, i, bits, before))
        before += c.rows
    spark, names = rows.sparkSession, "_shift INT, _low BIGINT, _i BIGINT, _bits INT, _start BIGINT"
    # One join per width of cells, most often a single one; a row is in exactly one cell.
    found = []
    for n, shift in enumerate(sorted({c.shift for c in cells}, reverse=True) or [0]):
        of_width = spark.createDataFrame([x for x in listed if x[0] == shift], names).select("_low", F.struct("_i", "_bits", "_start").alias(f"_found{n}"))
        rows = rows.join(F.broadcast(of_width), F.shiftright("_slot", shift) == F.col("_low"), "left").drop("_low")
        found.append(f"_found{n}")
    cell = F.coalesce(*[F.col(c) for c in found])
    rows = rows.withColumn("_at", cell).drop(*found)
    # The hash's leading bits, in the hash's own order.
    part = F.when(F.col("_at._bits") > 0, _leading_bits(F.col("_hash"), F.col("_at._bits"))).otherwise(F.lit(0).cast("bigint"))
    rows = rows.select("*", F.col("_at._i").alias("_cell"), part.alias("_part"), F.col("_at._start").alias("_start")).drop("_at")
    if not any(x[3] for x in listed):
        return rows.withColumnRenamed("_start", "_before")
    hot = [x[2] for x in listed if x[3]]
    hot_cells = spark.createDataFrame([(i,) for i in hot], "_hot BIGINT")
    sizes = rows.join(F.broadcast(hot_cells), F.col("_cell") == F.col("_hot"), "left_semi").groupBy("_cell", "_part").agg(F.sum("_rows").alias("n"))
    sums, offsets = dict.fromkeys(hot, 0), []
    for r in sorted(sizes.collect()):  # at most two parts per full part, so MOST_CELLS bounds them
        offsets.append((r["_cell"], r["_part"], sums[r["_cell"]]))
        sums[r["_cell"]] += r["n"]
    inside = F.broadcast(spark.createDataFrame(offsets, "_cell BIGINT, _part BIGINT, _inside BIGINT"))
    return rows.join(inside, ["_cell", "_part"], "left").withColumn("_before", F.col("_start") + F.coalesce("_inside", F.lit(0))).drop("_inside", "_start")


def _leading_bits(value: Column, bits: Column) -> Column:
    """``value >> (64 - bits)``, for one or more bits."""
    return F.call_function("shiftright", value, (F.lit(64) - bits).cast("int"))
