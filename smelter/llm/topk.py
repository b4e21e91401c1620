"""Exact top-k search by distributed histograms of the scores.

All scores of a block of queries against a block of candidates are one matrix product. Instead of keeping scores, each
block counts them per query into the cells of an interval that is known to hold the query's k-th best score. The counts
are added up over all blocks, the cell that holds the k-th best becomes the next interval, and so on until it is a
single number. Then only scores that reach it are kept, and ties are broken by the smaller id. A block keeps no more
than its own k best, so that any number of equal vectors stays bounded.

Vectors become integers, so scores are exact at any size that fits a long; a score beyond that is taken as the nearer of
-(2**63 - 1) and 2**63 - 1, and so is tied with others there. A component beyond a long is taken as the long's end.

A vector takes no part if it is null or holds a null or non-finite component, or if its id is null. Of rows that repeat an
id, the smallest vector stands for it. Missing components of shorter vectors count as 0. No queries or no candidates give
no rows. Extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from smelter.llm.shared import needed, stored
from smelter.session import ship_package

SCALE = 1024
CELLS = 256
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
SLICE = 512
LONGEST = 2**63 - 1
WIDE = "decimal(20,0)"  # an interval may be as wide as all longs


def whole_vectors(table: DataFrame) -> DataFrame:
    """``vec_id`` and the vector in whole numbers, of those that take part."""
    rows = needed(table, {"vec_id": "long", "embedding": "array<double>"})
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x * SCALE))
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).groupBy("vec_id").agg(F.min(whole).alias("vector"))


def top_k(table: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every row of ``vec_id`` that ``is_query`` holds for."""
    if k < 1:
        raise ValueError("k must be at least 1")
    ship_package(table.sparkSession)
    vectors = stored(whole_vectors(table), "vectors")
    facts = vectors.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("queries"), F.max(F.size("vector")).alias("width")).first()
    queries = vectors.filter(is_query).withColumnRenamed("vec_id", "query_id")
    # |score| is at most the product of the vectors' lengths.
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x))
    longest = vectors.agg(F.max(length)).first()[0] or 0.0
    most = length * (longest * (1 + 1e-9))
    bound = F.when(most < 9e18, (F.ceil(most) + 1).cast(WIDE)).otherwise(F.lit(LONGEST).cast(WIDE))
    interval = ((-bound).cast(WIDE).alias("low"), (2 * bound + 1).cast(WIDE).alias("span"))
    state = stored(queries.select("query_id", *interval, F.lit(k).cast("long").alias("wanted")), "state")

    blocks = _blocks(vectors, is_query, facts["n"], facts["queries"])
    while not state.filter("span > 1").isEmpty():
        counted = _in_blocks(blocks, state, _counting(facts["width"] or 0), "query_id long, cell int, n long")
        state = stored(_refined(state, counted), "state")
    best = _in_blocks(blocks, state, _choosing(facts["width"] or 0, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _blocks(vectors: DataFrame, is_query: Column, n: int, queries: int) -> DataFrame:
    """Every query in a copy per candidate block, every candidate in a copy per query block."""
    candidate_blocks, query_blocks = -(-n // CANDIDATE_BLOCK) or 1, -(-queries // QUERY_BLOCK) or 1
    asked = vectors.filter(is_query).select(
        F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks).cast("long")).alias("q"), F.explode(_up_to(candidate_blocks)).alias("c"), F.lit(True).alias("asks"), "vec_id", "vector"
    )
    offered = vectors.select(
        F.explode(_up_to(query_blocks)).alias("q"), F.pmod(F.xxhash64("vec_id"), F.lit(candidate_blocks).cast("long")).alias("c"), F.lit(False).alias("asks"), "vec_id", "vector"
    )
    return asked.unionByName(offered)


def _up_to(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _in_blocks(blocks: DataFrame, state: DataFrame, run: Callable, schema: str) -> DataFrame:
    intervals = state.withColumnRenamed("query_id", "vec_id").withColumn("asks", F.lit(True))
    return blocks.join(intervals, ["vec_id", "asks"], "left").groupBy("q", "c").applyInPandas(run, schema)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    matrix = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        matrix[i, : len(row)] = row
    return matrix


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two matrices of longs, held to +-LONGEST.

    float64 products are exact while no sum of magnitudes leaves 2**53. Beyond it, products of longs are exact modulo
    2**64, and the float64 product tells which of them fit; the few that it can't tell are multiplied in Python's integers.
    """
    floats = left.astype(float), right.astype(float)
    about = floats[0] @ floats[1].T
    magnitude = np.outer(np.sqrt((floats[0] ** 2).sum(1)), np.sqrt((floats[1] ** 2).sum(1))) * (1 + 1e-9)
    if magnitude.size == 0 or magnitude.max() < 2**53:
        return about.astype(np.int64)
    exact = left @ right.T
    error = magnitude * ((left.shape[1] + 4) * 2.0**-52)
    beyond, fits = np.abs(about) - error > 2.0**63, np.abs(about) + error < 2.0**63 - 1024
    exact[beyond] = np.where(about[beyond] > 0, LONGEST, -LONGEST)
    for i, j in np.argwhere(~beyond & ~fits):
        product = sum(int(a) * int(b) for a, b in zip(left[i], right[j], strict=True))
        exact[i, j] = max(-LONGEST, min(LONGEST, product))
    return exact


def _scores(block: pd.DataFrame, width: int) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Slices of a block's queries, their scores against all its candidates, and the candidates' ids."""
    asks = block["asks"].to_numpy(bool)
    asked, offered = block[asks].sort_values("vec_id"), block[~asks].sort_values("vec_id")
    candidates, ids = _matrix(offered["vector"], width), offered["vec_id"].to_numpy(np.int64)
    for at in range(0, len(asked), SLICE):
        part = asked.iloc[at : at + SLICE]
        yield part, exact_products(_matrix(part["vector"], width), candidates), ids


def _whole(numbers: pd.Series, kind: type) -> np.ndarray:
    return np.array([int(x) for x in numbers], kind)


def _counting(width: int) -> Callable:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((0, 3), np.int64)]
        open_ones = block[~block["asks"].to_numpy(bool) | (block["span"] > 1)]
        for part, scores, ids in _scores(open_ones, width):
            queries, lows, spans = part["vec_id"].to_numpy(np.int64), _whole(part["low"], np.int64), _whole(part["span"], np.uint64)
            # Distances from the lower end modulo 2**64: below the span exactly for the scores inside the interval.
            above = scores.view(np.uint64) - lows.view(np.uint64)[:, None]
            row, column = np.nonzero((above < spans[:, None]) & (ids != queries[:, None]))
            steps = (spans - np.uint64(1)) // np.uint64(CELLS) + np.uint64(1)
            cells = (above[row, column] // steps[row]).astype(np.int64)
            counts = np.bincount(row * CELLS + cells, minlength=1)
            some = np.flatnonzero(counts)
            found.append(np.column_stack([queries[some // CELLS], some % CELLS, counts[some]]))
        return pd.DataFrame(np.concatenate(found), columns=["query_id", "cell", "n"])

    return run


def _refined(state: DataFrame, counted: DataFrame) -> DataFrame:
    """Each query's next interval, and which of its scores is wanted there, counted from the top.

    With fewer than k candidates all are wanted: the interval closes at its lower end.
    """
    sums = counted.groupBy("query_id", "cell").agg(F.sum("n").alias("n"))
    cells = sums.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("cell", "n")), asc=False).alias("cells"))  # CELLS at most
    start = F.struct(F.lit(-1).alias("cell"), F.lit(0).cast("long").alias("above"))
    step = F.ceil(F.col("span") / CELLS).cast(WIDE)

    def next_cell(seen: Column, x: Column) -> Column:
        here = F.struct(x["cell"].alias("cell"), seen["above"].alias("above"))
        further = F.struct(F.lit(-1).alias("cell"), (seen["above"] + x["n"]).alias("above"))
        return F.when(seen["cell"] >= 0, seen).when(seen["above"] + x["n"] >= F.col("wanted"), here).otherwise(further)

    joined = state.join(cells, "query_id", "left").withColumn("at", F.aggregate(F.coalesce("cells", F.array().cast("array<struct<cell:int,n:long>>")), start, next_cell))
    done, found = F.col("span") <= 1, F.col("at")["cell"] >= 0
    return joined.select(
        "query_id",
        F.when(~done & found, F.col("low") + F.col("at")["cell"] * step).otherwise(F.col("low")).cast(WIDE).alias("low"),
        F.when(~done & found, F.least(step, F.col("span") - F.col("at")["cell"] * step)).otherwise(F.lit(1)).cast(WIDE).alias("span"),
        F.when(~done & found, F.col("wanted") - F.col("at")["above"]).otherwise(F.col("wanted")).alias("wanted"),
    )


def _choosing(width: int, k: int) -> Callable:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((0, 3), np.int64)]
        for part, scores, ids in _scores(block, width):
            for query, low, row in zip(part["vec_id"], _whole(part["low"], np.int64), scores, strict=True):
                fit = np.flatnonzero((row >= low) & (ids != query))
                fit = fit[np.argsort(-row[fit], kind="stable")[:k]]  # ids rise, so ties keep the smaller
                found.append(np.column_stack([np.full(len(fit), query), ids[fit], row[fit]]))
        return pd.DataFrame(np.concatenate(found), columns=["query_id", "vec_id", "score"])

    return run
