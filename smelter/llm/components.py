"""Connected components of a graph that is only held as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from smelter.llm.shared import discard, stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """For every node of the links ``(a, b)`` its component: columns ``node`` and ``component``, the smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to the smallest of all its
    neighbours, then its smaller neighbours and itself to the smallest of these. Both only take a minimum per node,
    which is added up before the shuffle, and join it back, where adaptive execution splits a node with very many
    links. The number of links never grows; the number of rounds grows with the logarithm of the number of nodes.
    Links with a null end are ignored. A node linked to itself alone is its own component. Each round's links are removed
    once the next ones are written.
    """
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(F.col("u").isNotNull() & F.col("v").isNotNull())
    nodes = stored(ends.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "nodes")
    edges, seen = _stored(_downward(ends))
    while seen[0]:
        former, (edges, now) = edges, _stored(_small_star(_large_star(edges)))
        discard(former)
        if now == seen:
            break
        seen = now
    result = stored(nodes.join(edges, nodes["node"] == edges["u"], "left").select("node", F.coalesce("v", "node").alias("component")), "components")
    discard(nodes, edges)
    return result


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The links, written and read again; their number and an order-free sum over them, equal only if the links are."""
    seen = Observation()
    total = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    edges = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("total")), "edges")
    return edges, (seen.get["n"], int(seen.get["total"]))


def _downward(pairs: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller end."""
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return _downward(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    joined = edges.join(least, "u")
    return _downward(joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select("u", F.col("least").alias("v"))))

