"""A Merkle manifest of a corpus, and a proof for every document by octopus multiproofs.

Every row of ``documents`` is a leaf: SHA-256 of its id, source, language, character count and text, each preceded by its
length in bytes. The leaves of a source, by rising id, form a tree in which runs of ``FAN`` nodes become one, up to the
source's subroot; the subroots, in order of the sources, form the last tree, up to the root.

1. Leaves are numbered in the order of source and id by a range shuffle: a row's number is its place in its partition and
   the rows of the partitions before. Neighbouring numbers form a leaf partition of ``BLOCK`` rows.
2. Nodes are built level by level; a group never has more than ``FAN`` rows, whatever a source holds.
3. A leaf partition knows a range of leaves in each of its trees. Of all its leaves' proofs together it lacks the nodes
   beside that range, on every level: the least union of coordinates, worked out from the ranges alone. They are fetched
   by one join.
4. Each leaf partition derives the nodes above its leaves, shared by many of them, and expands every single proof.

``root`` and ``subroot`` come from the tree of step 2; ``folded_root`` from the leaf partition: for a row as stored by the
nodes derived from it, for a tampered row by folding its changed leaf with its own siblings.

Any column may be null: a null field is ``-``, a null source comes first, a null id comes first in its source and is never
tampered with. Rows that repeat an id are ordered by their leaf; equal rows are leaves of their own, at neighbouring places,
and are spread over partitions like others. A source's only leaf is its subroot, and with one source that is the root; a
proof without siblings is the digest of nothing. Extra columns aren't read. An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.shared import needed, small_side, stored
from smelter.session import ship_package

BITS = 4
FAN = 1 << BITS
BLOCK_BITS = 12
DIGITS = 64
TOP = -1  # the tree over the subroots
PLACE_BITS = 33  # of monotonically_increasing_id
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_of(fields: Sequence[Column]) -> Column:
    """The digest (32 bytes) of the fields, each with its length."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """Each row's id, source and leaf, and the leaf of the changed text if the row is tampered with."""
    rows = needed(docs, FIELDS)
    changed = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & F.col("text").isNotNull()
    return rows.select("doc_id", "source", leaf_of([F.col(c) for c in FIELDS]).alias("leaf"), F.when(tampered, leaf_of(changed)).alias("changed"))


def numbered(rows: DataFrame, order: Sequence[Column], number: str) -> DataFrame:
    """``rows`` with their place, from 0, in an order; the counts that are collected are one per partition."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed, "placed").withColumn("_part", F.shiftright("_place", PLACE_BITS))
    counts = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for part in sorted(counts):
        offsets.append((part, before))
        before += counts[part]
    offsets = rows.sparkSession.createDataFrame(offsets, "_part long, _before long")
    place = F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1)
    return placed.join(F.broadcast(offsets), "_part").withColumn(number, F.col("_before") + place).drop("_part", "_before", "_place")


def _shifted(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, (level * BITS).cast("int"))


def _depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: the hexadecimal digits of n - 1."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.hex(n - 1)))


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """All nodes of trees, level by level from the given ones: ``tree, level, idx, n, digest``, n on that level.

    A tree's last level has one node. ``most`` is the largest tree's number of leaves.
    """
    found = [nodes.select("tree", F.lit(0).alias("level"), "idx", "n", "digest")]
    while most > 1:
        run = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        joined = F.array_join(F.transform(run, lambda x: F.lower(F.hex(x["digest"]))), "")
        above = found[-1].filter("n > 1").groupBy("tree", F.shiftright("idx", BITS).alias("above"))
        above = above.agg(F.unhex(F.sha2(joined, 256)).alias("digest"), (F.shiftright(F.max("n") - 1, BITS) + 1).alias("n"))
        found.append(stored(above.select("tree", F.lit(len(found)).alias("level"), F.col("above").alias("idx"), "n", "digest"), "nodes"))
        most = (most - 1 >> BITS) + 1
    return found


def _missing(ranges: DataFrame) -> DataFrame:
    """The nodes that the proofs of a leaf partition need and its own leaves don't give, and each tree's top node.

    ``ranges`` has the leaves ``low`` to ``high`` that a partition holds of a tree of ``n``. On a level, the ancestors of a
    range are a range too; what is missing are the other nodes of the runs at its two ends.
    """
    level, none = F.col("level"), F.array().cast("array<bigint>")
    each = ranges.withColumn("depth", _depth(F.col("n"))).withColumn("level", F.explode(F.sequence(F.lit(0), F.col("depth"))))
    each = each.select("*", _shifted(F.col("low"), level).alias("a"), _shifted(F.col("high"), level).alias("b"), _shifted(F.col("n") - 1, level).alias("last"))
    first, end = F.col("a").bitwiseAND(-FAN), F.least(F.col("b").bitwiseOR(FAN - 1), F.col("last"))
    left = F.when(first < F.col("a"), F.sequence(first, F.col("a") - 1)).otherwise(none)
    right = F.when(F.col("b") < end, F.sequence(F.col("b") + 1, end)).otherwise(none)
    top = F.array(F.lit(0).cast("bigint"))
    return each.select("block", "tree", "level", F.explode(F.when(level == F.col("depth"), top).otherwise(F.concat(left, right))).alias("idx"))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, its leaf, subroot and root, the digest of its proof, and the root folded from that proof."""
    ship_package(docs.sparkSession)
    # Equal rows are told apart by their place in a stored table, so that a range can split them.
    rows = stored(leaves(docs), "leaves").withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("copy").asc()]
    rows = numbered(rows, order, "number")
    sources = rows.groupBy("source").agg(F.min("number").alias("start"), F.count("*").alias("n"))
    trees = stored(numbered(sources, [F.col("start").asc()], "tree").withColumnRenamed("source", "of"), "trees")
    facts = trees.agg(F.count("*").alias("trees"), F.max("n").alias("largest")).first()

    located = rows.join(small_side(trees), rows["source"].eqNullSafe(trees["of"])).select(
        F.shiftright("number", BLOCK_BITS).alias("block"), "tree", (F.col("number") - F.col("start")).alias("idx"), "n", "doc_id", F.col("leaf").alias("digest"), "changed"
    )
    located = stored(located, "located")
    levels = _levels(located, facts["largest"] or 0)
    subroots = _union([level.filter("n = 1") for level in levels])
    levels += _levels(stored(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(facts["trees"]).cast("long").alias("n"), "digest"), "subroots"), facts["trees"])

    ranges = located.groupBy("block", "tree").agg(F.min("idx").alias("low"), F.max("idx").alias("high"), F.max("n").alias("n"))
    ranges = stored(ranges, "ranges")
    top = ranges.groupBy("block").agg(F.min("tree").alias("low"), F.max("tree").alias("high"))
    ranges = ranges.unionByName(top.withColumn("tree", F.lit(TOP).cast("long")).withColumn("n", F.lit(facts["trees"]).cast("long")))
    wanted = small_side(stored(_missing(ranges), "wanted"))
    fetched = _union(levels).join(wanted, ["tree", "level", "idx"]).select("block", "tree", "level", "idx", "digest")
    fetched = fetched.toDF(*[f"fetched_{c}" for c in fetched.columns])
    return located.groupBy("block").cogroup(fetched.groupBy("fetched_block")).applyInPandas(_proofs_of(facts["trees"]), PROOFS)


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


class _Tree:
    """What a leaf partition knows of a tree of ``n`` leaves: its runs above the own leaves, as hexadecimal text."""

    def __init__(self, n: int, own: dict[int, bytes], fetched: dict[int, dict[int, bytes]]):
        self.runs: list[dict[int, bytes]] = []
        level = 0
        while n > 1:
            known = fetched.get(level, {}) | own
            parents = sorted({i >> BITS for i in own})
            runs = {r: b"".join([known[i] for i in range(r << BITS, min(r + 1 << BITS, n))]) for r in parents}
            self.runs.append(runs)
            own = {r: _hash(joined) for r, joined in runs.items()}
            level, n = level + 1, (n - 1 >> BITS) + 1
        self.root, self.claimed = own[0], fetched[level][0]

    def paths(self, above: bytes) -> dict[int, bytes]:
        """For every run of leaves the siblings of its ancestors, up to the root, and what follows ``above`` it."""
        found = {0: above}
        for runs in reversed(self.runs[1:]):
            found = {i: b"".join(_others(joined, i)) + found[r] for r, joined in runs.items() for i in range(r << BITS, (r << BITS) + len(joined) // DIGITS)}
        return found

    def folded(self, i: int, node: bytes) -> bytes:
        """The root, if leaf ``i`` were ``node`` and all its siblings were the same."""
        for runs in self.runs:
            before, after = _others(runs[i >> BITS], i)
            node, i = _hash(before + node + after), i >> BITS
        return node


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def _others(joined: bytes, i: int) -> tuple[bytes, bytes]:
    """A run's nodes before and after node ``i``."""
    at = (i & FAN - 1) * DIGITS
    return joined[:at], joined[at + DIGITS :]


def _proofs_of(n_trees: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def proofs(own: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        nodes: dict[int, dict[int, dict[int, bytes]]] = defaultdict(lambda: defaultdict(dict))
        for tree, level, i, digest in zip(*(fetched[f"fetched_{c}"].tolist() for c in ("tree", "level", "idx", "digest")), strict=True):
            nodes[tree][level][i] = digest.hex().encode()
        held: dict[int, dict[int, bytes]] = defaultdict(dict)
        sizes = {}
        for tree, i, n, digest in zip(*(own[c].tolist() for c in ("tree", "idx", "n", "digest")), strict=True):
            held[tree][i], sizes[tree] = digest.hex().encode(), n
        trees = {tree: _Tree(sizes[tree], found, nodes[tree]) for tree, found in held.items()}
        top = _Tree(n_trees, {tree: t.root for tree, t in trees.items()}, nodes[TOP])
        over_trees = top.paths(b"")
        paths = {}
        for tree, t in trees.items():
            beside = b"".join(_others(top.runs[0][tree >> BITS], tree)) if top.runs else b""
            paths[tree] = t.paths(beside + over_trees[tree >> BITS if top.runs else 0])

        found = []
        for doc_id, tree, i, changed in zip(*(own[c].tolist() for c in ("doc_id", "tree", "idx", "changed")), strict=True):
            t = trees[tree]
            leaf, path = held[tree][i], paths[tree][i >> BITS if t.runs else 0]
            siblings = b"".join(_others(t.runs[0][i >> BITS], i)) if t.runs else b""
            folded = top.folded(tree, t.folded(i, changed.hex().encode())) if changed is not None else top.root
            row = (doc_id, leaf, t.claimed, top.claimed, _hash(siblings + path), folded)
            found.append((row[0], *(x.decode() for x in row[1:]), folded == top.claimed))
        frame = pd.DataFrame(found, columns=[c.split()[0] for c in PROOFS.split(", ")])
        return frame.astype({"doc_id": "Int64"})

    return proofs
