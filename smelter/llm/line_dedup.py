"""Line deduplication: lines that occur in many documents stay in one of them.

A line's key is the line without white space (0x20, 0x09-0x0D) at both ends and with A-Z lower-cased. Keys of at least
``LEAST_CHARACTERS`` code points are hashed (SHA-256) and exploded; documents are counted per hash. Of a hash found in at
least ``LEAST_DOCUMENTS`` documents, all lines go but those in the document with the largest id. Texts are put together
again from their remaining lines, by position.

Texts don't move. Each document is described once by its id, the digest of its text and the hashes of its lines, which is
what the counts and the dropped positions are made of; these are joined to the documents by id and digest. Counts are
first taken per hash and document and then per hash, both added up before their shuffle, so that a line held by a third of
all documents is spread over all tasks. Hashes to drop, and positions that texts lose, are broadcast up to a counted number and
joined by a shuffle beyond it, where adaptive execution splits hot ones.

A null or empty text is one empty line and stays as it is. Rows that repeat an id are one document when documents are
counted, and each gets a result of its own; rows without an id are one document too, below all ids. Line breaks are ``\\n``
alone; a ``\\r`` before one is white space of the key and stays in the text. A line repeated within a document counts once,
and goes or stays in all its places. Extra columns, also of the names used here, are carried along by ``without_repeats``.
An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.shared import free_names, needed, small_side, stored

LEAST_CHARACTERS = 40
LEAST_DOCUMENTS = 5
BROADCAST_POSITIONS = 500_000
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOCUMENT = {"doc_id": "long", "text": "string"}


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _lower_ascii(text: Column) -> Column:
    """A-Z lower-cased; a text of ASCII alone, which has one byte per character, takes the faster built-in way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _line_hashes(text: Column) -> Column:
    """Per line the hash of its key, or null if the key is too short."""
    keys = F.transform(F.split(_lower_ascii(text), "\n"), lambda x: F.btrim(x, F.lit(SPACE)))
    return F.transform(keys, lambda x: F.when(F.char_length(x) >= LEAST_CHARACTERS, digest(x)))


def dropped_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``doc_id, text_digest, positions``: the rising positions, from 0, of the lines that a text loses in that document."""
    rows = needed(docs, DOCUMENT).withColumn("text", F.coalesce("text", F.lit("")))
    described = stored(rows.select("doc_id", digest(F.col("text")).alias("text_digest"), _line_hashes(F.col("text")).alias("hashes")), "lines")
    held = described.select("doc_id", F.explode(F.array_distinct(F.array_compact("hashes"))).alias("line"))
    per_line = held.groupBy("line", "doc_id").agg(F.lit(1).alias("one")).groupBy("line").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    repeated = small_side(stored(per_line.filter(F.col("n") >= least_documents).select("line", "keeper"), "repeated"))
    places = described.select("doc_id", "text_digest", F.posexplode("hashes").alias("position", "line")).filter(F.col("line").isNotNull())
    lost = places.join(repeated, "line").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # Rows equal in id and text lose the same lines, so a set per id and text is bounded by the text's lines.
    return lost.groupBy("doc_id", "text_digest").agg(F.sort_array(F.collect_set("position")).alias("positions"))


def _without(lines: Column, positions: Column) -> Column:
    """The lines but those at the rising positions: the runs between them, one after another."""
    last = F.size(positions)

    def run(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(positions, i - 1) + 1)
        end = F.when(i == last, F.size(lines)).otherwise(F.get(positions, i))
        return F.slice(lines, start + 1, end - start)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), last), run)), "\n")


def _reassembled(docs: DataFrame, names: dict[str, str], least_documents: int) -> DataFrame:
    """The documents with their lines, the number of lines that go and the text that is left, under the given names."""
    dropped = stored(dropped_lines(docs, least_documents).toDF(names["id"], names["digest"], names["positions"]), "dropped")
    n_positions = dropped.agg(F.sum(F.size(names["positions"]))).first()[0] or 0
    dropped = F.broadcast(dropped) if n_positions <= BROADCAST_POSITIONS else dropped
    doc_id = (docs["doc_id"] if "doc_id" in docs.columns else F.lit(None)).cast("long")
    text = F.coalesce((docs["text"] if "text" in docs.columns else F.lit(None)).cast("string"), F.lit(""))
    same = (digest(text) == dropped[names["digest"]]) & doc_id.eqNullSafe(dropped[names["id"]])
    rows = docs.join(dropped, same, "left").withColumn(names["lines"], F.split(text, "\n"))
    lines, positions = F.col(names["lines"]), F.col(names["positions"])
    kept = F.when(positions.isNull(), text).otherwise(_without(lines, positions))
    return rows.select(
        *[docs[c] for c in docs.columns],
        F.size(lines).cast("long").alias(names["n_lines"]),
        F.coalesce(F.size(positions), F.lit(0)).cast("long").alias(names["n_dropped"]),
        kept.alias(names["kept"]),
    )


def _names(docs: DataFrame) -> dict[str, str]:
    wanted = ("id", "digest", "positions", "lines", "n_lines", "n_dropped", "kept")
    return dict(zip(wanted, free_names(docs, *[f"line_{w}" for w in wanted]), strict=True))


def without_repeats(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """The documents with all their columns, their texts without the repeated lines."""
    names = _names(docs)
    rows = _reassembled(docs, names, least_documents)
    text = F.when(F.col(names["n_dropped"]) > 0, F.col(names["kept"])).otherwise(docs["text"])
    return rows.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])


def line_report(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Per row its id, its lines before, the lines dropped, and the digest of the text that is left."""
    names = _names(docs)
    rows = _reassembled(needed(docs, DOCUMENT), names, least_documents)
    return rows.select(
        "doc_id",
        F.col(names["n_lines"]).alias("n_lines"),
        F.col(names["n_dropped"]).alias("n_dropped"),
        F.sha2(F.col(names["kept"]), 256).alias("kept_sha256"),
    )
