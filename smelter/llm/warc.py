"""A content-addressed archive of web records, and WARC files written from it and read back.

An archive is a folder with two tables. ``payloads`` holds every distinct payload once, under its SHA-256; ``headers``
holds the exact header block of every record, and the address of its payload. A record is put together again by joining
the two. Payloads are checked when they are read: their digest is computed anew and compared with the address.

``write_warc`` joins the records and writes them as WARC files, each a single gzip member (Spark's writer ends a member
with its file). ``read_warc`` parses such files: header lines up to the empty line, then as many bytes as the header's
length says, whatever they hold. ``restored`` joins revisits to the responses that they refer to.

Records of equal payloads of at least ``SHORTEST`` bytes are one response, with the largest page id, and revisits of it.

A null html is an empty payload, a null url an empty target. Records without an id, and repeated ids, are kept, and have
record ids of their own; of rows equal in id and payload each is a response, and the payload is still stored once. An empty
table gives an empty archive and no records. A record of any length is read whole, one at a time. Extra columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.shared import map_batches, needed, shuffles_go, small_side, stored

SHORTEST = 1000
BREAK = "\r\n"
FILE_RECORDS = 20_000
RESPONSES_BROADCAST = 200_000  # lengths and digests, some 150 bytes a response


def write_archive(pages: DataFrame, folder: str, date: Column | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as an archive; ``date`` is the time of capture, by default that of the write."""
    date = F.current_timestamp() if date is None else date
    rows = needed(pages, {"page_id": "long", "url": "string", "html": "string"})
    rows = rows.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    digests = stored(
        rows.select(
            "page_id", "url", F.sha2("payload", 256).alias("address"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("length"),
            F.date_format(F.to_utc_timestamp(date, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    # Which record holds the payload is settled by ids and digests; payloads move only to be stored once.
    holders = digests.groupBy("address").agg(F.max(F.struct("page_id", "row")).alias("holder"))
    records = digests.join(holders, "address")
    revisit = (F.col("length") >= SHORTEST) & ~F.col("page_id").eqNullSafe(F.col("holder.page_id"))
    headers = records.select("address", revisit.alias("revisit"), _header_block(revisit).alias("header"))
    payloads = rows.select(F.sha2("payload", 256).alias("address"), "payload").dropDuplicates(["address"])
    with shuffles_go(pages.sparkSession):
        headers.write.parquet(f"{folder}/headers")
        payloads.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def _record_id(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), row.cast("string"), F.lit(">"))


def _header_block(revisit: Column) -> Column:
    """WARC header lines, each ended by a line break; the empty line after them isn't part of the block."""
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("row"))),
        F.concat(F.lit("WARC-Date: "), F.coalesce("date", F.lit("1970-01-01T00:00:00Z"))),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "sha1"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("holder.page_id"), F.col("holder.row")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("length")).cast("string")),
    ]
    return F.concat(F.concat_ws(BREAK, *lines), F.lit(BREAK))


def _field(name: str) -> Column:
    """A header's value; null if the record hasn't it."""
    return F.nullif(F.regexp_extract("header", rf"(?m)^{name}: ?([^\r\n]*)", 1), F.lit(""))


def _page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "<urn:page:([^:>]*):[0-9]+>", 1).try_cast("long")


def _fields() -> list[Column]:
    return [
        _page_of(_field("WARC-Record-ID")).alias("page_id"),
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Target-URI").alias("url"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        _page_of(_field("WARC-Refers-To")).alias("refers_to"),
        _field("Content-Length").cast("long").alias("content_length"),
        F.col("header"),
    ]


def _joined(spark: SparkSession, folder: str, headers: DataFrame) -> DataFrame:
    """Header blocks with the payloads at their addresses, whose digest is computed anew; a missing one is an error."""
    payloads = spark.read.parquet(f"{folder}/payloads")
    whole = F.sha2("payload", 256) == F.col("address")
    payloads = payloads.select("address", F.when(whole, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "address"))).alias("payload"))
    present = F.coalesce("payload", F.raise_error(F.concat(F.lit("missing payload "), "address")).cast("binary"))
    return headers.join(payloads, "address", "left").withColumn("payload", present)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Records with their exact header block, its fields, and the full payload, also of revisits.

    A payload that doesn't have its address for a digest, or a record without payload, stops the read with an error.
    """
    return _joined(spark, folder, spark.read.parquet(f"{folder}/headers")).select(*_fields(), "payload")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """The archive's records as WARC has them: header block, empty line, and the payload, which revisits leave out."""
    headers = spark.read.parquet(f"{folder}/headers")
    responses = _joined(spark, folder, headers.filter("NOT revisit")).select(F.concat("header", F.lit(BREAK), F.decode("payload", "UTF-8")).alias("record"))
    return responses.unionByName(headers.filter("revisit").select(F.concat("header", F.lit(BREAK)).alias("record")))


def write_warc(spark: SparkSession, folder: str, target: str) -> None:
    """Write the archive's records as compressed WARC files, at most ``FILE_RECORDS`` to a file."""
    with shuffles_go(spark):
        text = records(spark, folder).write.option("lineSep", BREAK * 2).option("compression", "gzip")
        text.option("maxRecordsPerFile", FILE_RECORDS).text(target)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a folder's WARC files: header block, its fields, and the block of as many bytes as it says.

    Files are compressed whole, so a task reads a file from its start, as chunks between empty lines, and joins the chunks
    of a block until its length is reached. A file that ends inside a record stops the read with an error.
    """
    chunks = spark.read.option("lineSep", BREAK * 2).text(folder).select(F.col("_metadata.file_path").alias("file"), F.encode("value", "UTF-8").alias("chunk"))
    parsed = map_batches(chunks, _parsed, "header string, block binary")
    return parsed.select(*_fields(), _field("WARC-Record-ID").alias("record_id"), _field("WARC-Refers-To").alias("response_id"), "block")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the chunks between empty lines, file by file in their order.

    A block that ends in a line break ends inside what parts two chunks, or with it: then the rest of the empty lines that
    end the record comes with the next chunk.
    """
    line_end, gap = BREAK.encode(), BREAK.encode() * 2
    last, header, wanted, parts, size, rest = None, None, 0, [], 0, None
    for batch in batches:
        headers, blocks = [], []
        for file, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if file != last:
                _check(header is None, last)
                last, rest = file, None
            if header is not None:
                parts.append(chunk)
                size += len(chunk)
                _check(size <= wanted, file)
                if size < wanted:
                    parts.append(gap)
                    size += len(gap)
                    rest = gap[size - wanted :] if size >= wanted else None
                if size >= wanted:
                    headers.append(header.decode())
                    blocks.append(b"".join(parts)[:wanted])
                    header = None
                continue
            if rest is not None:
                ended = rest == gap[len(gap) - len(rest) :] and chunk.startswith(rest[: len(rest) % len(gap)])
                _check(ended and (chunk == b"" or len(rest) < len(gap)), file)
                chunk, rest = chunk[len(rest) % len(gap) :], None
                if not chunk:
                    continue
            _check(chunk.startswith(b"WARC/"), file)
            length = re.search(rb"\r\nContent-Length: (\d+)(?:\r\n|$)", chunk)
            _check(length is not None, file)
            header, wanted, parts, size = chunk + line_end, int(length[1]), [], 0
        yield pa.RecordBatch.from_arrays([pa.array(headers, pa.string()), pa.array(blocks, pa.binary())], ["header", "block"])
    _check(header is None, last)


def _check(fits: bool, file: str) -> None:
    if not fits:
        raise ValueError(f"{file} doesn't hold whole records")


def _verified(payload: Column) -> Column:
    """A payload, if it has the digest that its header names."""
    return F.when(F.sha1(payload) == F.col("payload_digest"), payload).otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id")).cast("binary"))


def restored(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a folder's WARC files with full payloads, those of revisits from their responses."""
    read = read_warc(spark, folder).withColumnRenamed("block", "payload")
    responses = read.filter("record_type = 'response'").withColumn("payload", _verified(F.col("payload")))
    held = responses.select(F.col("record_id").alias("response_id"), "payload")
    revisits = read.filter("record_type = 'revisit'").drop("payload").join(held, "response_id", "left")
    missing = F.raise_error(F.concat(F.lit("missing response "), "response_id")).cast("binary")
    return responses.unionByName(revisits.withColumn("payload", _verified(F.coalesce("payload", missing))))


def archived_records(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages as an archive and as WARC files, read those back, and describe every record by what was read.

    Lengths and digests are taken from the payloads as read; what revisits need of them moves without the payloads.
    """
    write_archive(pages, f"{folder}/archive")
    write_warc(spark, f"{folder}/archive", f"{folder}/warc")
    read = read_warc(spark, f"{folder}/warc")
    digest = F.when(F.col("record_type") == "response", F.sha1("block"))
    facts = stored(read.select("page_id", F.octet_length("block").cast("long").alias("payload_bytes"), digest.alias("read"), "payload_digest", "record_type", "refers_to", "record_id", "response_id"), "records")
    responses = facts.filter("record_type = 'response'").drop("response_id")
    held = responses.select(F.col("record_id").alias("response_id"), "payload_bytes", "read")
    revisits = facts.filter("record_type = 'revisit'").drop("payload_bytes", "read").join(small_side(held, RESPONSES_BROADCAST), "response_id", "left").drop("response_id")
    whole = F.when(F.col("read") == F.col("payload_digest"), F.col("read")).otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id")).cast("string"))
    return responses.unionByName(revisits).select("page_id", "payload_bytes", whole.alias("payload_digest"), "record_type", "refers_to")
