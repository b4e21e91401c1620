import glob
import gzip
import hashlib
import os
import random
import re
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from smelter.llm import warc
from smelter.llm.warc import archived_records, read_archive, read_warc, records, restored, write_archive, write_warc

PAGES = "page_id LONG, url STRING, html STRING"
LONG = "é\r\n\r\nWARC/1.1\r\n" + "x" * 1000
ROWS = [
    (1, "http://a.org/", LONG), (7, "http://b.org/", LONG), (4, None, LONG), (2, "http://c.org/", "short"), (3, "http://d.org/\r\nX: y", "short"),
    (5, "u", None), (6, "u", ""), (None, "u", LONG), (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "y" * 1000), (10, "u", "y" * 1000),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, PAGES)


def test_records_are_read_back(spark, pages, folder, clashing):
    expected = []
    for i, _, html in ROWS:
        payload = (html or "").encode()
        largest = max(j for j, _, h in ROWS if j is not None and (h or "") == (html or ""))
        revisit = len(payload) >= 1000 and i != largest
        expected.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", largest if revisit else None))
    assert Counter(map(tuple, archived_records(spark, clashing(pages), f"{folder}/archive").collect())) == Counter(expected)


def test_every_payload_is_stored_once_and_joined_back(spark, pages, folder):
    write_archive(pages, f"{folder}/archive")
    assert spark.read.parquet(f"{folder}/archive/payloads").count() == len({h or "" for *_, h in ROWS})
    archive = read_archive(spark, f"{folder}/archive")
    assert sorted(bytes(r["payload"]).decode() for r in archive.collect()) == sorted(h or "" for *_, h in ROWS)
    for r in records(spark, f"{folder}/archive").collect():
        head, _, block = r["record"].partition("\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and int(fields["Content-Length"]) == len(block.encode())


def test_warc_files_hold_whole_records(spark, pages, folder):
    write_archive(pages, f"{folder}/archive")
    write_warc(spark, f"{folder}/archive", f"{folder}/warc")
    data, found = b"".join(gzip.open(f).read() for f in glob.glob(f"{folder}/warc/*.gz")), []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        length = int(fields[b"Content-Length"])
        assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Type"} <= set(fields)
        found.append((head + b"\r\n\r\n" + rest[:length]).decode())
        assert rest[length : length + 4] == b"\r\n\r\n"
        data = rest[length + 4 :]
    assert sorted(found) == sorted(r["record"] for r in records(spark, f"{folder}/archive").collect())
    assert len({re.search("WARC-Record-ID: (.*)\r", r)[1] for r in found}) == len(ROWS)


@pytest.mark.parametrize("files", [1, 3, 20_000])
def test_bytes_in_are_bytes_out(spark, folder, monkeypatch, files):
    """Payloads that hold, begin with, end in and consist of line breaks, whole records among them, over files and batches."""
    draw = random.Random(files)
    pieces = ["\r\n", "\r", "\n", "\r\n\r\n", "x", "é", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\0"]
    texts = ["", "\r\n", "\r\n\r\n", "\r\n\r\n\r\n", "\r", "\n", "x\r\n", "x\r\n\r", "x\r\n\r\n", "\r\nx", "\n\r\n", "é" * 70_000 + "\r\n\r\n" + "y" * 200_000]
    texts += ["".join(draw.choices(pieces, k=draw.randint(0, 12))) for _ in range(200)] + ["".join(draw.choices(pieces, k=900)) for _ in range(20)] * 2
    rows = [(i, "u", html) for i, html in enumerate(texts)]
    monkeypatch.setattr(warc, "FILE_RECORDS", files)
    write_archive(spark.createDataFrame(rows, PAGES).repartition(3), f"{folder}/archive")
    write_warc(spark, f"{folder}/archive", f"{folder}/warc")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = {r["page_id"]: bytes(r["payload"]).decode() for r in restored(spark, f"{folder}/warc").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {i: html for i, _, html in rows}


@pytest.mark.parametrize("change, message", [(lambda b: b.replace(b"short", b"shirt"), "damaged record"), (lambda b: b[: len(b) // 2], "whole records"), (lambda b: b + b"x", "whole records")])
def test_damaged_files_are_found(spark, folder, change, message):
    write_archive(spark.createDataFrame([(2, "u", "short" * 50)], PAGES), f"{folder}/archive")
    write_warc(spark, f"{folder}/archive", f"{folder}/warc")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{folder}/warc/*.gz"))
    os.makedirs(f"{folder}/broken")
    with gzip.open(f"{folder}/broken/a.gz", "wb") as out:
        out.write(change(data))
    with pytest.raises(PySparkException, match=message):
        restored(spark, f"{folder}/broken").collect()


def test_records_are_dated_and_read_with_their_headers(spark, pages, folder):
    write_archive(pages, f"{folder}/archive", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    write_warc(spark, f"{folder}/archive", f"{folder}/warc")
    read = read_warc(spark, f"{folder}/warc").collect()
    assert all("\r\nWARC-Date: 2024-05-06T" in r["header"] for r in read)
    assert Counter(r["header"] for r in read) == Counter(r["header"] for r in spark.read.parquet(f"{folder}/archive/headers").collect())


def test_damage_is_found(spark, pages, folder):
    write_archive(pages, f"{folder}/archive")
    payloads = spark.read.parquet(f"{folder}/archive/payloads")
    payloads.selectExpr("address", "encode(concat(decode(payload, 'UTF-8'), '!'), 'UTF-8') AS payload").write.parquet(f"{folder}/broken/payloads")
    spark.read.parquet(f"{folder}/archive/headers").write.parquet(f"{folder}/broken/headers")
    with pytest.raises(PySparkException, match="damaged payload"):
        read_archive(spark, f"{folder}/broken").collect()


def test_an_empty_table_gives_an_empty_archive(spark, folder):
    assert archived_records(spark, spark.createDataFrame([], PAGES), f"{folder}/archive").collect() == []
