from __future__ import annotations

import hashlib
import io
import re

from pyspark.sql import functions as F

from vigil.llm import warc
from vigil.llm.common import Scratch


def pages_df(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "'y' AS digest", "0 AS bytes", "'z' AS record_type")


BIG = "A" * 2000
ROWS = [(1, "http://x/\r\na", BIG), (2, None, BIG), (None, "u", BIG), (3, "u", None), (4, "u", "x\r\n\r\nWARC/1.1\r\n"), (2, None, BIG), (5, "é", "é" * 500), (6, "é", "é" * 500), (7, "s", "é" * 499), (8, "s", "é" * 499)]


def test_records_and_edges(spark):
    path = Scratch(spark, "warc-test").path("a")
    warc.write_pages(pages_df(spark, ROWS), path, max_file_bytes=3000)
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_pages(spark, path).collect()), key=str)
    big, last = hashlib.sha1(BIG.encode()).hexdigest(), hashlib.sha1(("é" * 500).encode()).hexdigest()
    want = [(0, 2000, big, "revisit", 2), (1, 2000, big, "revisit", 2), (2, 2000, big, "response", None), (2, 2000, big, "response", None), (3, 0, hashlib.sha1(b"").hexdigest(), "response", None)]
    want += [(4, 15, hashlib.sha1(ROWS[4][2].encode()).hexdigest(), "response", None), (5, 1000, last, "revisit", 6), (6, 1000, last, "response", None)]
    want += [(i, 998, hashlib.sha1(("é" * 499).encode()).hexdigest(), "response", None) for i in (7, 8)]
    assert got == sorted(want, key=str)


def test_pushdown_and_uncommitted_files(spark):
    path = Scratch(spark, "warc-test").path("b")
    warc.write_pages(pages_df(spark, ROWS), path)
    store, root = warc._open_fs(path)
    with store.open_output_stream(f"{root}/part-lost.warc") as f:
        f.write(b"a failed attempt")
    df = spark.read.format("warc").load(path)
    assert df.where("record_type = 'response'").count() == 7
    assert df.where("record_type in ('revisit') and refers_to = '<urn:x-page:2>' and target_uri like 'http%'").count() == 1
    assert df.where("target_uri is null and record_type <> 'warcinfo'").count() == 2
    assert df.where("record_type = 'response' and payload is null").count() == 0
    warc.write_pages(pages_df(spark, ROWS[:1]), path)  # appended by a second commit
    assert df.sparkSession.read.format("warc").load(path).where("record_type <> 'warcinfo'").count() == 11


def test_every_record_is_dated_once(spark):
    path = Scratch(spark, "warc-test").path("dated")
    warc.write_pages(pages_df(spark, ROWS), path)
    rows = spark.read.format("warc").load(path)
    dates = [r[0] for r in rows.select("headers.WARC-Date").collect()]
    assert len(dates) > 10 and all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", d or "") for d in dates)
    own = warc.page_records(pages_df(spark, ROWS[:1])).withColumn("headers", F.create_map(F.lit("WARC-Date"), F.lit("2001-02-03T04:05:06Z")))
    own.write.format("warc").mode("append").save(path + "-own")
    again = spark.read.format("warc").load(path + "-own").where("record_type <> 'warcinfo'")
    assert [r[0] for r in again.select("headers.WARC-Date").collect()] == ["2001-02-03T04:05:06Z"]
    store, root = warc._open_fs(path + "-own")
    raw = b"".join(store.open_input_stream(f.path).read() for f in store.get_file_info(warc.fs.FileSelector(root)) if f.path.endswith(".warc"))
    assert raw.count(b"\r\nWARC-Date: ") == 2


def test_unwanted_blocks_are_not_read():
    class Counting(io.BytesIO):
        read_bytes = 0

        def read(self, n=-1):
            got = super().read(n)
            Counting.read_bytes += len(got)
            return got

    raw = io.BytesIO()
    for i in range(5):
        warc.write_record(raw, [("WARC-Type", "response" if i == 3 else "other"), ("Content-Type", "application/http")], warc.http_block(b"x" * 10_000))
    f = Counting(raw.getvalue())
    got = list(warc.read_records(f, lambda h: h["WARC-Type"] == "response", True))
    assert [p for _, p in got] == [b"x" * 10_000] and Counting.read_bytes < 10_200
    f.seek(0)
    assert [p for _, p in warc.read_records(f, lambda h: True, False)] == [None] * 5


def test_empty(spark):
    path = Scratch(spark, "warc-test").path("c")
    warc.write_pages(pages_df(spark, ROWS).limit(0), path)
    assert warc.read_pages(spark, path).count() == 0
