"""WARC 1.1 archives as a Spark data source (``format("warc")``).

Writing: every task writes files of about ``max_file_bytes`` under its own
names; the driver's commit lists them in a small manifest.  Files of failed
or repeated task attempts are in no manifest and so are never read.

Reading: one partition per committed file.  Predicates on record type and the
other header columns are pushed into the reader, which parses a record's
headers first and seeks past the block of a record that fails them.  With
the option ``payload`` set to false no payload is read at all.

Paths are opened through Arrow's file systems (local, HDFS, S3, GCS), on
executors, without the JVM.
"""

from __future__ import annotations

import io
import json
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage

from vigil.llm.common import Scratch, bounded_batches, broadcast_if_small

SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, headers map<string,string>, payload binary"
#: Header of each header column.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An extension header: the length of the payload that a revisit leaves out.
FULL_LENGTH = "X-Payload-Length"
BATCH_BYTES = 8 << 20
#: Groups of equal payloads up to which their table is broadcast (about 60
#: bytes each).
BROADCAST_ROWS = 500_000


# --------------------------------------------------------------------- records


def header_value(text: str) -> str:
    """A value that stays in its line: control characters as %XX."""
    return "".join(quote(c, safe="") if ord(c) < 32 or ord(c) == 127 else c for c in text)


def record_date() -> str:
    """The time of writing, which a record must carry if its row names none."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_record(out, headers: Iterable[tuple[str, str]], block: bytes) -> int:
    head = VERSION + b"\r\n" + b"".join(f"{k}: {header_value(v)}\r\n".encode() for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n".encode()
    out.write(head)
    out.write(block)
    out.write(b"\r\n\r\n")
    return len(head) + len(block) + 4


def http_block(payload: bytes | None) -> bytes:
    """An HTTP response; a revisit has its head alone."""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload or b'')}\r\n\r\n".encode() + (payload or b"")


def read_records(f: io.BufferedReader, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records that ``wanted(headers)`` accepts.

    The block of any other record, and every block if ``with_payload`` is
    false, is passed by a seek."""
    while line := f.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := f.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(":")
            headers[name.strip()] = value.strip()
        size = int(headers.get("Content-Length", 0))
        if not wanted(headers):
            f.seek(size, io.SEEK_CUR)
        elif not with_payload or headers.get("WARC-Type") == "revisit":
            f.seek(size, io.SEEK_CUR)
            yield headers, None
        else:
            block = f.read(size)
            if len(block) < size:
                raise EOFError("the archive ends inside a record")
            if headers.get("Content-Type", "").startswith("application/http"):
                block = block[block.index(b"\r\n\r\n") + 4 :]
            yield headers, block


# ------------------------------------------------------------------ data source


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]  # as Hadoop writes local paths
    return fs.FileSystem.from_uri(path)


@dataclass
class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcDataSource(DataSource):
    """Options: ``path``; ``payload`` (read: true); ``max_file_bytes`` (write:
    64 MB)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], str(self.options.get("payload", "true")).lower() == "true")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("an archive is only appended to")
        return WarcWriter(self.options["path"], int(self.options.get("max_file_bytes", 64 << 20)))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, EqualNullSafe, In, IsNotNull, IsNull, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, root = _open_fs(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        names = []
        for x in sorted((x.path for x in found if posixpath.basename(x.path).startswith("_committed-"))):
            with store.open_input_file(x) as f:
                names += json.loads(f.readall())
        return [_File(posixpath.join(root, n)) for n in sorted(names)] or [_File("")]

    def wanted(self, headers: dict[str, str]) -> bool:
        for f in self.filters:
            v = headers.get(HEADERS[f.attribute[0]])
            if isinstance(f, IsNull):
                ok = v is None
            elif isinstance(f, IsNotNull):
                ok = v is not None
            elif isinstance(f, In):
                ok = v in f.value
            elif isinstance(f, StringStartsWith):
                ok = v is not None and v.startswith(f.value)
            else:
                ok = v == f.value and (v is not None or isinstance(f, EqualNullSafe))
            if not ok:
                return False
        return True

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        kinds = [pa.string()] * 5 + [pa.map_(pa.string(), pa.string()), pa.binary()]
        names = [*HEADERS, "headers", "payload"]
        rows, size = [], 0
        store, _ = _open_fs(self.path)
        with io.BufferedReader(store.open_input_file(partition.path), 1 << 20) as f:
            for headers, payload in read_records(f, self.wanted, self.payload):
                rows.append((*(headers.get(h) for h in HEADERS.values()), list(headers.items()), payload))
                size += 500 + len(payload or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class WarcWriter(DataSourceArrowWriter):
    """Rows of ``SCHEMA`` (``headers``: further ones) to archive files."""

    def __init__(self, path: str, max_file_bytes: int):
        self.path, self.max_file_bytes = path, max_file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _open_fs(self.path)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    store.create_dir(root, recursive=True)
                    files.append(f"part-{uuid.uuid4().hex}.warc")
                    out = io.BufferedWriter(store.open_output_stream(posixpath.join(root, files[-1])), 1 << 20)
                    info = b"format: WARC File Format 1.1\r\n"
                    size = write_record(out, [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", record_date()), ("Content-Type", "application/warc-fields")], info)
                headers = [(h, row[c]) for c, h in HEADERS.items() if row[c] is not None] + list(row["headers"] or [])
                if not any(h.lower() == "warc-date" for h, _ in headers):
                    headers.append(("WARC-Date", record_date()))
                size += write_record(out, [*headers, ("Content-Type", "application/http; msgtype=response")], http_block(row["payload"]))
                if size >= self.max_file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _open_fs(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(posixpath.join(root, f"_committed-{uuid.uuid4().hex}.json")) as f:
            f.write(json.dumps([n for m in messages if m for n in m.files]).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _open_fs(self.path)
        for m in messages:
            for n in m.files if m else ():
                store.delete_file(posixpath.join(root, n))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# --------------------------------------------------------------------- pages


def page_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Archive rows of ``pages`` (page_id, url, html): of equal payloads of at
    least ``least_bytes`` the one of the largest page_id is a response, the
    others revisit it; smaller ones are all responses.

    A null html is an empty payload and a null url leaves its header out; a
    null page_id ranks below all others and is written without a number;
    rows that tie for the largest page_id are all responses; other columns
    are ignored.  The groups of equal payloads are aggregated by digest; their
    table is broadcast if its counted size is within ``BROADCAST_ROWS``, so
    that no payload is shuffled, else AQE splits the join on a digest that
    many pages share.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    src = src.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    last = src.where(F.col("bytes") >= least_bytes).groupBy(F.col("digest").alias("_digest")).agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and _last is not null")
    last = Scratch(pages.sparkSession, "warc-groups").save(last.select("_digest", "_last"), "groups")
    last = broadcast_if_small(last, last.count(), BROADCAST_ROWS)
    out = src.join(last, (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= least_bytes), "left")
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    record = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    headers = F.create_map(F.lit(FULL_LENGTH), F.col("bytes").cast("string"))
    headers = F.when(revisit, F.map_concat(headers, F.create_map(F.lit("WARC-Profile"), F.lit(REVISIT_PROFILE)))).otherwise(headers)
    return out.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        record(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(revisit, record(F.col("_last"))).alias("refers_to"),
        headers.alias("headers"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, least_bytes: int = 1000, max_file_bytes: int = 64 << 20) -> None:
    register(pages.sparkSession)
    bounded_batches(pages.sparkSession)
    page_records(pages, least_bytes).write.format("warc").option("max_file_bytes", str(max_file_bytes)).mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from
    the archives.  Of responses both come from the payload as read; revisits
    are read by their headers alone."""
    register(spark)
    number = lambda c: F.regexp_extract(c, "<urn:x-page:(-?[0-9]+)>", 1)
    full = spark.read.format("warc").load(path).where("record_type = 'response'")
    full = full.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")
    again = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit'")
    again = again.select("record_id", F.col("headers")[FULL_LENGTH].cast("long").alias("payload_bytes"), F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", "refers_to")
    both = full.unionAll(again)
    return both.select(
        F.nullif(number(F.col("record_id")), F.lit("")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.nullif(number(F.col("refers_to")), F.lit("")).cast("long").alias("refers_to"),
    )
