"""WARC archives: written with Spark's text writer, read by a Python data source.

Writing: a record is one string (headers, blank line, payload) and the
record separator is the writer's line separator, so the archives are ordinary
committed Spark output in any store that Spark can write.  Of equal payloads
the least page id is the response and the others are revisit records that
refer to it and have no block.

Reading: ``spark.read.format("warc").load(path)`` plans partitions of whole
files, takes predicates on record type and headers, parses a record's headers
first and passes over the block of every record that a predicate has refused
(or of all, with option ``payload`` = "none") without decoding it.  Plain and
gzip archives, also of many members.  A malformed record raises, it is never
dropped.

Null html: empty payload.  Null url: no target header.  Null page ids come
last; rows that repeat the least page id of a payload are all responses.  Line
breaks in a url are percent-encoded.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, MapType, StringType

from pricelens.llm.common import fields, kind_of, pick
from pricelens.session import scratch_dir

PARTITION_BYTES = 32_000_000
BATCH_BYTES = 8_000_000
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# column: the header it is read from
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "date": "warc-date", "target_uri": "warc-target-uri",
           "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
SCHEMA = fields(**{c: StringType() for c in HEADERS}, headers=MapType(StringType(), StringType()), block_bytes=LongType(), payload=BinaryType())


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 bits (10 hex digits, 8 letters) at a time."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record per row.  Only (digest, least id) is aggregated, map-side
    first; the join that brings it to the pages can be split where a payload
    is hot."""
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    least = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    rows = rows.join(least, "digest")
    revisit = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)  # noqa: E731  null (left out) if the value is
    record = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Payload-Length", F.col("size").cast("string")),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.when(revisit, line("WARC-Refers-To", urn("first"))), line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, 0).otherwise(F.col("size")).cast("string")), F.lit(""), F.when(revisit, "").otherwise(F.col("html")))
    rows.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


@dataclass
class Files(InputPartition):
    names: list[str]


def store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def holds(test: Filter, value: str | None) -> bool:
    """A pushed predicate on a header's value (None: no such header)."""
    if isinstance(test, IsNotNull):
        return value is not None
    if isinstance(test, EqualNullSafe):
        return value == test.value
    if value is None:
        return False
    if isinstance(test, EqualTo):
        return value == test.value
    if isinstance(test, In):
        return value in test.value
    return value.startswith(test.value)


def records(stream: io.BufferedIOBase, tests: list[Filter], wanted: bool, name: str) -> Iterator[tuple[dict[str, str], int, bytes | None]]:
    """(headers, block length, block or None) of the records that pass."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record where one should start: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            key, colon, value = line.partition(b":")
            if not colon:
                raise ValueError(f"{name}: malformed header {line[:80]!r}")
            headers[key.decode().lower()] = value.strip().decode()
        size = int(headers["content-length"])
        use = all(holds(t, headers.get(HEADERS[t.attribute[0]])) for t in tests)
        if use and wanted:
            block = stream.read(size)
            if len(block) < size:
                raise ValueError(f"{name}: record cut short")
            yield headers, size, block
        else:
            skip(stream, size)
            if use:
                yield headers, size, None


def skip(stream: io.BufferedIOBase, size: int) -> None:
    if isinstance(stream, io.BufferedReader):
        stream.seek(size, io.SEEK_CUR)
        return
    while size > 0:
        size -= len(stream.read(min(size, 1 << 20))) or size


class WarcReader(DataSourceReader):
    def __init__(self, path: str, wanted: bool):
        self.path, self.wanted, self.tests = path, wanted, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what can be told from a header; gives the rest back."""
        for f in filters:
            if isinstance(f, (EqualTo, EqualNullSafe, In, IsNotNull, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, root = store(self.path)
        found = [i for i in system.get_file_info(fs.FileSelector(root, recursive=True)) if i.is_file and i.size and not i.base_name.startswith(("_", "."))]
        out, held = [], 0
        for i in sorted(found, key=lambda i: i.path):  # whole files, small ones together
            if not out or held + i.size > PARTITION_BYTES:
                out.append(Files([]))
                held = 0
            out[-1].names.append(i.path)
            held += i.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = store(self.path)
        schema, rows, held = to_arrow_schema(SCHEMA), [], 0
        for name in partition.names:
            with system.open_input_file(name) as raw:
                buffered = io.BufferedReader(raw, 1 << 20)
                stream = gzip.GzipFile(fileobj=buffered) if buffered.peek(2)[:2] == b"\x1f\x8b" else buffered
                for headers, size, block in records(stream, self.tests, self.wanted, name):
                    rows.append({**{c: headers.get(h) for c, h in HEADERS.items()}, "headers": list(headers.items()), "block_bytes": size, "payload": block})
                    held += len(block or b"") + 500
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "all") != "none")


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", "all" if payload else "none").load(path)


def round_trip(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages, read the archives back: page_id, payload_bytes,
    payload_digest, record_type, refers_to.  Responses are measured anew from
    the payload that was read; revisits need their headers only."""
    spark, kind = pages.sparkSession, kind_of(pages, id_col)
    path = scratch_dir(spark, "warc")
    write(pages, path, min_bytes, id_col=id_col, url_col=url_col, html_col=html_col)
    page = lambda c: F.nullif(F.substring(c, 11, 1 << 30).substr(F.lit(1), F.length(c) - 11), F.lit("")).cast(kind)
    responses = read(spark, path).where("record_type = 'response'").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type", F.lit(None).cast(kind).alias("refers_to"))
    revisits = read(spark, path, payload=False).where("record_type = 'revisit'").select(
        page("record_id").alias("page_id"), F.col("headers")["warc-payload-length"].cast("long").alias("payload_bytes"),
        F.substring("payload_digest", 6, 32).alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
    return responses.union(revisits)
