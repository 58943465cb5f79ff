"""WARC archives: a writer, and a Python data source that reads them.

Writing is Spark's text writer: a record is its header and block, and the two line ends that close a record are the line
separator, so files appear in any file system that Spark writes to. Of records with equal payloads of at least a given size,
those with the largest id are responses and the others revisit records without a payload.

Reading plans partitions of whole files, small ones together. Predicates on the header columns (record type, id, digest,
length, URI, reference) are pushed down: a record's header is parsed first, and if a predicate fails, or payloads are not
asked for, its block is skipped by its length and never decoded (in a plain file it is not even read). The files to read and their sizes come from Spark's own file
systems; tasks open them through Arrow's.

Defined results: null payloads are empty; null URIs and ids have no header; equal rows with the largest id are all responses;
rows without an id revisit one that has an id, and are responses if none has; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)

from .common import shared_path, table

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CLOSE = "\r\n\r\n"
PARTITION_BYTES = 64 << 20
SCHEMA = "page_id long, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to long, payload binary"
# Header names of the columns that predicates can be pushed to.
HEADERS = {
    "page_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
    "refers_to": "WARC-Refers-To",
}


def digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits are four letters."""
    hexed = F.sha1(payload)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*letters)


def _header(name: str, value: Column) -> Column:
    """One header line, none for null; line ends in a value would end the header and are escaped."""
    safe = F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload and its digest and length, record type and the id a revisit refers to.

    The payload table is joined with one row per payload, so a payload that many rows share is split by skew-join handling.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"sha": F.unhex(F.sha1("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    most = rows.groupBy("sha", "payload_bytes").agg(F.max("page_id").alias("most"))
    revisit = (F.col("payload_bytes") >= least_bytes) & F.col("most").isNotNull() & ~F.col("most").eqNullSafe(F.col("page_id"))
    joined = rows.join(most.hint("merge"), ["sha", "payload_bytes"])
    return joined.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("most")).alias("refers_to"),
    )


def write(pages: DataFrame, path: str, least_bytes: int = 0, compression: str = "gzip") -> None:
    """Writes a record per row of (page_id, url, html). ``compression`` is gzip or none."""
    rows = roles(pages, least_bytes)
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload").cast("string")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", urn(F.col("page_id"))),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z\r\n"),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest(F.col("payload")))),
        _header("X-Payload-Length", F.col("payload_bytes")),
        _header("WARC-Refers-To", urn(F.col("refers_to"))),
        _header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", CLOSE).option("compression", compression).text(path)


class FilePartition(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.files = json.loads(options["files"])
        self.payload = options.get("payload", "true") == "true"
        self.size = int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        names = {EqualTo: "=", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", IsNull: "null", IsNotNull: "some"}
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if type(f) in names and column in HEADERS:
                self.tests.append((column, names[type(f)], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[FilePartition]:
        """Files in order of size fill partitions up to the given size; a larger file is one by itself."""
        planned, room = [], 0
        for path, size in sorted(self.files, key=lambda x: -x[1]):
            if not planned or size > room:
                planned.append(FilePartition([]))
                room = self.size
            planned[-1].files.append(path)
            room -= size
        return planned or [FilePartition([])]

    def _passes(self, row: dict) -> bool:
        for column, test, want in self.tests:
            value = row[column]
            if test == "null" or test == "some":
                ok = (value is None) == (test == "null")
            elif value is None:
                ok = False
            elif test == "in":
                ok = value in want
            else:
                ok = {"=": value == want, ">": value > want, ">=": value >= want, "<": value < want, "<=": value <= want}[test]
            if not ok:
                return False
        return True

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        rows, held = [], 0
        for path in partition.files:
            for row in self._records(path):
                rows.append(row)
                held += len(row["payload"] or b"") + 200
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _records(self, path: str) -> Iterator[dict]:
        system, name = open_file_system(path)
        if name.endswith(".gz"):
            opened = system.open_input_stream(name, compression="gzip")
        else:
            opened = system.open_input_file(name)
        with opened as raw:
            ahead = Ahead(raw, seekable=not name.endswith(".gz"))
            while (head := ahead.until(b"\r\n\r\n")) is not None:
                fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
                length = int(fields[b"Content-Length"])
                row = columns_of(fields)
                passes = self._passes(row)
                if passes and self.payload and row["record_type"] == "response":
                    row["payload"] = ahead.take(length).split(b"\r\n\r\n", 1)[1]
                else:
                    ahead.skip(length)
                ahead.skip(len(CLOSE))
                if passes:
                    yield row


class Ahead:
    """Reads a file in pieces. What is skipped is jumped over in a plain file, and in a compressed one inflated and dropped
    piece by piece."""

    def __init__(self, raw, seekable: bool, piece: int = 1 << 16):
        self.raw, self.seekable, self.piece, self.data = raw, seekable, piece, b""

    def _more(self, least: int = 0) -> bool:
        got = self.raw.read(max(least, self.piece))
        self.data += got
        return bool(got)

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the next mark, which is passed; None at the end of the file."""
        seen = 0
        while (at := self.data.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.data)
            if not self._more():
                return None
        found, self.data = self.data[:at], self.data[at + len(mark) :]
        return found

    def take(self, n: int) -> bytes:
        while len(self.data) < n and self._more(n - len(self.data)):
            pass
        found, self.data = self.data[:n], self.data[n:]
        return found

    def skip(self, n: int) -> None:
        here = min(n, len(self.data))
        self.data, n = self.data[here:], n - here
        if n and self.seekable:
            self.raw.seek(self.raw.tell() + n)
            return
        while n and (got := self.raw.read(min(n, self.piece))):
            n -= len(got)


def columns_of(fields: dict[bytes, bytes]) -> dict:
    def text(column: str) -> str | None:
        value = fields.get(HEADERS[column].encode())
        return None if value is None else value.decode()

    def number(column: str) -> int | None:
        value = text(column)
        return None if value is None else int(value.removeprefix("<urn:page:").removesuffix(">"))

    return {
        "page_id": number("page_id"),
        "record_type": text("record_type"),
        "target_uri": text("target_uri"),
        "payload_digest": (text("payload_digest") or "").removeprefix("sha1:") or None,
        "payload_bytes": number("payload_bytes"),
        "refers_to": number("refers_to"),
        "payload": None,
    }


def open_file_system(path: str):
    """Arrow's file system of a URI; s3a is named s3 there."""
    uri = path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path
    return pyarrow.fs.FileSystem.from_uri(uri)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives in a folder. Without ``payload`` no block is decoded."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    files = [(s.getPath().toUri().toString(), s.getLen()) for s in listed if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    # the records of a reader's partition are not spread further, so small inputs are cut finer
    share = max(1 << 20, min(PARTITION_BYTES, sum(n for _, n in files) // max(1, spark.sparkContext.defaultParallelism)))
    return spark.read.format("warc").option("files", json.dumps([f for f in files if f[1]])).option("payload", str(payload).lower()).option("partitionBytes", share).load()


def round_trip(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Writes archives and reads them back: responses with their payload, of which length and digest are taken anew, and
    revisits by their headers alone."""
    write(pages, path, least_bytes)
    spark = pages.sparkSession
    responses = read(spark, path).where("record_type = 'response'")
    revisits = read(spark, path, payload=False).where("record_type = 'revisit'")
    seen = responses.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": digest(F.col("payload"))})
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return seen.select(columns).unionByName(revisits.select(columns))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))


_LETTERS = " || ".join(f"substr('{ALPHABET}', ((('0x' || substr(h, {5 * g + 1}, 5))::INT >> {s}) & 31) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS most FROM d)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
  CASE WHEN most IS DISTINCT FROM page_id AND most IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN most IS DISTINCT FROM page_id THEN most END AS refers_to
FROM m
"""
