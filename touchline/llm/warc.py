"""WARC archives as a PySpark Python data source.

Reading plans partitions over files, reads each record's headers first, and goes past the rest of a record that the
predicates rule out, without decoding it. Writing makes one archive a task, a gzip member a record, and moves the
files of successful tasks into place when the job commits. Files are reached through pyarrow's file systems, so the path may
lie in any store that they know.
"""

from __future__ import annotations

import gzip
import io
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, content_type string, http_length long, payload binary"
#: WARC header of each column that a predicate may rule records out by.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type"}
#: Bytes of archives read by a task, and rows of an Arrow batch.
PARTITION_BYTES, BATCH_BYTES = 64 << 20, 8 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(path: str):
    """(file system, path in it)"""
    from pyarrow import fs

    if match := re.match(r"(?:file:)(?://)?(/.*)", path):
        path = match[1]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class WarcSource(DataSource):
    """Format ``warc``. Options of a reader: ``recordTypes`` (comma-separated), ``payload`` (``none`` leaves it out), ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"])


@dataclass
class WarcFiles(InputPartition):
    paths: tuple[str, ...]


def keeps(filters: list, headers: dict[str, str]) -> bool:
    """Whether a record's headers satisfy the pushed predicates."""
    for kind, column, value in filters:
        own = headers.get(HEADERS[column])
        if own is None or kind == "in" and own not in value or kind == "starts" and not own.startswith(value):
            return False
    return True


def read_headers(stream) -> dict[str, str] | None:
    """The next record's headers in lower case; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    out: dict[str, str] = {}
    last = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and last:
            out[last] += " " + text.strip()
            continue
        last, _, value = text.partition(":")
        last = last.strip().lower()
        out[last] = value.strip()
    return out


def skip(stream, n: int, seekable: bool) -> None:
    if seekable:
        stream.seek(n, 1)
        return
    while n > 0:
        part = stream.read(min(n, 1 << 20))
        if not part:
            return
        n -= len(part)


def split_http(block: bytes) -> tuple[int | None, bytes]:
    """(Content-Length of an HTTP message, its body)"""
    head, _, body = block.partition(b"\r\n\r\n")
    found = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", head)
    return (int(found[1]) if found else None), body


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.size = int(options.get("partitionBytes", PARTITION_BYTES))
        self.payload = options.get("payload", "bytes") != "none"
        types = options.get("recordTypes")
        self.filters: list = [("in", "record_type", tuple(x.strip() for x in types.split(",")))] if types else []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.filters.append(("in", column, (f.value,)))
            elif isinstance(f, In):
                self.filters.append(("in", column, tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.filters.append(("starts", column, f.value))
            elif isinstance(f, IsNotNull):
                self.filters.append(("there", column, None))
            else:
                yield f

    def partitions(self) -> list[WarcFiles]:
        """Files in groups of about ``partitionBytes``; a larger one has a task of its own."""
        from pyarrow import fs

        store, path = _store(self.path)
        info = store.get_file_info(path)
        files = [info] if info.is_file else [x for x in store.get_file_info(fs.FileSelector(path, recursive=True)) if x.is_file and re.search(r"\.warc(\.gz)?$", x.path)]
        out, size = [[]], 0
        for x in sorted(files, key=lambda x: x.path):
            if out[-1] and size + x.size > self.size:
                out.append([])
                size = 0
            out[-1].append(x.path)
            size += x.size
        return [WarcFiles(tuple(x)) for x in out]

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in (r for p in partition.paths for r in self.records(p)):
            rows.append(row)
            size += len(row[-1] or b"") + 500
            if size > BATCH_BYTES:
                yield self.batch(rows)
                rows, size = [], 0
        yield self.batch(rows)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.string()] * 7, pa.int64(), pa.binary()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def records(self, path: str) -> Iterator[tuple]:
        store, _ = _store(self.path)
        with store.open_input_file(path) as file:
            packed = path.endswith(".gz")
            stream = gzip.GzipFile(fileobj=file) if packed else io.BufferedReader(file, 1 << 16)
            while (headers := read_headers(stream)) is not None:
                n = int(headers.get("content-length", 0))
                if not keeps(self.filters, headers):
                    skip(stream, n, not packed)
                    continue
                length, payload = None, None
                if not self.payload:
                    skip(stream, n, not packed)
                else:
                    block = stream.read(n)
                    if headers.get("content-type", "").startswith("application/http"):
                        length, payload = split_http(block)
                    else:
                        payload = block
                yield (*(headers.get(h) for h in HEADERS.values()), length, payload)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


def clean_value(value: str) -> str:
    """A header value: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, record_id: str, uri: str | None, date: str, digest: str | None, refers_to: str | None, payload: bytes, length: int) -> bytes:
    """A record's bytes. A revisit keeps the HTTP headers, with the full payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if kind == "revisit" else payload if kind == "warcinfo" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {clean_value(uri)}"] if uri is not None else []
    lines += [f"WARC-Payload-Digest: sha1:{digest}"] if digest else []
    lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"] if kind == "revisit" else []
    lines += [f"Content-Type: {'application/warc-fields' if kind == 'warcinfo' else 'application/http; msgtype=response'}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class WarcWriter(DataSourceArrowWriter):
    """Rows: record_type, record_id, target_uri, date, payload_digest, refers_to, http_length, payload."""

    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        name = f"{path}/.{self.job}-{uuid.uuid4().hex}.writing"
        with store.open_output_stream(name, compression=None) as out:
            out.write(member(record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", None, "1970-01-01T00:00:00Z", None, None, b"format: WARC File Format 1.1\r\n", 0)))
            for batch in iterator:
                columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                for i in range(batch.num_rows):
                    row = {k: v[i].as_py() for k, v in columns.items()}
                    out.write(member(record(row["record_type"], row["record_id"], row["target_uri"], row["date"], row["payload_digest"], row["refers_to"], row["payload"] or b"", row["http_length"])))
        return Written(name)

    def commit(self, messages: list) -> None:
        store, path = _store(self.path)
        for i, m in enumerate(messages):
            if m is not None:
                store.move(m.path, f"{path}/part-{i:05d}-{uuid.uuid4().hex[:8]}.warc.gz")
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        """Remove what this job's failed or repeated tasks have left."""
        from pyarrow import fs

        store, path = _store(self.path)
        for x in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if x.base_name.startswith(f".{self.job}-"):
                store.delete_file(x.path)


def register(spark: SparkSession) -> None:
    """Make the format known; planning needs the session's switch for predicates of Python sources."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 digest: ten hexadecimal digits make eight of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """A record a page. Of pages with equal payloads of at least ``least_bytes`` bytes, the one with the largest id is the
    response and the others revisit it; smaller ones are all responses. A null payload is empty; pages without an id
    revisit one with an id, and are responses if none has; pages repeated with the largest id are all responses."""
    register(pages.sparkSession)
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("__id"), F.col(url_col).cast("string").alias("target_uri"), payload.alias("payload"), F.sha2(payload, 256).alias("__key"))
    shared = rows.select("__id", "__key").groupBy("__key").agg(F.max("__id").alias("__top"), F.count(F.lit(1)).alias("__n")).where("__n > 1 and __top is not null").select("__key", "__top")
    rows = rows.join(shared, "__key", "left")
    revisit = F.col("__top").isNotNull() & (F.octet_length("payload") >= least_bytes) & ~F.col("__id").eqNullSafe(F.col("__top"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("__id")).alias("record_id"),
        "target_uri",
        F.lit(date).alias("date"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.when(revisit, urn(F.col("__top"))).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("http_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All records of the archives below ``path``; filters on the header columns reach the source. An empty folder has no
    records; a header that a record lacks is null; repeated records have rows of their own."""
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri`` of the archived pages.

    Length and digest of a response are taken from the payload as read, those of a revisit from its headers.
    """
    rows = read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    response = F.col("record_type") == "response"
    return rows.select(
        number(F.col("record_id")).alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(response, base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
        "target_uri",
    )
