"""Legacy web archives (ARC) read, converted to WARC, written and read back.

Archives lie in a folder of any file system that Spark knows: Spark writes them as text with raw
bytes and reads them as binary files. Each file is built in one piece of bounded size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.texts import BATCH_ROWS, small_batches
from tallyline.session import stored, work_dir

#: Bytes of records that one archive file takes before the next one is begun.
FILE_BYTES = 16 << 20

# Fields of a record's header line by version of the ARC format.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

RECORDS = (
    "record_id string, type string, uri string, date string, ip string, content_type string, "
    "head binary, payload binary, payload_bytes long, payload_digest string, page_id long"
)


@contextmanager
def one_row_batches(spark: SparkSession):
    """Arrow batches of one row while files are read as rows."""
    small_batches(spark, 1)
    try:
        yield
    finally:
        small_batches(spark, BATCH_ROWS)


def digest_of(data: bytes) -> str:
    """SHA-1 in base32, as archives have it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# -- ARC -----------------------------------------------------------------------------------


def _arc_head(version: int, name: str) -> bytes:
    """The first record of an ARC file: version line and field names."""
    fields = ARC_FIELDS[version]
    body = f"{version} 0 legacy\n{' '.join(fields)}\n".encode()
    values = [f"filedesc://{name}", "0.0.0.0", "20000101000000", "text/plain", *["-"] * (len(fields) - 5), str(len(body))]
    return " ".join(values).encode() + b"\n" + body


def _arc_files(file_bytes: int, folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, part, held, size = TaskContext.get().partitionId(), 0, [], 0
        version = 1 + task % 2
        fields = ARC_FIELDS[version]

        def whole() -> pa.RecordBatch:
            head = _arc_head(version, f"{task}-{part}.arc")
            return pa.RecordBatch.from_arrays([pa.array([b"\n".join([head, *held])], pa.binary())], ["file"])

        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
                if page_id is not None:
                    head += f"X-Page-Id: {page_id}\r\n"
                doc = head.encode() + b"\r\n" + payload
                uri = "".join(url.split()) if url else "unknown:"
                values = [uri or "unknown:", "0.0.0.0", "20000101000000", "text/html"]
                if version == 2:
                    values += ["200", digest_of(payload), "-", str(size), f"{task}-{part}.arc"]
                held.append(" ".join([*values, str(len(doc))]).encode() + b"\n" + doc)
                assert len(values) + 1 == len(fields)
                size += len(doc)
                if size >= file_bytes:
                    yield whole()
                    part, held, size = part + 1, [], 0
        if held:
            yield whole()

    return run


def write_arc(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> str:
    """Write ``page_id``, ``url``, ``html`` rows as gzipped ARC files, of version 1 or 2 by turns."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    files = rows.mapInArrow(_arc_files(file_bytes, path), "file binary").select(F.col("file").cast("string"))
    files.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return path


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and body of each record of an ARC file but the first.

    The first record names the version and the fields of the header lines; lines are read from the
    right, as a legacy URL may hold spaces. Bodies are taken by their declared length.
    """
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("a header line has no end")
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if fields is None:
            if not line.startswith("filedesc:"):
                raise ValueError("an ARC file must begin with its file description")
            length = int(line.rsplit(" ", 1)[1])
            lines = data[end + 1 : end + 1 + length].decode("utf-8", "replace").split("\n")
            version = int(lines[0].split()[0])
            fields = lines[1].split() if len(lines) > 1 and lines[1].strip() else ARC_FIELDS.get(version)
            if fields is None:
                raise ValueError(f"unknown version {version}")
        else:
            found = line.rsplit(" ", len(fields) - 1)
            if len(found) != len(fields):
                raise ValueError(f"{len(found)} fields where the version has {len(fields)}")
            values = dict(zip(fields, found, strict=True))
            length = int(values["Archive-length"])
            if end + 1 + length > len(data):
                raise ValueError("a record is shorter than declared")
            yield values, data[end + 1 : end + 1 + length]
        at = end + 1 + length


def arc_date(text: str) -> str:
    """The time of a WARC record from the digits of an ARC date; missing parts are the least ones."""
    digits = (text + "00000101000000"[len(text) :])[:14] if text.isdigit() else "00010101000000"
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def _split_http(body: bytes) -> tuple[bytes, bytes]:
    """Head (with the empty line) and payload of an HTTP message."""
    at = body.find(b"\r\n\r\n")
    return (body[: at + 4], body[at + 4 :]) if at >= 0 else (body, b"")


def _http_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("latin-1")
    return None


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.lstrip("-").isdigit() else None


def _unzipped(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def _arc_rows(path: str, content: bytes) -> Iterator[tuple]:
    """The records of an ARC file in the columns of ``RECORDS``, payloads as they are."""
    name = path.rsplit("/", 1)[-1]
    for n, (fields, body) in enumerate(arc_records(_unzipped(content))):
        is_http = body.startswith(b"HTTP/")
        head, payload = _split_http(body) if is_http else (b"", body)
        digest, uri = digest_of(payload), fields["URL"]
        ident = uuid.uuid5(uuid.NAMESPACE_URL, f"{uri} {fields['Archive-date']} {digest} {name} {n}")
        yield (
            f"<urn:uuid:{ident}>", "response" if is_http else "resource", uri, arc_date(fields["Archive-date"]),
            fields["IP-address"], "application/http; msgtype=response" if is_http else fields["Content-type"],
            head, payload, len(payload), digest, _number(_http_field(head, b"x-page-id")),
        )


def _heads_of_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What tells revisits, without the payloads: one batch per file."""
    kinds = {"path": pa.string(), "record_id": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "page_id": pa.int64()}
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = [(path, r[0], *r[8:]) for r in _arc_rows(path, content)]
            if rows:
                columns = zip(zip(*rows, strict=True), kinds.values(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], list(kinds))


def _records_of_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """WARC fields of the records of ARC files; payloads are packed, as they are stored."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string()] * 6 + [pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = []
            for row in _arc_rows(path, content):
                rows.append((*row[:7], squeeze(row[7]), *row[8:]))
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files (plain or gzipped, any version) as WARC records.

    Identifiers are name-based, so that a second conversion yields the same; ``type`` is response for
    HTTP messages and resource for all else. ``payload`` is packed with zstd.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    with one_row_batches(spark):
        return stored(files.mapInArrow(_records_of_arc, RECORDS), "arc-records")


def mark_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records with ``refers_to``: the record id of the first one with an equal payload.

    First: least ``page_id``, then least record id (null ids last). Only records with payloads of at
    least ``least_bytes`` refer to others; for all others, and for the first ones, it is null. Payloads
    are equal if digest and size are.
    """
    alike = ["payload_digest", "payload_bytes"]
    first = records.where(F.col("payload_bytes") >= least_bytes).groupBy(*alike).agg(
        F.min(F.struct(F.col("page_id").isNull(), "page_id", "record_id")).alias("f"), F.count(F.lit(1)).alias("n")
    )
    # Only shared payloads are joined; one record cannot refer to itself.
    first = first.where("n > 1").select(*alike, F.col("f.record_id").alias("first_id"))
    rows = records.join(first, alike, "left")
    return rows.withColumn("refers_to", F.when(F.col("first_id") != F.col("record_id"), F.col("first_id"))).drop("first_id")


# -- WARC ----------------------------------------------------------------------------------


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.0", *(f"{k}: {v}".encode() for k, v in fields), f"Content-Length: {len(block)}".encode(), b"", b""]
    return b"\r\n".join(lines) + block


class _WarcFiles:
    """Records one behind the other, in files of about ``file_bytes``."""

    def __init__(self, file_bytes: int):
        self.file_bytes, self.held, self.size = file_bytes, [], 0

    def add(self, record: tuple, refers_to: str | None) -> Iterator[pa.RecordBatch]:
        """Take in a record in the columns of ``RECORDS``; yields a file when one is full."""
        ident, kind, uri, date, ip, content_type, head, payload, _, digest, _ = record
        block = head if refers_to else head + payload
        fields = [
            ("WARC-Type", "revisit" if refers_to else kind), ("WARC-Record-ID", ident), ("WARC-Date", date),
            ("WARC-Target-URI", uri), ("WARC-IP-Address", ip),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ]
        if refers_to:
            fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", refers_to)]
        self.held.append(_warc_record([*fields, ("Content-Type", content_type)], block))
        self.size += len(block)
        if self.size >= self.file_bytes:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(self.held)], pa.binary())], ["file"])
            self.held, self.size = [], 0


def _warc_files(file_bytes: int) -> Callable:
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, files = zstandard.ZstdDecompressor().decompress, _WarcFiles(file_bytes)
        for batch in batches:
            for r in batch.to_pylist():
                r["payload"] = b"" if r["refers_to"] else unpack(r["payload"])
                yield from files.add(tuple(r[c] for c in names), r["refers_to"])
        yield from files.rest()

    return run


def _converted(file_bytes: int) -> Callable:
    """WARC files from whole ARC files and the revisits among the records of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _WarcFiles(file_bytes)
        for batch in batches:
            for path, content, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first = {m["record_id"]: m["refers_to"] for m in marks or ()}
                for record in _arc_rows(path, content):
                    yield from files.add(record, first.get(record[0]))
        yield from files.rest()

    return run


def _write_files(files: DataFrame, path: str) -> str:
    files.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return path


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> str:
    """Write records (as of ``read_arc`` and ``mark_revisits``) as gzipped WARC files."""
    small_batches(records.sparkSession)
    return _write_files(records.mapInArrow(_warc_files(file_bytes), "file binary").select(F.col("file").cast("string")), path)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC file."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("a record does not begin with its version")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields["content-length"])
        if end + 4 + length > len(data):
            raise ValueError("a record is shorter than declared")
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length


def _records_of_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "type", "uri", "date", "payload_digest", "payload_bytes", "refers_to", "page_id", "sound"]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    for batch in batches:
        for content in batch.column(1).to_pylist():
            rows = []
            for fields, block in warc_records(_unzipped(content)):
                head, payload = _split_http(block) if block.startswith(b"HTTP/") else (b"", block)
                revisit = fields["warc-type"] == "revisit"
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest_of(payload)
                size = _number(_http_field(head, b"content-length")) if revisit else len(payload)
                sound = fields.get("warc-block-digest") in (None, f"sha1:{digest_of(block)}")
                sound = sound and fields.get("warc-payload-digest") in (None, f"sha1:{digest}")
                rows.append((
                    fields["warc-record-id"], fields["warc-type"], fields.get("warc-target-uri"), fields.get("warc-date"),
                    digest, size, fields.get("warc-refers-to"), _number(_http_field(head, b"x-page-id")), sound,
                ))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Per WARC record: id, type, target, time, digest and size of the payload, ``refers_to``, ``page_id``, ``sound``.

    Digests of records with a payload are computed from it; ``sound`` says whether they are those of
    the header. A revisit has those of the payload it stands for.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    kinds = (
        "record_id string, type string, uri string, date string, payload_digest string, payload_bytes long, "
        "refers_to string, page_id long, sound boolean"
    )
    with one_row_batches(spark):
        return stored(files.mapInArrow(_records_of_warc, kinds), "warc-records")


def convert_arc(
    spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES
) -> str:
    """Convert the ARC files below ``arc_path`` to WARC files, repeated payloads as revisits.

    The files are read twice: for ids, digests and sizes, which alone are joined to find revisits, and
    to write the records. In between, the revisits are gathered by file, so there are no more of them in one
    row than the file has records; no payload is stored or sorted. Broken header lines and lengths
    raise an error that says what is wrong. No files give no files.
    """
    files = spark.read.format("binaryFile").load(arc_path).select("path", "content")
    kinds = "path string, record_id string, payload_bytes long, payload_digest string, page_id long"
    with one_row_batches(spark):
        heads = stored(files.mapInArrow(_heads_of_arc, kinds), "arc-heads")
        revisits = mark_revisits(heads, least_bytes).where("refers_to is not null")
        by_file = stored(revisits.groupBy("path").agg(F.collect_list(F.struct("record_id", "refers_to")).alias("marks")), "revisits")
        whole = files.join(by_file, "path", "left").select("path", "content", "marks")
        converted = whole.mapInArrow(_converted(file_bytes), "file binary").select(F.col("file").cast("string"))
        return _write_files(converted, warc_path)


def op9_warc_from_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` as legacy archives, converted to WARC and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    arc = write_arc(pages, work_dir(spark, "arc"))
    found = read_warc(spark, convert_arc(spark, arc, work_dir(spark, "warc")))
    first = found.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first_page"))
    rows = found.join(first, "refers_to", "left")
    return rows.select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("first_page").alias("refers_to"),
    )
