"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Each record is a gzip member of its own. A task writes its records to files of its own in
the given folder and returns their names, so what a lost or repeated task has left behind
is in no list and is never read. The reader takes files by their bytes. It checks every
member and record; where a check fails it searches for the next place at which a member
or a version line starts a record that passes, goes on from there, and reports the bytes
between as a quarantined gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm.common import document_key, join_checked, materialize, need

FILE_BYTES = 64 << 20
# The format's names.
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
NOBODY = (1 << 63) - 1


# --- records ---------------------------------------------------------------------


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The record of a page: its response, or the revisit of another page's payload."""
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url) if url else f'urn:page:{page}'}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if refers_to is not None:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"Refers-To-Page-ID: {refers_to}",
        ]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END + block + END


@dataclass
class Found:
    """A record, or a gap of bytes that belong to none."""

    offset: int
    length: int
    problem: str | None = None
    fields: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    payload_bytes: int | None = None
    digest: str | None = None


class Damaged(ValueError):
    pass


def _parse(data: bytes, at: int) -> tuple[Found, int]:
    """The record that starts at `at`, and the place after it; raises Damaged."""
    head = data.find(END, at)
    if not data.startswith(b"WARC/1.", at) or head < 0:
        raise Damaged("no version line or header end")
    fields = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line without a colon")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdecimal():
        raise Damaged("no content length")
    begin, stop = head + len(END), head + len(END) + int(size)
    if data[stop : stop + len(END)] != END:
        raise Damaged("the block does not end where its length says")
    found = Found(at, stop + len(END) - at, fields=fields)
    block = data[begin:stop]
    http, _, body = block.partition(END) if block.startswith(b"HTTP/") else (b"", b"", block)
    if fields.get("warc-type") == "revisit":
        named = [v for n, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if n.strip().lower() == b"content-length"]
        found.payload_bytes = int(named[0]) if named and named[0].strip().isdigit() else None
        found.digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    else:
        found.payload, found.payload_bytes, found.digest = body, len(body), digest_of(body)
        told = fields.get("warc-payload-digest", "")
        if told.startswith("sha1:") and told != f"sha1:{found.digest}":
            raise Damaged("the payload does not have its digest")
    return found, stop + len(END)


def _unpack(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at `at`, and the place after it."""
    inflater = zlib.decompressobj(31)
    try:
        content = inflater.decompress(data[at:])
    except zlib.error as error:
        raise Damaged(f"gzip: {error}") from None
    if not inflater.eof:
        raise Damaged("gzip: the member has no end")
    return content, len(data) - len(inflater.unused_data)


def _read_at(data: bytes, view: memoryview, at: int) -> tuple[list[Found], int]:
    """Records of the member or plain record at `at`, and the place after it."""
    if not data.startswith(MEMBER, at):
        found, after = _parse(data, at)
        return [found], after
    content, after = _unpack(view, at)
    inside, place = [], 0
    while place < len(content):
        found, place = _parse(content, place)
        found.offset, found.length = at, after - at
        inside.append(found)
    return inside, after


def salvage(data: bytes) -> Iterator[Found]:
    """All sound records of a file, and the gaps between them, in order."""
    view, at, gap, why = memoryview(data), 0, None, ""
    while at < len(data):
        try:
            found, after = _read_at(data, view, at)
        except Damaged as problem:
            if gap is None:
                gap, why = at, str(problem)
            starts = [p for p in (data.find(MEMBER, at + 1), data.find(b"WARC/1.", at + 1)) if p >= 0]
            at = min(starts, default=len(data))
            continue
        if gap is not None:
            yield Found(gap, at - gap, why)
            gap = None
        yield from found
        at = after
    if gap is not None:
        yield Found(gap, len(data) - gap, why)


# --- Spark -----------------------------------------------------------------------


def write_archive(
    pages: DataFrame,
    folder: str,
    least_revisit_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> DataFrame:
    """Write a record per row into files of at most about `file_bytes`; returns (file, records, bytes).

    Of rows with equal payloads of at least `least_revisit_bytes` bytes the one with the
    smallest id is the response and the others revisit it; rows that repeat this id are
    responses too, and missing ids come last. Null payloads count as empty, a null url is
    replaced by a name made of the id. The folder must be one that all executors share.
    """
    need(pages, (id_column, url_column, payload_column))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page"), document_key(id_column).alias("key"),
        F.col(url_column).alias("url"), F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"),
    )
    hashed = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    large = hashed.filter(F.octet_length("payload") >= least_revisit_bytes)
    first = large.groupBy("sha1").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(first.filter("n > 1").drop("n"), "repeated-payloads")
    known = join_checked(hashed, repeated, ["sha1"], "left")
    again = (F.octet_length("payload") >= least_revisit_bytes) & (F.col("first") < F.col("key"))
    jobs = known.select("page", "url", "payload", F.when(again, F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        sink = name = None
        records = size = 0

        def close():
            nonlocal sink
            sink.close()
            sink = None
            return pa.RecordBatch.from_pydict({"file": [name], "records": [records], "bytes": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                member = gzip.compress(record(row["page"], row["url"], row["payload"], row["refers_to"]), 6, mtime=0)
                sink.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    yield close()
        if sink is not None:
            yield close()

    return materialize(jobs.mapInArrow(run, "file string, records long, bytes long"), "archive-files")


def read_archive(spark: SparkSession, paths: str | list[str], files: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """One row per record and per gap of the files under `paths`.

    Columns: file, offset and length in it, problem (what is wrong with a gap, else null),
    record_type, page_id, uri, refers_to, payload_bytes, payload_digest and payload (null
    unless `payloads`). `files` may list the names of the files to read. Plain and
    compressed files are told apart by content; a file must fit into memory (2 GB at
    most), so writers should roll over to new files as `write_archive` does.
    """
    stored = spark.read.format("binaryFile").load(paths).select("path", "content")
    stored = stored.withColumn("file", F.element_at(F.split("path", "/"), -1))
    if files is not None:
        stored = stored.join(files.select("file"), "file", "left_semi")

    def number(text: str | None) -> int | None:
        return int(text) if text and text.lstrip("-").isdecimal() else None

    schema = pa.schema(
        [
            ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("problem", pa.string()),
            ("record_type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
        ]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for found in salvage(content.as_py()):
                    f = found.fields
                    rows.append((
                        name.as_py(), found.offset, found.length, found.problem, f.get("warc-type"),
                        number(f.get("page-id")), f.get("warc-target-uri"), number(f.get("refers-to-page-id")),
                        found.payload_bytes, found.digest, found.payload if payloads and not found.problem else None,
                    ))
                    held += len(found.payload) if payloads else 0
                    if len(rows) >= 2000 or held >= 16 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return stored.select("file", "content").mapInArrow(
        run,
        "file string, offset long, length long, problem string, record_type string, page_id long, uri string, "
        "refers_to long, payload_bytes long, payload_digest string, payload binary",
    )
