"""WARC archives: deduplicated writing, an index of all records, and byte-range reads.

Records are gzip members of their own, so each can be read alone. The index comes
first: file, offset, length, URL and digest of every record. A read takes the
index rows it wants, in order of file and offset, joins neighbours to ranges and
fetches each range at once.

Files lie below one folder of any file system that pyarrow opens by its URI
(local or shared disk, S3, GCS, HDFS). A task writes files of new names and only
the index of a task that succeeded names them, so repeated tasks do no harm.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.llm.columns import rows_per_batch
from stratalode.sinks import stage

ROWS = 500
RECORD = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint"
INDEX = f"file string, offset bigint, length bigint, {RECORD}"
_index_schema = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
    ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
])
_read_schema = pa.schema([_index_schema.field(i) for i in range(3, 9)] + [pa.field("payload", pa.binary())])
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder's URI; one slash after ``file:`` will do."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _clean(value: str) -> str:
    """A header value: line ends would end it."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, compressed. A revisit keeps the HTTP header, which tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", None if url is None else _clean(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>" if revisit else None),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


def parse(raw: bytes) -> dict:
    """What a compressed record holds; a response's payload is measured and hashed."""
    data = zlib.decompress(raw, 31)
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload its header tells")
    number = lambda name: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)", fields.get(name, ""))) else None
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "payload_digest": digest, "payload_bytes": length, "refers_to": number("WARC-Refers-To"),
        "payload": None if revisit else payload,
    }


def _writer(folder: str, max_file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name, out, at = "", None, 0
        for batch in batches:
            index = []
            for row in batch.to_pylist():
                if out is None or at >= max_file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                payload = (row["html"] or "").encode()
                raw = record(row["page_id"], row["url"], payload, row["digest"], row["refers_to"], row["revisit"])
                out.write(raw)
                index.append({
                    "file": name, "offset": at, "length": len(raw), "page_id": row["page_id"], "url": row["url"],
                    "record_type": "revisit" if row["revisit"] else "response", "payload_digest": row["digest"],
                    "payload_bytes": len(payload), "refers_to": row["refers_to"],
                })
                at += len(raw)
            yield pa.RecordBatch.from_pylist(index, schema=_index_schema)
        if out is not None:
            out.close()

    return write


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 1000, max_file_bytes: int = 1 << 30) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); returns the index, written below ``folder``.

    Of records with equal payloads of ``min_revisit_bytes`` or more, those with the
    largest page_id are responses and the others revisit it; all smaller ones are
    responses. A NULL html is an empty payload. A NULL page_id is smaller than any
    other; rows that share the largest one all are responses. An empty table gives
    an empty index; other columns are left out.

    Payloads are compared by their SHA-1. Only digests that occur more than once
    are joined to the pages; they are added up before the shuffle.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
        F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest"),
    )
    large = rows.where(F.octet_length("html") >= min_revisit_bytes)
    repeated = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("newest")).where("n > 1")
    repeated = stage(repeated.select("digest", "newest"), "repeated-payloads")
    joined = rows.join(repeated, "digest", "left")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    joined = joined.select(
        "page_id", "url", "html", "digest", F.when(revisit, F.col("newest")).alias("refers_to"), revisit.alias("revisit")
    )
    path = f"{folder.rstrip('/')}/index"
    with rows_per_batch(spark, ROWS):  # pages are turned into Python objects a batch at a time
        joined.mapInArrow(_writer(folder, max_file_bytes), INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def ranges(rows: Iterable[dict], gap: int, most: int) -> Iterator[list[dict]]:
    """Rows in order of file and offset, in groups whose bytes are worth one read."""
    group: list[dict] = []
    for row in rows:
        if group:
            last = group[-1]
            near = row["file"] == last["file"] and row["offset"] <= last["offset"] + last["length"] + gap
            if not near or row["offset"] + row["length"] - group[0]["offset"] > most:
                yield group
                group = []
        group.append(row)
    if group:
        yield group


def _reader(folder: str, gap: int, most: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        name, source = None, None
        for group in ranges((row for batch in batches for row in batch.to_pylist()), gap, most):
            if group[0]["file"] != name:
                if source is not None:
                    source.close()
                name = group[0]["file"]
                source = system.open_input_file(f"{path}/{name}")
            first, last = group[0]["offset"], max(r["offset"] + r["length"] for r in group)
            data = source.read_at(last - first, first)
            found = [parse(data[r["offset"] - first : r["offset"] - first + r["length"]]) for r in group]
            yield pa.RecordBatch.from_pylist(found, schema=_read_schema)
        if source is not None:
            source.close()

    return read


def reading_tasks(index: DataFrame, bytes_per_task: int) -> int:
    """Tasks for the archive bytes that an index names: the index itself says nothing of their size."""
    total = index.agg(F.sum("length")).first()[0] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-total // bytes_per_task), min(2 * cores, total >> 20))


def read_records(
    index: DataFrame, folder: str, gap: int = 1 << 16, most: int = 8 << 20, bytes_per_task: int = 128 << 20
) -> DataFrame:
    """The records that ``index`` rows name, with their payloads (NULL for revisits).

    Rows are dealt out by file and offset, so a task reads whole stretches; ranges
    no more than ``gap`` bytes apart are joined, up to ``most`` bytes at a time.
    Tasks take about ``bytes_per_task`` of the archives, less where cores are free. A
    response whose payload does not have the digest of its header is an error.
    """
    tasks = reading_tasks(index, bytes_per_task)
    wanted = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return wanted.mapInArrow(_reader(folder, gap, most), f"{RECORD}, payload binary")

