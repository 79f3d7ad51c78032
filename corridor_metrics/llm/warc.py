"""WARC archives: capture, normalisation of whole-file gzip, and reading by offset.

``capture`` writes each partition as one WARC file that is a single gzip member, the way
plain ``gzip`` leaves it. ``normalise`` inflates such a stream once, rewrites every record as
a member of its own, and writes a sidecar index (offset, length and main headers of each
record), after which any record is read alone. ``read_records`` does so.

Payloads that occur more than once are stored once: the others become revisit records.

Defined results: NULL payloads count as empty; a NULL page id or url leaves its header out;
of equal payloads of at least ``least`` bytes the rows with the largest page id are
responses (all of them, if that id repeats) and the others revisit it; without any id all are responses.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.llm.common import payload, spread

REVISIT_FROM = 1000
DATE = "2024-01-01T00:00:00Z"
# Fixed value: profile of revisit records in the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STEP = 1 << 20

FILES = "part int, path string, n_records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, offset long, length long"


def record_id(page_id: int | None, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{sha1}')}>"


def record_bytes(page_id: int | None, url: str | None, data: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n".encode()
    block = http if revisit else http + data
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, sha1)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, sha1) if revisit else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


def inflate(stream) -> Iterator[bytes]:
    """Data of a gzip stream of one or more members, a step at a time."""
    machine = zlib.decompressobj(31)
    while chunk := stream.read(STEP):
        while chunk:
            yield machine.decompress(chunk, STEP)
            while machine.unconsumed_tail and not machine.eof:
                yield machine.decompress(machine.unconsumed_tail, STEP)
            chunk = machine.unused_data
            if machine.eof and chunk:
                machine = zlib.decompressobj(31)
    yield machine.flush()


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) for each record of a stream; holds one record at a time."""
    held = bytearray()
    need = None
    head: dict[str, str] = {}
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = headers_of(bytes(held[:end]))
                need = end + 4 + int(head["content-length"]) + 4
            if len(held) < need:
                break
            yield head, bytes(held[:need])
            del held[:need]
            need = None


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    machine = zlib.compressobj(6, zlib.DEFLATED, 31)
    return machine.compress(data) + machine.flush()


def mark_revisits(pages: DataFrame, least: int = REVISIT_FROM, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, data, sha1, refers_to, revisit."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload(html_col).alias("data"))
    rows = rows.withColumn("sha1", F.sha1("data"))
    firsts = (
        rows.where(F.octet_length("data") >= least).groupBy("sha1")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return rows.join(firsts, "sha1", "left").select(
        "page_id", "url", "data", "sha1", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")
    )


def _capture(folder: str):
    def capture(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        filesystem, base = fs.FileSystem.from_uri(folder)
        name, attempt, n = f"{base}/capture-{part:06d}.warc.gz", uuid.uuid4().hex, 0
        machine = zlib.compressobj(6, zlib.DEFLATED, 31)
        with filesystem.open_output_stream(f"{name}.{attempt}", compression=None) as sink:
            for batch in batches:
                columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "data", "sha1", "refers_to", "revisit")]
                for i in range(batch.num_rows):
                    sink.write(machine.compress(record_bytes(*(c[i].as_py() for c in columns))))
                n += batch.num_rows
            sink.write(machine.flush())
        filesystem.move(f"{name}.{attempt}", name)
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]), pa.array([n])], names=["part", "path", "n_records"])

    return capture


def capture(marked: DataFrame, folder: str) -> DataFrame:
    """Write rows of ``mark_revisits`` as whole-file gzip archives; returns the stored list of files."""
    filesystem, base = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(base, recursive=True)
    marked.mapInArrow(_capture(folder), FILES).write.mode("overwrite").parquet(f"{folder}/captures")
    return marked.sparkSession.read.schema(FILES).parquet(f"{folder}/captures")


def _normalise(folder: str):
    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for part, path in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("part", "path"))):
                name, attempt, at, n = f"{base}/part-{part:06d}", uuid.uuid4().hex, 0, 0
                with (
                    filesystem.open_input_stream(path, compression=None) as source,
                    filesystem.open_output_stream(f"{name}.{attempt}", compression=None) as sink,
                    filesystem.open_output_stream(f"{name}.{attempt}.i", compression=None) as index,
                ):
                    for head, record in split_records(inflate(source)):
                        data = member(record)
                        sink.write(data)
                        entry = {"offset": at, "length": len(data), "id": head["warc-record-id"], "type": head["warc-type"], "uri": head.get("warc-target-uri")}
                        index.write((json.dumps(entry) + "\n").encode())
                        at += len(data)
                        n += 1
                filesystem.move(f"{name}.{attempt}", f"{name}.warc.gz")
                filesystem.move(f"{name}.{attempt}.i", f"{name}.index.jsonl")
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]), pa.array([n])], names=["part", "path", "n_records"])

    return normalise


def normalise(captures: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives record by record with an index; returns the stored list of files."""
    filesystem, base = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(base, recursive=True)
    spread(captures, "part").mapInArrow(_normalise(folder), FILES).write.mode("overwrite").parquet(f"{folder}/files")
    return captures.sparkSession.read.schema(FILES).parquet(f"{folder}/files")


def read_record(file, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of the record at an offset."""
    file.seek(offset)
    data = zlib.decompress(file.read(length), 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    head = headers_of(head)
    http, _, body = rest[: int(head["content-length"])].partition(b"\r\n\r\n")
    return head, headers_of(http), body


def _read(folder: str):
    names = [f.split()[0] for f in RECORDS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(batch.schema.get_field_index("path")).to_pylist():
                rows = []
                with filesystem.open_input_file(f"{path}.warc.gz") as file, filesystem.open_input_stream(f"{path}.index.jsonl", compression=None) as side:
                    rest = b""
                    while chunk := side.read(STEP):
                        *lines, rest = (rest + chunk).split(b"\n")
                        for entry in map(json.loads, lines):
                            head, http, body = read_record(file, entry["offset"], entry["length"])
                            revisit = head["warc-type"] == "revisit"
                            size = int(http["content-length"]) if revisit else len(body)
                            stored = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                            digest = stored if revisit else hashlib.sha1(body).hexdigest()
                            number = lambda key, head=head: int(head[key]) if key in head else None
                            rows.append((number("x-page-id"), size, digest, head["warc-type"], number("x-refers-to-page-id"), path, entry["offset"], entry["length"]))
                        if len(rows) >= 10_000:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return read


def read_records(files: DataFrame, folder: str) -> DataFrame:
    """Every record, read alone by its place in the index."""
    return spread(files, "part").mapInArrow(_read(folder), RECORDS)
