import gzip
import hashlib
import io
from collections import defaultdict

from pyarrow import fs

from corridor_metrics.llm import warc
from corridor_metrics.llm.queries import QUERIES, fresh_folder
from edge_cases import edges, nothing, shipped  # noqa: F401

ROWS = [
    (1, "http://a/x", "short"), (2, "http://b/y z\r\nX: 1", "short"), (3, "http://c", "p" * 1500), (4, None, "p" * 1500), (5, "http://d", None),
    (6, "http://e", ""), (None, "http://f", "p" * 1500), (7, "http://g", "é\r\n\r\nWARC/1.1\r\n" * 200), (4, None, "p" * 1500),
    (None, "http://h", "q" * 2000), (None, "http://h", "q" * 2000), (8, "http://long", "wide page " * 400_000),
]


def expected(rows):
    top = defaultdict(list)
    for page, _, html in rows:
        top[html or ""].append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = max((p for p in top[html or ""] if p is not None), default=None)
        revisit = len(data) >= 1000 and first is not None and page != first
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def archived(spark, df):
    folder = fresh_folder(spark, "warc")
    captures = warc.capture(warc.mark_revisits(df), f"{folder}/captures")
    files = warc.normalise(captures, f"{folder}/archive")
    return captures, files, warc.read_records(files, f"{folder}/archive")


def test_edges(spark):
    df = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, sha1 string, data int").repartition(3)
    captures, files, records = archived(spark, df)
    got = records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(ROWS)
    local = fs.LocalFileSystem()
    for before, after in zip(captures.orderBy("part").collect(), files.orderBy("part").collect()):
        with local.open_input_stream(before.path, compression=None) as a, local.open_input_stream(f"{after.path}.warc.gz", compression=None) as b:
            whole, members = a.read(), b.read()
        assert gzip.decompress(whole) == gzip.decompress(members)  # the same records
        assert before.n_records == after.n_records
    row = records.where("page_id = 7").first()
    with open(f"{row.path}.warc.gz", "rb") as file:
        head, _, body = warc.read_record(file, row.offset, row.length)
        assert head["warc-type"] == "response" and body == ROWS[7][2].encode()
        file.seek(row.offset)
        assert gzip.decompress(file.read(row.length)).startswith(b"WARC/1.1\r\n")


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert archived(spark, df)[2].count() == 0


def test_inflate_reads_members_and_whole_files():
    data = bytes(range(256)) * 20_000
    for stream in (gzip.compress(data), gzip.compress(data[:1000]) + gzip.compress(data[1000:]) + gzip.compress(b"")):
        assert b"".join(warc.inflate(io.BytesIO(stream))) == data


def test_query(spark, small):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op7_warc"](spark, small).collect()), key=repr) == expected(rows)
