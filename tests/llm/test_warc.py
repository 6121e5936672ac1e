import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from slicerefresh.llm import warc as op

ROWS = [
    (5, "http://a/1", "<p>same</p>", "x", 1),
    (3, "http://a/2", "<p>same</p>", "x", 1),
    (9, None, "<p>same</p>", None, 1),
    (1, "http://a/\r\n3", None, "x", None),
    (2, "http://é/4", "", "x", 1),
    (4, "http://b/5", "lines\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n€", "x", 1),
    (6, "http://b/6", "one row twice", "x", 1),
    (6, "http://b/6", "one row twice", "x", 1),
    (None, "http://b/7", "no id", "x", 1),
    (None, None, "<p>same</p>", "x", 1),
    (7, "http://b/8", "long " * 200_000, "x", 1),
]
SCHEMA = "page_id long, url string, html string, address string, row int"


def expected(rows, min_bytes=0):
    first = {}
    for page, _, html, *_ in rows:
        key = html or ""
        first[key] = min(first.get(key, 10**9), page if page is not None else 10**8)
    out = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), first[html or ""]))
    return out


def test_edge_rows(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = op.archive_pages(pages).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted((str(p), n, d) for p, n, d, _ in expected(ROWS))
    by = {r.page_id: r for r in got if r.page_id not in (None, 6)}
    assert by[3].record_type == "response" and by[3].refers_to is None
    assert (by[5].record_type, by[5].refers_to) == ("revisit", 3) == (by[9].record_type, by[9].refers_to)
    assert (by[2].record_type, by[2].refers_to) == ("revisit", 1)  # a null payload is empty
    assert sorted((r.record_type, r.refers_to) for r in got if r.page_id == 6) == [("response", None), ("revisit", 6)]
    none = {r.payload_bytes: r for r in got if r.page_id is None}
    assert none[5].record_type == "response" and none[11].refers_to == 3
    assert op.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_records_are_rebuilt_exactly(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    archive = op.store(pages)
    assert archive.payloads.count() == len({r[2] or "" for r in ROWS})
    records = op.reconstruct(archive).collect()
    assert sorted(r.payload for r in records) == sorted(r[2] or "" for r in ROWS)
    path = op.write_files(archive)
    raw = [gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect()]
    parsed = [x for data in raw for x in op.parse(data)]
    assert len(parsed) == len(ROWS)
    headers = {r.header for r in records}
    for data in raw:  # the files are the stored headers and payloads, byte for byte
        at = 0
        for fields, payload in op.parse(data):
            end = data.index(b"\r\n\r\n", at)
            assert data[at : end + 2].decode() in headers
            assert (payload == b"") == (fields["WARC-Type"] == "revisit" or fields["X-Payload-Length"] == "0")
            at = end + 4 + len(payload) + 4
        assert at == len(data)


def test_short_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    records = op.read_files(spark, op.write_files(op.store(pages, min_bytes=12))).collect()
    assert len(records) == len(ROWS)
    assert all(r.record_type == "response" for r in records if r.payload_bytes < 12)
    assert sum(r.record_type == "revisit" for r in records) == 1


def test_damage_is_seen(spark):
    pages = spark.createDataFrame(ROWS[:2], SCHEMA)
    archive = op.store(pages)
    path = archive.path + "-damaged"
    archive.headers.withColumn("header", F.regexp_replace("header", "sha1:.", "sha1:1")).write.parquet(f"{path}/headers")
    archive.payloads.write.parquet(f"{path}/payloads")
    records = op.read_files(spark, op.write_files(op.Archive(spark, path)))
    assert records.filter("record_type = 'response' and payload_digest <> computed_digest").count() == 1


def test_base32(spark):
    rows = [(hashlib.sha1(str(k).encode()).hexdigest(),) for k in range(50)]
    got = spark.createDataFrame(rows, "h string").select("h", op.base32_of_hex(F.upper("h")).alias("b")).collect()
    assert all(r.b == base64.b32encode(bytes.fromhex(r.h)).decode() for r in got)
