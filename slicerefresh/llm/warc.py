"""Content-addressed WARC archive.

An archive is two tables and the files made from them:

* ``payloads``: each distinct payload once, under its SHA-256, which is
  computed again from the stored bytes before the archive is used;
* ``headers``: the exact header block of every record, apart from the
  payload, with the digest it refers to;
* ``warc``: WARC/1.1 files, made by joining both: a header block, an empty
  line, the payload, two line ends.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
smallest page id is a ``response``, which holds the payload; the others are
``revisit`` records that refer to it and hold none.  ``read_files`` parses WARC
files by their Content-Length; ``reconstruct`` gives every original record
back, payload included, from the two tables.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicerefresh.llm.shared import join_hot, written
from slicerefresh.session import scratch_path

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
#: Records of a WARC file at most; files are read whole, one at a time.
FILE_RECORDS = 2_000
_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(hexdigest: Column) -> Column:
    """Base32 of a 40-digit hexadecimal digest: five hex digits are four base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(hexdigest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _HEX, _BASE32)


def _clean(value: Column) -> Column:
    """A header value has one line."""
    return F.regexp_replace(value, r"[\r\n]+", " ")


def record_uri(row: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), row.cast("string"), F.lit(">"))


def _header(kind: Column, row: Column, url: Column, page: Column, digest: Column, length: Column, first_page: Column) -> Column:
    """The header block: lines end in CRLF, without the empty line that ends it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    revisit = kind == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", record_uri(row)),
        line("WARC-Date", F.lit(DATE)),
        optional("WARC-Target-URI", _clean(url)),
        optional("X-Page-ID", page.cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("X-Payload-Length", length.cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), optional("X-Refers-To-Page-ID", first_page.cast("string")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(length.cast("string"))),
    )


class Archive:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    @property
    def headers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/headers")

    @property
    def payloads(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/payloads")

    @property
    def files(self) -> str:
        return f"{self.path}/warc"


def store(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> Archive:
    """Write the header and payload tables of ``pages``.

    A null payload is empty; null ids are largest.  Of rows with equal payload
    and id the first read is the response.  Other columns are not read.  An
    empty table gives an empty archive.
    """
    spark = pages.sparkSession
    archive = Archive(spark, scratch_path(spark, "llm-warc"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.sha2("payload", 256).alias("address"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    index = written(rows.select("page_id", "url", "address", "sha1", "payload_bytes", F.monotonically_increasing_id().alias("row")), "warc-index")

    # The response of each payload: null ids last, then the first read.
    first = index.groupBy("address").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first"),
        F.count("*").alias("copies"),
        F.max("payload_bytes").alias("longest"),
        F.min("payload_bytes").alias("shortest"),
    )
    first = written(first, "warc-first")
    if not first.filter("longest <> shortest").isEmpty():
        raise ValueError("payloads of different lengths have one SHA-256")
    long_enough = F.col("longest") >= min_bytes
    first = first.select("address", "copies", F.when(long_enough, F.col("first.page_id")).alias("first_page"), F.when(long_enough, F.col("first.row")).alias("first_row"))
    marked = join_hot(index, first, ["address"], "copies", index.count())
    kind = F.when(F.col("first_row") != F.col("row"), "revisit").otherwise("response")
    headers = marked.withColumn("record_type", kind).withColumn("payload_digest", base32_of_hex(F.upper("sha1")))
    header = _header(F.col("record_type"), F.col("row"), F.col("url"), F.col("page_id"), F.col("payload_digest"), F.col("payload_bytes"), F.col("first_page"))
    headers.select("row", "page_id", "address", "payload_bytes", "record_type", header.alias("header")).write.parquet(f"{archive.path}/headers")

    # Each payload once: every task keeps the first of equal payloads it meets, the shuffle keeps one of these.
    rows.groupBy("address").agg(F.min("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{archive.path}/payloads")
    if not archive.payloads.filter(F.sha2("payload", 256) != F.col("address")).isEmpty():
        raise ValueError("a stored payload does not have its address")
    return archive


def reconstruct(archive: Archive) -> DataFrame:
    """Every original record: row, header, payload (revisits get the payload they refer to)."""
    return archive.headers.join(archive.payloads, "address").select("row", "page_id", "record_type", "header", "payload")


def write_files(archive: Archive) -> str:
    """Write the WARC files: responses are joined to their payload, revisits need none.

    Records stay in the partitions of the join, so that payloads move once;
    files are compressed as a whole.
    """
    headers = archive.headers
    responses = headers.filter("record_type = 'response'").join(archive.payloads, "address")
    records = responses.select(F.concat("header", F.lit("\r\n"), "payload").alias("value")).unionByName(
        headers.filter("record_type = 'revisit'").select(F.concat("header", F.lit("\r\n")).alias("value"))
    )
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(archive.files)
    return archive.files


def parse(raw: bytes):
    """Yield ``(header fields, payload)`` of each record of a WARC file."""
    at = 0
    while at < len(raw):
        if not raw.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = raw.index(b"\r\n\r\n", at)
        fields: dict[str, str] = {}
        for line in raw[at:end].decode("utf-8").split("\r\n")[1:]:
            name, _, value = line.partition(": ")
            fields[name] = value
        size = int(fields["Content-Length"])
        body = end + 4
        yield fields, raw[body : body + size]
        if raw[body + size : body + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end after its Content-Length")
        at = body + size + 4


_READ = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, computed_digest string, url string"


def _number(fields: dict[str, str], name: str) -> int | None:
    return int(fields[name]) if name in fields else None


def _read_batches(batches):
    for batch in batches:
        for content in batch.column("content"):
            out: dict[str, list] = {k.split()[0]: [] for k in _READ.split(", ")}
            for fields, payload in parse(gzip.decompress(content.as_buffer())):
                kind = fields["WARC-Type"]
                out["page_id"].append(_number(fields, "X-Page-ID"))
                out["record_type"].append(kind)
                out["payload_bytes"].append(_number(fields, "X-Payload-Length"))
                out["payload_digest"].append(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                out["refers_to"].append(_number(fields, "X-Refers-To-Page-ID"))
                out["computed_digest"].append(base64.b32encode(hashlib.sha1(payload).digest()).decode() if kind == "response" else None)
                out["url"].append(fields.get("WARC-Target-URI"))
            if out["page_id"]:
                yield pa.record_batch(
                    [pa.array(v, pa.int64() if k in ("page_id", "payload_bytes", "refers_to") else pa.string()) for k, v in out.items()], names=list(out)
                )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Parse WARC files; the digest of each stored payload is computed again."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    return files.mapInArrow(_read_batches, _READ)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Store, write, read back: one row per page, as read from the WARC files.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to.
    A payload that does not have the digest in its header is an error.
    """
    archive = store(pages)
    records = read_files(pages.sparkSession, write_files(archive))
    broken = (F.col("record_type") == "response") & ~F.col("computed_digest").eqNullSafe(F.col("payload_digest"))
    checked = F.when(broken, F.raise_error(F.concat(F.lit("digest mismatch: "), F.col("payload_digest")))).otherwise(F.col("payload_digest"))
    return records.select("page_id", "payload_bytes", checked.cast("string").alias("payload_digest"), "record_type", "refers_to")
