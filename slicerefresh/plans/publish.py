"""Publishing a table without ever truncating it first: stage -> verify -> switch.

A published table is an external catalog table whose location is one
immutable version folder.  A new version is written next to the old one,
the rows in its files are counted and checked against the counts of the inputs,
and only then is the table's location switched.  A failed run leaves the previous
version readable and unchanged, and the previous version doubles as the
pre-change backup.

Physical layout of the fact: the table is bucketed by the layout's full
primary key and sorted by it inside each bucket.

* Bucketing by the *full* key spreads a hot partition key (a practice with a
  third of all rows) over all buckets: no skew.
* A bucketed scan is hash-partitioned by a subset of the columns, which
  satisfies the distribution a whole-row DISTINCT needs, so the next slice
  replacement de-duplicates without a shuffle.
* Sorting by the layout key gives narrow min/max ranges of the layout's
  partition key per Parquet row group: reads by practice / provider /
  location / measure skip most row groups.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slicerefresh.operators.audit import WrittenCounts
from slicerefresh.schema import Layout


class PublishError(RuntimeError):
    pass


@dataclass
class BucketSpec:
    num_buckets: int
    columns: tuple[str, ...]
    sort_columns: tuple[str, ...]

    @classmethod
    def for_layout(cls, layout: Layout, num_buckets: int, columns: Sequence[str] | None = None) -> BucketSpec:
        """Buckets by the layout's whole key, or by ``columns`` of it; always sorted by the key."""
        return cls(num_buckets, tuple(columns or layout.key), tuple(layout.key))

    def fits(self, layout: Layout) -> bool:
        return set(self.columns) <= set(layout.key) and self.sort_columns == tuple(layout.key)


@dataclass
class Staged:
    """A written, not yet published version of ``table``."""

    table: str
    path: str
    staging_name: str
    bucket_spec: BucketSpec | None
    rows: int | None = None  # in the written files, from verification
    verified: bool = False
    bucket_rows: tuple[int, int] | None = None  # (largest, median) rows per bucket, from verification
    previous_properties: dict[str, str] | None = None  # the bucket statistics before the switch
    base: str | None = None  # the table's location that the new version was made from


#: Versions are written once and read by every refresh after it.
PARQUET_OPTIONS = {"compression": "zstd"}
#: Bytes that a task of a publishing job reads: it may have to sort them, and a row
#: takes about 20 times its compressed Parquet bytes in memory.
SCAN_BYTES = 32 << 20
_SCAN_CONF = "spark.sql.files.maxPartitionBytes"
_scans_lock, _scans_open = threading.Lock(), {}


@contextmanager
def small_scans(spark: SparkSession):
    """Scans of at most ``SCAN_BYTES`` a task while it lasts (jobs may overlap; the last one puts the session's value back)."""
    key = spark._jsparkSession.hashCode()
    with _scans_lock:
        n, before = _scans_open.get(key, (0, None))
        if n == 0:
            before = spark.conf.get(_SCAN_CONF)
            given = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
            spark.conf.set(_SCAN_CONF, str(min(SCAN_BYTES, given)))
        _scans_open[key] = (n + 1, before)
    try:
        yield
    finally:
        with _scans_lock:
            n, before = _scans_open.pop(key)
            if n > 1:
                _scans_open[key] = (n - 1, before)
            else:
                spark.conf.set(_SCAN_CONF, before)


def _describe(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"]}


def table_location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    return _describe(spark, table).get("Location")


def table_bucket_spec(spark: SparkSession, table: str) -> BucketSpec | None:
    if not spark.catalog.tableExists(table):
        return None
    d = _describe(spark, table)
    if "Num Buckets" not in d:
        return None

    def cols(text: str | None) -> tuple[str, ...]:
        return tuple(re.findall(r"`([^`]*)`", text or ""))

    return BucketSpec(int(d["Num Buckets"]), cols(d.get("Bucket Columns")), cols(d.get("Sort Columns")))


DEFAULT_BUCKET_BYTES = 1 << 30  # about 1 GiB of Parquet per bucket file
#: For tables that are refreshed: one task de-duplicates and sorts a bucket, whose rows
#: take about 40 times their Parquet bytes in memory.
REFRESH_BUCKET_BYTES = 16 << 20


def default_num_buckets(spark: SparkSession, source_bytes: int | None = None, bucket_bytes: int = DEFAULT_BUCKET_BYTES) -> int:
    """Bucket count for a new table: about ``bucket_bytes`` per bucket, never
    fewer than the cluster's default parallelism (every core gets a bucket),
    never more than Spark's own limit (buckets grow beyond it instead).
    The count is fixed for the table's lifetime (changing it means a full
    rewrite), so it is sized from the data, not from session settings."""
    floor = max(1, spark.sparkContext.defaultParallelism)
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return min(most, max(floor, -(-(source_bytes or 0) // bucket_bytes)))


def stored_bytes(spark: SparkSession, source: str) -> int | None:
    """Bytes on storage of a catalog table or a path (a metadata call)."""
    is_path = "/" in source
    loc = source if is_path else table_location(spark, source)
    if not loc:
        return None
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(loc)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(path).getLength()) if fs.exists(path) else None


def _version_id() -> str:
    """Names of versions sort by their time: seconds, then microseconds (five digits) and a random part."""
    now = time.time_ns() // 1000
    return time.strftime("v%Y%m%d%H%M%S", time.localtime(now // 1_000_000)) + f"_{now % 1_000_000:05x}{uuid.uuid4().hex[:3]}"


def _staging_name(table: str) -> str:
    db, _, name = table.rpartition(".")
    staged = f"{name}__staged_{uuid.uuid4().hex[:8]}"
    return f"{db}.{staged}" if db else staged


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _cols(cols: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in cols)


def bucket_ready(df: DataFrame, spec: BucketSpec) -> DataFrame:
    """Hash-partition ``df`` like the buckets (partition id = bucket id), so a
    task writes one file per bucket instead of one per bucket per task.

    A rebalance, not a plain repartition: AQE splits a skewed partition (say,
    a group of exact copies holding a third of the rows) over several tasks,
    each writing its own file of that bucket, and coalesces small ones.
    """
    return df.hint("rebalance", spec.num_buckets, *spec.columns)


# A bucket with this many times the median bucket's rows (and at least this
# many rows) makes a bucketed scan a straggler: one task would read all of it.
SKEW_FACTOR = 4.0
SKEW_MIN_ROWS = 10_000_000


BUCKET_MAX_PROPERTY = "slicerefresh.bucket_rows_max"
BUCKET_MEDIAN_PROPERTY = "slicerefresh.bucket_rows_median"


def _bucket_counts(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(total, largest, median) rows per bucket of the files under ``path``.

    Rows, not bytes: a group of exact copies compresses to almost nothing but
    still costs its scan task every row.  One distributed job that reads no
    column data (row counts come from the Parquet footers); only three
    numbers reach the driver.
    """
    # Rows are counted per file first: the pattern runs once per file, not once per row.
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n"))
    per_bucket = per_file.groupBy(F.regexp_extract("f", r"_(\d{5,})(?:\.c\d+)?\.[^/]*$", 1).alias("b")).agg(F.sum("n").alias("n"))
    row = per_bucket.agg(F.sum("n").alias("n"), F.max("n").alias("mx"), F.percentile_approx("n", 0.5).alias("med")).first()
    return int(row["n"] or 0), int(row["mx"] or 0), int(row["med"] or 0)


def bucket_row_stats(spark: SparkSession, table: str) -> tuple[int, int]:
    """(largest, median) rows per bucket: from the table properties recorded
    when this library published the version, else counted from footers."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(table)}").collect()}
    if BUCKET_MAX_PROPERTY in props and BUCKET_MEDIAN_PROPERTY in props:
        return int(props[BUCKET_MAX_PROPERTY]), int(props[BUCKET_MEDIAN_PROPERTY])
    _, largest, median = _bucket_counts(spark, table_location(spark, table))
    return largest, median


def buckets_skewed(spark: SparkSession, table: str) -> bool:
    largest, median = bucket_row_stats(spark, table)
    return largest >= SKEW_MIN_ROWS and largest > SKEW_FACTOR * max(median, 1)


_HERE = object()


def stage_table(df: DataFrame, table: str, root: str, bucket_spec: BucketSpec | None = None, base=_HERE) -> Staged:
    """Write ``df`` as a new version folder under ``root`` (one Spark job).

    ``base`` is the table's location that ``df`` was made from (default: the
    present one); the switch refuses a table that has moved from there.
    """
    base = table_location(df.sparkSession, table) if base is _HERE else base
    path = f"{root.rstrip('/')}/{_version_id()}"
    staging_name = _staging_name(table)
    writer = df.write.mode("errorifexists").format("parquet").options(**PARQUET_OPTIONS).option("path", path)
    if bucket_spec is not None:
        writer = writer.bucketBy(bucket_spec.num_buckets, *bucket_spec.columns).sortBy(*bucket_spec.sort_columns)
    writer.saveAsTable(staging_name)
    return Staged(table, path, staging_name, bucket_spec, base=base)


def verify(spark: SparkSession, staged: Staged, expected_rows: int | None = None) -> Staged:
    """Count the rows of the written files (Parquet footers only) and compare.

    For a bucketed version the count is taken per bucket, in the same job, so
    the bucket statistics the next refresh needs come for free.
    """
    if staged.bucket_spec is not None:
        staged.rows, largest, median = _bucket_counts(spark, staged.path)
        staged.bucket_rows = (largest, median)
    else:
        staged.rows = spark.read.parquet(staged.path).count()
    if expected_rows is not None and staged.rows != expected_rows:
        raise PublishError(f"{staged.table}: {staged.rows} rows written, {expected_rows} expected")
    staged.verified = True
    return staged


def accept(staged: Staged, held: WrittenCounts) -> Staged:
    """Mark a version verified whose files were already counted and checked."""
    staged.rows, staged.verified = held.rows, True
    if staged.bucket_spec is not None:
        staged.bucket_rows = held.bucket_rows
    return staged


def evolve_table(spark: SparkSession, table: str, new: StructType) -> list[str]:
    """Add the columns of ``new`` that ``table`` lacks (nullable, at the end of
    the table's columns); any other difference is refused.  Returns their names."""
    old = {f.name: f.dataType for f in spark.table(table).schema.fields}
    gone = [c for c in old if c not in new.names]
    changed = [f.name for f in new.fields if f.name in old and old[f.name] != f.dataType]
    if gone or changed:
        raise PublishError(f"{table}: the new version lacks columns {gone} or has other types for {changed}")
    added = [f for f in new.fields if f.name not in old]
    if added:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {_quote(table)} ADD COLUMNS ({ddl})")
    return [f.name for f in added]


def switch(spark: SparkSession, staged: Staged) -> str | None:
    """Point ``staged.table`` at the staged version; returns the previous location.

    Refused if the table has moved since the version was staged: its rows
    would undo what another job has published.  Columns that the new version
    adds are added to the table first.
    """
    if not staged.verified:
        raise PublishError(f"{staged.table}: refusing to switch to an unverified version")
    previous = table_location(spark, staged.table)
    if previous != staged.base:
        raise PublishError(f"{staged.table}: staged from {staged.base}, now at {previous}; stage it again")
    if previous is None:
        schema = spark.table(staged.staging_name).schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        clause = ""
        spec = staged.bucket_spec
        if spec is not None:
            clause = (
                f" CLUSTERED BY ({_cols(spec.columns)}) SORTED BY ({_cols(spec.sort_columns)})"
                f" INTO {spec.num_buckets} BUCKETS"
            )
        spark.sql(f"CREATE TABLE {_quote(staged.table)} ({ddl}) USING parquet{clause} LOCATION '{staged.path}'")
    else:
        current_spec = table_bucket_spec(spark, staged.table)
        if current_spec != staged.bucket_spec:
            raise PublishError(f"{staged.table}: bucket spec {current_spec} differs from the staged {staged.bucket_spec}")
        evolve_table(spark, staged.table, spark.table(staged.staging_name).schema)
        spark.sql(f"ALTER TABLE {_quote(staged.table)} SET LOCATION '{staged.path}'")
        spark.sql(f"REFRESH TABLE {_quote(staged.table)}")
    if staged.bucket_rows is not None:
        largest, median = staged.bucket_rows
        if previous is not None:
            props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(staged.table)}").collect()}
            staged.previous_properties = {k: props[k] for k in (BUCKET_MAX_PROPERTY, BUCKET_MEDIAN_PROPERTY) if k in props}
        spark.sql(
            f"ALTER TABLE {_quote(staged.table)} SET TBLPROPERTIES"
            f" ('{BUCKET_MAX_PROPERTY}' = '{largest}', '{BUCKET_MEDIAN_PROPERTY}' = '{median}')"
        )
    spark.sql(f"DROP TABLE IF EXISTS {_quote(staged.staging_name)}")  # external: files stay
    return previous


def discard(spark: SparkSession, staged: Staged) -> None:
    """Forget a staged version that will not be published (its folder stays)."""
    spark.sql(f"DROP TABLE IF EXISTS {_quote(staged.staging_name)}")


_VERSION_NAME = re.compile(r"^v\d{14}_[0-9a-f]{8}$")


def live_versions(spark: SparkSession, table: str) -> set[str]:
    """Names of the version folders that hold rows of ``table``: that of the
    table's location, and of every partition's files (one job that tells files
    apart first; a refreshed table has partitions in several versions)."""
    from slicerefresh.plans.generations import file_folders, physical

    name = physical(spark, table)
    version = re.compile(r"/(v\d{14}_[0-9a-f]{8})(?:/|$)")
    held = {m.group(1) for d in file_folders(spark.table(name)) if (m := version.search(d))}
    return held | {table_location(spark, name).rstrip("/").rsplit("/", 1)[-1]}


def prune_versions(spark: SparkSession, table: str, root: str, keep: int = 2) -> list[str]:
    """Delete old version folders of ``table`` under ``root``.

    Only folders named like a version (``v<timestamp>_<id>``) are considered.
    Always kept: every folder that holds rows of the table, folders newer than
    the newest of these (a running job may have staged them), and the ``keep``
    newest others (the backups a restore can go back to).  Returns the deleted
    paths.
    """
    if not spark.catalog.tableExists(table):
        raise PublishError(f"{table} is not published; refusing to prune {root}")
    live = live_versions(spark, table)
    if not all(_VERSION_NAME.match(v) for v in live):
        raise PublishError(f"{table}: its version folders are unknown ({sorted(live)}); refusing to prune {root}")
    jvm = spark.sparkContext._jvm
    root_path = jvm.org.apache.hadoop.fs.Path(root)
    fs = root_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted(
        (st.getPath() for st in fs.listStatus(root_path) if st.isDirectory() and _VERSION_NAME.match(st.getPath().getName())),
        key=lambda p: p.getName(),
    )
    older = [p for p in versions if p.getName() not in live and p.getName() < max(live)]
    doomed = older[: max(0, len(older) - keep)]
    for p in doomed:
        fs.delete(p, True)
    return [p.toString() for p in doomed]


def restore(spark: SparkSession, table: str, location: str | None, properties: dict[str, str] | None = None) -> None:
    """Undo a switch: point ``table`` back at ``location`` (or unregister it),
    with the bucket statistics it had."""
    if location is None:
        spark.sql(f"DROP TABLE IF EXISTS {_quote(table)}")  # external: files stay
        return
    spark.sql(f"ALTER TABLE {_quote(table)} SET LOCATION '{location}'")
    stats = (BUCKET_MAX_PROPERTY, BUCKET_MEDIAN_PROPERTY)
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {_quote(table)} SET TBLPROPERTIES ({pairs})")
    missing = [k for k in stats if not properties or k not in properties]
    if missing:
        spark.sql(f"ALTER TABLE {_quote(table)} UNSET TBLPROPERTIES IF EXISTS ({', '.join(repr(k) for k in missing)})")
    spark.sql(f"REFRESH TABLE {_quote(table)}")


def switch_all(spark: SparkSession, staged: Sequence[Staged]) -> list[str | None]:
    """Switch several tables; on any failure the already switched ones are restored."""
    done: list[tuple[Staged, str | None]] = []
    try:
        for s in staged:
            done.append((s, switch(spark, s)))
    except Exception:
        for s, prev in reversed(done):
            restore(spark, s.table, prev, s.previous_properties)
        raise
    return [prev for _, prev in done]


def publish_table(
    df: DataFrame,
    table: str,
    root: str,
    bucket_spec: BucketSpec | None = None,
    expected_rows: int | None = None,
) -> Staged:
    """Stage, verify and switch one table."""
    spark = df.sparkSession
    staged = verify(spark, stage_table(df, table, root, bucket_spec), expected_rows)
    switch(spark, staged)
    return staged


def layout_write(df: DataFrame, layout: Layout, path: str, mode: str = "errorifexists", num_partitions: int | None = None) -> None:
    """Plain Parquet files in a layout's key order, without a catalog.

    Range partitioning on the full key (sampled bounds) gives every file a
    narrow key range and splits a hot partition key over many files; the sort
    inside each file narrows row-group ranges further.  Without a fixed
    partition count AQE sizes the output partitions.
    """
    key = list(layout.key)
    out = df.repartitionByRange(num_partitions, *key) if num_partitions else df.repartitionByRange(*key)
    out.sortWithinPartitions(*key).write.mode(mode).parquet(path)


def layout_report(files: DataFrame, layout: Layout) -> DataFrame:
    """How far the files of ``files`` (read from Parquet) are in a layout's order.

    One row: ``n_rows``; ``n_descents``, rows that come after a greater key in
    their file; ``n_overlaps``, files whose least key is below the greatest key
    of the files before (in order of their least keys).  Both are 0 for files
    that ``layout_write`` made.  The rows' places come from the files themselves
    (``_metadata.row_index``); a task holds one file's keys, the last step one
    row per file.
    """
    key = F.struct(*layout.key)
    rows = files.select(key.alias("k"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    before = F.lag("k").over(Window.partitionBy("f").orderBy("i"))
    per_file = rows.withColumn("before", before).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("least"), F.max("k").alias("most"), F.count_if(F.col("k") < F.col("before")).alias("descents")
    )
    ahead = F.max("most").over(Window.orderBy("least", "most").rowsBetween(Window.unboundedPreceding, -1))
    return per_file.withColumn("ahead", ahead).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum("descents"), F.lit(0)).cast("long").alias("n_descents"),
        F.count_if(F.col("least") < F.col("ahead")).alias("n_overlaps"),
    )
