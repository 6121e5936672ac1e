"""The publishing jobs: replace a slice in each of the four tables, publish, advance status.

Per table the work is

1. one count of the inputs (key and cleaning columns only), which also decides
   the conditional dedupe,
2. the staged write,
3. one count of the written files, rows inside and outside the slice apart,
   which must agree with the first,
4. optionally the delimited snapshot, written from the staged version, and the
   backup of the rows as they were.

All tables are staged and verified before any is switched, and a failure
while switching restores the tables already switched.  The status table is
staged before, switched and restored with them.  Inputs are never overwritten:
every version goes to a new folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from slicerefresh.operators.audit import AuditCounts, WrittenMismatch, audit_frame, check_written, input_counts, written_counts
from slicerefresh.operators.clean import DIRTY_CHAR, DIRTY_COLUMN, control_char_filter
from slicerefresh.operators.keys import key_collapse
from slicerefresh.operators.replace import distinct_parts, distinct_rows, has_large_group, should_dedupe, slice_select
from slicerefresh.operators.scope import ResolvedScope, Scope
from slicerefresh.operators.status import practice_filter, practice_high_water, refresh_status
from slicerefresh.plans.incremental import (
    NotIncremental,
    PartitionSwitch,
    StagedPartitions,
    flip_partitions,
    partition_columns,
    prepare_partitions,
    stage_incremental,
    stage_new,
    undo_partitions,
)
from slicerefresh.plans.generations import physical
from slicerefresh.plans.publish import (
    REFRESH_BUCKET_BYTES,
    BucketSpec,
    PublishError,
    Staged,
    _describe,
    accept,
    bucket_ready,
    buckets_skewed,
    default_num_buckets,
    discard,
    restore,
    small_scans,
    stage_table,
    stored_bytes,
    switch,
    table_bucket_spec,
    table_location,
    verify,
)
from slicerefresh.schema import CANONICAL_SCHEMA, TABLE_ORDER, conform, layout
from slicerefresh.sources.delimited import REJECTS, read_delimited, read_manifest, replace_parts, write_delimited, write_parts
from slicerefresh.sources.tables import read_table

Source = str | DataFrame


@dataclass(frozen=True)
class SnapshotFormat:
    """How a delimited snapshot is laid out: header or not, 26 or 27 columns.

    The same definition is used to write and to read a snapshot.
    """

    header: bool = False
    evolved: bool = False
    # "lossless" (this library's codec) or "legacy" (the original job's files).
    codec: str = "lossless"
    # Divided like the partitioned table it is taken from, so that the next
    # export of the same folder replaces only what the refresh touched.
    partitioned: bool = False

    def columns(self, table: str) -> list[str]:
        return layout(table).columns(self.evolved)

    def schema(self, table: str):
        return layout(table).schema(self.evolved)


#: Folders of the original job: no header, 26 columns, its own codec.
ORIGINAL_FORMAT = SnapshotFormat(header=False, evolved=False, codec="legacy")
#: The same shape without the original codec's losses.
PLAIN_FORMAT = SnapshotFormat(header=False, evolved=False)
BACKUP_FORMAT = SnapshotFormat(header=True, evolved=True)


@dataclass
class TableRun:
    table: str
    target: str
    audit: AuditCounts
    staged: Staged
    dedupe: bool
    snapshot_path: str | None = None
    previous_location: str | None = None


@dataclass
class SyncReport:
    runs: list[TableRun] = field(default_factory=list)
    status: Staged | None = None

    def audit(self, spark: SparkSession) -> DataFrame:
        return audit_frame(spark, [(r.table, r.audit) for r in self.runs])


@dataclass
class Replacement:
    """A lazy replacement: the rows that stay, the rows that come, and both."""

    kept: DataFrame
    added: DataFrame
    deduped: bool

    @property
    def result(self) -> DataFrame:
        return self.kept.unionByName(self.added)


def write_snapshot(rows: DataFrame, path: str, table: str, fmt: SnapshotFormat, n_rows: int | None = None, spec: BucketSpec | None = None) -> None:
    """A table's delimited snapshot, in its layout's column order.

    ``spec`` says that ``rows`` are read from the files of a table bucketed so: each
    file of the snapshot then holds rows of few buckets, which its manifest notes.
    """
    buckets = {"buckets": [spec.num_buckets, *spec.columns]} if spec is not None else {}
    write_delimited(rows, path, header=fmt.header, columns=fmt.columns(table), codec=fmt.codec, rows=n_rows, **buckets)


def snapshot_spec(spark: SparkSession, path: str, table: str) -> BucketSpec | None:
    """The buckets that the files of a snapshot hold few of each; null if they are of no bucketed table."""
    noted = (read_manifest(spark, path) or {}).get("buckets")
    return BucketSpec.for_layout(layout(table), noted[0], noted[1:]) if noted else None


def export_partitions(spark: SparkSession, staged: StagedPartitions, path: str, table: str, fmt: SnapshotFormat) -> bool:
    """A partitioned table's snapshot, as it will be after the switch; true if only touched partitions were written.

    The manifest names the version that the folder holds.  If it is the one that
    the refresh was made from, only the partitions that the refresh rewrote are
    exported; else (another format, a switch that failed after its export, a new
    folder) all are.
    """
    part = F.col(staged.col)
    stored = read_manifest(spark, path)
    same = stored is not None and stored.get("version") is not None and stored["version"] == staged.base
    if same and (stored["header"], stored["codec"], stored["columns"]) == (fmt.header, fmt.codec, fmt.columns(table)):
        rows = stored["rows"] - staged.audit.prod_full + staged.audit.after_add
        gone = [v for v in staged.touched if v not in staged.written]
        replace_parts(staged.new_rows(spark), path, part, gone, spark, rows=rows, version=staged.path)
        return True
    whole = staged.whole(spark)
    write_parts(whole, path, part, header=fmt.header, columns=fmt.columns(table), codec=fmt.codec, rows=whole.count(), version=staged.path)
    return False


def write_backup(rows: DataFrame, path: str, table: str, spec: BucketSpec | None = None) -> None:
    """The rows as they were before a refresh: a snapshot that the snapshot job can start from."""
    whole = conform(rows)
    write_snapshot(whole, path, table, BACKUP_FORMAT, whole.count(), spec)  # counted from Parquet footers, for a table


def replacement_plan(
    current: DataFrame,
    staging: DataFrame,
    scope: ResolvedScope,
    *,
    dedupe: str = "reference",
    clean_column: str | None = DIRTY_COLUMN,
    clean_char: str = DIRTY_CHAR,
    bucket_spec: BucketSpec | None = None,
    current_bucketed: bool = False,
    current_placed: bool = False,
    schema=CANONICAL_SCHEMA,
    collapse_keys: Sequence[str] | None = None,
    removed: int | None = None,
) -> Replacement:
    """The lazy result of replacing the slice.

    ``removed`` (the number of current rows in the slice) decides the dedupe of
    ``dedupe="reference"``; without it an existence probe does, which stops at
    the first match and, for literal scopes, prunes row groups by the
    pushed-down ``IN`` filter.  ``current_placed``: each file of ``current`` holds
    rows of few of the buckets, so that rows that stay need no shuffle.
    """
    cur, stg = conform(current, schema), conform(staging, schema)
    if clean_column:
        cur = control_char_filter(cur, clean_column, clean_char)
        stg = control_char_filter(stg, clean_column, clean_char)
    deduped = should_dedupe(dedupe, removed, cur, scope)
    kept, added = scope.exclude(cur), slice_select(stg, scope)
    placed = current_placed and bucket_spec is not None and scope.stays_put
    bucketed = current_bucketed or placed
    if collapse_keys:
        bucketed = current_bucketed
        # Store semantics: one row per key (it subsumes the dedupe).  Kept and
        # added rows never share a key (both slice keys are in every key), so
        # each side collapses on its own; on a table bucketed by the key the
        # kept side needs no shuffle.
        kept, added = key_collapse(kept, collapse_keys), key_collapse(added, collapse_keys)
    elif deduped:
        # Copies have one key, so they lie in one bucket of a bucketed table and
        # meet in the shuffle that makes buckets; a large group of them is reduced
        # before it.
        if placed and not current_bucketed:
            kept, some = distinct_parts(kept)
            if some is not None:
                some = bucket_ready(some, bucket_spec)
                kept = some if kept is None else kept.unionByName(some)
        elif bucket_spec is None or not current_bucketed and has_large_group(kept, bucket_spec.columns):
            kept = distinct_rows(kept)
        elif current_bucketed:
            kept = kept.distinct()
        else:
            kept, bucketed = kept.repartition(bucket_spec.num_buckets, *bucket_spec.columns).distinct(), True
    if bucket_spec is not None:
        # The kept rows of a table bucketed the same way are already in bucket
        # order; only the (small) staged slice is shuffled into buckets.
        if not bucketed:
            kept = bucket_ready(kept, bucket_spec)
        added = bucket_ready(added, bucket_spec)
    return Replacement(kept, added, deduped)


def pinned(spark: SparkSession, source: Source) -> Source:
    """A catalog table as it is now, however often it is read and whatever is published to it meanwhile.

    Versions are folders that nobody changes, so a table's present location (or
    its present generation) is a version.  Other sources stay as they are; if
    they change during a refresh, its counts do not agree and it is refused.
    """
    if isinstance(source, DataFrame) or "/" in source or ":" in source:
        return source
    name = physical(spark, source)
    if name != source:
        return spark.table(name)
    found = _describe(spark, source)
    if found.get("Provider", "").lower() != "parquet" or "Location" not in found or partition_columns(spark, source):
        return source
    return spark.read.schema(spark.table(source).schema).parquet(found["Location"])


def resolve_scope(
    spark: SparkSession,
    scope: Scope | ResolvedScope,
    staging_for: Callable[[str], Source],
    *,
    practice_table: str = "summary_details_by_practice",
    measure_table: str = "summary_details_by_measure",
    **kwargs,
) -> ResolvedScope:
    """Resolve once for all tables: practices from the by-practice staging,
    measures from the by-measure staging, both before cleaning."""
    if isinstance(scope, ResolvedScope):
        return scope
    # Only a key that stands for everything in staging needs its staging table.
    tables = dict(zip(scope.values, (practice_table, measure_table), strict=True))
    named = {k: staging_for(tables[k]) for k, values in scope.values.items() if values is None}
    sources = {k: read_table(spark, src, [k]) for k, src in named.items()}
    first = next(iter(named.values()), None)
    if len(named) > 1 and all(src is first or (isinstance(src, str) and src == first) for src in named.values()):
        sources = dict.fromkeys(named, read_table(spark, first, list(named)))  # one table, one scan
    return scope.resolve(sources, **kwargs)


def stage_sync(
    spark: SparkSession,
    table: str,
    *,
    current: Source,
    staging: Source,
    scope: ResolvedScope,
    target: str,
    root: str,
    dedupe: str = "reference",
    num_buckets: int | None = None,
    snapshot_path: str | None = None,
    snapshot_format: SnapshotFormat = SnapshotFormat(header=True, evolved=True),
    backup_path: str | None = None,
    collapse_keys: bool = False,
    current_bytes: int | None = None,
    current_spec: BucketSpec | None = None,
    slices: int | None = None,
    bucket_columns: Sequence[str] | None = None,
    like: TableRun | None = None,
) -> TableRun:
    """Stage and verify the new version of one table (not yet switched).

    ``collapse_keys`` applies the keyed store's semantics: one row per
    primary key of the layout (latest ``updated_dt``, then a total order).

    A partitioned target is refreshed incrementally, in place: only the
    partitions that hold rows of the slice are rewritten.  ``slices`` makes a
    new target such a table, partitioned by the slice's hash.

    ``current_spec`` tells of a snapshot how its files hold the buckets of the
    table it was taken from.  ``like`` is the run of a new table by the same
    refresh of the same rows (``siblings``): its staged rows, bucketed by
    ``bucket_columns`` or sliced as these will be, are sorted anew where they lie.
    """
    lay = layout(table)
    if spark.catalog.tableExists(target) and partition_columns(spark, target):
        if collapse_keys:
            raise NotIncremental(f"{target} is partitioned; collapse_keys needs the full refresh of a bucketed table")
        return _stage_partitioned(
            spark, table, current=current, staging=staging, scope=scope, target=target, root=root, dedupe=dedupe,
            snapshot_path=snapshot_path, snapshot_format=snapshot_format, backup_path=backup_path,
        )
    if slices and not spark.catalog.tableExists(target):
        if collapse_keys:
            raise NotIncremental("collapse_keys needs the full refresh of a bucketed table")
        cur = read_table(spark, current)
        if backup_path:
            write_backup(cur, backup_path, table)
        staged = stage_new(spark, target, current=cur, staging=read_table(spark, staging), scope=scope, root=root, layout=lay, slices=slices, dedupe=dedupe, like=like.staged if like else None)
        run = TableRun(table, target, staged.audit, staged, dedupe=staged.deduped)
        if snapshot_path:
            _export(spark, staged, snapshot_path, table, snapshot_format)
            run.snapshot_path = snapshot_path
        return run
    base = table_location(spark, target)  # before anything is read from it
    existing = table_bucket_spec(spark, target)
    if existing is None and spark.catalog.tableExists(target):
        raise PublishError(
            f"{target} exists but is neither bucketed nor partitioned; publish it with publish_table(bucket_spec=...)"
            " or publish_partitioned first"
        )
    source_spec = table_bucket_spec(spark, current) if isinstance(current, str) else current_spec
    if existing:
        n = existing.num_buckets
    elif num_buckets:
        n = num_buckets
    elif source_spec is not None and source_spec.columns == tuple(bucket_columns or lay.key):
        n = source_spec.num_buckets  # same buckets as the source: its kept rows need no shuffle
    else:
        n = default_num_buckets(spark, stored_bytes(spark, current) if isinstance(current, str) else current_bytes, REFRESH_BUCKET_BYTES)
    spec = BucketSpec.for_layout(lay, n, bucket_columns)
    if existing is not None:
        if not existing.fits(lay):
            raise ValueError(f"{target} is bucketed as {existing}, layout {table} needs {spec}")
        spec = existing
    cur_df = read_table(spark, current)
    current_placed = source_spec is not None and (source_spec.num_buckets, source_spec.columns) == (spec.num_buckets, spec.columns)
    current_bucketed = isinstance(current, str) and source_spec == spec
    if current_bucketed and buckets_skewed(spark, current):
        # One bucket (a group of copies of one key) would make its scan task a
        # straggler: read plain, splittable files instead; the dedupe then
        # aggregates map-side before its shuffle.
        cur_df = spark.read.parquet(table_location(spark, current))
        current_bucketed = current_placed = False
    if backup_path:
        write_backup(cur_df, backup_path, table, source_spec if isinstance(current, str) else None)
    stg_df = read_table(spark, staging)
    named = REJECTS if REJECTS in cur_df.columns else None
    counts = input_counts(control_char_filter(conform(cur_df, keep=[named] if named else [])), control_char_filter(conform(stg_df)), scope, named)
    if like is not None:
        result, deduped = spark.read.schema(CANONICAL_SCHEMA).parquet(like.staged.path), should_dedupe(dedupe, counts.to_remove)
    else:
        plan = replacement_plan(
            cur_df, stg_df, scope, dedupe=dedupe, bucket_spec=spec, current_bucketed=current_bucketed, current_placed=current_placed,
            collapse_keys=lay.key if collapse_keys else None, removed=counts.to_remove,
        )
        result, deduped = plan.result, plan.deduped
    staged = stage_table(result, target, root, spec, base)
    try:
        held = written_counts(spark.read.parquet(staged.path), scope)
        check_written(table, counts, held, exact=not deduped, collapsed=collapse_keys)
        if like is not None and held.kept != like.audit.after_removal:
            raise WrittenMismatch(f"{table}: {held.kept} kept rows written, {like.audit.after_removal} in the version it was made from")
        accept(staged, held)
        run = TableRun(table, target, counts, staged, dedupe=deduped)
        if snapshot_path:
            snap = spark.read.parquet(staged.path)
            write_snapshot(snap, snapshot_path, table, snapshot_format, counts.after_add, spec)
            run.snapshot_path = snapshot_path
    except Exception:
        discard(spark, staged)
        raise
    return run


def _stage_partitioned(spark, table, *, current, staging, scope, target, root, dedupe, snapshot_path, snapshot_format, backup_path) -> TableRun:
    if current != target:
        raise NotIncremental(f"{target} is partitioned: it is refreshed in place, so current must be {target!r}")
    lay = layout(table)
    if backup_path:
        write_backup(spark.table(target), backup_path, table)
    staged = stage_incremental(spark, target, staging=read_table(spark, staging), scope=scope, root=root, layout=lay, dedupe=dedupe)
    run = TableRun(table, target, staged.audit, staged, dedupe=staged.deduped)
    if snapshot_path:
        _export(spark, staged, snapshot_path, table, snapshot_format)
        run.snapshot_path = snapshot_path
    return run


def _export(spark: SparkSession, staged: StagedPartitions, path: str, table: str, fmt: SnapshotFormat) -> None:
    if fmt.partitioned:
        export_partitions(spark, staged, path, table, fmt)
    else:
        whole = staged.result(spark)
        write_snapshot(whole, path, table, fmt, whole.count())


def _switch_runs(spark: SparkSession, runs: list[TableRun], status: Staged | None = None) -> None:
    """Switch every staged table, and the status table last; on any failure the
    switches already made are undone.

    Partitioned versions are made ready in the catalog before the first switch,
    so that the switches themselves are a catalog statement or two each.
    """
    ready: dict[int, PartitionSwitch] = {}
    done: list[tuple[str, object]] = []
    try:
        for k, r in enumerate(runs):
            if isinstance(r.staged, StagedPartitions):
                ready[k] = prepare_partitions(spark, r.staged)
        for k, r in enumerate(runs):
            if k in ready:
                flip_partitions(spark, ready[k])
                continue
            r.previous_location = table_location(spark, r.staged.table)
            done.append((r.previous_location, r.staged))  # restored even if its own switch fails halfway
            switch(spark, r.staged)
        if status is not None:
            done.append((table_location(spark, status.table), status))
            switch(spark, status)
    except Exception:
        for sw in ready.values():
            undo_partitions(spark, sw)
        for previous, staged in reversed(done):
            restore(spark, staged.table, previous, staged.previous_properties)
        for r in runs:
            _discard(spark, r.staged)
        if status is not None:
            discard(spark, status)
        raise


@dataclass(frozen=True)
class StatusTarget:
    """The status table to advance after the by-practice table is published."""

    table: str
    root: str
    refreshed_at: Column | None = None


def stage_status(spark: SparkSession, run: TableRun, scope: ResolvedScope, status: StatusTarget, key: str = "practice_id") -> Staged:
    """High-water per practice of the scope, over all measures of the staged
    version, written into a new version of the status table (not yet switched)."""
    if isinstance(run.staged, StagedPartitions):
        # Partitions by practice: the rewritten ones are exactly the practices in scope, all measures.
        new = run.staged.new_rows(spark) if run.staged.col == key else None
        result = (new if new is not None else run.staged.result(spark)).select(key, "visit_dt")
    else:
        result = spark.read.parquet(run.staged.path).select(key, "visit_dt")
    hw = practice_high_water(practice_filter(result, scope, key), key=key)
    base = table_location(spark, status.table)
    before = spark.table(status.table)
    updated = refresh_status(before, hw, status.refreshed_at, key=key)
    return verify(spark, stage_table(updated, status.table, status.root, base=base), expected_rows=before.count())


def sync_all(
    spark: SparkSession,
    *,
    scope: Scope | ResolvedScope,
    current_for: Callable[[str], Source],
    staging_for: Callable[[str], Source],
    target_for: Callable[[str], str],
    root_for: Callable[[str], str],
    tables: tuple[str, ...] = TABLE_ORDER,
    dedupe: str = "reference",
    num_buckets: int | None = None,
    snapshot_for: Callable[[str], str] | None = None,
    snapshot_format: SnapshotFormat = SnapshotFormat(header=True, evolved=True),
    backup_for: Callable[[str], str] | None = None,
    status: StatusTarget | None = None,
    scope_options: Mapping | None = None,
    parallel_tables: int = 4,
    collapse_keys: bool = False,
    bytes_for: Callable[[str], int | None] | None = None,
    spec_for: Callable[[str], BucketSpec | None] | None = None,
    slices: int | None = None,
) -> SyncReport:
    """Stage all tables and the status, then switch all of them together.

    The tables are independent until the switch, so up to ``parallel_tables``
    of them are staged at once: their jobs share the cluster instead of
    waiting for each other's tails.  New tables that start from the same rows
    (``siblings``) hold the same result: the first one's staged rows are what the
    others sort anew, so that these rows are shuffled once.
    """
    versions: dict = {}

    def staged_rows(table: str) -> Source:
        source = staging_for(table)
        key = source if isinstance(source, str) else id(source)
        if key not in versions:
            versions[key] = pinned(spark, source)
        return versions[key]

    resolved = resolve_scope(spark, scope, staged_rows, **(scope_options or {}))
    pins = {t: staged_rows(t) for t in tables}

    sources = {t: current_for(t) for t in tables}
    first = {} if collapse_keys else siblings(spark, tables, sources, pins, target_for)
    shared = {s for t, s in first.items() if t != s}  # tables that others are made from
    common = {s: [c for c in layout(s).key if all(c in layout(t).key for t in tables if first[t] == s)] for s in shared}

    def stage(table: str, like: TableRun | None = None) -> TableRun:
        return stage_sync(
            spark,
            table,
            current=sources[table],
            staging=pins[table],
            scope=resolved,
            target=target_for(table),
            root=root_for(table),
            dedupe=dedupe,
            num_buckets=num_buckets,
            snapshot_path=snapshot_for(table) if snapshot_for else None,
            snapshot_format=snapshot_format,
            backup_path=backup_for(table) if backup_for else None,
            collapse_keys=collapse_keys,
            current_bytes=bytes_for(table) if bytes_for else None,
            current_spec=spec_for(table) if spec_for else None,
            slices=slices,
            bucket_columns=common.get(first.get(table)),
            like=like,
        )

    report = SyncReport()
    with small_scans(spark):
        report.runs = _stage_all(spark, stage, tables, parallel_tables, first)
    by_practice = [r for r in report.runs if r.table == "summary_details_by_practice"]
    if status is not None and by_practice:
        try:
            report.status = stage_status(spark, by_practice[0], resolved, status)
        except Exception:
            for r in report.runs:
                _discard(spark, r.staged)
            raise
    _switch_runs(spark, report.runs, report.status)
    return report


def _discard(spark: SparkSession, staged) -> None:
    """Forget a staged version (partition-level stages have no catalog entry)."""
    if isinstance(staged, Staged):
        discard(spark, staged)


def siblings(spark: SparkSession, tables: Sequence[str], currents: Mapping[str, Source], stagings: Mapping[str, Source], target_for: Callable[[str], str]) -> dict[str, str]:
    """Of every new table the first one that starts from the same current and staging rows (maybe itself).

    Sources are the same if they are one frame or one name.
    """
    heads: dict = {}
    out = {}
    for t in tables:
        if spark.catalog.tableExists(target_for(t)):
            continue
        key = tuple(s if isinstance(s, str) else id(s) for s in (currents[t], stagings[t]))
        out[t] = heads.setdefault(key, t)
    return out


def _stage_all(spark: SparkSession, stage: Callable[..., TableRun], tables: tuple[str, ...], parallel: int, first: Mapping[str, str]) -> list[TableRun]:
    """Stage every table, those made from another one's staged rows behind it; if
    any fails, nothing is switched and the staged catalog entries are dropped
    (their folders stay, unpublished)."""
    runs: dict[str, TableRun] = {}
    failed: list[BaseException] = []
    heads = [t for t in tables if first.get(t, t) == t]
    for group in (heads, [t for t in tables if t not in heads]):
        if failed or not group:
            continue
        with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(group)))) as pool:
            futures = {}
            for t in group:
                like = () if t in heads else (runs[first[t]],)
                futures[t] = pool.submit(inheritable_thread_target(spark)(stage), t, *like)
                if parallel <= 1 and futures[t].exception() is not None:
                    break
            wait(futures.values())
        failed = [f.exception() for f in futures.values() if f.exception() is not None]
        runs |= {t: f.result() for t, f in futures.items() if f.exception() is None}
    if failed:
        for r in runs.values():
            _discard(spark, r.staged)
        raise failed[0]
    return [runs[t] for t in tables]


def sync_table(
    spark: SparkSession,
    table: str,
    *,
    current: Source,
    staging: Source,
    scope: Scope | ResolvedScope,
    target: str,
    root: str,
    status: StatusTarget | None = None,
    **kwargs,
) -> SyncReport:
    """The production job for one table: current table (often the target
    itself) + staging table -> new version of the target."""
    return sync_all(
        spark,
        scope=scope,
        current_for=lambda _t: current,
        staging_for=lambda _t: staging,
        target_for=lambda _t: target,
        root_for=lambda _t: root,
        tables=(table,),
        status=status,
        **kwargs,
    )


def read_snapshot(spark: SparkSession, path: str, table: str, fmt: SnapshotFormat | None = None, rejects: bool = False) -> DataFrame:
    """A table's delimited snapshot, typed, in canonical order; with ``rejects`` the
    names of each row's columns whose value does not parse come along.

    The format is the one in the folder's manifest; ``fmt`` is for folders
    without one, and is refused if it is given and contradicts what is stored.
    A folder without a manifest is not read unless its format is given.
    """
    stored = read_manifest(spark, path)
    if stored is not None:
        known = [SnapshotFormat(stored["header"], evolved, stored["codec"], "version" in stored) for evolved in (False, True)]
        known = [f for f in known if f.columns(table) == stored["columns"]]
        if not known or (fmt is not None and fmt != known[0]):
            raise PublishError(f"{path} was written as {stored}, which is not {fmt or table}")
        fmt = known[0]
    if fmt is None:
        raise PublishError(f"{path} does not say how it was written; give its format (ORIGINAL_FORMAT for folders of the original job)")
    rows = read_delimited(spark, path, fmt.schema(table), header=fmt.header, codec=fmt.codec, rejects=rejects)
    return conform(rows, keep=[REJECTS] if rejects else [])


def restore_backup(spark: SparkSession, table: str, *, backup: str, target: str, root: str) -> Staged:
    """Put a backup's rows back in place, as they were: a new version of ``target``, verified by the manifest's row count."""
    spec = table_bucket_spec(spark, target)
    if spec is None:
        raise PublishError(f"{target} is not a bucketed table; restore it with sync_from_snapshot into a new one")
    stored = read_manifest(spark, backup) or {}
    rows = read_snapshot(spark, backup, table, None if stored else BACKUP_FORMAT)
    if stored.get("buckets") != [spec.num_buckets, *spec.columns]:  # else its files hold few buckets each already
        rows = bucket_ready(rows, spec)
    with small_scans(spark):
        staged = verify(spark, stage_table(rows, target, root, spec), stored.get("rows"))
    switch(spark, staged)
    return staged


def sync_from_snapshot(
    spark: SparkSession,
    *,
    scope: Scope | ResolvedScope,
    snapshot_in_for: Callable[[str], str],
    staging_for: Callable[[str], Source],
    target_for: Callable[[str], str],
    root_for: Callable[[str], str],
    snapshot_out_for: Callable[[str], str] | None = None,
    snapshot_in_format: SnapshotFormat | None = None,
    snapshot_out_format: SnapshotFormat = SnapshotFormat(header=True, evolved=True),
    tables: tuple[str, ...] = TABLE_ORDER,
    count_rejects: bool = False,
    **kwargs,
) -> SyncReport:
    """The snapshot job: current rows come from delimited snapshots.

    With ``count_rejects`` each run's audit says how many values of every column
    did not parse (in rows that the cleaning keeps), counted in the scan that
    counts the inputs.

    The new snapshot goes to a new folder (``snapshot_out_for``), never over
    the one being read; its format is stored beside it, so that the next run
    reads it as it is.
    """
    return sync_all(
        spark,
        scope=scope,
        current_for=lambda t: read_snapshot(spark, snapshot_in_for(t), t, snapshot_in_format, count_rejects),
        staging_for=staging_for,
        target_for=target_for,
        root_for=root_for,
        tables=tables,
        snapshot_for=snapshot_out_for,
        snapshot_format=snapshot_out_format,
        bytes_for=lambda t: stored_bytes(spark, snapshot_in_for(t)),  # sizes the buckets of a new target
        spec_for=lambda t: snapshot_spec(spark, snapshot_in_for(t), t),
        **kwargs,
    )


@dataclass(frozen=True)
class Preset:
    """Naming of one job family: where snapshots, staging and targets live."""

    snapshot_folder: str
    staging_database: str
    target_database: str

    def snapshot_in(self, base: str, run_dir: str) -> Callable[[str], str]:
        return lambda t: f"{base.rstrip('/')}/{self.snapshot_folder}/{run_dir}/{t}"

    def staging(self) -> Callable[[str], str]:
        return lambda t: f"{self.staging_database}.{t}"

    def target(self) -> Callable[[str], str]:
        return lambda t: f"{self.target_database}.{t}"
