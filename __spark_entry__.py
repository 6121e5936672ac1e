"""

Every query reads the driver's tables (``lineitem`` mapped onto the scored
visit fact, see ``slicerefresh.fixtures``; ``events`` for the second shape)
and runs over them whole.  Queries that publish write into a fresh folder
under the session's shared folder (``spark.checkpoint.dir``).  The oracle
SQL starts from the same fixture definitions and re-states each operator's
semantics in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicerefresh import fixtures as fx
from slicerefresh.operators.audit import sync_audit
from slicerefresh.operators.clean import control_char_filter
from slicerefresh.operators.keys import key_check, key_collapse
from slicerefresh.operators.replace import distinct_rows, slice_append, slice_delete, slice_replace, slice_select
from slicerefresh.operators.scope import Scope
from slicerefresh.operators.status import practice_filter, practice_high_water, refresh_status
from slicerefresh.plans.incremental import publish_partitioned, sync_incremental
from slicerefresh.plans.publish import REFRESH_BUCKET_BYTES, BucketSpec, default_num_buckets, layout_report, layout_write, publish_table, stored_bytes
from slicerefresh.plans.sync import (
    PLAIN_FORMAT,
    Preset,
    SnapshotFormat,
    StatusTarget,
    read_snapshot,
    restore_backup,
    sync_all,
    sync_from_snapshot,
    sync_table,
    write_snapshot,
)
from slicerefresh.schema import CANONICAL, FACT_TYPES, LAYOUTS, TABLE_ORDER, conform, conform_rejects, evolve_schema, layout
from slicerefresh.session import scratch_path
from slicerefresh.sources.delimited import read_delimited, reject_counts, write_delimited
from slicerefresh.sources.files import data_files
from slicerefresh.sources.tables import register_views, slice_sql

try:
    from slicerefresh.llm import queries as llm
except ImportError:  # the subpackage is optional
    llm = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

BY_PRACTICE, BY_PROVIDER, BY_LOCATION, BY_MEASURE = TABLE_ORDER


# --- scopes ----------------------------------------------------------------


def _scope(kind: str, staging: DataFrame):
    practices = {"list": fx.LIST_PRACTICES, "all": None, "all_practices": None, "all_measures": fx.LIST_PRACTICES,
                 "no_match": fx.NO_MATCH_PRACTICES, "absent": fx.ABSENT_PRACTICES}[kind]
    measures = None if kind in ("all", "all_measures") else fx.LIST_MEASURES
    return Scope.of(practices, measures).resolve(staging.select("practice_id", "measure_id"))


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return fx.prod(spark, sf), fx.staging(spark, sf)


def q_slice_replace_all_joined(spark, sf):
    """All-of-staging scope kept distributed (the large-scope path): counted
    key frames joined with marker columns instead of literal lists."""
    prod, staging = _inputs(spark, sf)
    scope = Scope.of(None, None).resolve(staging.select("practice_id", "measure_id"), max_literal_values=0)
    return slice_replace(prod, staging, scope)


def _replace(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        prod, staging = _inputs(spark, sf)
        return slice_replace(prod, staging, _scope(kind, staging))

    return q


# --- single operators --------------------------------------------------------


def q_control_char_filter(spark, sf):
    return control_char_filter(fx.prod(spark, sf))


def q_conform_columns(spark, sf):
    """Untyped input (text columns) in another column order -> canonical typed frame."""
    lay = LAYOUTS[BY_LOCATION]
    b = fx.base(spark, sf)
    wire = b.select(*[F.col(c) if c == "practice_id" else F.col(c).cast("string").alias(c) for c in lay.columns(True)])
    return conform(wire)


def q_evolve_datasource(spark, sf):
    return conform(evolve_schema(fx.prod(spark, sf).drop("datasource")))


def q_slice_select(spark, sf):
    prod, staging = _inputs(spark, sf)
    return slice_select(control_char_filter(prod), _scope("list", staging))


def q_slice_select_all(spark, sf):
    prod, staging = _inputs(spark, sf)
    return slice_select(control_char_filter(prod), _scope("all", staging))


def q_practice_filter(spark, sf):
    prod, staging = _inputs(spark, sf)
    scope = _scope("list", staging)
    return practice_filter(slice_replace(prod, staging, scope), scope)


def _delete(kind: str):
    def q(spark, sf):
        prod, staging = _inputs(spark, sf)
        return slice_delete(control_char_filter(prod), _scope(kind, staging))

    return q


def q_slice_append(spark, sf):
    """Kept rows plus added rows that arrive in another column order."""
    prod, staging = _inputs(spark, sf)
    added = slice_select(control_char_filter(staging), _scope("list", staging))
    added = added.select(*LAYOUTS[BY_MEASURE].columns(True))
    return slice_append(control_char_filter(prod), added)


def _scope_keys(key: str):
    """Everything in staging for one key: the distinct keys as Spark computes
    them (kept distributed, not turned into a literal list)."""

    def q(spark, sf):
        staging = fx.staging(spark, sf)
        return Scope.of(None, None).resolve(staging, max_literal_values=0).key_frame(key)

    return q


def q_distinct_rows(spark, sf):
    return distinct_rows(control_char_filter(fx.prod(spark, sf)))


def _key_check(table: str):
    def q(spark, sf):
        return key_check(fx.prod(spark, sf), layout(table).key)

    return q


def q_key_collapse(spark, sf):
    prod, staging = _inputs(spark, sf)
    both = control_char_filter(prod).unionByName(control_char_filter(staging))
    return key_collapse(both, layout(BY_PRACTICE).key, order=("updated_dt",))


def q_sync_audit(spark, sf):
    prod, staging = _inputs(spark, sf)
    scope = _scope("list", staging)
    cur, stg = control_char_filter(prod), control_char_filter(staging)
    return sync_audit(cur, stg, scope, slice_delete(cur, scope))


def q_snapshot_roundtrip(spark, sf):
    """Raw prod (dirty rows included) through a 26-column snapshot without header."""
    path = scratch_path(spark, "snapshot")
    fmt = SnapshotFormat(header=False, evolved=False)
    write_delimited(fx.prod(spark, sf), path, header=fmt.header, columns=fmt.columns(BY_PRACTICE))
    return conform(read_delimited(spark, path, fmt.schema(BY_PRACTICE), header=fmt.header))


def q_legacy_snapshot_read(spark, sf):
    """A snapshot folder in the original job's format (delimiter only, no
    header, 26 columns), read back by the legacy codec."""
    path = scratch_path(spark, "legacy-snapshot")
    fmt = SnapshotFormat(header=False, evolved=False, codec="legacy")
    write_delimited(fx.prod(spark, sf), path, header=fmt.header, columns=fmt.columns(BY_PRACTICE), codec=fmt.codec)
    return read_snapshot(spark, path, BY_PRACTICE, fmt)


def q_snapshot_roundtrip_header(spark, sf):
    """Staging through a 27-column snapshot with header, in the by-provider order."""
    path = scratch_path(spark, "snapshot")
    fmt = SnapshotFormat(header=True, evolved=True)
    write_delimited(fx.staging(spark, sf), path, header=fmt.header, columns=fmt.columns(BY_PROVIDER))
    return conform(read_delimited(spark, path, fmt.schema(BY_PROVIDER), header=fmt.header))


def _layout(table: str):
    def q(spark, sf):
        path = scratch_path(spark, f"layout-{table}")
        layout_write(_replace("list")(spark, sf), LAYOUTS[table], path)
        return spark.read.parquet(path).select(*LAYOUTS[table].columns(True))

    return q


def _layout_proof(table: str):
    """A result written in a layout's order, and how far its files are in order."""

    def q(spark, sf):
        path = scratch_path(spark, f"proof-{table}")
        layout_write(_replace("list")(spark, sf), LAYOUTS[table], path)
        report = layout_report(spark.read.parquet(path), LAYOUTS[table])
        return report.select(F.lit(table).alias("table_name"), "n_rows", "n_descents", "n_overlaps")

    return q


def _bad_text(spark, sf) -> DataFrame:
    """The fixture's base as text, with values that do not parse (``fx.BAD_VALUES``)."""
    b = fx.base(spark, sf)
    text = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if FACT_TYPES[c] == "timestamp" else F.col(c).cast("string") for c in CANONICAL}
    return b.select(*[F.when(F.expr(fx.BAD_VALUES[c][0]), F.lit(fx.BAD_VALUES[c][1])).otherwise(text[c]).alias(c) if c in fx.BAD_VALUES else text[c].alias(c) for c in CANONICAL])


def _read_rejects(codec: str):
    """Values of a snapshot that do not parse, counted per column in the scan that reads it."""

    def q(spark, sf):
        path = scratch_path(spark, f"rejects-{codec}")
        fmt = SnapshotFormat(header=False, evolved=True, codec=codec)
        write_delimited(_bad_text(spark, sf), path, header=False, columns=fmt.columns(BY_LOCATION), codec=codec)
        return reject_counts(read_delimited(spark, path, fmt.schema(BY_LOCATION), codec=codec, rejects=True))

    return q


def q_conform_rejects(spark, sf):
    """Values that a lenient conform turns into nulls, counted per column."""
    text = _bad_text(spark, sf)
    named = text.select(F.explode(conform_rejects(text)).alias("column_name"))
    return named.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_rejected"))


def q_snapshot_rejects(spark, sf):
    """The snapshot job's own reject counts, taken in the scan that counts its inputs."""
    base = scratch_path(spark, "job-rejects")
    fmt = SnapshotFormat(header=True, evolved=True)
    write_delimited(_bad_text(spark, sf), f"{base}/in", header=True, columns=fmt.columns(BY_MEASURE))
    report = sync_from_snapshot(
        spark, scope=Scope.of(fx.LIST_PRACTICES, fx.LIST_MEASURES), snapshot_in_for=lambda t: f"{base}/in", staging_for=lambda t: fx.staging(spark, sf),
        target_for=lambda t, name=_table_name("rejects"): name, root_for=lambda t: f"{base}/t", tables=(BY_MEASURE,), count_rejects=True,
    )
    return spark.createDataFrame(list(report.runs[0].audit.rejected.items()), "column_name string, n_rejected long")


def q_single_file_export(spark, sf):
    """The whole table through one file, and the number of files."""
    path = scratch_path(spark, "one-file")
    fmt = SnapshotFormat(header=True, evolved=True)
    write_delimited(fx.prod(spark, sf), path, header=True, columns=fmt.columns(BY_LOCATION), single_file=True)
    rows = read_delimited(spark, path, fmt.schema(BY_LOCATION), header=True)
    return conform(rows).withColumn("n_files", F.lit(data_files(spark, path)[0]))


def q_layout_configured(spark, sf):
    """A layout written with a configured number of partitions, and the number of files."""
    path = scratch_path(spark, "configured")
    layout_write(fx.prod(spark, sf), LAYOUTS[BY_MEASURE], path, num_partitions=5)
    return conform(spark.read.parquet(path)).withColumn("n_files", F.lit(data_files(spark, path)[0]))


def q_key_check_null_parts(spark, sf):
    """Keys that come more than once or have a null part (the store takes neither)."""
    return key_check(fx.prod(spark, sf), layout(BY_PRACTICE).key, null_keys=True)


def q_refresh_status_now(spark, sf):
    """The default refresh time is now: which rows got it."""
    scope = Scope.of(fx.REFRESH_PRACTICES, fx.LIST_MEASURES).resolve()
    hw = practice_high_water(practice_filter(_refresh_input(spark, sf), scope))
    out = refresh_status(fx.status(spark, sf), hw)
    late = F.col("lastrefreshtime") >= F.localtimestamp() - F.expr("interval 1 hour")
    return out.select("practiceid", "enddate", late.alias("refreshed_now"))


# --- publishing jobs ---------------------------------------------------------


def _table_name(tag: str) -> str:
    import uuid

    return f"{tag}_{uuid.uuid4().hex[:10]}"


def _bucket_spec(spark, sf, table: str) -> BucketSpec:
    """Buckets sized from the input: the fact has about twice the bytes of ``lineitem``."""
    size = 2 * (stored_bytes(spark, f"{sf.rstrip('/')}/lineitem.parquet") or 0)
    return BucketSpec.for_layout(LAYOUTS[table], default_num_buckets(spark, size, REFRESH_BUCKET_BYTES))


def _publish_inputs(spark, sf, table: str):
    """Publish the fixture's prod as the current table and its staging as a table."""
    root = scratch_path(spark, "tables")
    prod, staging = _inputs(spark, sf)
    spec = _bucket_spec(spark, sf, table)
    current = _table_name("current")
    publish_table(prod.repartition(spec.num_buckets, *spec.columns), current, f"{root}/current", spec)
    staged = _table_name("staging")
    publish_table(staging, staged, f"{root}/staging")
    return root, current, staged


def _sync_table(table: str, kind: str):
    def q(spark, sf):
        root, current, staged = _publish_inputs(spark, sf, table)
        scope = _scope(kind, spark.table(staged))
        # In place, like the production job: the current table is the target.
        sync_table(spark, table, current=current, staging=staged, scope=scope, target=current, root=f"{root}/current")
        return spark.table(current)

    return q


def q_sync_table_collapse(spark, sf):
    """The production job with the keyed store's semantics (one row per key),
    on a slice that removes nothing, so the original's dedupe does not apply."""
    root, current, staged = _publish_inputs(spark, sf, BY_PRACTICE)
    sync_table(spark, BY_PRACTICE, current=current, staging=staged, scope=_scope("no_match", spark.table(staged)),
               target=current, root=f"{root}/current", collapse_keys=True)
    return spark.table(current)


def _tagged(frames: dict) -> DataFrame:
    """The rows of several tables, each with its table's name."""
    parts = [df.select(F.lit(t).alias("table_name"), *CANONICAL) for t, df in frames.items()]
    return reduce(lambda x, y: x.unionByName(y), parts)


def _snapshot_job(kind: str, variant: bool):
    """The snapshot job over all four tables: published rows and the rows of
    the snapshots it writes, read back."""

    def q(spark, sf):
        base = scratch_path(spark, "snapshots")
        prod, staging = _inputs(spark, sf)
        preset = Preset("family/clean" if variant else "clean", "", "")
        snap_in = preset.snapshot_in(base, "run1")
        for t in TABLE_ORDER:  # the snapshots the job starts from
            write_delimited(prod, snap_in(t), header=PLAIN_FORMAT.header, columns=PLAIN_FORMAT.columns(t))
        staged = _table_name("staging")
        publish_table(staging, staged, f"{base}/staging")
        targets = {t: _table_name("target") for t in TABLE_ORDER}
        sync_from_snapshot(
            spark,
            scope=_scope(kind, spark.table(staged)),
            snapshot_in_for=snap_in,
            staging_for=lambda t: staged,
            target_for=lambda t: targets[t],
            root_for=lambda t: f"{base}/target/{t}",
            snapshot_out_for=preset.snapshot_in(base, "run2"),
        )
        published = {t: spark.table(targets[t]) for t in TABLE_ORDER}
        exported = {f"{t} snapshot": read_snapshot(spark, preset.snapshot_in(base, "run2")(t), t) for t in TABLE_ORDER}
        return _tagged({**published, **exported})

    return q


def q_snapshot_chain(spark, sf):
    """The output snapshot of one run (list scope) is the input of the next (all of staging)."""
    base = scratch_path(spark, "chain")
    prod, staging = _inputs(spark, sf)
    staged = _table_name("staging")
    publish_table(staging, staged, f"{base}/staging")
    write_snapshot(prod, f"{base}/run0/{BY_MEASURE}", BY_MEASURE, PLAIN_FORMAT)
    for run, kind in enumerate(("list", "all")):
        sync_from_snapshot(
            spark,
            scope=_scope(kind, spark.table(staged)),
            snapshot_in_for=lambda t, run=run: f"{base}/run{run}/{t}",
            staging_for=lambda t: staged,
            target_for=lambda t, name=_table_name("chain"): name,
            root_for=lambda t, run=run: f"{base}/target{run}/{t}",
            snapshot_out_for=lambda t, run=run: f"{base}/run{run + 1}/{t}",
            tables=(BY_MEASURE,),
        )
    return read_snapshot(spark, f"{base}/run2/{BY_MEASURE}", BY_MEASURE)


def q_sync_table_backup(spark, sf):
    """The pre-image backup of a refresh, read back: the current rows as they were."""
    root, current, staged = _publish_inputs(spark, sf, BY_PROVIDER)
    sync_table(spark, BY_PROVIDER, current=current, staging=staged, scope=_scope("list", spark.table(staged)), target=current,
               root=f"{root}/current", backup_for=lambda t: f"{root}/backup/{t}")
    fmt = SnapshotFormat(header=True, evolved=True)
    return read_delimited(spark, f"{root}/backup/{BY_PROVIDER}", fmt.schema(BY_PROVIDER), header=True).select(*CANONICAL)


def _backed_up(spark, sf, table: str) -> tuple[str, str]:
    """A refreshed table and the folder of its backups."""
    root, current, staged = _publish_inputs(spark, sf, table)
    sync_table(spark, table, current=current, staging=staged, scope=_scope("list", spark.table(staged)), target=current,
               root=f"{root}/current", backup_for=lambda t: f"{root}/backup/{t}")
    return root, current


def q_restore_from_backup(spark, sf):
    """The backup of a refresh is the input of the snapshot job: the clean rows as they were before it."""
    root, _ = _backed_up(spark, sf, BY_PROVIDER)
    target = _table_name("restored")
    sync_from_snapshot(spark, scope=Scope.of(fx.NO_MATCH_PRACTICES, fx.LIST_MEASURES), snapshot_in_for=lambda t: f"{root}/backup/{t}",
                       staging_for=lambda t: fx.staging(spark, sf), target_for=lambda t: target, root_for=lambda t: f"{root}/restored",
                       tables=(BY_PROVIDER,))
    return spark.table(target).select(*CANONICAL)


def q_restore_backup_exact(spark, sf):
    """The pre-image put back in place: every row as it was, dirty ones too."""
    root, current = _backed_up(spark, sf, BY_LOCATION)
    restore_backup(spark, BY_LOCATION, backup=f"{root}/backup/{BY_LOCATION}", target=current, root=f"{root}/current")
    return spark.table(current).select(*CANONICAL)


def _sliced(table: str, kind: str, dirty_start: bool = False):
    """A layout partitioned by the slice's hash, refreshed in place: only slices that hold rows in scope are rewritten."""

    def q(spark, sf):
        root = scratch_path(spark, "sliced")
        prod, staging = _inputs(spark, sf)
        name = _table_name("sliced")
        start = prod if dirty_start else distinct_rows(control_char_filter(prod))
        publish_partitioned(start, name, f"{root}/{name}", LAYOUTS[table], slices=32)
        sync_incremental(spark, name, staging=staging, scope=_scope(kind, staging), root=f"{root}/{name}", layout=LAYOUTS[table])
        return spark.table(name).select(*CANONICAL)

    return q


def q_snapshot_chain_partitioned(spark, sf):
    """A table by slices refreshed twice with its snapshot in one folder: the second time only touched slices are exported."""
    base = scratch_path(spark, "chain_partitioned")
    prod, staging = _inputs(spark, sf)
    staged, name = _table_name("staging"), _table_name("sliced")
    publish_table(staging, staged, f"{base}/staging")
    for kind, current in (("list", prod), ("all", name)):
        sync_table(
            spark, BY_PROVIDER, current=current, staging=staged, scope=_scope(kind, spark.table(staged)), target=name, root=f"{base}/table",
            slices=16, snapshot_for=lambda t: f"{base}/snapshot/{t}", snapshot_format=SnapshotFormat(header=True, evolved=True, partitioned=True),
        )
    return read_snapshot(spark, f"{base}/snapshot/{BY_PROVIDER}", BY_PROVIDER)


def q_sync_all_sliced(spark, sf):
    """Four new tables by slices from the list scope, then refreshed in place by all of staging, with the status table."""
    base = scratch_path(spark, "sync_all_sliced")
    prod, staging = _inputs(spark, sf)
    staged, status_table = _table_name("staging"), _table_name("status")
    publish_table(staging, staged, f"{base}/staging")
    publish_table(fx.status(spark, sf), status_table, f"{base}/status")
    targets = {t: _table_name(t.rsplit("_", 1)[-1]) for t in TABLE_ORDER}
    for kind, current_for in (("list", lambda t: prod), ("all", lambda t: targets[t])):
        sync_all(
            spark,
            scope=_scope(kind, spark.table(staged)),
            current_for=current_for,
            staging_for=lambda t: staged,
            target_for=lambda t: targets[t],
            root_for=lambda t: f"{base}/{t}",
            slices=16,
            status=StatusTarget(status_table, f"{base}/status", F.lit(fx.REFRESHED_AT).cast("timestamp_ntz")),
        )
    return _tagged({t: spark.table(targets[t]) for t in TABLE_ORDER})


def q_evolve_published_table(spark, sf):
    """A published table of 26 columns, refreshed in place: it gets ``datasource``."""
    root = scratch_path(spark, "evolve")
    prod, staging = _inputs(spark, sf)
    table, staged = _table_name("old"), _table_name("staging")
    spec = _bucket_spec(spark, sf, BY_PRACTICE)
    publish_table(prod.drop("datasource").repartition(spec.num_buckets, *spec.columns), table, f"{root}/table", spec)
    publish_table(staging, staged, f"{root}/staging")
    sync_table(spark, BY_PRACTICE, current=table, staging=staged, scope=_scope("list", spark.table(staged)), target=table, root=f"{root}/table")
    return spark.table(table).select(*CANONICAL)


def _incremental(kind: str, distinct_start: bool):
    """Partitioned layout refreshed in place, only the partitions in scope rewritten."""

    def q(spark, sf):
        root = scratch_path(spark, "incremental")
        prod, staging = _inputs(spark, sf)
        start = control_char_filter(prod)
        if distinct_start:
            start = distinct_rows(start)
        table = _table_name("partitioned")
        lay = LAYOUTS[BY_PRACTICE]
        publish_partitioned(start, table, f"{root}/{table}", lay)
        sync_incremental(spark, table, staging=staging, scope=_scope(kind, staging), root=f"{root}/{table}", layout=lay)
        return spark.table(table)

    return q


def _sync_all_partitioned(kind: str):
    """The four-table job over partitioned layouts: each refreshed in place,
    only the practices in scope rewritten, all switched together, with the
    status refresh; rows per table."""

    def q(spark, sf):
        base = scratch_path(spark, "sync_all_partitioned")
        prod, staging = _inputs(spark, sf)
        start = distinct_rows(control_char_filter(prod))
        staged, status_table = _table_name("staging"), _table_name("status")
        publish_table(staging, staged, f"{base}/staging")
        publish_table(fx.status(spark, sf), status_table, f"{base}/status")
        targets = {t: _table_name(t.rsplit("_", 1)[-1]) for t in TABLE_ORDER}
        first = targets[BY_PRACTICE]
        publish_partitioned(start, first, f"{base}/{BY_PRACTICE}", LAYOUTS[BY_PRACTICE])
        for t in TABLE_ORDER[1:]:
            publish_partitioned(spark.table(first), targets[t], f"{base}/{t}", LAYOUTS[t], like=first)
        sync_all(
            spark,
            scope=_scope(kind, spark.table(staged)),
            current_for=lambda t: targets[t],
            staging_for=lambda t: staged,
            target_for=lambda t: targets[t],
            root_for=lambda t: f"{base}/{t}",
            status=StatusTarget(status_table, f"{base}/status", F.lit(fx.REFRESHED_AT).cast("timestamp_ntz")),
        )
        return _tagged({t: spark.table(targets[t]) for t in TABLE_ORDER})

    return q


def q_sync_all(spark, sf):
    """Four tables staged, verified, then switched together; rows per table."""
    base = scratch_path(spark, "sync_all")
    prod, staging = _inputs(spark, sf)
    staged = _table_name("staging")
    publish_table(staging, staged, f"{base}/staging")
    current = _table_name("prod")
    publish_table(prod, current, f"{base}/prod")
    targets = {t: _table_name(t) for t in TABLE_ORDER}
    sync_all(
        spark,
        scope=Scope.of(fx.LIST_PRACTICES, fx.LIST_MEASURES),
        current_for=lambda t: current,
        staging_for=lambda t: staged,
        target_for=lambda t: targets[t],
        root_for=lambda t: f"{base}/{t}",
    )
    return _tagged({t: spark.table(targets[t]) for t in TABLE_ORDER})


def _refresh_input(spark, sf):
    prod, staging = _inputs(spark, sf)
    result = slice_replace(prod, staging, _scope("list", staging))
    return result.filter(F.coalesce(F.col("practice_id") != fx.REFRESH_REMOVED_PRACTICE, F.lit(True)))


def q_practice_high_water(spark, sf):
    scope = Scope.of(fx.REFRESH_PRACTICES, fx.LIST_MEASURES).resolve()
    return practice_high_water(practice_filter(_refresh_input(spark, sf), scope))


def q_refresh_status(spark, sf):
    """The status table advanced through the publishing path (stage, verify, switch)."""
    base = scratch_path(spark, "status")
    status_table = _table_name("status")
    publish_table(fx.status(spark, sf), status_table, f"{base}/status")
    scope = Scope.of(fx.REFRESH_PRACTICES, fx.LIST_MEASURES).resolve()
    hw = practice_high_water(practice_filter(_refresh_input(spark, sf), scope))
    refreshed = F.lit(fx.REFRESHED_AT).cast("timestamp_ntz")
    publish_table(refresh_status(spark.table(status_table), hw, refreshed), status_table, f"{base}/status")
    return spark.table(status_table)


def q_sync_table_status(spark, sf):
    """The production job on the by-practice table, with the status refresh."""
    root, current, staged = _publish_inputs(spark, sf, BY_PRACTICE)
    status_table = _table_name("status")
    publish_table(fx.status(spark, sf), status_table, f"{root}/status")
    refreshed = F.lit(fx.REFRESHED_AT).cast("timestamp_ntz")
    sync_table(
        spark, BY_PRACTICE, current=current, staging=staged, scope=Scope.of(fx.REFRESH_PRACTICES, fx.LIST_MEASURES),
        target=current, root=f"{root}/current", status=StatusTarget(status_table, f"{root}/status", refreshed),
    )
    return spark.table(status_table)


def q_sql_surface(spark, sf):
    prod, staging = _inputs(spark, sf)
    view, _ = register_views(control_char_filter(prod), control_char_filter(staging), "summary_details_by_practice")
    return slice_sql(spark, view, _scope("list", staging))


def q_events_slice_replace_all(spark, sf):
    """Second shape: user_id as practice, event_type as measure, no cleaning column."""
    ev, stg = fx.events(spark, sf), fx.events_staging(spark, sf)
    scope = Scope({k: None for k in fx.EVENTS_KEYS}).resolve(stg)
    return slice_replace(ev, stg, scope, clean_column=None, schema=ev.schema)


def q_events_snapshot_roundtrip(spark, sf):
    """Microsecond timestamps and quoted text through the delimited codec."""
    ev = fx.events(spark, sf)
    path = scratch_path(spark, "events-snapshot")
    write_delimited(ev, path, header=True)
    return read_delimited(spark, path, ev.schema, header=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "control_char_filter": q_control_char_filter,
        "conform_columns": q_conform_columns,
        "evolve_datasource": q_evolve_datasource,
        "slice_select": q_slice_select,
        "slice_select_all": q_slice_select_all,
        "practice_filter": q_practice_filter,
        "slice_delete_list": _delete("list"),
        "slice_delete_all": _delete("all"),
        "slice_delete_no_match": _delete("no_match"),
        "slice_append": q_slice_append,
        "slice_replace_list": _replace("list"),
        "slice_replace_all": _replace("all"),
        "slice_replace_all_joined": q_slice_replace_all_joined,
        "slice_replace_all_practices": _replace("all_practices"),
        "slice_replace_all_measures": _replace("all_measures"),
        "slice_delete_without_add": _replace("absent"),
        "scope_all_practices": _scope_keys("practice_id"),
        "scope_all_measures": _scope_keys("measure_id"),
        "distinct_rows": q_distinct_rows,
        "key_check_practice": _key_check(BY_PRACTICE),
        "key_check_provider": _key_check(BY_PROVIDER),
        "key_check_location": _key_check(BY_LOCATION),
        "key_check_measure": _key_check(BY_MEASURE),
        "key_collapse": q_key_collapse,
        "sync_audit": q_sync_audit,
        "snapshot_roundtrip": q_snapshot_roundtrip,
        "snapshot_roundtrip_header": q_snapshot_roundtrip_header,
        "legacy_snapshot_read": q_legacy_snapshot_read,
        "layout_by_practice": _layout(BY_PRACTICE),
        "layout_by_provider": _layout(BY_PROVIDER),
        "layout_by_location": _layout(BY_LOCATION),
        "layout_by_measure": _layout(BY_MEASURE),
        **{f"layout_proof_{t.rsplit('_', 1)[-1]}": _layout_proof(t) for t in TABLE_ORDER},
        "read_rejects": _read_rejects("lossless"),
        "read_rejects_legacy": _read_rejects("legacy"),
        "conform_rejects": q_conform_rejects,
        "snapshot_rejects": q_snapshot_rejects,
        "single_file_export": q_single_file_export,
        "layout_configured": q_layout_configured,
        "key_check_null_parts": q_key_check_null_parts,
        "refresh_status_now": q_refresh_status_now,
        "restore_from_backup": q_restore_from_backup,
        "restore_backup_exact": q_restore_backup_exact,
        "sync_sliced_provider_list": _sliced(BY_PROVIDER, "list"),
        "sync_sliced_location_all": _sliced(BY_LOCATION, "all"),
        "sync_sliced_measure_dedupe": _sliced(BY_MEASURE, "list", dirty_start=True),
        "sync_sliced_practice_absent": _sliced(BY_PRACTICE, "absent"),
        "sync_all_sliced": q_sync_all_sliced,
        "snapshot_chain_partitioned": q_snapshot_chain_partitioned,
        "sync_table_by_practice": _sync_table(BY_PRACTICE, "list"),
        "sync_table_by_provider": _sync_table(BY_PROVIDER, "all"),
        "sync_table_by_location": _sync_table(BY_LOCATION, "all_practices"),
        "sync_table_by_measure": _sync_table(BY_MEASURE, "all_measures"),
        "sync_table_status": q_sync_table_status,
        "sync_table_collapse": q_sync_table_collapse,
        "sync_from_snapshot": _snapshot_job("list", variant=False),
        "sync_variant": _snapshot_job("all", variant=True),
        "snapshot_chain": q_snapshot_chain,
        "sync_table_backup": q_sync_table_backup,
        "evolve_published_table": q_evolve_published_table,
        "sync_all": q_sync_all,
        "sync_incremental_list": _incremental("list", distinct_start=True),
        "sync_all_partitioned_all": _sync_all_partitioned("all"),
        "sync_incremental_all": _incremental("all", distinct_start=True),
        "sync_incremental_no_match": _incremental("no_match", distinct_start=False),
        "practice_high_water": q_practice_high_water,
        "refresh_status": q_refresh_status,
        "sql_surface": q_sql_surface,
        "events_slice_replace_all": q_events_slice_replace_all,
        "events_snapshot_roundtrip": q_events_snapshot_roundtrip,
        **(llm.queries() if llm else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the current table after publishing a listed slice (sf0.001)."""
    return _replace("list")(spark, SMOKE_DIR)


# --- oracle ----------------------------------------------------------------

_P_LIST = ", ".join(str(p) for p in fx.LIST_PRACTICES)
_M_LIST = ", ".join(f"'{m}'" for m in fx.LIST_MEASURES)
_ALL_P = "SELECT practice_id FROM staging"
_ALL_M = "SELECT measure_id FROM staging"

SLICES = {
    "list": f"practice_id IN ({_P_LIST}) AND measure_id IN ({_M_LIST})",
    "all": f"practice_id IN ({_ALL_P}) AND measure_id IN ({_ALL_M})",
    "all_practices": f"practice_id IN ({_ALL_P}) AND measure_id IN ({_M_LIST})",
    "all_measures": f"practice_id IN ({_P_LIST}) AND measure_id IN ({_ALL_M})",
    "no_match": f"practice_id IN ({', '.join(map(str, fx.NO_MATCH_PRACTICES))}) AND measure_id IN ({_M_LIST})",
    "absent": f"practice_id IN ({', '.join(map(str, fx.ABSENT_PRACTICES))}) AND measure_id IN ({_M_LIST})",
}


def _s(kind: str) -> str:
    return f"coalesce({SLICES[kind]}, false)"


def _kept_ctes(kind: str) -> dict[str, str]:
    """EXCEPT semantics: distinct kept rows iff the slice removes something."""
    return {
        "kept_all": f"SELECT * FROM clean_prod WHERE NOT {_s(kind)}",
        "removed": f"SELECT count(*) AS n FROM clean_prod WHERE {_s(kind)}",
        "kept": "SELECT DISTINCT * FROM kept_all WHERE (SELECT n FROM removed) > 0"
        " UNION ALL SELECT * FROM kept_all WHERE (SELECT n FROM removed) = 0",
    }


def _replace_ctes(kind: str) -> dict[str, str]:
    return {**_kept_ctes(kind), "result": f"SELECT * FROM kept UNION ALL SELECT * FROM clean_staging WHERE {_s(kind)}"}


def _replace_sql(kind: str) -> str:
    return fx.with_inputs_sql("SELECT * FROM result", **_replace_ctes(kind))


def _layout_cols(table: str) -> str:
    return ", ".join(LAYOUTS[table].columns(True))


def _key_check_sql(table: str) -> str:
    key = ", ".join(layout(table).key)
    return fx.with_inputs_sql(f"SELECT {key}, count(*) AS n_rows FROM prod GROUP BY {key} HAVING count(*) > 1")


def _refresh_ctes() -> dict[str, str]:
    return {
        **_replace_ctes("list"),
        "refresh_input": f"SELECT * FROM result WHERE coalesce(practice_id <> {fx.REFRESH_REMOVED_PRACTICE}, true)",
        "hw": "SELECT practice_id, max(visit_dt) AS enddate FROM refresh_input"
        f" WHERE practice_id IN ({', '.join(map(str, fx.REFRESH_PRACTICES))}) GROUP BY practice_id",
    }


_REFRESH_BODY = (
    "SELECT s.practiceid,"
    " CASE WHEN hw.practice_id IS NOT NULL THEN hw.enddate ELSE s.enddate END AS enddate,"
    f" CASE WHEN hw.practice_id IS NOT NULL THEN TIMESTAMP '{fx.REFRESHED_AT}' ELSE s.lastrefreshtime END AS lastrefreshtime"
    " FROM status s LEFT JOIN hw ON s.practiceid = hw.practice_id"
)


def _key_collapse_sql(source: str = "SELECT * FROM clean_prod UNION ALL SELECT * FROM clean_staging") -> str:
    key = list(layout(BY_PRACTICE).key)
    rest = [c for c in CANONICAL if c not in key and c != "updated_dt"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["updated_dt", *rest])
    return fx.with_inputs_sql(
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {order}) AS rn"
        f" FROM ({source})) WHERE rn = 1"
    )


def _sync_audit_sql() -> str:
    s = _s("list")
    return fx.with_inputs_sql(
        "SELECT *, after_removal + to_add AS after_add FROM (SELECT"
        " (SELECT count(*) FROM clean_prod) AS prod_full,"
        f" (SELECT count(*) FROM clean_prod WHERE {s}) AS to_remove,"
        f" (SELECT count(*) FROM clean_staging WHERE {s}) AS to_add,"
        " (SELECT count(*) FROM kept) AS after_removal)",
        **_kept_ctes("list"),
    )


def _legacy_snapshot_sql() -> str:
    """What the original format keeps: text written with the default CSV
    writer loses blanks and control characters (code points 1-32) at both
    ends of every text value."""
    ends = "concat(" + ", ".join(f"chr({i})" for i in range(1, 33)) + ")"
    text = [c for c in CANONICAL if FACT_TYPES[c] == "string"]
    replaced = ", ".join(f"trim({c}, {ends}) AS {c}" for c in text)
    return fx.with_inputs_sql(f"SELECT * REPLACE ({replaced}) FROM prod")


def _sync_all_sql(kind: str = "list") -> str:
    return _tagged_sql(kind, TABLE_ORDER)


def _tagged_sql(kind: str, names) -> str:
    body = " UNION ALL ".join(f"SELECT '{t}' AS table_name, * FROM result" for t in names)
    return fx.with_inputs_sql(body, **_replace_ctes(kind))


def oracle_sql() -> dict[str, str]:
    w = fx.with_inputs_sql
    events_s = (
        "coalesce(user_id IN (SELECT user_id FROM ev_staging)"
        " AND event_type IN (SELECT event_type FROM ev_staging), false)"
    )
    events_replace = (
        f"WITH ev_staging AS ({fx.events_staging_sql()}),\n"
        f"removed AS (SELECT count(*) AS n FROM events WHERE {events_s})\n"
        f"SELECT DISTINCT * FROM events WHERE NOT {events_s} AND (SELECT n FROM removed) > 0\n"
        f"UNION ALL SELECT * FROM events WHERE NOT {events_s} AND (SELECT n FROM removed) = 0\n"
        f"UNION ALL SELECT * FROM ev_staging WHERE {events_s}"
    )
    return {
        "control_char_filter": w("SELECT * FROM clean_prod"),
        "conform_columns": w("SELECT * FROM base"),
        "evolve_datasource": w("SELECT * EXCLUDE (datasource), CAST(NULL AS INTEGER) AS datasource FROM prod"),
        "slice_select": w(f"SELECT * FROM clean_prod WHERE {_s('list')}"),
        "slice_select_all": w(f"SELECT * FROM clean_prod WHERE {_s('all')}"),
        "practice_filter": w(f"SELECT * FROM result WHERE practice_id IN ({_P_LIST})", **_replace_ctes("list")),
        "slice_delete_list": w("SELECT * FROM kept", **_kept_ctes("list")),
        "slice_delete_all": w("SELECT * FROM kept", **_kept_ctes("all")),
        "slice_delete_no_match": w("SELECT * FROM kept", **_kept_ctes("no_match")),
        "slice_append": w(f"SELECT * FROM clean_prod UNION ALL SELECT * FROM clean_staging WHERE {_s('list')}"),
        "slice_replace_list": _replace_sql("list"),
        "slice_replace_all": _replace_sql("all"),
        "slice_replace_all_joined": _replace_sql("all"),
        "slice_replace_all_practices": _replace_sql("all_practices"),
        "slice_replace_all_measures": _replace_sql("all_measures"),
        "slice_delete_without_add": _replace_sql("absent"),
        "scope_all_practices": w("SELECT DISTINCT practice_id FROM staging WHERE practice_id IS NOT NULL"),
        "scope_all_measures": w("SELECT DISTINCT measure_id FROM staging WHERE measure_id IS NOT NULL"),
        "distinct_rows": w("SELECT DISTINCT * FROM clean_prod"),
        "key_check_practice": _key_check_sql(BY_PRACTICE),
        "key_check_provider": _key_check_sql(BY_PROVIDER),
        "key_check_location": _key_check_sql(BY_LOCATION),
        "key_check_measure": _key_check_sql(BY_MEASURE),
        "key_collapse": _key_collapse_sql(),
        "sync_audit": _sync_audit_sql(),
        "snapshot_roundtrip": w("SELECT * FROM prod"),
        "snapshot_roundtrip_header": w("SELECT * FROM staging"),
        "legacy_snapshot_read": _legacy_snapshot_sql(),
        "layout_by_practice": _replace_sql("list"),
        "layout_by_provider": _replace_sql("list"),
        "layout_by_location": _replace_sql("list"),
        "layout_by_measure": _replace_sql("list"),
        **{
            f"layout_proof_{t.rsplit('_', 1)[-1]}": w(
                f"SELECT '{t}' AS table_name, count(*) AS n_rows, 0::BIGINT AS n_descents, 0::BIGINT AS n_overlaps FROM result", **_replace_ctes("list")
            )
            for t in TABLE_ORDER
        },
        "read_rejects": _rejects_sql(),
        "read_rejects_legacy": _rejects_sql(),
        "conform_rejects": _rejects_sql(),
        "snapshot_rejects": _rejects_sql("(midname IS NULL OR position(chr(23) IN midname) = 0)"),
        "single_file_export": w("SELECT *, 1 AS n_files FROM prod"),
        "layout_configured": w("SELECT *, 5 AS n_files FROM prod"),
        "key_check_null_parts": w(
            "SELECT practice_id, measure_id, visit_dt, unit, visit_uid, count(*) AS n_rows FROM prod GROUP BY ALL HAVING count(*) > 1"
            " OR practice_id IS NULL OR measure_id IS NULL OR visit_dt IS NULL OR unit IS NULL OR visit_uid IS NULL"
        ),
        "refresh_status_now": w(
            "SELECT practiceid, CASE WHEN hw.practice_id IS NOT NULL THEN hw.enddate ELSE s.enddate END AS enddate,"
            " hw.practice_id IS NOT NULL AS refreshed_now FROM status s LEFT JOIN hw ON s.practiceid = hw.practice_id",
            **_refresh_ctes(),
        ),
        "restore_from_backup": w("SELECT * FROM clean_prod"),
        "restore_backup_exact": w("SELECT * FROM prod"),
        "sync_sliced_provider_list": _replace_sql("list"),
        "sync_sliced_location_all": _replace_sql("all"),
        "sync_sliced_measure_dedupe": _replace_sql("list"),
        "sync_sliced_practice_absent": _replace_sql("absent"),
        "snapshot_chain_partitioned": _chain_sql("SELECT * FROM second_run"),
        "sync_all_sliced": _chain_sql("SELECT table_name, d.* FROM (SELECT * FROM second_run) d CROSS JOIN (VALUES "
                                      + ", ".join(f"('{t}')" for t in TABLE_ORDER) + ") AS names(table_name)"),
        "sync_table_by_practice": _replace_sql("list"),
        "sync_table_by_provider": _replace_sql("all"),
        "sync_table_by_location": _replace_sql("all_practices"),
        "sync_table_by_measure": _replace_sql("all_measures"),
        "sync_table_status": _sync_table_status_sql(),
        "sync_table_collapse": _key_collapse_sql("SELECT * FROM clean_prod"),
        "sync_from_snapshot": _tagged_sql("list", [*TABLE_ORDER, *(f"{t} snapshot" for t in TABLE_ORDER)]),
        "sync_variant": _tagged_sql("all", [*TABLE_ORDER, *(f"{t} snapshot" for t in TABLE_ORDER)]),
        "snapshot_chain": _chain_sql("SELECT * FROM second_run"),
        "sync_table_backup": w("SELECT * FROM prod"),
        "evolve_published_table": _replace_sql("list"),
        "sync_all": _sync_all_sql(),
        "sync_incremental_list": _replace_sql("list"),
        "sync_all_partitioned_all": _sync_all_sql("all"),
        "sync_incremental_all": _replace_sql("all"),
        "sync_incremental_no_match": _replace_sql("no_match"),
        "practice_high_water": w("SELECT * FROM hw", **_refresh_ctes()),
        "refresh_status": w(_REFRESH_BODY, **_refresh_ctes()),
        "sql_surface": w(f"SELECT * FROM clean_prod WHERE {_s('list')}"),
        "events_slice_replace_all": events_replace,
        "events_snapshot_roundtrip": "SELECT * FROM events",
        **(llm.oracle_sql() if llm else {}),
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}),
    }


def _chain_sql(body: str) -> str:
    """A refresh by list, and one by all of staging over its result."""
    return fx.with_inputs_sql(
        body,
        first_run=_replace_sql("list"),
        second_run=f"SELECT DISTINCT * FROM first_run WHERE NOT {_s('all')} UNION ALL SELECT * FROM clean_staging WHERE {_s('all')}",
    )


def _rejects_sql(kept: str = "true") -> str:
    counts = (f"SELECT '{c}' AS column_name, count(*) AS n_rejected FROM base WHERE {cond} AND {kept}" for c, (cond, _) in fx.BAD_VALUES.items())
    return fx.with_inputs_sql("SELECT * FROM (" + " UNION ALL ".join(counts) + ") WHERE n_rejected > 0")


def _sync_table_status_sql() -> str:
    """Status after the by-practice job with scope (refresh practices x list measures)."""
    p = ", ".join(map(str, fx.REFRESH_PRACTICES))
    kind_s = f"coalesce(practice_id IN ({p}) AND measure_id IN ({_M_LIST}), false)"
    ctes = {
        "kept_all": f"SELECT * FROM clean_prod WHERE NOT {kind_s}",
        "removed": f"SELECT count(*) AS n FROM clean_prod WHERE {kind_s}",
        "kept": "SELECT DISTINCT * FROM kept_all WHERE (SELECT n FROM removed) > 0"
        " UNION ALL SELECT * FROM kept_all WHERE (SELECT n FROM removed) = 0",
        "result": f"SELECT * FROM kept UNION ALL SELECT * FROM clean_staging WHERE {kind_s}",
        "hw": f"SELECT practice_id, max(visit_dt) AS enddate FROM result WHERE practice_id IN ({p}) GROUP BY practice_id",
    }
    return fx.with_inputs_sql(_REFRESH_BODY, **ctes)
