"""Incremental publish: rewrite only the partitions that hold rows of the slice.

The full publish of a bucketed table (``plans.sync``) rewrites the whole table
per refresh, as the original job does.  A table published here is partitioned

* by a column of the slice (``practice_id``), or
* by the slice's hash (``slices=N``): ``pmod(hash(practice_id, measure_id), N)``.
  Any layout can be refreshed this way, its files sorted by its own key, however
  far that key starts from the practice.  A column of very many values
  (``MAX_PARTITIONS``) is partitioned this way too.

A refresh finds the partitions that hold rows of the slice, in the table or in
staging, and rewrites these only -- provided that the rest of the table would
come out unchanged, which the full semantics guarantee only if

* the untouched partitions hold no dirty rows (the cleaning filter applies to
  the whole table), and
* when the slice removes rows, the untouched partitions hold no duplicate
  rows (the conditional de-duplication applies to the whole table too).

Both facts are recorded as table properties by the publisher itself and are
checked before anything is written.  A table that does not qualify is refused
(partitioned by a column) or rewritten in all its slices (by hash).

Counts come from the inputs before the write and from the written files after
it; the two must agree.  The new partitions are switched all at once
(``plans.generations``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from slicerefresh.operators.audit import AuditCounts, WrittenMismatch, check_written, input_counts, written_counts
from slicerefresh.operators.clean import DIRTY_CHAR, DIRTY_COLUMN, control_char_filter
from slicerefresh.operators.replace import distinct_parts, distinct_rows, has_duplicates, should_dedupe, slice_select
from slicerefresh.operators.scope import ResolvedScope
from slicerefresh.plans import generations as gen
from slicerefresh.plans.generations import LITERAL_VALUES, partition_columns, table_properties
from slicerefresh.plans.publish import PARQUET_OPTIONS, PublishError, _version_id, default_num_buckets, small_scans
from slicerefresh.schema import CANONICAL_SCHEMA, SLICE_KEYS, Layout, conform
from slicerefresh.sources.files import folders

__all__ = ["LITERAL_VALUES", "NotIncremental", "partition_columns", "publish_partitioned", "sync_incremental", "table_properties"]

CLEAN_PROPERTY = "slicerefresh.clean"  # which column holds no such character, see _cleaned
DISTINCT_PROPERTY = "slicerefresh.distinct"
SLICES_PROPERTY = "slicerefresh.slices"  # number of hash partitions, for tables published by slice
SLICE_COLUMN = "slice_no"
#: A column of more values than this is not partitioned by its values, but by this number of slices or more.
MAX_PARTITIONS = 2_000
WIDE_SLICES = 500
#: Partitions of more files than this each, small ones on average, are put together anew when they are rewritten.
FILES_IN_A_PARTITION = 8
SMALL_FILE = 8 << 20


class NotIncremental(PublishError):
    """The table does not meet the preconditions of an exact incremental refresh."""


@dataclass
class StagedPartitions:
    """Rewritten partitions of ``table``, written and verified, not yet switched."""

    table: str
    col: str
    path: str
    audit: AuditCounts
    touched: list
    written: dict  # partition value -> folder
    deduped: bool
    distinct: bool
    schema: StructType
    base: str | None = None  # the table's version that the refresh was made from; null for a new table
    properties: dict = field(default_factory=dict)

    def new_rows(self, spark: SparkSession) -> DataFrame | None:
        return spark.read.schema(self.schema).parquet(self.path) if self.written else None

    def whole(self, spark: SparkSession) -> DataFrame:
        """The whole table as it will be after the switch, a slice's number included."""
        new = self.new_rows(spark)
        if self.base is None:
            return new if new is not None else spark.createDataFrame([], self.schema)
        current = spark.table(gen.physical(spark, self.table))
        untouched = within(current, self.col, self.touched, inside=False)
        return untouched if new is None else untouched.unionByName(new, allowMissingColumns=True)

    def result(self, spark: SparkSession) -> DataFrame:
        """The whole table as it will read after the switch."""
        return self.whole(spark).drop(SLICE_COLUMN)


def _cleaned(column: str | None, char: str) -> str:
    """The clean property: the column and the character's code point, or ``none``."""
    return f"{column}:{ord(char)}" if column else "none"


def slice_number(n: int, keys: tuple[str, ...] = SLICE_KEYS) -> Column:
    """Hash partition of a row: all rows of one (practice, measure) are in one."""
    return F.pmod(F.hash(*keys), F.lit(n)).cast("int")


def within(df: DataFrame, col: str, values: list, inside: bool = True) -> DataFrame:
    """Rows whose ``col`` is (or is not) one of ``values``; null is none of them."""
    if len(values) <= gen.LITERAL_VALUES:
        hit = F.coalesce(F.col(col).isin(values), F.lit(False)) if values else F.lit(False)
        return df.where(hit if inside else ~hit)
    side = df.sparkSession.createDataFrame([(v,) for v in values], f"`{col}` {df.schema[col].dataType.simpleString()}")
    return df.join(side, col, "left_semi" if inside else "left_anti")


def _partition_location(spark: SparkSession, table: str, col: str, v) -> str:
    return gen.partition_location(spark, table, col, v)


def _written_partitions(spark: SparkSession, path: str, col: str, kind) -> dict:
    """Partition value to folder, from the names of the written folders."""
    out = {}
    for name, place in folders(spark, path, f"{col}=").items():
        text = gen.unescaped(name).split("=", 1)[1]
        if text != "__HIVE_DEFAULT_PARTITION__":
            out[text if kind.simpleString() == "string" else int(text)] = place
    return out


def _order(col: str, layout: Layout) -> list[str]:
    return [col, *[k for k in layout.key if k != col]]


def _spread(df: DataFrame, col: str, layout: Layout) -> DataFrame:
    """Range-partition by the full layout key: a hot practice is split over many
    tasks, each task holds few partitions."""
    return df.repartitionByRange(*_order(col, layout))


def _write_partitioned(df: DataFrame, path: str, col: str, layout: Layout) -> None:
    """Sort by the layout key, write by partition.

    The rows of a partition must be in few tasks: spread ones, or those of files
    that hold one partition each, which stay where they are.
    """
    df.sortWithinPartitions(*_order(col, layout)).write.mode("errorifexists").options(**PARQUET_OPTIONS).partitionBy(col).parquet(path)


def _crowded(table: DataFrame, col: str, values: list) -> bool:
    """Whether the files of these partitions are many and small (no column is read; two numbers reach the driver)."""
    files = within(table.select(col, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size")), col, values)
    r = files.select("f", "size").distinct().agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    return r["n"] > FILES_IN_A_PARTITION * len(values) and r["size"] < SMALL_FILE * r["n"]


def _partitioned_rows(rows: DataFrame, col: str, slices: int | None) -> DataFrame:
    return rows.withColumn(SLICE_COLUMN, slice_number(slices)) if col == SLICE_COLUMN else rows


def publish_partitioned(
    df: DataFrame,
    table: str,
    root: str,
    layout: Layout,
    *,
    partition_col: str = "practice_id",
    slices: int | None = None,
    clean_column: str | None = DIRTY_COLUMN,
    clean_char: str = DIRTY_CHAR,
    check_distinct: bool = True,
    schema=CANONICAL_SCHEMA,
    like: str | None = None,
) -> str:
    """Create a partitioned layout table from ``df`` (cleaned first).

    ``slices`` partitions it by the slice's hash instead of ``partition_col``.
    So does a ``partition_col`` of more than ``MAX_PARTITIONS`` values: the
    catalog's statements and the folders would grow with the values, and one
    refresh would take as many as it has values in scope.
    With ``check_distinct`` one duplicate check over the written rows records
    whether the table holds duplicate rows (it shuffles their hashes).
    ``like`` is a table partitioned here that ``df`` is read from: the new one is
    partitioned as it is, so that rows are sorted where they lie and not shuffled.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        raise PublishError(f"{table} exists; refresh it with sync_incremental")
    rows = conform(df, schema)
    if clean_column:
        rows = control_char_filter(rows, clean_column, clean_char)
    if like:
        slices = table_properties(spark, like).get(SLICES_PROPERTY)
        slices, rows = int(slices) if slices else None, rows.select(*spark.table(like).columns)
    elif not slices and rows.select(partition_col).distinct().limit(MAX_PARTITIONS + 1).count() > MAX_PARTITIONS:
        slices = max(WIDE_SLICES, default_slices(spark))
        rows = rows.select(*[c for c in rows.columns if c != partition_col], partition_col)  # as a table partitioned by it has them
    col = SLICE_COLUMN if slices else partition_col
    path = f"{root.rstrip('/')}/{_version_id()}"
    full = _partitioned_rows(rows, col, slices)
    with small_scans(spark):
        _write_partitioned(full if like else _spread(full, col, layout), path, col, layout)
        back = spark.read.schema(full.schema).parquet(path)
        distinct = check_distinct and not has_duplicates(back)
    gen.create_generations(spark, table, full.schema, col, path, _properties(_cleaned(clean_column, clean_char), distinct, slices))
    gen.point(spark, table, gen.generation(table, "a"))
    return path


def _properties(clean: str, distinct: bool, slices: int | None) -> dict[str, str]:
    out = {CLEAN_PROPERTY: clean, DISTINCT_PROPERTY: str(distinct).lower()}
    return out | ({SLICES_PROPERTY: str(slices), gen.HIDDEN_PROPERTY: SLICE_COLUMN} if slices else {})


def default_slices(spark: SparkSession, source_bytes: int | None = None) -> int:
    """Slices of a new table: about 256 MB each, and several per core, so that a small slice of the table touches few."""
    return max(4 * spark.sparkContext.defaultParallelism, default_num_buckets(spark, source_bytes, 256 << 20))


def sync_incremental(spark: SparkSession, table: str, **kwargs) -> StagedPartitions:
    """Refresh ``table`` in place, rewriting only the partitions in scope
    (stage, verify, switch).  Same rows as the full refresh of the whole
    table; the preconditions are checked first (see module docstring)."""
    with small_scans(spark):
        staged = stage_incremental(spark, table, **kwargs)
    switch_partitions(spark, staged)
    return staged


def touched_values(scope: ResolvedScope, col: str) -> list:
    """The partition values a refresh touches: the scope's values of ``col``.

    One value per partition that is dropped and added in the catalog, so that
    the driver holds as many as its catalog statements name anyway.
    """
    ks = scope.parts[col]
    if ks.literal:
        return [v for v in ks.values if v is not None]
    return [r[0] for r in ks.frame.collect() if r[0] is not None]


def touched_slices(current: DataFrame, staging: DataFrame, scope: ResolvedScope, slices: int) -> list[int]:
    """Slices that hold rows in scope, in the table or in staging.

    Reads the key columns only, the slice's filter pushed down to the files'
    row groups; at most ``slices`` numbers reach the driver.
    """
    keys = scope.keys
    held = scope.select(current.select(SLICE_COLUMN, *keys)).select(SLICE_COLUMN)
    came = scope.select(staging.select(*keys)).select(slice_number(slices, tuple(keys)).alias(SLICE_COLUMN))
    return sorted(r[0] for r in held.unionByName(came).distinct().collect())


def stage_incremental(
    spark: SparkSession,
    table: str,
    *,
    staging: DataFrame,
    scope: ResolvedScope,
    root: str,
    layout: Layout,
    dedupe: str = "reference",
    clean_column: str | None = DIRTY_COLUMN,
    clean_char: str = DIRTY_CHAR,
    schema=CANONICAL_SCHEMA,
) -> StagedPartitions:
    """Write and verify the new versions of the partitions in scope.

    Kept rows lie in files of one partition each, in order, and are written from
    there; only the added rows are shuffled.  Partitions that refreshes have left
    in many small files are put together anew.
    """
    parts = partition_columns(spark, table)
    if len(parts) != 1:
        raise NotIncremental(f"{table} must be partitioned by exactly one column, is by {parts}")
    col, props = parts[0], table_properties(spark, table)
    slices = int(props[SLICES_PROPERTY]) if col == SLICE_COLUMN else None
    if not slices and col not in scope.parts:
        raise NotIncremental(f"the scope has no value set for the partition column {col!r}")
    if clean_column and props.get(CLEAN_PROPERTY) != _cleaned(clean_column, clean_char):
        raise NotIncremental(
            f"{table} is not known to be clean of {clean_char!r} in {clean_column} (but {props.get(CLEAN_PROPERTY)});"
            " publish it with publish_partitioned first"
        )
    whole = spark.table(gen.physical(spark, table))
    stg = conform(staging, schema)
    if clean_column:
        stg = control_char_filter(stg, clean_column, clean_char)
    values = touched_slices(whole, stg, scope, slices) if slices else touched_values(scope, col)

    def rows_of(values: list) -> DataFrame:
        rows = conform(within(whole, col, values), schema)  # partition pruning
        return control_char_filter(rows, clean_column, clean_char) if clean_column else rows

    current = rows_of(values)
    # One small job over the touched partitions (key and cleaning columns
    # only) gives the input counts and the dedupe decision.
    counts = input_counts(current, stg, scope)
    deduped = should_dedupe(dedupe, counts.to_remove)
    was_distinct = props.get(DISTINCT_PROPERTY) == "true"
    if deduped and not was_distinct:
        if not slices:
            raise NotIncremental(
                f"{table}: the slice removes rows, so the whole table must be de-duplicated, and it is not known"
                " to be free of duplicates; use the full refresh"
            )
        values = sorted({*values, *(int(n.split("=", 1)[1]) for n in gen.partition_names(spark, table))})
        current = rows_of(values)
        counts = input_counts(current, stg, scope)

    kept, some = scope.exclude(current), None
    if deduped and not was_distinct:
        kept, some = distinct_parts(kept)
    added = slice_select(stg, scope)
    added_distinct = not has_duplicates(added)
    moved = added if some is None else some.unionByName(added)
    if kept is not None and (not scope.stays_put or _crowded(whole, col, values)):
        kept, moved = None, kept.unionByName(moved)
    result = _spread(_partitioned_rows(moved, col, slices), col, layout)
    if kept is not None:
        result = _partitioned_rows(kept, col, slices).unionByName(result)
    path = f"{root.rstrip('/')}/{_version_id()}"
    staged = _stage(spark, result, table, path, col, layout, scope, counts, exact=not deduped or was_distinct)
    staged.touched, staged.deduped, staged.base = values, deduped, props.get(gen.VERSION_PROPERTY)
    # Untouched partitions are as distinct as before; touched ones hold kept rows
    # (distinct if the table was, or made so) and added rows, which never collide with them.
    staged.distinct = (was_distinct or deduped) and added_distinct
    staged.properties = {DISTINCT_PROPERTY: str(staged.distinct).lower()}
    return staged


def stage_new(
    spark: SparkSession, table: str, *, current: DataFrame, staging: DataFrame, scope: ResolvedScope, root: str, layout: Layout, slices: int, dedupe: str = "reference", like: StagedPartitions | None = None
) -> StagedPartitions:
    """Write and verify the first version of a table by slices: the whole result of the refresh.

    ``like`` is a staged version made from the same rows by the same refresh, with
    as many slices: its rows are sorted anew where they lie.
    """
    cur, stg = (control_char_filter(conform(df)) for df in (current, staging))
    counts = input_counts(cur, stg, scope)
    deduped = should_dedupe(dedupe, counts.to_remove)
    added = slice_select(stg, scope)
    if like is not None and like.written:
        result = like.new_rows(spark)
    else:
        kept = distinct_rows(scope.exclude(cur)) if deduped else scope.exclude(cur)
        result = _spread(_partitioned_rows(kept.unionByName(added), SLICE_COLUMN, slices), SLICE_COLUMN, layout)
    path = f"{root.rstrip('/')}/{_version_id()}"
    staged = _stage(spark, result, table, path, SLICE_COLUMN, layout, scope, counts, exact=not deduped)
    if like is not None and counts.after_removal != like.audit.after_removal:
        raise WrittenMismatch(f"{table}: {counts.after_removal} kept rows written, {like.audit.after_removal} in the version it was made from")
    staged.touched, staged.deduped = list(staged.written), deduped
    staged.distinct = like.distinct if like is not None else not has_duplicates(added) if deduped else not has_duplicates(staged.new_rows(spark)) if staged.written else True
    staged.properties = _properties(_cleaned(DIRTY_COLUMN, DIRTY_CHAR), staged.distinct, slices)
    return staged


def _stage(spark, result: DataFrame, table, path, col, layout, scope, counts: AuditCounts, exact: bool) -> StagedPartitions:
    """Write the partitions, then count what the files hold: kept rows are those outside the slice."""
    # The table's own column comes last in the files' schema, as the catalog has it.
    schema = StructType([f for f in result.schema.fields if f.name != col] + [StructField(col, IntegerType()) if col == SLICE_COLUMN else result.schema[col]])
    _write_partitioned(result, path, col, layout)
    written = _written_partitions(spark, path, col, schema[col].dataType)
    held = written_counts(spark.read.schema(schema).parquet(path), scope)
    check_written(table, counts, held, exact)
    return StagedPartitions(table, col, path, counts, [], written, False, False, schema)


@dataclass
class PartitionSwitch:
    """A prepared version of a table and what it replaces, so that it can be undone."""

    staged: StagedPartitions
    ready: gen.Prepared


def prepare_partitions(spark: SparkSession, staged: StagedPartitions) -> PartitionSwitch:
    """Make the new version ready in the catalog; readers still have the one before."""
    if staged.base is None:
        gen.create_generations(spark, staged.table, staged.schema, staged.col, staged.path, staged.properties)
        return PartitionSwitch(staged, gen.Prepared(staged.table, None, gen.generation(staged.table, "a")))
    kinds = {f.name: f for f in spark.table(gen.physical(spark, staged.table)).schema.fields}
    schema = StructType([kinds[f.name] if f.name == staged.col else f for f in staged.schema.fields])
    locations = {v: staged.written.get(v) for v in staged.touched}
    change = gen.Change(staged.col, staged.base, staged.path, locations, schema, staged.properties)
    return PartitionSwitch(staged, gen.prepare(spark, staged.table, change))


def flip_partitions(spark: SparkSession, sw: PartitionSwitch) -> None:
    """Point readers at the prepared version, in one catalog statement."""
    gen.flip(spark, sw.ready)


def switch_partitions(spark: SparkSession, staged: StagedPartitions) -> PartitionSwitch:
    """Prepare and flip.  Refused if another refresh was switched since this one
    was staged; a failure leaves readers with the version before."""
    sw = prepare_partitions(spark, staged)
    try:
        flip_partitions(spark, sw)
    except Exception:
        undo_partitions(spark, sw)
        raise
    return sw


def undo_partitions(spark: SparkSession, sw: PartitionSwitch) -> None:
    """Give readers back the version before the switch."""
    gen.undo(spark, sw.ready)


def adopt(spark: SparkSession, table: str) -> None:
    """Turn a partitioned catalog table into a name over two generations (once; readers of the old table are cut off)."""
    name, first = gen._quote(table), gen.generation(table, "a")
    spark.sql(f"ALTER TABLE {name} RENAME TO {gen._quote(first)}")
    gen.set_properties(spark, first, {gen.VERSION_PROPERTY: gen._describe(spark, gen._quote(first))["Location"]})
    gen.point(spark, table, first)
