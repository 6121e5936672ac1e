"""Row counts of every step of a slice replacement, in as few passes as possible.

The reference runs one Spark action per count (five to eight per table).
Here the counts of both inputs come from one aggregation over a tagged
union that reads only the key and cleaning columns; the counts after removal
and after the append come from the written files, whose kept rows are those
outside the slice and whose added rows are those inside it.  So no count
depends on how often a task or a stage ran.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.operators.scope import ResolvedScope

AUDIT_COLUMNS = ("prod_full", "to_remove", "to_add", "after_removal", "after_add")

_FLAG = "__in_scope"
_TAG = "__src"


@dataclass
class AuditCounts:
    prod_full: int
    to_remove: int
    to_add: int
    after_removal: int | None = None
    after_add: int | None = None
    rejected: dict[str, int] | None = None  # values that did not parse, by column, where they were counted

    def as_row(self) -> dict:
        return asdict(self)

    def check(self) -> None:
        """Identity of the counts: after_add = after_removal + to_add."""
        if self.after_add is not None and self.after_removal is not None:
            if self.after_add != self.after_removal + self.to_add:
                raise AssertionError(f"audit identity broken: {self}")


def _tagged(current: DataFrame, staging: DataFrame, scope: ResolvedScope) -> DataFrame:
    keys = scope.keys
    cur = scope.mark(current.select(*keys), _FLAG).select(F.lit("cur").alias(_TAG), F.col(_FLAG))
    stg = scope.mark(staging.select(*keys), _FLAG).select(F.lit("stg").alias(_TAG), F.col(_FLAG))
    return cur.unionByName(stg)


def _count_exprs(extra: bool = False):
    tag, flag = F.col(_TAG), F.col(_FLAG)
    exprs = [
        F.count_if(tag == "cur").alias("prod_full"),
        F.count_if((tag == "cur") & flag).alias("to_remove"),
        F.count_if((tag == "stg") & flag).alias("to_add"),
    ]
    if extra:
        exprs.append(F.count_if(tag == "kept").alias("after_removal"))
    return exprs


def input_counts(current: DataFrame, staging: DataFrame, scope: ResolvedScope, rejects: str | None = None) -> AuditCounts:
    """One job: full, to-remove and to-add counts of the (cleaned) inputs.

    ``rejects`` is a column of ``current`` that names a row's rejected columns;
    they are counted in the same scan.

    Both inputs are reduced to their slice keys before the union, so the scan
    reads three columns (the keys and the cleaning column), and the global
    aggregate is partial per task: nothing grows with the data but the scan.
    """
    if rejects is None:
        row = _tagged(current, staging, scope).agg(*_count_exprs()).first()
        return AuditCounts(row["prod_full"], row["to_remove"], row["to_add"])
    names = [c for c in current.columns if c != rejects] + ["*"]
    cur = scope.mark(current.select(*scope.keys, rejects), _FLAG).select(F.lit("cur").alias(_TAG), _FLAG, rejects)
    stg = scope.mark(staging.select(*scope.keys), _FLAG).select(F.lit("stg").alias(_TAG), _FLAG, F.lit(None).cast("array<string>").alias(rejects))
    lost = [F.count_if(F.array_contains(rejects, c)).alias(f"rejected {c}") for c in names]
    row = cur.unionByName(stg).agg(*_count_exprs(), *lost).first()
    rejected = {c: row[f"rejected {c}"] for c in names if row[f"rejected {c}"]}
    return AuditCounts(row["prod_full"], row["to_remove"], row["to_add"], rejected=rejected)


@dataclass
class WrittenCounts:
    """What a written version holds."""

    kept: int
    added: int
    files: int
    bucket_rows: tuple[int, int] = (0, 0)  # (largest, median) rows per bucket, for bucketed files

    @property
    def rows(self) -> int:
        return self.kept + self.added


#: The bucket number in the name of a bucketed file.
_BUCKET = r"_(\d{5,})(?:\.c\d+)?\.[^/]*$"


def written_counts(files: DataFrame, scope: ResolvedScope) -> WrittenCounts:
    """Rows inside and outside the slice, per file, then in total (one job).

    Reads the key columns only.  The files' rows are counted per file first, so
    that the pattern for bucket numbers runs once per file.
    """
    flagged = scope.mark(files.select(*scope.keys, F.col("_metadata.file_path").alias("__file")), _FLAG)
    per_file = flagged.groupBy("__file").agg(F.count_if(F.col(_FLAG)).alias("added"), F.count(F.lit(1)).alias("n"))
    bucket = F.coalesce(F.regexp_extract("__file", _BUCKET, 1), F.lit(""))
    per_bucket = per_file.groupBy(bucket.alias("b")).agg(F.sum("added").alias("added"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("files"))
    r = per_bucket.agg(
        F.sum("added").alias("added"), F.sum("n").alias("n"), F.sum("files").alias("files"),
        F.max("n").alias("most"), F.percentile_approx("n", 0.5).alias("median"),
    ).first()
    n, added = int(r["n"] or 0), int(r["added"] or 0)
    return WrittenCounts(n - added, added, int(r["files"] or 0), (int(r["most"] or 0), int(r["median"] or 0)))


class WrittenMismatch(RuntimeError):
    """The written files do not hold what the inputs call for."""


def check_written(name: str, counts: AuditCounts, held: WrittenCounts, exact: bool = True, collapsed: bool = False) -> None:
    """Complete ``counts`` from the written files, or refuse them.

    Added rows must be those of the staged slice (no more of them, if rows are
    collapsed by key); kept rows those outside the slice: all of them if
    ``exact``, no more of them where duplicates go.
    """
    kept = counts.prod_full - counts.to_remove
    wrong_added = held.added > counts.to_add if collapsed else held.added != counts.to_add
    wrong_kept = held.kept != kept if exact and not collapsed else held.kept > kept or (kept > 0 and held.kept == 0)
    if wrong_added or wrong_kept:
        raise WrittenMismatch(f"{name}: the files hold {held.kept} kept and {held.added} added rows, the inputs call for {kept} and {counts.to_add}")
    if collapsed:
        counts.to_add = held.added
    counts.after_removal, counts.after_add = held.kept, held.rows
    counts.check()


def sync_audit(current: DataFrame, staging: DataFrame, scope: ResolvedScope, kept: DataFrame) -> DataFrame:
    """Lazy one-row audit of a replacement whose kept rows are ``kept``.

    ``current`` and ``staging`` are the cleaned inputs.  One aggregation over
    a tagged union; ``after_add = after_removal + to_add`` by construction of
    UNION ALL.
    """
    tagged = _tagged(current, staging, scope).unionByName(
        kept.select(F.lit("kept").alias(_TAG), F.lit(None).cast("boolean").alias(_FLAG))
    )
    counts = tagged.agg(*_count_exprs(extra=True))
    return counts.select(
        *[F.col(c) for c in AUDIT_COLUMNS[:4]],
        (F.col("after_removal") + F.col("to_add")).alias("after_add"),
    )


AUDIT_SCHEMA = T.StructType([T.StructField(c, T.LongType(), True) for c in AUDIT_COLUMNS])


def audit_frame(spark: SparkSession, rows: list[tuple[str, AuditCounts]]) -> DataFrame:
    """A small report frame (one row per table) from already computed counts."""
    schema = T.StructType([T.StructField("table_name", T.StringType(), False), *AUDIT_SCHEMA.fields])
    data = [(name, *(getattr(a, c) for c in AUDIT_COLUMNS)) for name, a in rows]
    return spark.createDataFrame(data, schema)
