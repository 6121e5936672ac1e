"""``~``-delimited snapshots: one codec for both directions.

The reference writes and reads snapshots with only the delimiter set, which
loses microseconds, merges ``''`` with null, splits rows at newlines and
trims control characters at field ends (so a dirty row can turn clean after
one round trip).  The option set below survives a round trip of every value
kind the fact holds.  Its files are gzipped, which any reader of Spark's tells by
their names.

Every export holds a manifest (``_format.json``): codec, header, columns and
types, the rows it holds and the files they are in.  It decides how the folder
is read; a reader that asks for something else, a first line that contradicts
it, and a folder from which files are missing are refused.

An export may be divided into folders by a value (``part_value=...``), so that a
later export replaces only some of them.  The manifest goes first and comes back
last, so that a reader in between is refused.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.sources.files import data_files, delete, exists, folders, read_json, write_json

# --- Fixed values: the snapshot format of the original job ------------------
DELIMITER = "~"
# The only option the original job sets on its snapshots (both directions).
LEGACY_OPTIONS = {"sep": DELIMITER}
# ---------------------------------------------------------------------------

CODECS = ("lossless", "legacy")
MANIFEST = "_format.json"
#: Column that names the columns of a row whose value could not be parsed (``*``: the row has not as many fields as it should).
REJECTS = "__rejects"
_CORRUPT = "__corrupt"
#: Column (in the folders' names only) by which an export is divided.
PART = "part_value"


class FormatMismatch(ValueError):
    """A folder that is not what its manifest, or the reader, says."""

CODEC_OPTIONS = {
    "sep": DELIMITER,
    "nullValue": "\\N",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
#: Exports of this library are compressed (the legacy codec's and single files are not); such a
#: file is read by one task, so that none holds more than so many rows.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"}


def _options(header: bool) -> dict[str, str]:
    opts = dict(CODEC_OPTIONS)
    opts["header"] = "true" if header else "false"
    # With a header the file's column names must be those of the schema.
    opts["enforceSchema"] = "false" if header else "true"
    return opts


def _escaped(c: Column) -> Column:
    """Text without line ends and without a value that reads as null: a
    backslash doubled, line ends as ``\\n`` and ``\\r``.  Every row is one line,
    so files split."""
    for raw, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(written))
    return c


def _unescaped(c: Column) -> Column:
    parts = F.split(c, r"\\\\", -1)  # at doubled backslashes
    plain = F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def _text_columns(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """How the folder at ``path`` was written; null without a manifest.

    Snapshots of earlier versions have a note beside the folder instead.
    """
    inside, beside = f"{path.rstrip('/')}/{MANIFEST}", f"{path.rstrip('/')}.format"
    if exists(spark, inside):
        return read_json(spark, inside)
    return json.loads(spark.read.text(beside).first()[0]) if exists(spark, beside) else None


def _write_manifest(spark: SparkSession, path: str, schema: T.StructType, header: bool, codec: str, rows: int | None, **more) -> None:
    if rows is None:
        rows = _parsed(spark, path, schema, header, "PERMISSIVE", codec).count()
    files, size = data_files(spark, path)
    types = [f.dataType.simpleString() for f in schema.fields]
    write_json(spark, f"{path.rstrip('/')}/{MANIFEST}",
               {"codec": codec, "header": header, "columns": schema.names, "types": types, "rows": rows, "files": files, "bytes": size, **more})


def check_folder(spark: SparkSession, path: str, schema: T.StructType, header: bool, codec: str) -> None:
    """Refuse a folder that is not what the reader takes it for.

    The manifest must say the same; as many files and bytes must be there as
    were written; the first line must be the header, or have one field for each
    column and not be a header (a job of one task, without a manifest too).
    """
    stored = read_manifest(spark, path)
    if stored is not None:
        asked = {"codec": codec, "header": header, "columns": schema.names}
        wrong = {k: stored[k] for k, v in asked.items() if stored[k] != v}
        if wrong:
            raise FormatMismatch(f"{path} was written with {wrong}, not {({k: asked[k] for k in wrong})}")
        if "files" in stored and (held := data_files(spark, path)) != (stored["files"], stored["bytes"]):
            raise FormatMismatch(f"{path} holds {held[0]} files of {held[1]} bytes, {stored['files']} of {stored['bytes']} were written")
    if "*" in path or not data_files(spark, path)[1]:
        return
    options = {**(LEGACY_OPTIONS if codec == "legacy" else CODEC_OPTIONS), "header": "false"}
    first = spark.read.options(**options).csv(path)  # as many columns as the first line has fields
    first = first.drop(PART)
    line = list(first.head(1)[0])
    if header != (line == schema.names):
        raise FormatMismatch(f"the first line of {path} is {'a' if not header else 'no'} header of {schema.names}")
    if len(first.columns) != len(schema.names):
        raise FormatMismatch(f"the first line of {path} has {len(first.columns)} fields, not {len(schema.names)}")


def _parsed(spark: SparkSession, path: str, schema: T.StructType, header: bool, mode: str, codec: str) -> DataFrame:
    if codec == "lossless":
        return spark.read.options(**_options(header), mode=mode).schema(schema).csv(path)
    return spark.read.options(**LEGACY_OPTIONS, header=str(header).lower()).schema(_as_text(schema)).csv(path)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = False,
    mode: str = "PERMISSIVE",
    codec: str = "lossless",
    rejects: bool = False,
) -> DataFrame:
    """Read a snapshot directory with an explicit schema (never inferred).

    ``schema`` gives the file column order and the types to parse into; with
    ``PERMISSIVE`` a value that does not parse becomes null, as in the
    original job; ``FAILFAST`` raises instead.  The folder is checked first
    (``check_folder``).

    ``rejects`` adds the column ``__rejects``: the names of a row's columns whose
    value became null that way.  It comes from the same scan: Spark's
    corrupt-record column keeps the line of such a row, and only these lines
    are parsed once more, as text.

    ``codec="legacy"`` reads folders written by the original job (delimiter
    only): every field is read as text and then typed; timestamp text carries
    its zone offset, so it is parsed as an instant and turned into the
    session's wall-clock time.  What that format already lost on writing
    (sub-millisecond digits, control characters at field ends, the
    difference between empty and null) cannot come back.
    """
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, got {codec!r}")
    check_folder(spark, path, schema, header, codec)
    if codec == "lossless" and not rejects:
        return _text_columns(_parsed(spark, path, schema, header, mode, codec), _unescaped)
    if codec == "lossless":
        kept = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType(), True)])
        rows = spark.read.options(**_options(header), mode=mode, columnNameOfCorruptRecord=_CORRUPT).schema(kept).csv(path)
        text = F.from_csv(_CORRUPT, _as_text(schema).simpleString()[len("struct<") : -1].replace(":", " "), CODEC_OPTIONS)
        rows = rows.withColumn(_CORRUPT, F.when(F.col(_CORRUPT).isNotNull(), text))
        lost = {f.name: F.col(f"{_CORRUPT}.`{f.name}`").isNotNull() & F.col(f"`{f.name}`").isNull() for f in schema.fields}
        named = _named(lost)
        named = F.when(F.col(_CORRUPT).isNull(), F.array().cast("array<string>")).when(F.size(named) > 0, named).otherwise(F.array(F.lit("*")))
        return _text_columns(rows.withColumn(REJECTS, named).drop(_CORRUPT), _unescaped)
    raw = _parsed(spark, path, schema, header, mode, codec)
    strict = mode.upper() == "FAILFAST"
    typed = [_typed(f, strict) for f in schema.fields]
    if not rejects:
        return raw.select(*typed)
    lost = {f.name: F.col(f"`{f.name}`").isNotNull() & t.isNull() for f, t in zip(schema.fields, typed, strict=True)}
    return raw.select(*typed, _named(lost).alias(REJECTS))


def _named(lost: dict[str, Column]) -> Column:
    """The names whose condition holds."""
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in lost.items()]), lambda x: x.isNotNull())


def reject_counts(df: DataFrame) -> DataFrame:
    """``column_name, n_rejected``: values that could not be parsed, of a frame read with ``rejects``."""
    named = df.select(F.explode(REJECTS).alias("column_name"))
    return named.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_rejected"))


def _typed(field: T.StructField, strict: bool):
    c = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return c
    if isinstance(field.dataType, T.TimestampNTZType):
        instant = c.cast("timestamp") if strict else c.try_cast("timestamp")
        return instant.cast(T.TimestampNTZType()).alias(field.name)
    return (c.cast(field.dataType) if strict else c.try_cast(field.dataType)).alias(field.name)


def write_delimited(
    df: DataFrame,
    path: str,
    *,
    header: bool = False,
    columns: list[str] | None = None,
    single_file: bool = False,
    mode: str = "overwrite",
    codec: str = "lossless",
    rows: int | None = None,
    **more,
) -> None:
    """Write a snapshot: one file per task, or one file with ``single_file``.

    ``single_file`` funnels all rows through one task (the original job does
    this); keep it for small exports only.  ``codec="legacy"`` writes what
    the original job wrote, for consumers that still read that format.  The
    manifest's row count is ``rows`` where the caller knows it, else the
    written lines are counted; ``more`` is noted in it too.
    """
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, got {codec!r}")
    out = df.select(*columns) if columns else df
    if single_file:
        out = out.coalesce(1)
    schema = out.schema
    opts = {**LEGACY_OPTIONS, "header": str(header).lower()}
    if codec == "lossless":
        opts, out = _options(header) | ({} if single_file else COMPRESSED), _text_columns(out, _escaped)
    out.write.mode(mode).options(**opts).csv(path)
    _write_manifest(df.sparkSession, path, schema, header, codec, rows if mode == "overwrite" else None, **more)


def write_parts(df: DataFrame, path: str, part: Column, *, header: bool, columns: list[str], codec: str, rows: int, version: str) -> None:
    """Write an export divided into folders by ``part``, in place of what is there.

    A task writes a file for each value that it holds, so the rows of a value
    must lie in few tasks: those of a table partitioned by ``part`` do.
    """
    delete(df.sparkSession, f"{path.rstrip('/')}/{MANIFEST}")
    schema = _write_parts(df, path, part, header, columns, codec, "static")
    _write_manifest(df.sparkSession, path, schema, header, codec, rows, version=version)


def replace_parts(df: DataFrame | None, path: str, part: Column, gone: list, spark: SparkSession, *, rows: int, version: str) -> None:
    """Replace the folders of an export whose values ``df`` holds, and delete those of ``gone``; all others stay as they are."""
    stored = read_manifest(spark, path)
    kept = T.StructType([T.StructField(c, T._parse_datatype_string(t), True) for c, t in zip(stored["columns"], stored["types"], strict=True)])
    delete(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if df is not None:
        _write_parts(df, path, part, stored["header"], stored["columns"], stored["codec"], "dynamic")
    for name, place in folders(spark, path, f"{PART}=").items():
        if unquote(name.split("=", 1)[1]) in {str(v) for v in gone}:
            delete(spark, place)
    _write_manifest(spark, path, kept, stored["header"], stored["codec"], rows, version=version)


def _write_parts(df: DataFrame, path: str, part: Column, header: bool, columns: list[str], codec: str, mode: str) -> T.StructType:
    out = df.withColumn(PART, part).select(*columns, PART)
    schema = T.StructType([f for f in out.schema.fields if f.name != PART])
    opts = {**LEGACY_OPTIONS, "header": str(header).lower()}
    if codec == "lossless":
        text = [_escaped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in schema.fields]
        opts, out = _options(header) | COMPRESSED, out.select(*text, PART)
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PART).options(**opts).csv(path)
    return schema
