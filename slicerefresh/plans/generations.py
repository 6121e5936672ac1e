"""A partitioned table whose versions change hands in one catalog statement.

A published name is a view over one of two partitioned catalog tables, its
generations ``a`` and ``b``.  Both hold the same partitions but for the last
refresh.  A refresh brings the generation that nobody reads to the new version
-- partition by partition, as many catalog statements as it takes -- and then
one ``ALTER VIEW`` points the name at it.  A reader sees the version before or
the version after, never a partition missing and never a column list in between.

What a refresh changed is noted beside its files (``_switch.json``), so that the
other generation catches up by the same few partitions at the next refresh.  A
generation whose state is not known (a job ended in between) is rebuilt from the
catalog's list of the one in use.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slicerefresh.plans.publish import PublishError, _describe, _quote, evolve_table
from slicerefresh.sources.files import exists, read_json, write_json

VERSION_PROPERTY = "slicerefresh.version"  # the folder of the version that a generation holds
HIDDEN_PROPERTY = "slicerefresh.hidden"  # a partition column that the view leaves out
SWITCH_NOTE = "_switch.json"

#: Catalog statements name so many partitions at a time; longer lists of values are joined, not written into a filter.
LITERAL_VALUES = 1_000

_SUFFIX = "__generation_"
_ACTIVE = re.compile(rf"FROM (.+{_SUFFIX}[ab]`)\s*$")


def generation(table: str, which: str) -> str:
    db, _, name = table.rpartition(".")
    return f"{db}.{name}{_SUFFIX}{which}" if db else f"{name}{_SUFFIX}{which}"


def active_generation(spark: SparkSession, table: str) -> str | None:
    """The generation that ``table`` reads; null if it is no such view."""
    if not spark.catalog.tableExists(table):
        return None
    found = _ACTIVE.search(_describe(spark, _quote(table)).get("View Text", ""))
    return found.group(1).replace("`", "") if found else None


def other_generation(name: str) -> str:
    return name[:-1] + ("b" if name.endswith("a") else "a")


def physical(spark: SparkSession, table: str) -> str:
    """The catalog table that holds the rows of ``table``."""
    return active_generation(spark, table) or table


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """Properties of the table, or of the generation in use."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(physical(spark, table))}").collect()}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Partition columns from ``DESCRIBE`` (a catalog call, no Spark job;
    ``Catalog.listColumns`` runs jobs)."""
    cols, section = [], False
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(physical(spark, table))}").collect():
        name = (r["col_name"] or "").strip()
        if name == "# Partition Information":
            section = True
        elif section and (not name or (name.startswith("#") and name != "# col_name")):
            break
        elif section and name != "# col_name":
            cols.append(name)
    return cols


# --- partitions of one catalog table ------------------------------------------


def unescaped(name: str) -> str:
    """A partition's name (``col=value``) without the catalog's and the folders' %XX escapes."""
    return unquote(name)


def value_sql(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v)


def _spec(col: str, v) -> str:
    return f"PARTITION (`{col}` = {value_sql(v)})"


def _batches(items: list) -> list[list]:
    return [items[i : i + LITERAL_VALUES] for i in range(0, len(items), LITERAL_VALUES)]


def add_partitions(spark: SparkSession, table: str, col: str, locations: dict) -> None:
    for part in _batches(list(locations.items())):
        parts = " ".join(f"{_spec(col, v)} LOCATION {value_sql(loc)}" for v, loc in part)
        spark.sql(f"ALTER TABLE {_quote(table)} ADD IF NOT EXISTS {parts}")


def drop_partitions(spark: SparkSession, table: str, col: str, values: list) -> None:
    """Forget partitions; the tables are external, their files stay."""
    for part in _batches(values):
        spark.sql(f"ALTER TABLE {_quote(table)} DROP IF EXISTS " + ", ".join(_spec(col, v) for v in part))


def set_properties(spark: SparkSession, table: str, pairs: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {_quote(table)} SET TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in pairs.items()) + ")")


def partition_names(spark: SparkSession, table: str) -> set[str]:
    """Partitions of a table as the catalog prints them (``col=value``), unescaped."""
    return {unescaped(r[0]) for r in spark.sql(f"SHOW PARTITIONS {_quote(physical(spark, table))}").collect()}


def partition_location(spark: SparkSession, table: str, col: str, v) -> str:
    """The partition's own location (the output also lists the table's, later)."""
    name = physical(spark, table)
    in_partition = False
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(name)} {_spec(col, v)}").collect():
        field = (r["col_name"] or "").strip()
        if field.startswith("# Detailed Partition Information"):
            in_partition = True
        elif field.startswith("#") and in_partition:
            break
        elif in_partition and field == "Location":
            return r["data_type"]
    raise PublishError(f"{name}: no location for partition {col}={v}")


def file_folders(rows: DataFrame) -> list[str]:
    """Folders of the files that ``rows`` (of a catalog table) come from: files are
    told apart first, so that the pattern runs once per file; folders reach the driver."""
    files = rows.select(F.col("_metadata.file_path").alias("f")).groupBy("f").count()
    folders = files.select(F.regexp_extract("f", "^(.*)/[^/]+$", 1).alias("d")).distinct()
    return [unquote(r[0]) for r in folders.collect()]


# --- generations -----------------------------------------------------------------


def _columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _create(spark: SparkSession, name: str, schema: StructType, col: str, path: str, properties: dict[str, str]) -> None:
    fields = StructType([f for f in schema.fields if f.name != col] + [schema[col]])
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(
        f"CREATE TABLE {_quote(name)} ({_columns_ddl(fields)}) USING parquet PARTITIONED BY (`{col}`)"
        f" LOCATION {value_sql(path)} TBLPROPERTIES ({pairs})"
    )
    if exists(spark, path):
        spark.sql(f"MSCK REPAIR TABLE {_quote(name)}")


def _one_slash(path: str) -> str:
    """A path with one slash behind its scheme, as the catalog has it (file paths have three)."""
    return re.sub(r"^(\w[\w+.-]*):/+", r"\1:/", path)


def _select_sql(spark: SparkSession, name: str) -> str:
    hidden = table_properties(spark, name).get(HIDDEN_PROPERTY)
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c != hidden)
    return f"SELECT {columns} FROM {_quote(name)}"


def create_generations(spark: SparkSession, table: str, schema: StructType, col: str, path: str, properties: dict[str, str]) -> None:
    """Both generations over the version folder at ``path``; no reader has them yet."""
    for which in "ab":
        spark.sql(f"DROP TABLE IF EXISTS {_quote(generation(table, which))}")
        _create(spark, generation(table, which), schema, col, path, {**properties, VERSION_PROPERTY: path})


def drop_generations(spark: SparkSession, table: str) -> None:
    for which in "ab":
        spark.sql(f"DROP TABLE IF EXISTS {_quote(generation(table, which))}")


def point(spark: SparkSession, table: str, name: str) -> None:
    """The one statement that readers notice: ``table`` now reads ``name``."""
    change = "ALTER" if spark.catalog.tableExists(table) else "CREATE"
    spark.sql(f"{change} VIEW {_quote(table)} AS {_select_sql(spark, name)}")


@dataclass
class Change:
    """The partitions that a version replaces: a new folder, or none where the partition goes."""

    col: str
    base: str  # version folder that the change was made from
    path: str  # its own version folder
    locations: dict  # partition value -> folder or None
    schema: StructType
    properties: dict[str, str]

    def note(self) -> dict:
        return {"col": self.col, "base": self.base, "partitions": [[v, loc] for v, loc in self.locations.items()]}


def _apply(spark: SparkSession, name: str, col: str, locations: dict) -> None:
    drop_partitions(spark, name, col, list(locations))
    add_partitions(spark, name, col, {v: loc for v, loc in locations.items() if loc is not None})


def _rebuild(spark: SparkSession, name: str, active: str) -> None:
    """Make ``name`` hold what ``active`` holds, from the catalog and the files' places.

    Partitions in the table's own folder are found there; only those that lie
    elsewhere are listed one by one.
    """
    col = partition_columns(spark, active)[0]
    schema, base = spark.table(active).schema, _one_slash(_describe(spark, _quote(active))["Location"])
    spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
    properties = {k: v for k, v in table_properties(spark, active).items() if k.startswith("slicerefresh.") and k != VERSION_PROPERTY}
    _create(spark, name, schema, col, base, {**properties, VERSION_PROPERTY: ""})
    found = {unescaped(d.rsplit("/", 1)[-1]): _one_slash(d) for d in file_folders(spark.table(active))}
    kind = schema[col].dataType

    def value(partition: str):
        text = partition.split("=", 1)[1]
        return text if kind.simpleString() == "string" else int(text)

    names = partition_names(spark, active)
    gone = [value(n) for n in partition_names(spark, name) - names]
    moved = {value(n): found.get(n) or partition_location(spark, active, col, value(n)) for n in names if not found.get(n, "").startswith(f"{base}/")}
    drop_partitions(spark, name, col, gone)
    _apply(spark, name, col, moved)


def _caught_up(spark: SparkSession, table: str, active: str) -> str:
    """The generation out of use, holding the version of ``active``."""
    idle = other_generation(active)
    now = table_properties(spark, active)
    version = table_properties(spark, idle).get(VERSION_PROPERTY, "") if spark.catalog.tableExists(idle) else ""
    if version == now[VERSION_PROPERTY]:
        return idle
    place = f"{now[VERSION_PROPERTY]}/{SWITCH_NOTE}"
    note = read_json(spark, place) if version and exists(spark, place) else None
    if note and note["base"] == version:
        set_properties(spark, idle, {VERSION_PROPERTY: ""})
        evolve_table(spark, idle, spark.table(active).schema)
        _apply(spark, idle, note["col"], {v: loc for v, loc in note["partitions"]})
    else:
        _rebuild(spark, idle, active)
    set_properties(spark, idle, {k: v for k, v in now.items() if k.startswith("slicerefresh.")})
    return idle


@dataclass
class Prepared:
    """A version that lies ready in the generation out of use."""

    table: str
    before: str | None  # the generation that readers have; null for a new table
    after: str


def prepare(spark: SparkSession, table: str, change: Change) -> Prepared:
    """Bring the generation out of use to the new version; readers notice nothing."""
    active = active_generation(spark, table)
    if active is None:
        raise PublishError(f"{table} is not published in generations; publish it with publish_partitioned")
    version = table_properties(spark, active)[VERSION_PROPERTY]
    if version != change.base:
        raise PublishError(f"{table}: staged from version {change.base}, now {version}; stage it again")
    idle = _caught_up(spark, table, active)
    set_properties(spark, idle, {VERSION_PROPERTY: ""})  # unknown until all is done
    evolve_table(spark, idle, change.schema)
    _apply(spark, idle, change.col, change.locations)
    write_json(spark, f"{change.path}/{SWITCH_NOTE}", change.note())
    set_properties(spark, idle, {**change.properties, VERSION_PROPERTY: change.path})
    spark.sql(f"REFRESH TABLE {_quote(idle)}")
    return Prepared(table, active, idle)


def flip(spark: SparkSession, ready: Prepared) -> None:
    now = active_generation(spark, ready.table)
    if now != ready.before:
        raise PublishError(f"{ready.table}: prepared over {ready.before}, now {now}; stage it again")
    point(spark, ready.table, ready.after)


def undo(spark: SparkSession, ready: Prepared) -> None:
    """Back to the version before, in one statement again; the other generation is rebuilt when it is needed."""
    if ready.before is None:
        spark.sql(f"DROP VIEW IF EXISTS {_quote(ready.table)}")
        drop_generations(spark, ready.table)
        return
    if active_generation(spark, ready.table) != ready.before:
        point(spark, ready.table, ready.before)
    set_properties(spark, ready.after, {VERSION_PROPERTY: ""})
