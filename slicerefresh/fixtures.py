"""Test inputs derived from the driver's ``lineitem`` table.

The reference ships no data; FIXTURES.md maps ``lineitem`` onto the fact's
27 columns.  The mapping is kept here as SQL expressions that Spark and
DuckDB both accept, so the Spark queries and the SQL oracle start from the
same rows.  Everything grows with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicerefresh.schema import CANONICAL, CANONICAL_SCHEMA, conform

# --- Fixed values: the test mapping of FIXTURES.md (section B) -------------
BASE_EXPRESSIONS = {
    "practice_id": "nullif(cast(l_suppkey as int), 7)",
    "measure_id": "concat('QPP', l_returnflag, l_linestatus)",
    "visit_dt": "l_shipdate",
    "unit": "case when l_linenumber <= 4 then 'visit' else 'patient' end",
    "visit_uid": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string))",
    "created_dt": "l_shipdate",
    "datasource": "cast(null as int)",
    "denom": "1",
    "denom_exception": "case when l_linenumber = 5 then 1 else 0 end",
    "denom_exclusion": "case when l_linenumber = 6 then 1 else 0 end",
    "dob": "cast(l_shipdate as date)",
    "firstname": "concat('F', cast(l_partkey % 97 as string))",
    "gender": "case when l_partkey % 2 = 0 then 'F' else 'M' end",
    "initial_population": "1",
    "lastname": "concat('L', cast(l_partkey % 89 as string))",
    "location_id": "cast(l_partkey % 50 as int)",
    "midname": "case when l_linenumber = 7 then concat('m', chr(23)) when l_linenumber % 2 = 0 then null else 'mid' end",
    "mrn": "cast(l_orderkey % 1000 as string)",
    "notmet": "case when l_returnflag = 'R' then 0 else 1 end",
    "num": "case when l_returnflag = 'R' then 1 else 0 end",
    "num_exception": "0",
    "num_exclusion": "0",
    "patient_uid": "cast(l_orderkey as string)",
    "provider_id": "cast(l_partkey % 200 as string)",
    "result": "cast(l_quantity as float)",
    "ssn": "cast(null as string)",
    "updated_dt": "l_shipdate",
}
# prod = base plus exact duplicates of these rows.
PROD_DUPLICATES = "mod(practice_id, 10) = 0 and unit = 'visit' and result <= 5"
# staging = these base rows, with the overrides below.
STAGING_FILTER = (
    "mod(practice_id, 3) = 0 and measure_id in ('QPPAF', 'QPPNO')"
    " and not (practice_id = 6 and measure_id = 'QPPAF') and result > 10"
)
STAGING_OVERRIDES = {
    "datasource": "cast(4 as int)",
    "result": "cast(result + 100 as float)",
    "num": "1",
    "notmet": "0",
}
# Scopes.
LIST_PRACTICES = [3, 6, 7]
LIST_MEASURES = ["QPPAF", "QPPRF"]
NO_MATCH_PRACTICES = [9999]
ABSENT_PRACTICES = [1, 2]  # in prod, never in staging (staging has multiples of 3 only)
# Status table and its refresh.
STATUS_EXTRA_PRACTICE = 5000
STATUS_LATE_PRACTICE = 4
STATUS_LATE_END = "2030-01-01 00:00:00"
STATUS_EARLY = "1990-01-01 00:00:00"
REFRESH_PRACTICES = [3, 4, 6, 10]
REFRESH_REMOVED_PRACTICE = 6
REFRESHED_AT = "2031-01-01 00:00:00"
# Values that do not parse, planted by these conditions on base (for reject counts).
BAD_VALUES = {
    "denom": ("mod(practice_id, 5) = 0", "n/a"),
    "dob": ("gender = 'F' and unit = 'patient'", "2020-13-45"),
    "result": ("mrn = '7'", "abc"),
    "visit_dt": ("mod(practice_id, 10) = 0 and measure_id = 'QPPNO'", "yesterday"),
}
# Second shape over `events`: user_id as practice, event_type as measure.
EVENTS_KEYS = ("user_id", "event_type")
EVENTS_STAGING_FILTER = (
    "user_id % 4 = 0 and event_type in ('click', 'purchase') and not (user_id = 8 and event_type = 'click')"
)
EVENTS_STAGING_OVERRIDES = {"value": "value + 1000"}
# ---------------------------------------------------------------------------


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir)
    return conform(li.selectExpr(*[f"{BASE_EXPRESSIONS[c]} AS {c}" for c in CANONICAL]), CANONICAL_SCHEMA)


def prod(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base(spark, sf_dir)
    return b.unionByName(b.filter(PROD_DUPLICATES))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base(spark, sf_dir).filter(STAGING_FILTER)
    cols = [F.expr(STAGING_OVERRIDES[c]).alias(c) if c in STAGING_OVERRIDES else F.col(c) for c in CANONICAL]
    return conform(b.select(*cols), CANONICAL_SCHEMA)


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every even practice of prod, plus one practice prod does not have."""
    evens = prod(spark, sf_dir).where("practice_id % 2 = 0").select(F.col("practice_id").alias("practiceid")).distinct()
    extra = spark.range(1).select(F.lit(STATUS_EXTRA_PRACTICE).cast("int").alias("practiceid"))
    early = F.lit(STATUS_EARLY).cast("timestamp_ntz")
    late = F.lit(STATUS_LATE_END).cast("timestamp_ntz")
    return evens.unionByName(extra).select(
        "practiceid",
        F.when(F.col("practiceid") == STATUS_LATE_PRACTICE, late).otherwise(early).alias("enddate"),
        early.alias("lastrefreshtime"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def events_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    cols = [F.expr(EVENTS_STAGING_OVERRIDES[c]).alias(c) if c in EVENTS_STAGING_OVERRIDES else F.col(c) for c in ev.columns]
    return ev.filter(EVENTS_STAGING_FILTER).select(*cols)


def events_staging_sql() -> str:
    return (
        "SELECT * REPLACE ("
        + ", ".join(f"{e} AS {c}" for c, e in EVENTS_STAGING_OVERRIDES.items())
        + f") FROM events WHERE {EVENTS_STAGING_FILTER}"
    )


# --- The same inputs as SQL (for the DuckDB oracle) ------------------------


def base_sql() -> str:
    cols = ",\n  ".join(f"{BASE_EXPRESSIONS[c]} AS {c}" for c in CANONICAL)
    return f"SELECT\n  {cols}\nFROM lineitem"


def prod_sql() -> str:
    return f"SELECT * FROM base UNION ALL SELECT * FROM base WHERE {PROD_DUPLICATES}"


def staging_sql() -> str:
    cols = ", ".join(f"{STAGING_OVERRIDES[c]} AS {c}" if c in STAGING_OVERRIDES else c for c in CANONICAL)
    return f"SELECT {cols} FROM base WHERE {STAGING_FILTER}"


def status_sql() -> str:
    return (
        "SELECT DISTINCT practice_id AS practiceid,"
        f" CASE WHEN practice_id = {STATUS_LATE_PRACTICE} THEN TIMESTAMP '{STATUS_LATE_END}'"
        f" ELSE TIMESTAMP '{STATUS_EARLY}' END AS enddate,"
        f" TIMESTAMP '{STATUS_EARLY}' AS lastrefreshtime"
        " FROM prod WHERE practice_id % 2 = 0"
        f" UNION ALL SELECT {STATUS_EXTRA_PRACTICE}, TIMESTAMP '{STATUS_EARLY}', TIMESTAMP '{STATUS_EARLY}'"
    )


def with_inputs_sql(body: str, **ctes: str) -> str:
    """Wrap ``body`` with the fixture CTEs (base, prod, staging, clean_prod,
    clean_staging, status) followed by ``ctes`` in the given order."""
    clean = "midname IS NULL OR position(chr(23) IN midname) = 0"
    parts = {
        "base": base_sql(),
        "prod": prod_sql(),
        "staging": staging_sql(),
        "clean_prod": f"SELECT * FROM prod WHERE {clean}",
        "clean_staging": f"SELECT * FROM staging WHERE {clean}",
        "status": status_sql(),
        **ctes,
    }
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n" + body
