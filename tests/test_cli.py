"""The command line runs the production job over databases of published tables."""

from helpers import SMOKE

from slicerefresh import fixtures
from slicerefresh.__main__ import run
from slicerefresh.plans.publish import BucketSpec, publish_table
from slicerefresh.schema import LAYOUTS
from slicerefresh.session import scratch_path

TABLES = ("summary_details_by_practice", "summary_details_by_measure")


def test_table_job_from_the_command_line(spark, capsys):
    root = scratch_path(spark, "cli")
    for db in ("cli_prod", "cli_stg"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}.db'")
    prod, staging = fixtures.prod(spark, SMOKE), fixtures.staging(spark, SMOKE)
    for t in TABLES:
        spec = BucketSpec.for_layout(LAYOUTS[t], 4)
        publish_table(prod.repartition(4, *spec.columns), f"cli_prod.{t}", f"{root}/prod/{t}", spec)
        publish_table(staging, f"cli_stg.{t}", f"{root}/stg/{t}")
    report = run(
        ["table", "--practices", "3,6,7", "--measures", "QPPAF,QPPRF", "--current-db", "cli_prod",
         "--staging-db", "cli_stg", "--root", f"{root}/versions", "--tables", ",".join(TABLES)],
        spark,
    )
    assert [r.table for r in report.runs] == list(TABLES)
    for t in TABLES:
        assert spark.table(f"cli_prod.{t}").count() == 4813  # FIXTURES.md, list scope at sf0.001
    printed = capsys.readouterr().out.strip().splitlines()
    assert len(printed) == 2 and '"after_add": 4813' in printed[0]


def test_snapshot_job_with_its_own_naming(spark):
    from slicerefresh.plans.sync import Preset, SnapshotFormat
    from slicerefresh.sources.delimited import write_delimited

    root = scratch_path(spark, "cli")
    preset = Preset("REGX/family_clean", "family_regx_staging", "regx_target")
    for db in (preset.staging_database, preset.target_database):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}.db'")
    prod, staging = fixtures.prod(spark, SMOKE), fixtures.staging(spark, SMOKE)
    fmt = SnapshotFormat(header=False, evolved=False)
    table = "summary_details_by_location"
    snapshot_in = preset.snapshot_in(f"{root}/backups", "run7")
    write_delimited(prod, snapshot_in(table), header=False, columns=fmt.columns(table))
    from slicerefresh.schema import TABLE_ORDER

    for t in TABLE_ORDER:  # NA scopes come from the by-practice and by-measure staging tables
        publish_table(staging, preset.staging()(t), f"{root}/stg/{t}")
    run(
        ["snapshot", "--snapshot-folder", preset.snapshot_folder, "--run-dir", "run7", "--base", f"{root}/backups",
         "--staging-db", preset.staging_database, "--target-db", preset.target_database,
         "--practices", "NA", "--measures", "NA", "--root", f"{root}/versions", "--tables", table,
         "--snapshot-dir", f"{root}/out"],
        spark,
    )
    assert spark.table(preset.target()(table)).count() == 4861  # FIXTURES.md, all scope at sf0.001
    assert snapshot_in(table).endswith(f"REGX/family_clean/run7/{table}")
