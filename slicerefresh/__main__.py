"""Command line: run a publishing job the way the original job was started.

    python -m slicerefresh table --practices 3,6,7 --measures NA \\
        --current-db prod --staging-db staging --root gs://bucket/warehouse [--snapshot-dir ...] [--status-table ...]

    python -m slicerefresh snapshot --snapshot-folder REG/clean --run-dir 2024-01 --base gs://bucket/backups \\
        --staging-db staging --target-db prod --practices NA --measures QPP1,QPP2 --root gs://bucket/warehouse

``table`` is the production job: each table ``<current-db>.<table>`` is
refreshed from ``<staging-db>.<table>`` and republished in place.
``snapshot`` is the snapshot job: current rows come from the delimited
snapshots of a run folder, read in the format that their manifest says (without
one as ``--read-codec`` says, 26 columns without header).  ``NA`` means everything in staging.  One JSON line of step counts is printed per table.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from slicerefresh.operators.scope import Scope
from slicerefresh.plans.sync import (
    Preset,
    SnapshotFormat,
    StatusTarget,
    SyncReport,
    sync_all,
    sync_from_snapshot,
)
from slicerefresh.schema import TABLE_ORDER
from slicerefresh.sources.delimited import CODECS


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m slicerefresh", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("table", "snapshot"):
        s = sub.add_parser(name)
        s.add_argument("--practices", required=True, help="comma list of practice ids, or NA")
        s.add_argument("--measures", required=True, help="comma list of measure ids, or NA")
        s.add_argument("--root", required=True, help="folder under which each table's versions are written")
        s.add_argument("--tables", default=",".join(TABLE_ORDER), help="comma list, in publication order")
        s.add_argument("--dedupe", default="reference", choices=("reference", "always", "never"))
        s.add_argument("--snapshot-dir", help="write a delimited snapshot of every result under this folder")
        s.add_argument("--backup-dir", help="write a delimited backup of every table before its refresh under this folder")
        s.add_argument("--status-table", help="status table to advance after the by-practice table")
        s.add_argument("--status-root", help="folder for the status table's versions")
        s.add_argument("--num-buckets", type=int, help="bucket count of new tables (default: sized from the data)")
        s.add_argument("--parallel-tables", type=int, default=4, help="tables staged at once")
        s.add_argument("--collapse-keys", action="store_true", help="keep one row per primary key (keyed store)")
    t = sub.choices["table"]
    t.add_argument("--current-db", required=True, help="database of the published tables (refreshed in place)")
    t.add_argument("--staging-db", required=True, help="database of the staging tables")
    n = sub.choices["snapshot"]
    n.add_argument("--snapshot-folder", required=True, help="folder of the job family's snapshots, below the base")
    n.add_argument("--staging-db", required=True, help="database of the staging tables")
    n.add_argument("--target-db", required=True, help="database to publish into")
    n.add_argument("--read-codec", choices=CODECS, help="codec of snapshots that do not say how they were written (26 columns, no header)")
    n.add_argument("--run-dir", required=True, help="run folder of the snapshots to start from")
    n.add_argument("--base", required=True, help="base folder of the snapshot folders")
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> SyncReport:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("slicerefresh").getOrCreate()
    scope = Scope.parse(args.practices, args.measures)
    tables = tuple(t for t in args.tables.split(",") if t)
    common = dict(
        scope=scope,
        tables=tables,
        dedupe=args.dedupe,
        num_buckets=args.num_buckets,
        parallel_tables=args.parallel_tables,
        collapse_keys=args.collapse_keys,
        root_for=lambda t: f"{args.root.rstrip('/')}/{t}",
        snapshot_for=(lambda t: f"{args.snapshot_dir.rstrip('/')}/{t}") if args.snapshot_dir else None,
        backup_for=(lambda t: f"{args.backup_dir.rstrip('/')}/{t}") if args.backup_dir else None,
        status=StatusTarget(args.status_table, args.status_root or f"{args.root.rstrip('/')}/status")
        if args.status_table
        else None,
    )
    if args.job == "table":
        report = sync_all(
            spark,
            current_for=lambda t: f"{args.current_db}.{t}",
            target_for=lambda t: f"{args.current_db}.{t}",
            staging_for=lambda t: f"{args.staging_db}.{t}",
            **common,
        )
    else:
        preset = Preset(args.snapshot_folder, args.staging_db, args.target_db)
        report = sync_from_snapshot(
            spark,
            snapshot_in_for=preset.snapshot_in(args.base, args.run_dir),
            staging_for=preset.staging(),
            target_for=preset.target(),
            snapshot_out_for=common.pop("snapshot_for"),
            snapshot_in_format=SnapshotFormat(codec=args.read_codec) if args.read_codec else None,
            **common,
        )
    for r in report.runs:
        print(json.dumps({"table": r.table, "target": r.target, **r.audit.as_row(), "deduplicated": r.dedupe}))
    return report


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()
