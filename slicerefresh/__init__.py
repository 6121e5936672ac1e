"""slicerefresh: publish freshly computed rows into large fact tables, one slice at a time.

Built on Spark DataFrames and Spark SQL only.  The main entry points:

* ``Scope`` / ``ResolvedScope``  -- which slice (values per key, or all of staging)
* ``slice_replace``              -- the result of replacing one slice (lazy)
* ``sync_all`` / ``sync_table`` / ``sync_from_snapshot`` -- the publishing jobs
* ``publish_partitioned`` / ``sync_incremental`` -- refresh only the practices in scope
"""

from slicerefresh.operators.audit import AuditCounts, input_counts, sync_audit
from slicerefresh.operators.clean import control_char_filter
from slicerefresh.operators.keys import key_check, key_collapse
from slicerefresh.operators.replace import distinct_rows, slice_append, slice_delete, slice_replace, slice_select
from slicerefresh.operators.scope import ResolvedScope, Scope
from slicerefresh.operators.status import practice_filter, practice_high_water, refresh_status
from slicerefresh.plans.incremental import NotIncremental, publish_partitioned, sync_incremental
from slicerefresh.plans.publish import BucketSpec, PublishError, layout_write, prune_versions, publish_table
from slicerefresh.plans.sync import (
    SnapshotFormat,
    StatusTarget,
    sync_all,
    sync_from_snapshot,
    sync_table,
    write_snapshot,
)
from slicerefresh.schema import CANONICAL, LAYOUTS, TABLE_ORDER, conform, evolve_schema, layout, table_schema
from slicerefresh.sources.delimited import read_delimited, write_delimited
from slicerefresh.sources.tables import read_table, register_views, slice_sql

__all__ = [
    "AuditCounts",
    "BucketSpec",
    "CANONICAL",
    "LAYOUTS",
    "NotIncremental",
    "PublishError",
    "ResolvedScope",
    "Scope",
    "SnapshotFormat",
    "StatusTarget",
    "TABLE_ORDER",
    "conform",
    "control_char_filter",
    "distinct_rows",
    "evolve_schema",
    "input_counts",
    "key_check",
    "key_collapse",
    "layout",
    "layout_write",
    "practice_filter",
    "practice_high_water",
    "prune_versions",
    "publish_partitioned",
    "publish_table",
    "read_delimited",
    "read_table",
    "refresh_status",
    "register_views",
    "slice_append",
    "slice_delete",
    "slice_replace",
    "slice_select",
    "slice_sql",
    "sync_all",
    "sync_audit",
    "sync_from_snapshot",
    "sync_incremental",
    "sync_table",
    "table_schema",
    "write_snapshot",
    "write_delimited",
]
