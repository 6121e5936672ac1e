"""The four-table job over partitioned layouts advances the status table with its tables."""

import os
import sys

from helpers import SMOKE

from slicerefresh import sync_all


def test_the_partitioned_four_table_job_advances_the_status(spark, monkeypatch):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    seen = []
    monkeypatch.setattr(entry, "sync_all", lambda *a, **k: (seen.append(k.get("status")), sync_all(*a, **k))[1])
    out = entry.queries()["sync_all_partitioned_all"](spark, SMOKE)
    rows = {r["practiceid"]: r for r in spark.table(seen[0].table).collect()}
    staged = {r[0] for r in entry.fx.staging(spark, SMOKE).select("practice_id").distinct().collect()}
    advanced = {p for p, r in rows.items() if str(r["lastrefreshtime"]) == entry.fx.REFRESHED_AT}
    assert advanced == staged & set(rows) and advanced
    held = {(r[0], r[1]) for r in out.where("practice_id is not null").groupBy("practice_id").agg({"visit_dt": "max"}).collect()}
    assert all((p, rows[p]["enddate"]) in held for p in advanced)
