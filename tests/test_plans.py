"""Plan guards: no registered exact query may contain a cross join / nested-loop join,
and scans must be column-pruned."""
import __spark_entry__ as entry
from conftest import SF

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_no_cross_joins_in_registered_queries(spark):
    queries = entry.queries()
    bad = {}
    for name in sorted(entry.oracle_sql()):
        plan = queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_interaction_scan_is_pruned(spark):
    plan = entry.queries()["interaction_table"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "o_totalprice" not in plan
