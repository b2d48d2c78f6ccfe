"""Physical-plan properties of every registered query (planned, not executed).

No query may plan a Cartesian product or a broadcast nested-loop join, and
the scans must be column-pruned (no ``ReadSchema`` with every column of the
wide tables when the query needs a few).
"""

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

# Keys whose operators run actions while building the plan (writes, training);
# their plans are covered by the oracle/rows checks instead.
SIDE_EFFECTING = {"land_csv", "land_by_name", "landing_expectations", "ingest_stream", "ingest_audit_cols", "rescue_malformed", "materialize",
                  "overwrite_with_schema", "replace_full", "overlap_refresh_partitioned", "overlap_refresh_vanished", "lakehouse_job",
                  "model_registry", "train_severity", "score_claims", "feature_importance", "stratified_split",
                  "class_weights"}
KEYS = sorted(k for k in entry.queries() if k not in SIDE_EFFECTING)


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_or_nested_loop(spark, key):
    df = entry.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_is_column_pruned(spark):
    plan = entry.queries()["fraud_by_region"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    orders_scan = [line for line in plan.splitlines() if "orders.parquet" in line and "ReadSchema" in line]
    assert orders_scan and all("o_orderpriority" not in line for line in orders_scan)
