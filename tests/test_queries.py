"""Registered queries: equal to their SQL twins, and planned the way they should be."""

import ast
from pathlib import Path

import pytest

from __spark_entry__ import entry
from check import compare, connect
from pvspark.plans import bindings
from pvspark.plans.oracle import ORACLE
from pvspark.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
STREAMS = [name for name in QUERIES if name.endswith("_stream")]
BATCH = [name for name in QUERIES if name not in STREAMS]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_query_pairs_everything_or_runs_in_one_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        # One task may only merge the one partial row each partition leaves of a global maximum.
        assert "SinglePartition" not in line or "HashAggregate(keys=[]," in below


def scan_of(plan, column):
    return next(line for line in plan.splitlines() if "FileScan" in line and column in line)


def test_filters_and_columns_reach_the_files(spark):
    plan = plan_of(QUERIES["snapshot_at_instant"](spark, SF_DIR))
    scan = scan_of(plan, "event_id")
    assert "LessThanOrEqual(ts,2024-01-15" in scan and "props" not in scan and "event_type" not in scan
    scan = scan_of(plan_of(QUERIES["silent_pvs"](spark, SF_DIR)), "user_id")
    assert scan.rstrip().endswith("struct<user_id:bigint>")
    scan = scan_of(plan_of(QUERIES["triggered_snapshot"](spark, SF_DIR)), "event_id")
    assert "props" not in scan
    scan = scan_of(plan_of(QUERIES["latest_values"](spark, SF_DIR)), "event_id")
    assert "props" not in scan and "event_type" not in scan


def test_buffered_values_do_not_shuffle(spark):
    from pvspark.operators import snapshots

    rows = snapshots.recurring_buffered(
        bindings.pv_events(spark, SF_DIR), bindings.members(spark, SF_DIR), bindings.ORIGIN_MS, complete=False)
    assert "Exchange hashpartitioning" not in plan_of(rows)


def test_no_driver_side_collection_in_the_library():
    """No toPandas, localCheckpoint, cross join or unbounded collect in the package.

    The training-data operators have their own test, as they fit models on bounded samples.
    """
    for path in Path(__file__).resolve().parents[1].glob("pvspark/**/*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute):
                assert node.attr not in {"toPandas", "localCheckpoint", "crossJoin", "collect", "rdd"}, path
