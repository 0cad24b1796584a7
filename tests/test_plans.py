"""Plan shape of the registered queries: what a 100 TB run depends on."""

import re

import pytest

from sigfleet.plans import driver_queries
from tests.conftest import SF_SMOKE

# Queries that write landing files or run streams when built.
SIDE_EFFECTS = {
    "catalog_scan", "result_docs", "bom_repair", "stream_latest", "stream_heartbeat", "stream_fault_alerts",
    "range_carry_in_indexed", "latest_indexed", "ingest_twice", "ingest_lossless", "stream_heartbeat_polls", "result_document", "latest_csv", "id_names_csv",
    "report_json", "bom_repair_bytes", "result_files", "wide_files", "history_files", "output_files",
    "stream_labels", "stream_latest_files", "catalog_fallback_files",
}
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
BAD_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in driver_queries.QUERIES.items():
        if name not in SIDE_EFFECTS:
            out[name] = plan(fn(spark, SF_SMOKE))
    return out


def test_no_python_and_no_cross_joins(plans):
    for name, p in plans.items():
        for node in PY_NODES + BAD_JOINS:
            assert node not in p, f"{name} has {node}"


def test_range_scan_pushes_every_predicate(plans):
    p = plans["range_scan"]
    pushed = re.search(r"PushedFilters: \[(.*)\]", p).group(1)
    assert "EqualTo(user_id,7)" in pushed
    assert "event_type" in pushed
    assert "GreaterThanOrEqual(ts," in pushed and "LessThanOrEqual(ts," in pushed


def test_scans_read_only_needed_columns(plans):
    rs = re.findall(r"ReadSchema: (struct<[^\n]*>)", plans["latest_wide"])
    assert rs and all("props" not in s for s in rs)
    assert any("event_type" in s for s in rs)


def test_latest_is_a_partial_aggregate(plans):
    p = plans["latest_per_signal"]
    # partial max_by below the one exchange; no window over whole series
    tree = p.split("\n\n")[0].splitlines()
    exchange = next(i for i, line in enumerate(tree) if " Exchange" in line)
    assert sum("Aggregate" in line for line in tree[exchange:]) == 1
    assert "partial_max_by" in p and "Window" not in p
    assert p.count("hashpartitioning(") == 1


def test_top_k_is_cut_before_the_shuffle(plans):
    p = plans["series_sample"]
    assert re.search(r"WindowGroupLimit.*Partial", p.replace("\n", " "))


def test_latest_wide_single_aggregate(plans):
    p = plans["latest_wide"]
    assert p.count("partial_max_by") == 2  # status and power in one aggregate node
    assert "Keys [1]: [pump_id" in p
    assert p.count("hashpartitioning(") == 1  # one shuffle, on pump_id
