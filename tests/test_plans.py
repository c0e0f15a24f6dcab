"""Plan properties the library relies on at scale, checked on the physical
plans of the registered queries (planning only, no execution)."""

import pytest

from layerkit.plans import queries as Q
from layerkit.plans import queries_more as M

SF = "/root/testdata/sf0.001"
# Queries that write while being built: of these the DataFrames that are written
# (or that they end in) are planned, see ``WRITTEN``.
WRITES = {"incremental_table", "incremental_results", "audit_replace", "csv_files_good", "csv_files_rejects", "csv_files_load",
          "stream_ingest", "check_results", "check_summary", "audit_row", "check_build_error", *M.MORE}


def _read(spark):
    from layerkit.sources import read_lines

    return read_lines(spark, Q.landed_csv_files(spark, SF) + "/file_key=*/*.txt")


WRITTEN = {
    "incremental batch": lambda s: Q.new_rows(Q._t(s, SF, "events"), "ts", Q.CUTOFF_2),
    "csv lines with numbers": _read,
    "csv outcomes": lambda s: Q.parse_csv_outcomes(_read(s), Q.CSV_SCHEMA),
    "feedback lines": lambda s: M._feedback_lines(s, SF),
    "pages": lambda s: M.broken_pages(s, SF),
    "responses": lambda s: M.landed_responses(s, SF),
    "records in page order": lambda s: M.q_paged_by_cursor(s, SF),
    "chain problems": lambda s: Q.chain_problems(M.broken_pages(s, SF)),
    "checked model": lambda s: Q.check_models(s, SF)[0]["fct_revenue"][0]({n: Q._t(s, SF, n[4:]) for n in ("stg_orders", "stg_lineitem")}),
    "default patterns": lambda s: M.q_redact_default_patterns(s, SF),
    "names of a table": lambda s: M.q_redact_by_table(s, SF),
    "default markers": lambda s: M.q_marker_default(s, SF),
}


#: An automaton is walked over texts in Arrow batches.
ARROW = {("names of a table", "ArrowEvalPython")}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    given = {n: plan(fn(spark, SF)) for n, fn in Q.QUERIES.items() if n not in WRITES}
    return given | {n: plan(fn(spark)) for n, fn in WRITTEN.items()}


def test_no_cartesian_or_nested_loop_and_no_python(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
        for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert op not in p or (name, op) in ARROW, (name, op)


def test_names_are_found_without_moving_rows(plans):
    p = plans["names of a table"]
    assert "ArrowEvalPython" in p and "Generate" not in p and "Join" not in p
    # A small input is dealt out over the cores before.
    assert p.count("Exchange") == p.count("RoundRobinPartitioning")


@pytest.mark.parametrize("name", ["latest_event", "latest_event_by_day", "dedup_lineitem", "dedup_hot_key",
                                  "clean_visits",
                                  "review_sample"])
def test_topk_is_limited_before_the_shuffle(plans, name):
    p = plans[name]
    assert "WindowGroupLimit" in p and "Partial" in p, name


@pytest.mark.parametrize("name", ["check_unique", "check_accepted_values", "check_relationships",
                                  "at_risk_customers", "count_by_status", "enrich_summary"])
def test_aggregates_are_partial_before_the_shuffle(plans, name):
    p = plans[name]
    assert "partial_" in p or "HashAggregate(keys=[" in p.split("Exchange")[-1], name


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in plans["incremental_events"] \
        or "GreaterThan(ts" in plans["incremental_events"]
    assert "c_acctbal" in plans["check_relationships"] and "GreaterThanOrEqual(c_acctbal,0.0)" in \
        plans["check_relationships"]


def test_projections_are_pruned(plans):
    # a two-column projection must not read all customer columns
    p = plans["mask_customer"]
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in p
