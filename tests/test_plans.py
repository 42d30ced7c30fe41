"""Plan shape checks: pushdown, pruning, partial aggregation, broadcasts,
and no cartesian or nested-loop joins in the registered batch queries."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
from dispatchboard.plans import registry  # noqa: E402

BATCH = sorted(n for n in registry.QUERIES if not n.startswith(("stream_", "calls_json_formats")))


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_products(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_flagship_prunes_and_aggregates_partially(spark):
    p = plan(QUERIES["calls_window_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in p
    assert "PushedFilters: [IsNotNull(ts)]" in p
    # dedup, bucket counts and window sums: each partial + final
    assert p.count("partial_count") == 1 and p.count("partial_sum") == 1
    assert p.count("HashAggregate") >= 6
    # the 6-fold expansion runs on bucket groups, after the bucket count
    # (node details are listed from the scan up)
    d = p[p.index("(1) Scan"):]
    assert d.index("partial_count") < d.index("Generate") < d.index("partial_sum")


def test_small_lookups_broadcast_without_a_hint(spark):
    """Spark decides from real sizes: no limit, no single-partition step."""
    for name in ("calls_window_described", "slot_occupancy", "arrivals_known"):
        df = QUERIES[name](spark, SF_SMALL)
        df.collect()
        p = plan(df)
        assert "BroadcastHashJoin" in p[:p.index("Initial Plan")], name
        assert "SinglePartition" not in p and "GlobalLimit" not in p, name


def test_table_counts_aggregate_by_hash(spark):
    assert "SortAggregate" not in plan(QUERIES["entries_table_count"](spark, SF_SMALL))


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,view)" in plan(QUERIES["current_weather"](spark, SF_SMALL))
    assert "GreaterThan(o_orderkey" in plan(QUERIES["incremental_pull"](spark, SF_SMALL))


def test_topology_never_windows_a_whole_line(spark):
    """WIN-2 at every size: lag/lead run per (slice, line);
    the only window keyed on the line alone is over the per-slice summary,
    ordered by slice. (The per-slice window sits behind the checkpoint, so it
    is not in this plan.)"""
    import re
    from dispatchboard.operators import transit as T
    from dispatchboard.plans import fixtures as X
    p = plan(T.line_topology(X.stops(spark, SF_SMALL)), "extended")
    assert not re.search(r"windowspecdefinition\(line#\d+, station_order", p)
    assert re.search(r"windowspecdefinition\(line#\d+, _slice", p)


def test_sorts_break_ties_for_range_partitioning(spark):
    """SRT-1: the range shuffle of the final sort is keyed on count plus the
    group, so rows sharing a count can be spread over tasks."""
    import re
    p = plan(QUERIES["calls_window_counts"](spark, SF_SMALL), "extended")
    assert re.search(r"rangepartitioning\(call_count#\d+L DESC NULLS LAST, window_start", p)
    p = plan(QUERIES["incremental_pull"](spark, SF_SMALL), "extended")
    assert re.search(r"rangepartitioning\(o_orderkey#\d+L? ASC NULLS FIRST", p)
