"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_flagship_plan(spark):
    p = plan(E.queries()["job_block_activity"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "SortAggregate" not in p  # integer order keys keep the aggregates hash-based
    # column pruning reaches the scans: lineitem reads five of its columns, orders three
    li = [line for line in p.splitlines() if line.startswith("ReadSchema") and "l_orderkey" in line][0]
    assert "l_quantity" not in li and "l_shipdate" not in li and "l_comment" not in li
    od = [line for line in p.splitlines() if line.startswith("ReadSchema") and "o_orderkey" in line][0]
    assert "o_totalprice" not in od and "o_orderpriority" not in od


def test_receiver_jobs_have_no_cross_joins(spark):
    for key in ("job_receiver_scores", "receiver_coverage", "popularity_histogram", "dataset_counts"):
        p = plan(E.queries()[key](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_time_filter_pushed_to_scan(spark):
    p = plan(E.queries()["time_range_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts)" in p


def test_partition_pruning_on_scores(spark):
    # the key returns every folder; a reader that asks for one threshold opens that folder alone
    p = plan(E.queries()["snk_scores_partitioned"](spark, SF).filter("threshold_pct = 65"))
    assert "PartitionFilters: [isnotnull(threshold_pct" in p and "(threshold_pct" in p
