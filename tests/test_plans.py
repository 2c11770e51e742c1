"""Physical-plan properties that matter at scale."""
from daymatrix.operators.demand import demand_counts, prepare_visits
from daymatrix.operators.diagnosis import diagnosis_counts, prepare_diagnoses
from daymatrix.operators.dedup import latest_wins
from daymatrix.functions.icd import SELECTED_CODES
from daymatrix.plans import catalog
from daymatrix.sources import fixtures as fx

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    """The adaptive plan as executed (runs the query through ``collect``)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_demand_counts_rollup_and_broadcast_lookup(spark):
    df = demand_counts(prepare_visits(fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL)))
    plan = _final_plan(df)
    assert "BroadcastHashJoin" in plan
    # the row-level stack is aggregated once; the coarser scopes reuse its shuffle
    assert plan.count("Generate inline") == 1
    assert "ReusedExchange" in plan
    # the grouping-sets Expand runs over aggregated counts, never over raw rows
    expand_at = plan.index("Expand")
    assert "HashAggregate" in plan[expand_at:]
    assert "Generate inline" not in plan[expand_at:]


def test_diagnosis_reduces_before_lookup(spark):
    red = prepare_diagnoses(fx.diagnoses(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL))
    plan = _plan(red)
    # the aggregate sits below the broadcast join
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate")
    counts = diagnosis_counts(red, selected_codes=SELECTED_CODES)
    assert _final_plan(counts).count("Generate inline") == 1


def test_scan_pushes_filters_and_prunes(spark):
    df = catalog.scan_range(spark, SF_SMALL)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_latest_wins_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([(1, 1, 5)], "k INT, batch_id INT, n INT")
    plan = _plan(latest_wins(df, ["k"], "batch_id"))
    assert "Window" not in plan and "max_by" in plan


def test_latest_wins_of_counts_hashes(spark):
    plan = _plan(catalog.dedup_latest(spark, SF_SMALL))
    top = plan[: plan.index("Union")]
    assert "max_by" in top and "HashAggregate" in top
    assert "SortAggregate" not in top and "Sort [" not in top


def test_fill_windows_are_partitioned(spark):
    df = catalog.fill_forward(spark, SF_SMALL)
    plan = _plan(df)
    assert "Window [" in plan
    for line in plan.splitlines():
        if "Window [" in line:
            assert "[feature" in line.split("],")[-2] or "feature#" in line
    assert "SinglePartition" not in plan


def test_fill_frames_are_incremental(spark):
    """No frame runs to the partition end (Spark re-evaluates those per row)."""
    for job in (catalog.fill_backward, catalog.fill_interpolate, catalog.joined_daily):
        plan = _plan(job(spark, SF_SMALL)).lower()
        assert "unboundedfollowing" not in plan


def test_recount_bound_is_pushed_to_the_scan(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from daymatrix.plans.incremental import _raw_bound

    v = fx.visits(spark, SF_SMALL)
    rows = v.where(F.col("DATA_VISITA") >= _raw_bound(v, "DATA_VISITA", dt.date(1998, 12, 1)))
    assert "GreaterThanOrEqual(o_orderdate,1998-12-01T00:00)" in _plan(rows)
