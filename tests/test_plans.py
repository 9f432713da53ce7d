"""Physical plans: what is pushed down, what is shuffled, what is broadcast."""

from datetime import datetime

from conftest import plan_of

from gaugemill.operators import batching, gates, keyed, readings, rollup, windows
from gaugemill.plans import registry
from gaugemill.session import scratch_path
from gaugemill.sources import dimensions, observations, testbed


def stored_raw(spark, sf_dir):
    path = scratch_path(spark, "plan-raw")
    observations.append_raw(testbed.raw(spark, sf_dir), path)
    return path


def shuffles(df) -> int:
    return plan_of(df).count("Exchange hashpartitioning")


def test_closed_minute_gate_reaches_the_scan(spark, sf_dir):
    path = stored_raw(spark, sf_dir)
    as_of = datetime(2024, 1, 1, 6, 0, 30)
    raw = observations.scan_raw(spark, path, before=as_of)
    plan = plan_of(gates.closed_minutes(gates.not_imported(raw), as_of).select("id"))
    assert "LessThan(observe_date,2024-01-01" in plan
    assert "PartitionFilters: [isnotnull(obs_day" in plan
    assert "ReadSchema: struct<id:bigint,observe_date:timestamp,imported:boolean>" in plan


def test_node_average_takes_one_shuffle(spark, sf_dir):
    raw = testbed.raw(spark, sf_dir)
    models = dimensions.node_models(spark)
    assert shuffles(readings.probe_readings(raw)) == 0
    for function in (rollup.minute_avg_nodes, rollup.minute_avg_scalar, rollup.minute_averages):
        plan = plan_of(function(raw, models))
        assert plan.count("Exchange hashpartitioning") == 1
        assert "partial_sum" in plan and "SortMergeJoin" not in plan


def test_documents_are_parsed_once(spark, sf_dir):
    raw = testbed.raw(spark, sf_dir)
    keyed_raw = testbed.keyed_raw(spark, sf_dir)
    for df in (
        readings.all_readings(raw),
        rollup.minute_averages(raw, dimensions.node_models(spark)),
        windows.minute_summary(keyed_raw),
        keyed.minute_rollup(keyed_raw, registry.KEYED_AS_OF),
    ):
        assert plan_of(df).count("from_json(") == 1


def test_summaries_take_no_dimension_join(spark, sf_dir):
    keyed_raw = testbed.keyed_raw(spark, sf_dir)
    plan = plan_of(windows.quarter_summary_zoned(keyed_raw))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_star_join_broadcasts_the_dimensions(spark, sf_dir):
    plan = plan_of(registry.QUERIES["star_join_observations"](spark, sf_dir))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_only_blocks_are_sorted_together(spark, sf_dir):
    plan = plan_of(batching.count_windows(testbed.lines(spark, sf_dir), 7))
    assert "_block_lo" in plan
    assert "Exchange SinglePartition" not in plan


def test_flags_after_a_load_need_no_join(spark, sf_dir):
    plan = plan_of(registry.QUERIES["load_flags"](spark, sf_dir))
    assert "Join" not in plan and "Exchange" not in plan


def test_feeds_keep_only_the_top_rows_per_task(spark, sf_dir):
    plan = plan_of(registry.QUERIES["top25_pending"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan
