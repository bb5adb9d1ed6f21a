"""Physical shapes that must hold whatever the data size."""

import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["asof_01_snapshot_strict", "asof_02_latest_period", "qa_06_crawl_failures", "ing_20_last_in_batch",
                                  "ing_21_newest_periods", "txt_10_link_discovery"])
def test_top_rows_shrink_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_scans_read_only_the_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["str_04_daily_status"](spark, sf_dir))
    assert "props" not in plan and "value" not in plan.split("ReadSchema")[1]
    assert "o_totalprice" not in plan_of(QUERIES["int_08_effective_events_all"](spark, sf_dir))


def test_effective_events_shuffle_once_per_partitioning(spark, sf_dir):
    # thresholds, same-instant choice, interval ends and ordinals share one exchange on the key
    plan = plan_of(QUERIES["int_08_effective_events_us"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Window [") == 4


def test_compaction_uses_one_exchange(spark, sf_dir):
    assert plan_of(QUERIES["mnt_01_compaction"](spark, sf_dir)).count("Exchange hashpartitioning") == 1


def test_fixed_cutoff_selection_combines_before_its_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["asof_04_selected_all"](spark, sf_dir))
    assert "partial_max" in plan
