"""Physical plans that have to hold at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()


_PLANS: dict[str, str] = {}


def plan(spark, sf_dir, name: str) -> str:
    """The physical plan; some queries write tables on the way to it, so each is made once."""
    if name not in _PLANS:
        _PLANS[name] = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    return _PLANS[name]


@pytest.mark.parametrize(
    "name",
    ["dedup_bucket", "dedup_second", "dedup_hour", "dedup_window", "dedup_bitmap", "upsert_latest"],
)
def test_first_and_last_rows_are_chosen_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1


@pytest.mark.parametrize("name", ["tumble_agg", "sql_hop", "group_count", "split_words_distinct"])
def test_aggregates_combine_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert text.count("HashAggregate") == 2
    assert text.count("Exchange") == 1


def test_sessions_merge_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "sql_session")
    below = text[text.index("Exchange") :]
    assert "HashAggregate" in below


@pytest.mark.parametrize(
    "name", ["over_rows", "over_range_time", "retry_alert", "retract_count", "cep_times_user"]
)
def test_plain_window_plans_shuffle_once(spark, sf_dir, name):
    assert plan(spark, sf_dir, name).count("Exchange") == 1


@pytest.mark.parametrize("name", ["filter_eq", "sql_filter", "cep_times", "window_join"])
def test_filters_reach_the_scan(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "EqualTo(event_type,purchase)" in text.replace(" ", "")


@pytest.mark.parametrize(
    "name, unused",
    [
        ("group_count", "user_id"),
        ("dedup_hour", "props"),
        ("retry_alert", "props"),
        ("split_words", "lang"),
        ("tumble_agg", "value:double"),
    ],
)
def test_scans_read_only_used_columns(spark, sf_dir, name, unused):
    text = plan(spark, sf_dir, name)
    assert unused not in text[text.index("ReadSchema") :]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_plan_multiplies_rows_or_runs_python(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert operator not in text


#: A global order below the size that is cut into chunks, and the one-row report.
IN_ONE_PARTITION = {
    "cep_times",
    "cep_times_within",
    "cep_times_timeout",
    "bloom_error_bound",
    "cep_times_split",
    "cep_next_within_split",
}


def test_only_the_unkeyed_pattern_uses_one_partition(spark, sf_dir):
    single = {
        n
        for n in QUERIES
        if not n.startswith("stream_") and "SinglePartition" in plan(spark, sf_dir, n)
    }
    assert sorted(single - IN_ONE_PARTITION) == []
