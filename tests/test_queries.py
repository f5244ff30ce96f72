"""Every bound query against the independent engine."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract

QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.CORPUS_QUERIES}
ORACLE = {k: v for k, v in contract.oracle_sql().items() if k in QUERIES}


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_every_counterpart_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    compare.assert_same(QUERIES[name](spark, sf_dir), duck, ORACLE[name])


def test_bloom_antifilter_keeps_no_seen_key(spark, sf_dir, duck):
    kept = QUERIES["bloom_antifilter"](spark, sf_dir).collect()
    rows = duck.execute(
        """
        SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS num,
               ts < TIMESTAMP '2024-01-16' AS early FROM events
        """
    ).fetchall()
    seen = {(user, num) for _, user, num, early in rows if early}
    fresh = {event for event, user, num, early in rows if not early and (user, num) not in seen}
    ids = {r.event_id for r in kept}
    assert ids <= fresh
    assert len(fresh - ids) <= 0.01 * len(fresh) + 3 * (0.01 * len(fresh)) ** 0.5 + 1
