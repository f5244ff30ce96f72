"""Stream sessions and the stream join against the batch operators, with a hot group."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import fixtures
from test_ordered_batches import CLOSED_MS, ROWS, Feed, same
from tidemark.operators import joins, windows
from tidemark.streaming import join_batches
from tidemark.streaming import ordered_batches as ob

BASE = fixtures.BASE_MS
AGGREGATES = {"cnt": ("count", "num"), "total": ("sum", "num"), "least": ("min", "id"), "most": ("max", "id")}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture(scope="module")
def rates(spark):
    return fixtures.frame(spark, ROWS).persist()


@pytest.mark.parametrize("gap, rows_per_task", [("1 second", None), ("1 second", 40), ("300 milliseconds", 40)])
def test_sessions(feed, rates, gap, rows_per_task):
    size = len(ROWS) // 4
    feed.add(*[ROWS[i : i + size][::-1] for i in range(0, len(ROWS), size)])
    got = feed.drain(ob.Sessions(["hbdm"], gap, "et", ["id"], AGGREGATES, rows_per_task))
    expected = windows.session(rates, "et", gap, ["hbdm"], AGGREGATES)
    done = expected.filter(F.unix_millis("w_end") <= CLOSED_MS)
    assert 0 < done.count() < expected.count()
    same(got, done, "hbdm", "w_start", "w_end", *AGGREGATES)


@pytest.mark.parametrize("ms, count", [(1000, 1), (999, 1), (1001, 2)])
def test_session_gap_edge_over_batches(feed, ms, count):
    feed.add([(1, "A", BASE, 1)], [(2, "A", BASE + ms, 1)], [(3, "B", BASE + 60_000, 1)])
    got = feed.drain(ob.Sessions(["hbdm"], "1 second", "et", ["id"], {"cnt": ("count", "num")}))
    assert sorted(r.cnt for r in got.collect()) == [2] if count == 1 else [1, 1]


def _sides(rows):
    left = rows.filter("id % 3 = 0").select(F.col("et").alias("let"), F.col("hbdm").alias("lk"), F.col("id").alias("lid"))
    right = rows.filter("id % 3 <> 0").select(F.col("et").alias("ret"), F.col("hbdm").alias("rk"), F.col("id").alias("rid"))
    return left, right


ON = {"on": [("lk", "rk")], "left_time": "let", "right_time": "ret", "size": "5 seconds"}


@pytest.mark.parametrize("rows_per_task", [None, 5])
def test_join_of_streams(feed, rates, rows_per_task):
    size = len(ROWS) // 3
    feed.add(*[ROWS[i : i + size][::-1] for i in range(0, len(ROWS), size)])
    rows = join_batches.both_sides(*_sides(feed.stream()))
    got = join_batches.drain(rows, str(feed.path / "run"), **ON, rows_per_task=rows_per_task)
    same(got, joins.window_join(*_sides(rates), ON["on"], "let", "ret", "5 seconds"), "lk", "lid", "rid")
    waiting = [feed.spark.read.parquet(f"{feed.path}/run/state/run=*/batch_id=2/side_{s}").count() for s in (0, 1)]
    assert sum(waiting) < len(ROWS)


def test_retried_batch_and_late_rows(spark, tmp_path, rates):
    target = join_batches.JoinBatches(str(tmp_path / "data"), str(tmp_path / "state"), **ON)
    frame = lambda rows: join_batches.both_sides(*_sides(fixtures.frame(spark, rows)))
    rows = [(0, "A", BASE, 1), (1, "A", BASE + 1, 1)]
    target(frame(rows), 0)
    for _ in range(2):
        target(frame([(3, "A", BASE + 2, 1), (6, "A", BASE + 60_000, 1), (7, "A", BASE + 60_000, 1)]), 1)
    target(frame([(9, "A", BASE + 3, 1), (4, None, BASE + 60_001, 1), (12, None, BASE + 60_001, 1)]), 2)
    assert target.late == 1
    got = spark.read.schema(target.schema).parquet(str(tmp_path / "data"))
    assert sorted((r.lid, r.rid) for r in got.collect()) == [(0, 1), (3, 1), (6, 7)]


def test_hot_group_is_dealt_out(spark):
    """95 % of the left rows in one key and window: several tasks get a share, cold groups are not copied."""
    rows = [(3 * i, "hot" if i % 20 else f"k{i}", BASE + i % 900, 1) for i in range(6_000)]
    rows += [(1, "hot", BASE, 1), (4, "k20", BASE, 1)]
    left, right = _sides(fixtures.frame(spark, rows))
    hot = joins.hot_pairs(left.withColumn("g", F.xxhash64("lk")), F.col("g"), 1_000)
    assert list(hot.values()) == [6]
    joined = joins.window_join_by_size(left, right, ON["on"], "let", "ret", "5 seconds", 1_000)
    same(joined, joins.window_join(left, right, ON["on"], "let", "ret", "5 seconds"), "lid", "rid")
    assert joined.count() == 5_700 + 1


def test_cold_keys_stay_on_the_plain_window(spark):
    from tidemark.operators import over
    from tidemark.plans import ordered

    rows = [(i, "hot" if i % 4 else f"k{i % 50}", BASE + 10 * i, i % 5) for i in range(4_000)]
    frame = fixtures.frame(spark, rows)
    sizes = ordered.measure(frame, ["hbdm"], 1_000)
    assert sizes.chunks == 3 and len(sizes.hot) == 1
    assert ordered.measure(frame, ["hbdm"], 3_000) == ordered.Sizes() and ordered.measure(frame, [], 1_000) == ordered.Sizes(4)
    everything = ordered.measure(frame.filter("hbdm = 'hot'"), ["hbdm"], 1_000)
    assert everything == ordered.Sizes(3)
    got = over.over_rows(frame, ["hbdm"], ["et", "id"], "num", 10, rows_per_task=1_000)
    same(got, over.over_rows(frame, ["hbdm"], ["et", "id"], "num", 10), "id", "sum_num")
    cut = [f for f in got.inputFiles()]
    kept = spark.read.parquet(cut[0].rsplit("/", 1)[0])
    assert kept.count() == 3_000 and {r.hbdm for r in kept.select("hbdm").distinct().collect()} == {"hot"}
