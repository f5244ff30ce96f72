"""Event-ordered steps on micro-batches against the batch operators, with hot keys and retries."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

import fixtures
from tidemark.operators import changelog, dedup, over, patterns
from tidemark.sources import files
from tidemark.streaming import ordered_batches as ob

BASE = fixtures.BASE_MS
ROWS = sorted(fixtures.skewed(), key=lambda r: (r[2], r[0]))
CLOSED_MS = max(r[2] for r in ROWS) - 1000
NAMES = ["id", "hbdm", "ts", "num"]


class Feed:
    """A folder with one file per micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        (path / "in").mkdir()

    def add(self, *batches):
        for rows in batches:
            file = self.path / "in" / f"{self.files:03}.json"
            file.write_text("".join(json.dumps(dict(zip(NAMES, r))) + "\n" for r in rows))
            os.utime(file, (1_000_000 + self.files, 1_000_000 + self.files))
            self.files += 1
        return self

    def stream(self):
        raw = files.stream_table(self.spark, str(self.path / "in"), fixtures.RATE_SCHEMA, "json", 1)
        return raw.withColumn("et", F.timestamp_millis("ts"))

    def drain(self, step, delay="1 second"):
        return ob.drain(self.stream(), step, delay, str(self.path / "run"))

    def late(self, step):
        return ob.OrderedBatches(step, f"{self.path}/run/data", f"{self.path}/run/state").late_rows(self.spark)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def full(feed):
    """All rows in time order over three batches, each batch in reverse."""
    size = len(ROWS) // 3
    return feed.add(*[ROWS[i : i + size][::-1] for i in range(0, len(ROWS), size)])


@pytest.fixture(scope="module")
def rates(spark):
    return fixtures.frame(spark, ROWS).persist()


def closed(df, column="et"):
    return df.filter(F.unix_millis(column) <= CLOSED_MS)


def same(got, expected, *columns):
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(
        map(repr, map(tuple, expected.select(*columns).collect()))
    )


# With a bound of 40 rows a task, every key of the fixture and the un-keyed order are split.
SPLITS = [None, 40]


@pytest.mark.parametrize("rows_per_task", SPLITS)
def test_row_frames(full, rates, rows_per_task):
    got = full.drain(ob.RowFrame(["hbdm"], "et", ["id"], "num", 10, rows_per_task))
    same(got, closed(over.over_rows(rates, ["hbdm"], ["et", "id"], "num", 10)), "id", "sum_num")


@pytest.mark.parametrize("rows_per_task", SPLITS)
def test_time_frames(full, rates, rows_per_task):
    got = full.drain(ob.TimeFrame(["hbdm"], "et", ["id"], "num", "10 seconds", rows_per_task))
    same(got, closed(over.over_range_time(rates, ["hbdm"], "et", "num", "10 seconds")), "id", "sum_num")


@pytest.mark.parametrize("rows_per_task", SPLITS)
def test_running_totals(full, rates, rows_per_task):
    got = full.drain(ob.Unbounded(["hbdm"], "et", ["id"], "num", rows_per_task))
    same(got, closed(over.over_range_unbounded(rates, ["hbdm"], "et", "num")), "id", "sum_num")


@pytest.mark.parametrize("keys, rows_per_task, within", [([], None, None), ([], 40, "3 seconds"), (["num"], 40, None), (["num"], None, "3 seconds")])
def test_runs_with_their_events(full, rates, keys, rows_per_task, within):
    condition = F.col("hbdm") == "CNY"
    last = max(r[2] for r in ROWS if r[1] == "CNY") - 1000
    step = ob.Repeats(condition, keys, "et", ["id"], 2, 4, ["id", "num"], ["hbdm"], within, rows_per_task)
    expected = patterns.times(rates, condition, ["et", "id"], 2, 4, keys, ["id", "num"], within)
    done = expected.filter(F.unix_millis(F.element_at("matched", -1)["et"]) <= last)
    same(full.drain(step), done, "id", "hbdm", "length", "matched")


@pytest.mark.parametrize("keys, rows_per_task", [(["hbdm"], None), (["hbdm"], 40), ([], 40)])
def test_successions_and_timeouts(full, rates, keys, rows_per_task):
    first, second, order = F.col("num") >= 0, F.col("num") > 0, ["et", "id"]
    got = full.drain(ob.Succession(first, second, "1 second", keys, "et", ["id"], (), rows_per_task)).persist()
    matched = patterns.next_within(rates, first, second, "1 second", order, keys)
    lost = patterns.timed_out(rates, first, "1 second", order, keys)
    same(got.filter("kind = 'match'"), closed(matched, "next_et"), "id", "next_et")
    same(got.filter("kind = 'timeout'"), lost.filter(F.unix_millis("et") + 1000 <= CLOSED_MS), "id", "et")


@pytest.mark.parametrize("rows_per_task", SPLITS)
def test_repeat_alerts(full, rates, rows_per_task):
    got = full.drain(ob.RepeatAlert(["hbdm"], "et", ["id"], "id", "4 seconds", 5, rows_per_task))
    same(got, closed(patterns.repeat_alert(rates, ["hbdm"], ["et", "id"], "id", "4 seconds", 5)), "id", "cnt", "first_task")


@pytest.mark.parametrize("rows_per_task", SPLITS)
def test_changelog(feed, rates, rows_per_task):
    arrivals = sorted(ROWS)
    feed.add(*[arrivals[i : i + 90][::-1] for i in range(0, len(arrivals), 90)])
    got = feed.drain(ob.RetractCount("hbdm", ["id"], "num", rows_per_task))
    same(got, changelog.retract_count(rates, "hbdm", ["id"]), "acc", "hbdm", "cnt_num", "id")


@pytest.mark.parametrize("rows_per_task", SPLITS)
def test_sessions_open_at_once(full, rates, rows_per_task):
    """All rows in time order: no row waits, so the end of the stream is answered too."""
    got = full.drain(ob.SessionFirst(["hbdm"], "1 second", "et", ["id"], ["num"], rows_per_task))
    same(got, dedup.dedup_session_first(rates, ["hbdm"], "1 second", ["et", "id"]), "id", "hbdm", "num", "et")


def test_sessions_of_rows_out_of_order(feed):
    """A session's row is out in the batch it arrives in; a row that joins two sessions is out of neither."""
    step = ob.SessionFirst(["hbdm"], "10 seconds", "et", ["id"])
    at = lambda i, seconds, code="A": (i, code, BASE + 1000 * seconds, 1)
    out = lambda: sorted(r.id for r in feed.drain(step, "60 seconds").collect())
    assert feed.add([at(1, 100), at(2, 100), at(3, 100, None)]) and out() == [1, 3]
    assert feed.add([at(4, 120)]) and out() == [1, 3, 4]
    assert feed.add([at(5, 110)]) and out() == [1, 3, 4]  # reaches both
    assert feed.add([at(6, 105), at(7, 131), at(8, 90), at(9, 79)]) and out() == [1, 3, 4, 7, 9]
    assert feed.add([at(10, 400)]) and out() == [1, 3, 4, 7, 9, 10]
    assert feed.add([at(11, 120)]) and out() == [1, 3, 4, 7, 9, 10] and feed.late(step) == 1
    clock = feed.spark.read.parquet(f"{feed.path}/run/state/run=*/batch_id=5/tail")
    assert clock.count() == 2  # one open session, as its begin and end


def test_late_and_timeless_rows_are_dropped_and_counted(feed):
    times = [60_000, 61_000, 0, 120_000]
    feed.add(*[[(i, "A", BASE + ms, 1)] for i, ms in enumerate(times)], [(9, "A", None, 1)], [])
    step = ob.RowFrame(["hbdm"], "et", ["id"], "num", 10)
    assert sorted((r.id, r.sum_num) for r in feed.drain(step).collect()) == [(0, 1), (1, 2)]
    assert feed.late(step) == 1


def test_restart_and_retry_give_each_row_once(feed, rates):
    """Fed and drained bit by bit; then the last batch is tried again."""
    step = ob.TimeFrame(["hbdm"], "et", ["id"], "num", "10 seconds")
    size = len(ROWS) // 4 + 1
    for i in range(0, len(ROWS), size):
        got = feed.add(ROWS[i : i + size]).drain(step)
    expected = closed(over.over_range_time(rates, ["hbdm"], "et", "num", "10 seconds"))
    same(got, expected, "id", "sum_num")
    again = ob.OrderedBatches(step, f"{feed.path}/retry/data", f"{feed.path}/retry/state")
    for n in (0, 1, 1, 2, 3, 3):
        again(fixtures.frame(feed.spark, ROWS[n * size : (n + 1) * size]), n)
    same(feed.spark.read.parquet(f"{feed.path}/retry/data"), expected, "id", "sum_num")
    state = f"{feed.path}/retry/state/run=direct"
    assert sorted(os.listdir(state))[-1] == "batch_id=3" and len([d for d in os.listdir(state) if "batch" in d]) == 2


def test_hot_key_is_split(spark, tmp_path):
    """95 % of the rows in one key: no task of the ordered stages reads more than a few chunks of it."""
    rows = [(i, "hot" if i % 20 else f"k{i}", BASE + 10 * i, i % 5) for i in range(8_000)]
    frame = fixtures.frame(spark, rows)
    step = ob.RowFrame(["hbdm"], "et", ["id"], "num", 10, rows_per_task=1_000)
    both = step.rows(frame).withColumn(ob.US, F.unix_micros("et")).withColumn(ob.NEW, F.lit(True))
    found = step.results(both, 1 << 60)
    sizes = [r["count"] for r in found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()]
    assert len(sizes) >= 2
    chunks = spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0]).groupBy("_chunk").count().collect()
    assert len(chunks) == 8 and max(r["count"] for r in chunks) <= 2 * 1_000
    same(found, over.over_rows(frame, ["hbdm"], ["et", "id"], "num", 10), "id", "sum_num")


def test_exact_sums(spark, feed):
    """Large integers beside nulls, a null key, decimals; floating point is refused."""
    big = 2**60 + 1
    schema = "id BIGINT, k BIGINT, ts BIGINT, num BIGINT"
    rows = [(1, big, BASE, big), (2, None, BASE + 1, None), (3, big + 1, BASE + 2, 2), (4, big, BASE + 3, None), (5, 0, BASE + 60_000, 0)]
    frame = spark.createDataFrame(rows, schema).withColumn("et", F.timestamp_millis("ts"))
    for step in (ob.RowFrame(["k"], "et", ["id"], "num", 10), ob.Unbounded(["k"], "et", ["id"], "num")):
        target = ob.OrderedBatches(step, f"{feed.path}/{type(step).__name__}", f"{feed.path}/s{type(step).__name__}")
        target(frame.filter("id < 3"), 0)
        target(frame.filter("id >= 3"), 1)
        got = spark.read.schema(target.schema).parquet(target.target)
        assert sorted((r.id, r.k, r.sum_num) for r in got.collect()) == [(1, big, big), (2, None, None), (3, big + 1, 2), (4, big, big)]
    exact = frame.withColumn("num", F.col("num").cast("decimal(20,1)") / 1)
    assert "decimal" in ob.Unbounded(["k"], "et", ["id"], "num").rows(exact.withColumn("num", F.col("id").cast("decimal(6,1)"))).schema["_total"].dataType.simpleString()
    with pytest.raises(TypeError, match="integer or decimal"):
        ob.RowFrame(["k"], "et", ["id"], "num", 10).rows(frame.withColumn("num", F.col("num").cast("double")))
