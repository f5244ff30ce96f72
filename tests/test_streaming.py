"""Streams fed in several micro-batches against the batch operators."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

import fixtures
from tidemark.operators import aggregate, changelog, dedup, over, patterns, windows
from tidemark.sources import files
from tidemark.streaming import dedup as stream_dedup
from tidemark.streaming import sinks, stateful

BASE = fixtures.BASE_MS
SCHEMA = fixtures.RATE_SCHEMA
ROWS = sorted(fixtures.skewed(), key=lambda r: (r[2], r[0]))
CLOSED_MS = max(r[2] for r in ROWS) - 1000


class Feed:
    """A folder that receives one file per micro-batch, and the queries reading it."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        (path / "in").mkdir()

    def add(self, *batches):
        for rows in batches:
            file = self.path / "in" / f"{self.files:03}.json"
            names = ["id", "hbdm", "ts", "num"]
            file.write_text("".join(json.dumps(dict(zip(names, r))) + "\n" for r in rows))
            os.utime(file, (1_000_000 + self.files, 1_000_000 + self.files))
            self.files += 1
        return self

    def stream(self, delay="1 second"):
        raw = files.stream_table(self.spark, str(self.path / "in"), SCHEMA, "json", 1)
        timed = raw.withColumn("et", F.timestamp_millis("ts"))
        return timed.withWatermark("et", delay) if delay else timed

    def drain(self, df, mode="append"):
        if mode == "append":
            writer = files.stream_files(df, str(self.path / "out"), str(self.path / "check"))
        else:
            writer = sinks.each_batch(
                df, sinks.FanOut({str(self.path / "out"): lambda b: b}), str(self.path / "check"), mode
            )
        self.query = sinks.drain(writer)
        return self.spark.read.schema(df.schema).parquet(str(self.path / "out")).select(*df.columns)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def full_feed(feed):
    """All rows in time order over three batches, each batch in reverse."""
    size = len(ROWS) // 3
    return feed.add(*[ROWS[i : i + size][::-1] for i in range(0, len(ROWS), size)])


@pytest.fixture(scope="module")
def rates(spark):
    return fixtures.frame(spark, ROWS).persist()


def closed(df):
    return df.filter(F.unix_millis("et") <= CLOSED_MS)


def same(got, expected, *columns):
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(
        map(repr, map(tuple, expected.select(*columns).collect()))
    )


def test_over_rows(full_feed, rates):
    got = full_feed.drain(stateful.over_rows(full_feed.stream(), ["hbdm"], "et", ["id"], "num", 10))
    expected = over.over_rows(rates, ["hbdm"], ["et", "id"], "num", 10)
    same(got, closed(expected), "id", "sum_num")


def test_over_range_time(full_feed, rates):
    got = full_feed.drain(
        stateful.over_range_time(full_feed.stream(), ["hbdm"], "et", ["id"], "num", "10 seconds")
    )
    expected = over.over_range_time(rates, ["hbdm"], "et", "num", "10 seconds")
    same(got, closed(expected), "id", "sum_num")


def test_over_range_unbounded(full_feed, rates):
    got = full_feed.drain(
        stateful.over_range_unbounded(full_feed.stream(), ["hbdm"], "et", ["id"], "num")
    )
    expected = over.over_range_unbounded(rates, ["hbdm"], "et", "num")
    same(got, closed(expected), "id", "sum_num")


def test_session_first(full_feed, rates):
    got = full_feed.drain(
        stateful.dedup_session_first(full_feed.stream(), ["hbdm"], "1 second", "et", ["id"], ["num"])
    )
    expected = dedup.dedup_session_first(rates, ["hbdm"], "1 second", ["et", "id"])
    same(got, closed(expected), "id", "hbdm", "num", "et")


def test_same_millisecond_opens_one_session(feed):
    feed.add([(1, "A", BASE, 1), (2, "A", BASE, 2)], [(3, "B", BASE + 60_000, 3)])
    got = feed.drain(stateful.dedup_session_first(feed.stream(), ["hbdm"], "30 seconds", "et", ["id"]))
    assert [r.id for r in got.collect()] == [1]


@pytest.mark.parametrize("keys", [[], ["num"]])
def test_times(full_feed, rates, keys):
    condition = F.col("hbdm") == "CNY"
    last = max(r[2] for r in ROWS if r[1] == "CNY") - 1000
    got = full_feed.drain(
        stateful.times(full_feed.stream(), condition, "et", ["id"], 2, 4, keys, ["hbdm"])
    )
    expected = patterns.times(rates, condition, ["et", "id"], 2, 4, keys).withColumn(
        "end_et", F.element_at("matched", -1)["et"]
    )
    same(got, expected.filter(F.unix_millis("end_et") <= last), "id", "length", "et", "end_et", "hbdm")


def test_times_within(full_feed, rates):
    condition = F.col("hbdm") == "CNY"
    last = max(r[2] for r in ROWS if r[1] == "CNY") - 1000
    got = full_feed.drain(
        stateful.times(full_feed.stream(), condition, "et", ["id"], 3, 3, within="2 seconds")
    )
    expected = patterns.times(rates, condition, ["et", "id"], 3, 3, within="2 seconds").withColumn(
        "end_et", F.element_at("matched", -1)["et"]
    )
    same(got, expected.filter(F.unix_millis("end_et") <= last), "id", "end_et")


def test_succession(full_feed, rates):
    first, second, order = F.col("num") >= 0, F.col("num") > 0, ["et", "id"]
    got = full_feed.drain(
        stateful.succession(full_feed.stream(), first, second, "1 second", "et", ["id"], ["hbdm"])
    ).persist()
    matched = patterns.next_within(rates, first, second, "1 second", order, ["hbdm"])
    lost = patterns.timed_out(rates, first, "1 second", order, ["hbdm"])
    same(
        got.filter("kind = 'match'"),
        matched.filter(F.unix_millis("next_et") <= CLOSED_MS),
        "id",
        "next_et",
    )
    same(
        got.filter("kind = 'timeout'"), lost.filter(F.unix_millis("et") + 1000 <= CLOSED_MS), "id", "et"
    )


def test_repeat_alert(full_feed, rates):
    got = full_feed.drain(
        stateful.repeat_alert(full_feed.stream(), ["hbdm"], "et", ["id"], "id", "4 seconds", 5)
    )
    expected = patterns.repeat_alert(rates, ["hbdm"], ["et", "id"], "id", "4 seconds", 5)
    same(got, closed(expected), "id", "cnt", "first_task")


def test_retract_count(feed, rates):
    arrivals = sorted(ROWS)
    feed.add(*[arrivals[i : i + 50][::-1] for i in range(0, len(arrivals), 50)])
    got = feed.drain(stateful.retract_count(feed.stream(None), "hbdm", ["id"]), "update")
    same(got, changelog.retract_count(rates, "hbdm", ["id"]), "acc", "hbdm", "cnt_num", "id")


def test_restart_continues_from_the_checkpoint(feed, rates):
    size = len(ROWS) // 4
    for i in range(0, len(ROWS), size):
        feed.add(ROWS[i : i + size])
        got = feed.drain(stateful.over_rows(feed.stream(), ["hbdm"], "et", ["id"], "num", 10))
    expected = over.over_rows(rates, ["hbdm"], ["et", "id"], "num", 10)
    same(got, closed(expected), "id", "sum_num")


def test_bucket_dedup_drops_late_rows(feed):
    offsets = [("A", 1000), ("A", 3500), ("A", 4000), ("A", 4500), ("A", 15000), ("B", 30000), ("A", 9000)]
    feed.add(*[[(i, code, BASE + ms, 0)] for i, (code, ms) in enumerate(offsets)])
    unique = stream_dedup.dedup_bucket(feed.stream(None), "10 seconds", "1 second", "10 seconds")
    got = feed.drain(unique)
    assert sorted(r.ts - BASE for r in got.collect()) == [1000, 15000, 30000]
    assert sinks.late_rows(feed.query) == 1
    assert sinks.state_rows(feed.query) == 1


def test_first_in_bucket_is_the_first_to_arrive(feed):
    base = BASE - BASE % 30_000
    offsets = [(3, 5000), (2, 1000), (1, 4000), (4, 11_000), (5, 31_000)]
    feed.add([(i, "A", base + ms, i) for i, ms in offsets], [(6, "A", base + 95_000, 6)])
    stream = feed.stream(None).select("id", "et", "ts", "hbdm", "num")
    got = feed.drain(stream_dedup.first_in_bucket(stream, "10 seconds", ["id"]))
    assert sorted((r.id, r.ts - base) for r in got.collect()) == [(1, 4000), (4, 11_000), (5, 31_000)]


def test_open_window_keeps_a_bucket_that_the_watermark_passed(feed):
    """Late means late for the 30 second window, not for the 10 second bucket in it."""
    offsets = [("A", 1000), ("B", 25000), ("A", 9000), ("C", 9500)]
    base = BASE - BASE % 30_000
    feed.add(*[[(i, code, base + ms, 0)] for i, (code, ms) in enumerate(offsets)])
    got = feed.drain(stream_dedup.dedup_bucket(feed.stream(None), "10 seconds"))
    assert sorted(r.ts - base for r in got.collect()) == [1000, 9500, 25000]
    assert sinks.late_rows(feed.query) == 0


def test_hour_dedup(feed):
    hour = 3_600_000
    start = BASE - BASE % hour
    feed.add(
        [(1, "A", start + 5, 1), (2, "A", start + 6, 1)],
        [(3, "A", start + 7, 1), (4, "A", start + hour + 1, 1)],
        [(5, "B", start + 3 * hour, 1)],
        [(6, "B", start + 3 * hour + 1, 1)],
        [(7, "A", start + 8, 1)],
    )
    got = feed.drain(stream_dedup.dedup_hour(feed.stream(None), ["hbdm"]))
    ends = sorted((r.hbdm, r.ms - start) for r in got.withColumn("ms", F.unix_millis("hour_end")).collect())
    assert ends == [("A", hour), ("A", 2 * hour), ("B", 4 * hour)]
    assert sinks.late_rows(feed.query) == 1


@pytest.mark.parametrize("ms, count", [(1000, 1), (999, 1), (1001, 2)])
def test_session_gap_edge(feed, ms, count):
    feed.add([(1, "A", BASE, 1), (2, "A", BASE + ms, 1)], [(3, "B", BASE + 60_000, 1)])
    got = feed.drain(windows.sql_session(feed.stream(), "1 second"))
    assert got.count() == count


def test_windows_close_with_the_watermark(full_feed, rates):
    got = full_feed.drain(windows.rate_summary(full_feed.stream(), size="1 second"))
    expected = windows.rate_summary(rates, size="1 second")
    done = expected.filter(F.unix_millis("w_end") <= CLOSED_MS)
    same(got, done, "hbdm", "w_start", "w_end", "sum_num", "min_ts", "max_ts")
    assert 0 < got.count() < expected.count()


def test_group_count_updates(feed, rates):
    feed.add(ROWS[:100], ROWS[100:])
    updates = feed.drain(aggregate.group_count(feed.stream(None)), "update")
    last = updates.groupBy("hbdm").agg(F.max("cnt_num").alias("cnt_num"))
    same(last, aggregate.group_count(rates), "hbdm", "cnt_num")


def test_update_mode_returns_the_last_row_of_each_key(feed, rates):
    feed.add(ROWS[:80], ROWS[80:160], ROWS[160:])
    got = sinks.run_to_table(aggregate.group_count(feed.stream(None)), "update", ["hbdm"])
    expected = aggregate.group_count(rates)
    assert got.count() == expected.count()
    same(got, expected, "hbdm", "cnt_num")


def test_state_is_bounded(feed):
    """Rows of long-gone keys leave the state once the watermark has passed them."""
    batches = [
        [(100 * b + k, f"K{b}-{k}", BASE + 100_000 * b + k, 1) for k in range(20)] for b in range(4)
    ]
    feed.add(*batches)
    feed.drain(
        stateful.over_range_time(feed.stream(), ["hbdm"], "et", ["id"], "num", "10 seconds")
    )
    assert sinks.state_rows(feed.query) <= 4 * 20


def test_late_rows_are_counted(feed):
    """Spark compares with the watermark that the previous batch started with."""
    times = [60_000, 61_000, 0, 120_000]
    feed.add(*[[(i, "A", BASE + ms, 1)] for i, ms in enumerate(times)])
    got = feed.drain(stateful.over_rows(feed.stream(), ["hbdm"], "et", ["id"], "num", 10))
    assert sorted(r.id for r in got.collect()) == [0, 1]
    assert sinks.late_rows(feed.query) == 1


def test_large_integers_beside_nulls_stay_exact(spark, tmp_path):
    big = 2**60 + 1
    schema = "id BIGINT, k BIGINT, ts BIGINT, num BIGINT"
    source = str(tmp_path / "in")
    rows = [(1, big, BASE, big), (2, None, BASE + 1, None), (3, big + 1, BASE + 2, 2), (4, big, BASE + 3, None)]
    last = (5, 0, BASE + 60_000, 0)
    spark.createDataFrame([*rows, last], schema).coalesce(1).write.parquet(source)
    stream = files.stream_table(spark, source, schema).withColumn("et", F.timestamp_millis("ts"))
    sums = stateful.over_rows(stream.withWatermark("et", "1 second"), ["k"], "et", ["id"], "num", 10)
    got = sinks.run_to_table(sums).select("id", "k", "num", "sum_num").collect()
    assert sorted(map(tuple, got)) == [
        (1, big, big, big),
        (2, None, None, None),
        (3, big + 1, 2, 2),
        (4, big, None, big),
    ]
    changes = stateful.retract_count(stream, "k", ["id"], "num")
    counts = sinks.run_to_table(changes, "update").collect()
    assert sorted((r.id, r.k, r.acc, r.cnt_num) for r in counts) == [
        (1, big, True, 1),
        (2, None, True, 0),
        (3, big + 1, True, 1),
        (5, 0, True, 1),
    ]


@pytest.mark.parametrize("kind", ["over_rows", "over_range_time", "over_range_unbounded"])
def test_stream_sums_are_exact_for_decimals_and_ignore_null_times(spark, feed, kind):
    rows = fixtures.frame(spark, ROWS)
    exact = rows.withColumn("num", (F.col("num") + F.lit(0.7)).cast("decimal(6,1)"))
    feed.add(ROWS[:120], ROWS[120:])
    stream = feed.stream().withColumn("num", (F.col("num") + F.lit(0.7)).cast("decimal(6,1)"))
    if kind == "over_rows":
        got = stateful.over_rows(stream, ["hbdm"], "et", ["id"], "num", 10)
        expected = over.over_rows(exact, ["hbdm"], ["et", "id"], "num", 10)
    elif kind == "over_range_time":
        got = stateful.over_range_time(stream, ["hbdm"], "et", ["id"], "num", "10 seconds")
        expected = over.over_range_time(exact, ["hbdm"], "et", "num", "10 seconds")
    else:
        got = stateful.over_range_unbounded(stream, ["hbdm"], "et", ["id"], "num")
        expected = over.over_range_unbounded(exact, ["hbdm"], "et", "num")
    found = feed.drain(got)
    early = {r.id for r in found.collect()}
    same(found, expected.filter(F.col("id").isin(list(early))), "id", "sum_num")


def test_stream_sums_refuse_floating_point(feed):
    feed.add(ROWS[:10])
    with pytest.raises(TypeError, match="integer or decimal"):
        stateful.over_rows(feed.stream().withColumn("num", F.col("num").cast("double")), ["hbdm"], "et", ["id"], "num", 10)


@pytest.mark.parametrize("name", ["stream_group_count", "stream_tumble", "stream_over_range_unbounded", "stream_dedup_bucket"])
def test_streams_read_a_folder_of_part_files(spark, sf_dir, duck, tmp_path, name):
    import compare

    import __spark_entry__ as contract

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartitionByRange(40, "event_id").sortWithinPartitions("event_id").write.parquet(str(tmp_path / "events.parquet"))
    got = contract.queries()[name](spark, str(tmp_path))
    compare.assert_same(got, duck, contract.oracle_sql()[name])
