from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import encode
from tidemark.operators import dedup, joins, project
from tidemark.sources import files, message_log, upsert
from tidemark.streaming import sinks

import fixtures


def test_upsert_log_last_row_wins_and_retries_leave_no_trace(spark, tmp_path):
    log = upsert.UpsertLog(str(tmp_path / "log"), ["k"], ["ts"])
    schema = "k STRING, ts BIGINT, v INT"
    log(spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], schema), 0)
    second = spark.createDataFrame([("a", 1, 9)], schema)
    log(second, 1)
    log(second, 1)
    assert sorted(map(tuple, log.read(spark).collect())) == [("a", 1, 9), ("b", 1, 3)]
    assert spark.read.parquet(log.path).count() == 3
    compacted = log.compact(spark, str(tmp_path / "compacted"))
    assert sorted(map(tuple, compacted.read(spark).collect())) == [("a", 1, 9), ("b", 1, 3)]


def test_upsert_log_as_stream_sink(spark, tmp_path):
    source = tmp_path / "in"
    for v in (1, 2):
        spark.createDataFrame([("a", v)], "k STRING, v INT").coalesce(1).write.mode("append").parquet(
            str(source)
        )
    stream = files.stream_table(spark, str(source), "k STRING, v INT", files_per_trigger=1)
    log = upsert.UpsertLog(str(tmp_path / "log"), ["k"], ["v"])
    sinks.drain(sinks.each_batch(stream, log, str(tmp_path / "check")))
    assert log.read(spark).count() == 1
    assert spark.read.parquet(log.path).select("batch_id").distinct().count() == 2


def fake_connection(folder):
    """Writes what it was asked to execute into a folder.

    Defined in a function so that it travels to the workers by value.
    """

    class Connection:
        def __init__(self):
            self.calls = []

        def cursor(self):
            return self

        def executemany(self, statement, rows):
            self.calls.append((statement, [list(r) for r in rows]))

        def commit(self):
            with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as file:
                json.dump(self.calls, file)

        def close(self):
            pass

    return Connection


def test_batched_statements(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.range(25).select(
        F.col("id").alias("k"), F.lit("A").alias("name"), F.lit(1).alias("v")
    ).coalesce(2)
    columns = ["k", "name", "v"]
    statement = upsert.replace_statement("target", columns)
    assert statement == "REPLACE INTO target(k,name,v) values(?,?,?)"
    upsert.write_batched(df, fake_connection(folder), statement, columns, batch_size=10)
    calls = [c for p in tmp_path.glob("*.json") for c in json.loads(p.read_text())]
    assert sorted(r[0] for _, rows in calls for r in rows) == list(range(25))
    assert max(len(rows) for _, rows in calls) <= 10
    assert {s for s, _ in calls} == {statement}


def test_fan_out_writes_each_target_once(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("cny", "rest")}
    fan = sinks.FanOut(
        {
            paths["cny"]: lambda b: b.filter("hbdm = 'CNY'"),
            paths["rest"]: lambda b: b.filter("hbdm <> 'CNY'"),
        }
    )
    batch = spark.createDataFrame([(1, "CNY"), (2, "USD"), (3, "CNY")], "id INT, hbdm STRING")
    fan(batch, 0)
    fan(batch, 0)
    assert spark.read.parquet(paths["cny"]).count() == 2
    assert spark.read.parquet(paths["rest"]).count() == 1


def test_csv_and_text_files(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(1, "A", 2), (3, "B", 4)]
    files.write_csv(spark.createDataFrame(rows, "ts BIGINT, hbdm STRING, num INT"), path)
    assert sorted(map(tuple, files.read_rate_csv(spark, path).collect())) == rows
    assert sorted(r.value for r in files.read_text(spark, path).collect()) == ["1,A,2", "3,B,4"]


def test_csv_stream_sink_is_exactly_once(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([("1,A,2",), ("3,B,4",)], "value STRING").write.text(source)
    for _ in range(2):
        stream = files.stream_text(spark, source)
        sinks.drain(files.stream_files(stream, out, check, "text"))
    assert files.read_text(spark, out).count() == 2


def test_text_stream_to_distinct_words(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("a b  a\nc\n")
    words = project.distinct_words(files.stream_text(spark, str(tmp_path / "in")), "value")
    out = str(tmp_path / "out")
    sinks.drain(files.stream_files(words, out, str(tmp_path / "check")))
    assert sorted(r.word for r in spark.read.parquet(out).collect()) == ["", "a", "b", "c"]


def test_bloom_dedup_across_batches(spark, tmp_path):
    sink = sinks.BloomDedup(
        str(tmp_path / "filter"), str(tmp_path / "out"), ["k"], ["id"], expected=2000, fpp=0.001
    )
    schema = "k STRING, id INT"
    batches = [
        [(f"k{i % 50}", i) for i in range(200)],
        [(f"k{i}", i) for i in range(40, 90)],
        [(f"k{i}", i) for i in range(100)],
    ]
    for number, rows in enumerate(batches):
        sink(spark.createDataFrame(rows, schema), number)
    sink(spark.createDataFrame(batches[2], schema), 2)
    kept = [r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(kept) == len(set(kept))
    assert 98 <= len(kept) <= 100
    sink.compact(spark, str(tmp_path / "compacted"), 2)
    words = spark.read.parquet(str(tmp_path / "compacted"))
    assert words.count() == words.select("part", "word").distinct().count()


def test_bloom_dedup_far_beyond_the_expected_keys(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = sinks.BloomDedup(str(tmp_path / "filter"), out, ["k"], ["k"], expected=500, fpp=0.01)
    for number in range(3):
        sink(spark.range(10_000 * number, 10_000 * (number + 1)).withColumnRenamed("id", "k"), number)
        sink(spark.range(10_000 * number).withColumnRenamed("id", "k"), 100 + number)
    kept = spark.read.parquet(out).select("k")
    assert kept.count() == kept.distinct().count()
    assert kept.count() >= 30_000 * 0.98


def test_a_new_checkpoint_keeps_what_an_earlier_run_wrote(spark, tmp_path):
    log = upsert.UpsertLog(str(tmp_path / "log"), ["k"], ["v"])
    fan = sinks.FanOut({str(tmp_path / "fan"): lambda b: b})
    bloom = sinks.BloomDedup(str(tmp_path / "filter"), str(tmp_path / "kept"), ["k"], ["v"])
    for run, rows in enumerate(([("a", 1), ("c", 5)], [("b", 2), ("c", 4)])):
        source = str(tmp_path / f"in{run}")
        spark.createDataFrame(rows, "k STRING, v INT").write.parquet(source)
        for n, sink in enumerate((log, fan, bloom)):
            stream = files.stream_table(spark, source, "k STRING, v INT", files_per_trigger=10)
            sinks.drain(sinks.each_batch(stream, sink, str(tmp_path / f"check{run}{n}")))
    assert sorted(map(tuple, log.read(spark).collect())) == [("a", 1), ("b", 2), ("c", 4)]
    assert spark.read.parquet(str(tmp_path / "fan")).count() == 4
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert sorted((r.k, r.v) for r in kept.collect()) == [("a", 1), ("b", 2), ("c", 5)]


def test_bloom_never_lets_a_seen_key_through(spark):
    seen = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    fresh = spark.range(5000, 10000).select(F.col("id").cast("string").alias("k"))
    both = seen.unionByName(fresh)
    kept = dedup.bloom_antifilter(both, seen, ["k"], fpp=0.01)
    assert kept.join(seen, "k", "left_semi").count() == 0
    assert kept.count() >= 5000 * 0.985


def test_bloom_union(spark):
    left = spark.createDataFrame([("a",)], "k STRING")
    right = spark.createDataFrame([("b",)], "k STRING")
    union = dedup.bloom_union(*[dedup.bloom_words(d, ["k"], 10, 4) for d in (left, right)])
    marked = dedup.bloom_mark(left.unionByName(right), union, ["k"], 10, 4, "hit")
    assert all(r.hit for r in marked.collect())


def test_message_log_options():
    log = message_log.MessageLog("host:9092", "group1", max_offsets_per_trigger=1000)
    assert log.reader_options(["test", "other"]) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "test,other",
        "startingOffsets": "latest",
        "kafka.group.id": "group1",
        "maxOffsetsPerTrigger": "1000",
    }
    assert log.writer_options("sink") == {"kafka.bootstrap.servers": "host:9092", "topic": "sink"}


def test_messages_fan_out_to_topics(spark):
    df = spark.createDataFrame([(1, "A")], "ts BIGINT, hbdm STRING")
    one = message_log.messages(df, encode.row_text(["ts", "hbdm"]))
    assert [tuple(r) for r in one.collect()] == [("1,A",)]
    two = message_log.messages(df, encode.json_text(["ts", "hbdm"]), ["x", "y"])
    assert sorted(map(tuple, two.collect())) == [
        ('{"hbdm":"A","ts":1}', "x"),
        ('{"hbdm":"A","ts":1}', "y"),
    ]


def test_message_text_keeps_the_position(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"1,A,2"), "t", 0, 5)], "value BINARY, topic STRING, partition INT, offset BIGINT"
    )
    assert tuple(message_log.text(raw).first()) == ("1,A,2", "t", 0, 5)


def test_split_routes(spark):
    df = spark.createDataFrame([("airport_retry",), ("DRONE_RETRY",), ("DRONE",)], "type STRING")
    routes = project.split_routes(df, project.retry_routes())
    assert {n: d.count() for n, d in routes.items()} == {
        "airport_retry": 1,
        "drone_retry": 1,
        "main": 1,
    }


def test_null_type_goes_to_main(spark):
    df = spark.createDataFrame([(None,)], "type STRING")
    assert project.split_routes(df, project.retry_routes())["main"].count() == 1


def test_map_batches(spark):
    def double(batches):
        for batch in batches:
            yield batch.assign(num=batch.num * 2)

    df = spark.createDataFrame([(1,), (2,)], "num INT")
    assert sorted(r.num for r in project.map_batches(df, double, "num INT").collect()) == [2, 4]


@pytest.mark.parametrize("salt", [1, 3])
def test_window_join(spark, salt):
    base = fixtures.BASE_MS
    orders = spark.createDataFrame(
        [(base + t, "A", 1, c, v) for t, c, v in [(0, "CNY", 2), (9999, "CNY", 3), (10000, "CNY", 5), (1, None, 7)]],
        "ts BIGINT, catlog STRING, subcat INT, hbdm STRING, value INT",
    )
    rates = spark.createDataFrame(
        [(base + t, c, n) for t, c, n in [(5, "CNY", 2_000_000_000), (7, "USD", 1), (10001, "CNY", 4), (2, None, 1)]],
        "ts BIGINT, hbdm STRING, num INT",
    )
    timed = [d.withColumn("et", F.timestamp_millis("ts")) for d in (orders, rates)]
    rows = joins.order_rate_join(*timed, salt=salt).collect()
    assert sorted((r.ts - base, r.rate_ts - base, r.amount) for r in rows) == [
        (0, 5, 4_000_000_000),
        (9999, 5, 6_000_000_000),
        (10000, 10001, 20),
    ]
    assert len(rows[0]) == 9


def test_console_sink_takes_every_row(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("a",), ("b",)], "value STRING").write.text(source)
    query = sinks.drain(files.stream_console(files.stream_text(spark, source), str(tmp_path / "check")))
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
