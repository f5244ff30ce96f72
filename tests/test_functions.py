from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import decode, encode, hashing, time
from tidemark.sources import files


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_csv_rate_flags_bad_lines(spark):
    df = lines(
        spark, "1700000000123,XYZ,0", "1,CNY", "1,CNY,x", "", None, "1,CNY,2,extra", "1,CNY,2,,", " 1,A,2"
    )
    rows = decode.decode_csv_rate(df).select("ts", "hbdm", "num", "is_valid").collect()
    assert tuple(rows[0]) == (1700000000123, "XYZ", 0, True)
    assert tuple(rows[5]) == tuple(rows[6]) == (1, "CNY", 2, True)
    assert [r.is_valid for r in rows] == [True, False, False, False, False, True, True, False]
    assert all(r.ts is None and r.hbdm is None for r in rows if not r.is_valid)


def test_csv_order_needs_exactly_five_fields(spark):
    df = lines(spark, "5,A,1,CNY,7", "5,A,1,CNY", "5,A,1,CNY,7,8", "5,A,1,CNY,", "5,A,x,CNY,7")
    rows = decode.decode_csv_order(df).collect()
    assert [r.is_valid for r in rows] == [True, False, False, False, False]
    assert (rows[0].catlog, rows[0].subcat, rows[0].value) == ("A", 1, 7)


def test_accepted_and_rejected_are_a_partition(spark):
    decoded = decode.decode_csv_rate(lines(spark, "1,A,2", "bad", "3,B,4"))
    assert decode.accepted(decoded).count() == 2
    assert decode.rejected(decoded).select("value").first()[0] == "bad"


def test_json_rate_flags_bad_and_partial_messages(spark):
    df = lines(
        spark, '{"hbdm":"CNY","num":1,"timestamp":1700000001234}', "bad", '{"hbdm":"CNY"}', None
    )
    rows = decode.decode_json_rate(df).collect()
    assert [r.is_valid for r in rows] == [True, False, False, False]
    assert (rows[0].ts, rows[0].hbdm, rows[0].num) == (1700000001234, "CNY", 1)


def test_parse_runs_once_per_message(spark):
    decoded = decode.accepted(decode.decode_json_rate(lines(spark, "{}")))
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("message", ["bad", '{"hbdm":"CNY","timestamp":1}', None])
def test_strict_table_fails_even_when_the_field_is_unused(spark, message):
    df = lines(spark, '{"hbdm":"CNY","num":1,"timestamp":2}', message)
    decode.register_json_table(df, "strict_rate", schemas.RATE_MESSAGE)
    with pytest.raises(Exception, match="missing field|MALFORMED_RECORD"):
        spark.sql("SELECT hbdm FROM strict_rate").collect()


def test_strict_table_reads_good_messages(spark):
    df = lines(spark, '{"hbdm":"CNY","num":1,"timestamp":2}')
    decode.register_json_table(df, "strict_rate", schemas.RATE_MESSAGE)
    assert [tuple(r) for r in spark.sql("SELECT * FROM strict_rate").collect()] == [(2, "CNY", 1)]


def test_command_log(spark):
    good = (
        '{"ts":"2021-06-21 10:00:00.123","type":"AIRPORT_RETRY","serialnumber":"serial1",'
        '"task_id":"7","command_type":"DTT_UNMOUNT_BOX"}'
    )
    df = lines(
        spark,
        good,
        good.replace("AIRPORT_RETRY", "OTHER"),
        good.replace("DTT_UNMOUNT_BOX", "OTHER"),
        good.replace("10:00", "xx"),
    )
    rows = decode.decode_command_log(df).withColumn("et", F.col("et").cast("timestamp_ntz")).collect()
    assert [r.is_valid for r in rows] == [True, False, False, False]
    assert rows[0].et == dt.datetime(2021, 6, 21, 10, 0, 0, 123000)


def test_device_events_may_span_lines(spark, tmp_path):
    (tmp_path / "device.json").write_text(
        '{\n "time": "2024-02-03 04:05:06",\n "timestamp": 1706933106000,\n'
        ' "severity_level": 1,\n "source_id": "s-7",\n "code": "c-9"\n}\n'
    )
    row = files.read_device_events(spark, str(tmp_path)).first()
    assert (row.timestamp, row.severity_level, row.source_id, row.category) == (
        1706933106000,
        1,
        "s-7",
        None,
    )


def test_encoders_spell_null(spark):
    df = spark.createDataFrame([(True, 1, None), (False, None, "A")], "acc BOOLEAN, n INT, s STRING")
    rows = df.select(
        encode.row_text(["acc", "n", "s"]),
        encode.tuple_text(["n", "s"]),
        encode.changelog_text("acc", ["n"]),
        encode.changelog_text("acc", ["n"], ""),
        encode.json_text(["s", "n"]),
    ).collect()
    assert tuple(rows[0]) == ("true,1,null", "(1,null)", "true,1", "true1", '{"n":1}')
    assert tuple(rows[1]) == ("false,null,A", "(null,A)", "false,null", "falsenull", '{"s":"A"}')


def whole_hash(text: str, bits: int) -> int:
    """Each character weighs 32 times the next one."""
    return sum(ord(c) << (5 * place) for place, c in enumerate(reversed(text))) % (1 << bits)


@pytest.mark.parametrize("bits", [4, 10, 30, 31, 40])
def test_bit_offset_is_the_whole_hash(spark, bits):
    texts = ["", "A", "1700000000XYZ", "1699999000XYZ", "purchase", "äöü€汉字", "x" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r[0] for r in df.select(hashing.bit_offset("t", bits)).collect()]
    assert got == [whole_hash(t, bits) for t in texts]


def test_known_offset(spark):
    df = spark.createDataFrame([("AB",)], "t STRING")
    assert df.select(hashing.bit_offset("t")).first()[0] == 65 * 32 + 66


def test_time_buckets(spark):
    df = spark.createDataFrame([(1700000000014,), (1700000000515,), (3_600_000,)], "ts BIGINT")
    rows = df.select(
        time.time_bucket("ts", 1000), time.bucket_end("ts", 3_600_000), time.bucket_end("ts", 60_000, 1000)
    ).collect()
    assert rows[0][0] == rows[1][0] == 1700000000
    assert rows[2][1] == 7_200_000
    assert rows[2][2] == 3_601_000


def test_time_text_drops_trailing_zeros(spark):
    times = [(1622513218000,), (1622513218100,), (1622513218120,), (1622513218123,), (1622513218023,)]
    df = spark.createDataFrame(times, "ts BIGINT")
    texts = [r[0] for r in df.select(time.time_text("ts")).collect()]
    assert texts == [f"2021-06-01 02:06:58.{f}" for f in ("0", "1", "12", "123", "023")]


def test_duration():
    assert time.duration_ms("30 seconds") == 30_000
    assert time.duration_ms("1 minute") == 60_000
    assert time.duration_ms("250 milliseconds") == 250


def test_word_filter_shape_follows_the_bound():
    loose, tight = hashing.word_filter_shape(1000, 0.05)[0], hashing.word_filter_shape(1000, 0.001)[0]
    assert loose < tight
    with pytest.raises(ValueError):
        hashing.word_filter_shape(10, 1.5)
