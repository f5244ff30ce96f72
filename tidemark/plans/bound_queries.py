"""Every operator bound to the test tables: name -> (spark, sf_dir) -> DataFrame.

The ``events`` table plays the event stream through the rate view: ``hbdm`` is the
event type, ``num`` the JSON property ``k``, ``event_id`` the order of arrival.
Events are sparse, so durations are hours where the live jobs use seconds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import decode, encode, hashing, time
from tidemark.operators import aggregate, changelog, dedup, joins, over, patterns, project, windows
from tidemark.sources import tables, upsert
from tidemark.streaming import dedup as stream_dedup
from tidemark.streaming import join_batches, ordered_batches, sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

ARRIVAL = ["event_id"]
IN_TIME = ["et", "event_id"]

DELAY = "1 second"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _is(code: str) -> Column:
    return F.col("hbdm") == code


def _split(df: DataFrame) -> int:
    """Rows per task that no event type fits, so that the chunked plans are used."""
    return max(1, df.count() // 8)


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )


# Decoding


@query
def decode_json_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    line = encode.json_text(["timestamp", "hbdm", "num"])
    broken = F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 20)).otherwise(line)
    return decode.decode_json_rate(rates.select("event_id", broken.alias("value"))).drop("value")


@query
def decode_csv_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    line = (
        F.when(F.col("event_id") % 10 == 0, encode.row_text(["ts", "hbdm"]))
        .when(F.col("event_id") % 10 == 5, F.concat_ws(",", "ts", "hbdm", F.lit("x1")))
        .otherwise(encode.row_text(["ts", "hbdm", "num"]))
    )
    return decode.decode_csv_rate(rates.select("event_id", line.alias("value"))).drop("value")


@query
def decode_csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        time.epoch_ms("o_orderdate").alias("ts"),
        F.col("o_orderstatus").alias("catlog"),
        (F.col("o_custkey") % 10).alias("subcat"),
        F.substring("o_orderpriority", 1, 1).alias("hbdm"),
        F.col("o_custkey").alias("value"),
    )
    names = schemas.ORDER.fieldNames()
    line = F.when(F.col("o_orderkey") % 10 == 0, encode.row_text(names[:4])).otherwise(
        encode.row_text(names)
    )
    return decode.decode_csv_order(orders.select("o_orderkey", line.alias("line")), "line").drop("line")


def _commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as command log messages; sign-ups get a type that does not exist."""
    log_type = (
        F.when(_is("purchase"), "AIRPORT_RETRY")
        .when(_is("error"), "DRONE_RETRY")
        .when(_is("signup"), "SIGNUP")
        .otherwise("AIRPORT")
    )
    record = tables.rates(spark, sf_dir).select(
        "event_id",
        F.date_format("et", decode.COMMAND_TIME_FORMAT).alias("ts"),
        log_type.alias("type"),
        F.col("user_id").cast("string").alias("serialnumber"),
        F.col("event_id").cast("string").alias("task_id"),
        F.date_format("et", "yyyy-MM-dd").alias("dt"),
    )
    line = encode.json_text(["ts", "type", "serialnumber", "task_id", "dt"])
    return record.select("event_id", line.alias("value"))


@query
def decode_command_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.decode_command_log(_commands(spark, sf_dir))
    return _naive(decoded.select("event_id", "type", "serialnumber", "task_id", "dt", "et", "is_valid"))


@query
def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tables.rates(spark, sf_dir).select(
        "event_id", F.date_format("et", decode.COMMAND_TIME_FORMAT).alias("ts_text")
    )
    return _naive(texts.withColumn("et", decode.command_time("ts_text")))


@query
def table_source_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    lines = rates.select(encode.json_text(["timestamp", "hbdm", "num"]).alias("value"))
    decode.register_json_table(lines, "table_rate", schemas.RATE_MESSAGE)
    return spark.sql("SELECT * FROM table_rate")


# Encoding


@query
def encode_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).withColumn("num", F.when(F.col("num") > 0, F.col("num")))
    columns = ["ts", "hbdm", "num"]
    return rates.select(
        "event_id",
        encode.row_text(columns).alias("row_text"),
        encode.tuple_text(columns).alias("tuple_text"),
    )


@query
def encode_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = changelog.retract_count(tables.rates(spark, sf_dir), "hbdm", ARRIVAL)
    return changes.select(
        "event_id",
        encode.changelog_text("acc", ["hbdm", "cnt_num"]).alias("with_comma"),
        encode.changelog_text("acc", ["hbdm", "cnt_num"], "").alias("joined"),
    )


@query
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    return rates.select("event_id", encode.json_text(["timestamp", "hbdm", "num"]).alias("json"))


# Projection, filters, routing, words


@query
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.rates(spark, sf_dir).select(
        F.col("ts").alias("f0"), F.col("hbdm").alias("f1"), F.col("num").alias("f2"), "event_id"
    )
    named = project.rename(raw, {"f0": "ts", "f1": "hbdm", "f2": "num"})
    return project.with_arrival(named, "pt", F.col("event_id")).drop("event_id")


@query
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.equals(tables.rates(spark, sf_dir), "hbdm", "purchase").select(
        "event_id", "ts", "hbdm", "num"
    )


@query
def sql_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "ts", "hbdm", "num")
    return project.sql_equals(rates, "hbdm", "purchase")


@query
def route_two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    return project.with_route(rates, {"side": _is("purchase")}).select(
        "event_id", "hbdm", "num", project.ROUTE
    )


@query
def route_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    commands = decode.accepted(decode.decode_command_log(_commands(spark, sf_dir)))
    return project.with_route(commands, project.retry_routes()).select(
        "event_id", "type", project.ROUTE
    )


@query
def split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.words(tables.table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query
def split_words_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.distinct_words(tables.table(spark, sf_dir, "documents"), "text")


# Scalar functions


@query
def time_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rates(spark, sf_dir).select(
        "event_id",
        time.time_bucket("ts", 1000).alias("second"),
        time.time_bucket("ts", 10_000).alias("ten_seconds"),
        time.bucket_key("ts", 10_000, "hbdm").alias("bucket_key"),
        time.bucket_end("ts", 3_600_000).alias("hour_end"),
        time.time_text(time.bucket_end("ts", 30_000)).alias("window_end_text"),
    )


@query
def hash_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = tables.rates(spark, sf_dir).withColumn("key", time.bucket_key("ts", 1000, "hbdm"))
    return keyed.select("event_id", "key", hashing.bit_offset("key").alias("offset"))


# Grouped aggregation and changelogs


@query
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.group_count(tables.rates(spark, sf_dir))


@query
def group_sum_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.group_sum_sql(tables.rates(spark, sf_dir))


@query
def retract_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.retract_count(tables.rates(spark, sf_dir), "hbdm", ARRIVAL)


@query
def retract_count_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "hbdm", "num")
    return changelog.retract_count(rates, "hbdm", ARRIVAL, rows_per_task=_split(rates))


@query
def net_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of counts, consolidated for every thousand arrivals."""
    changes = changelog.retract_count(tables.rates(spark, sf_dir), "hbdm", ARRIVAL)
    batched = changes.withColumn("batch", time.time_bucket("event_id", 1000))
    return changelog.net_changes(batched, ["hbdm", "batch"], "cnt_num", ARRIVAL)


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("user_id", "event_id", "ts", "hbdm", "num")
    return changelog.latest_per(rates, ["user_id"], ARRIVAL)


# Windows


@query
def tumble_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.rate_summary(tables.rates(spark, sf_dir), size="1 hour")


@query
def hop_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    aggregates = {"cnt_all": ("count", "event_id"), "sum_num": ("sum", "num")}
    return windows.hop(rates, "et", "5 hours", "1 hour", ["hbdm"], aggregates)


def _sessions(rates: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    return windows.session(
        rates,
        "et",
        "30 minutes",
        ["hbdm"],
        {"cnt_num": ("count", "num")},
        ARRIVAL,
        rows_per_task,
    )


@query
def session_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(tables.rates(spark, sf_dir))


@query
def session_agg_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    return _sessions(rates, _split(rates))


@query
def sql_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sql_tumble(tables.rates(spark, sf_dir), "1 hour")


@query
def sql_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sql_hop(tables.rates(spark, sf_dir), "1 hour", "2 hours")


@query
def sql_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sql_session(tables.rates(spark, sf_dir), "30 minutes")


# OVER frames


def _frame_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rates(spark, sf_dir).select("event_id", "et", "hbdm", "num")


def _framed(df: DataFrame) -> DataFrame:
    return df.select("event_id", "hbdm", "num", "sum_num")


@query
def over_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _framed(over.over_rows(_frame_input(spark, sf_dir), ["hbdm"], IN_TIME, "num", 10))


@query
def over_rows_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = _frame_input(spark, sf_dir)
    return _framed(over.over_rows(rates, ["hbdm"], IN_TIME, "num", 10, rows_per_task=_split(rates)))


@query
def over_range_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _framed(over.over_range_unbounded(_frame_input(spark, sf_dir), ["hbdm"], "et", "num"))


@query
def over_range_unbounded_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = _frame_input(spark, sf_dir)
    return _framed(
        over.over_range_unbounded(
            rates, ["hbdm"], "et", "num", tie=ARRIVAL, rows_per_task=_split(rates)
        )
    )


@query
def over_range_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = _frame_input(spark, sf_dir)
    return _framed(over.over_range_time(rates, ["hbdm"], "et", "num", "6 hours"))


@query
def over_range_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = _frame_input(spark, sf_dir)
    return _framed(
        over.over_range_time(
            rates, ["hbdm"], "et", "num", "6 hours", tie=ARRIVAL, rows_per_task=_split(rates)
        )
    )


# Deduplication


@query
def dedup_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "ts", "hbdm", "num")
    return dedup.dedup_bucket(rates, "10 minutes", ARRIVAL)


@query
def dedup_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "ts", "hbdm", "num")
    return dedup.dedup_bucket(rates, "1 second", ARRIVAL)


@query
def dedup_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "user_id", "ts")
    return dedup.dedup_hour(rates, ARRIVAL, ["user_id"])


@query
def dedup_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device events keyed by source and code; users and event types play those parts."""
    devices = tables.rates(spark, sf_dir).select(
        "event_id", "ts", F.col("user_id").alias("source_id"), F.col("hbdm").alias("code")
    )
    return dedup.dedup_window(devices, "6 hours", ARRIVAL, ["source_id", "code"])


@query
def dedup_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "ts", "hbdm")
    return dedup.dedup_bitmap(rates, "1 hour", ARRIVAL)


def _bloom_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of the first half month as seen ones, the later ones as candidates."""
    rates = tables.rates(spark, sf_dir).select("event_id", "et", "user_id", "num")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    return rates.filter(F.col("et") < half), rates.filter(F.col("et") >= half)


@query
def bloom_antifilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, candidates = _bloom_sides(spark, sf_dir)
    return dedup.bloom_antifilter(candidates, seen, ["user_id", "num"], hash_of=hashing.md5_hash).drop("et")


@query
def bloom_error_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact membership beside the filter's answer: no miss, few false alarms."""
    seen, candidates = _bloom_sides(spark, sf_dir)
    keys = ["user_id", "num"]
    words, k = hashing.word_filter_shape(seen.count(), 0.01)
    marked = dedup.bloom_mark(
        candidates, dedup.bloom_words(seen, keys, words, k), keys, words, k, "maybe"
    )
    known = seen.select(*keys).distinct().withColumn("known", F.lit(True))
    both = marked.join(known, keys, "left").withColumn(
        "known", F.coalesce(F.col("known"), F.lit(False))
    )
    fresh = F.count_if(~F.col("known"))
    alarms = F.count_if(~F.col("known") & F.col("maybe"))
    return both.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if("known").alias("known"),
        F.count_if(F.col("known") & ~F.col("maybe")).alias("missed"),
        (alarms <= 0.01 * fresh + 3 * F.sqrt(0.01 * fresh)).alias("within_bound"),
    )


@query
def dedup_session_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "user_id", "et")
    return dedup.dedup_session_first(rates, ["user_id"], "6 hours", IN_TIME)


@query
def dedup_session_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "hbdm", "et")
    return dedup.dedup_session_first(
        rates, ["hbdm"], "30 minutes", IN_TIME, rows_per_task=_split(rates)
    )


@query
def session_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions on the time of arrival, here one event a second: purchases with at most two others between."""
    arrived = tables.rates(spark, sf_dir).filter(_is("purchase")).withColumn("arrived", F.timestamp_seconds("event_id"))
    aggregates = {"first_id": ("min", "event_id"), "last_id": ("max", "event_id"), "cnt_num": ("count", "num")}
    found = windows.session(arrived, "arrived", "3 seconds", ["hbdm"], aggregates, ARRIVAL)
    return found.select("hbdm", *aggregates, F.unix_seconds("w_end").alias("closes"))


@query
def promote_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch milliseconds promoted to event time, then windowed on it."""
    rates = project.with_event_time(tables.rates(spark, sf_dir).select("ts", "hbdm", "num"), "ts", "promoted")
    return _naive(windows.rate_summary(rates, "promoted", "2 hours"))


# Join


def _orders_and_rates(rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Purchases as orders and errors as rates, with the user as currency."""
    currency = F.col("user_id").cast("string")
    orders = rates.filter(_is("purchase")).select(
        "et",
        "ts",
        F.col("hbdm").alias("catlog"),
        (F.col("num") % 10).alias("subcat"),
        currency.alias("hbdm"),
        F.col("num").alias("value"),
    )
    return orders, rates.filter(_is("error")).select("et", "ts", currency.alias("hbdm"), "num")


@query
def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, rates = _orders_and_rates(tables.rates(spark, sf_dir))
    return joins.order_rate_join(orders, rates, "1 hour")


@query
def window_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, rates = _orders_and_rates(tables.rates(spark, sf_dir))
    return joins.order_rate_join(orders, rates, "1 hour", salt=4)


# Patterns


def _runs(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "et",
        "length",
        F.element_at("matched", -1)["event_id"].alias("last_event_id"),
        F.size("matched").alias("matched_count"),
        encode.json_text(["hbdm", "num"]).alias("json"),
    )


@query
def cep_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    return _runs(patterns.times(rates, _is("purchase"), IN_TIME, 5, 6, events=["event_id"]))


@query
def cep_times_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = _frame_input(spark, sf_dir)
    return _runs(
        patterns.times(
            rates, _is("purchase"), IN_TIME, 5, 6, events=["event_id"], rows_per_task=_split(rates)
        )
    )


@query
def cep_times_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    return _runs(
        patterns.times(rates, _is("purchase"), IN_TIME, 5, 6, ["user_id"], events=["event_id"])
    )


@query
def cep_times_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    return _runs(
        patterns.times(
            rates, _is("purchase"), IN_TIME, 5, 6, events=["event_id"], within="2 hours"
        )
    )


@query
def cep_times_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    return patterns.times_timed_out(rates, _is("purchase"), IN_TIME, 6, "2 hours").select(
        "event_id", "et", "matched_count"
    )


@query
def cep_next_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "user_id", "et", "hbdm")
    return patterns.next_within(
        rates, _is("purchase"), _is("purchase"), "6 hours", IN_TIME, ["user_id"]
    )


@query
def cep_next_within_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Un-keyed: the next event of any user."""
    rates = tables.rates(spark, sf_dir).select("event_id", "et", "hbdm")
    return patterns.next_within(
        rates, _is("purchase"), _is("purchase"), "5 minutes", IN_TIME, rows_per_task=_split(rates)
    )


@query
def cep_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir).select("event_id", "user_id", "et", "hbdm")
    return patterns.timed_out(rates, _is("purchase"), "6 hours", IN_TIME, ["user_id"])


def _alerts(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        "event_id", key, "et", "cnt", "first_task", patterns.alert_text(key).alias("alert")
    )


@query
def retry_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.rates(spark, sf_dir)
    return _alerts(
        patterns.repeat_alert(rates, ["user_id"], IN_TIME, "event_id", "6 hours"), "user_id"
    )


@query
def retry_alert_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = _frame_input(spark, sf_dir)
    return _alerts(
        patterns.repeat_alert(
            rates, ["hbdm"], IN_TIME, "event_id", "1 hour", rows_per_task=_split(rates)
        ),
        "hbdm",
    )


# Streams: the table is read as a stream, drained into files and read back


def _watermarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stream_rates(spark, sf_dir).withWatermark("et", DELAY)


def _drained(df: DataFrame, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    return _naive(sinks.run_to_table(df, mode, keys))


@query
def stream_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(aggregate.group_count(tables.stream_rates(spark, sf_dir)), "update", ["hbdm"])


@query
def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.stream_rates(spark, sf_dir).select("user_id", "event_id", "ts", "hbdm", "num")
    base = sinks.run_folder(spark)
    log = upsert.CompactedLog(f"{base}/data", ["user_id"], ARRIVAL)
    sinks.drain(sinks.each_batch(rates, log, f"{base}/checkpoint"))
    return log.read(spark)


@query
def stream_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(windows.rate_summary(_watermarked(spark, sf_dir), size="1 hour"))


@query
def stream_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(windows.sql_hop(_watermarked(spark, sf_dir), "1 hour", "2 hours"))


def _ordered(spark: SparkSession, sf_dir: str, step: ordered_batches.Step) -> DataFrame:
    return _naive(ordered_batches.drain(tables.stream_rates(spark, sf_dir), step, DELAY))


@query
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = ordered_batches.Sessions(["hbdm"], "30 minutes", "et", ARRIVAL, {"cnt_num": ("count", "num")})
    return _ordered(spark, sf_dir, step).withColumnsRenamed({"w_start": "s_start", "w_end": "s_end"})


@query
def stream_dedup_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.stream_rates(spark, sf_dir)
    unique = stream_dedup.dedup_bucket(rates, "10 minutes", DELAY, "30 minutes")
    return _drained(unique.select("hbdm", time.time_bucket("ts", 600_000).alias("bucket")))


@query
def stream_dedup_bucket_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.stream_rates(spark, sf_dir).select("event_id", "et", "ts", "hbdm", "num")
    return _drained(
        stream_dedup.first_in_bucket(rates, "10 minutes", ARRIVAL, DELAY, "30 minutes")
    )


@query
def stream_dedup_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = stream_dedup.dedup_hour(tables.stream_rates(spark, sf_dir), ["user_id"])
    return _drained(unique.select("user_id", "hour_end"))


@query
def stream_dedup_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tables.stream_rates(spark, sf_dir)
    unique = stream_dedup.dedup_bitmap(rates, "1 hour", DELAY)
    return _drained(unique.select("window_end", "offset"))


@query
def stream_dedup_session_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = ordered_batches.SessionFirst(["user_id"], "6 hours", "et", ARRIVAL)
    return _ordered(spark, sf_dir, step).select("user_id", "et", "event_id")


@query
def stream_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, rates = _orders_and_rates(tables.stream_rates(spark, sf_dir))
    sides = join_batches.both_sides(
        orders.withColumnRenamed("et", "order_et"),
        rates.withColumnsRenamed({"ts": "rate_ts", "hbdm": "rate_hbdm", "et": "rate_et"}),
    )
    joined = join_batches.drain(
        sides, on=[("hbdm", "rate_hbdm")], left_time="order_et", right_time="rate_et", size="1 hour",
        delays=("0 seconds", DELAY), finish=joins.converted,
    )
    return _naive(joined)


@query
def stream_retract_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ordered(spark, sf_dir, ordered_batches.RetractCount("hbdm", ARRIVAL))


@query
def stream_over_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _framed(_ordered(spark, sf_dir, ordered_batches.RowFrame(["hbdm"], "et", ARRIVAL, "num", 10)))


@query
def stream_over_range_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _framed(_ordered(spark, sf_dir, ordered_batches.TimeFrame(["hbdm"], "et", ARRIVAL, "num", "6 hours")))


@query
def stream_over_range_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _framed(_ordered(spark, sf_dir, ordered_batches.Unbounded(["hbdm"], "et", ARRIVAL, "num")))


def _stream_runs(df: DataFrame, *keys: str) -> DataFrame:
    ids = F.transform("matched", lambda m: m["event_id"].cast("string"))
    return df.select(
        *keys, "et", "event_id", "length", F.element_at("matched", -1)["et"].alias("end_et"), F.array_join(ids, ",").alias("matched_ids")
    )


@query
def stream_cep_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = ordered_batches.Repeats(_is("purchase"), ["user_id"], "et", ARRIVAL, 5, 6, ["event_id"])
    return _stream_runs(_ordered(spark, sf_dir, step), "user_id")


@query
def stream_cep_times_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Un-keyed: purchases of any user."""
    step = ordered_batches.Repeats(_is("purchase"), [], "et", ARRIVAL, 5, 6, ["event_id"])
    return _stream_runs(_ordered(spark, sf_dir, step))


@query
def stream_cep_succession(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchase = _is("purchase")
    step = ordered_batches.Succession(purchase, purchase, "6 hours", ["user_id"], "et", ARRIVAL)
    return _ordered(spark, sf_dir, step).select("user_id", "et", "event_id", "kind", "next_et")


@query
def stream_retry_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = ordered_batches.RepeatAlert(["user_id"], "et", ARRIVAL, "event_id", "6 hours")
    return _alerts(_ordered(spark, sf_dir, step), "user_id")
