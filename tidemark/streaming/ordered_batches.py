"""Event-ordered operators on micro-batches, with plans that split a hot key.

A micro-batch is a table, so each batch runs the batch operator, which cuts a hot key or an un-keyed
order into chunks (``plans.ordered``).  Three small tables carry a stream from one batch to
the next:

* the *clock*, the watermark: the latest event time so far minus the delay;
* the *waiting* rows, which the watermark has not passed: an earlier row may still arrive;
* the *tail*, what later rows need of earlier ones: the last ten rows of a key, one time frame,
  one total, the open match, the open sessions.

A batch releases the rows that its own watermark has passed, computes them behind the tail, and
writes results and state of its own, each in a folder of its run and number, the clock last.  A batch
that is tried again reads the state of the batch before and overwrites its own, so results are
exactly-once.  State lies in the shared folder and is never held in one process.

Rows whose time is not after the watermark of the batch before are late; they are dropped and counted.
Rows without a time are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.time import duration_ms, epoch_us
from tidemark.operators import changelog, over, patterns, windows
from tidemark.plans import ordered
from tidemark.sources import tables
from tidemark.sources.upsert import BATCH_COLUMN, RUN_COLUMN, partition_of, run_of
from tidemark.streaming import sinks

NEW, US = "_new", "_us_at"


def _sum_type(df: DataFrame, value: str) -> str:
    return df.select(F.sum(value).alias("s")).schema["s"].dataType.simpleString()


class Step:
    """What one operator computes of a batch.

    ``rows`` picks and prepares the columns of the input; ``results`` and ``tail`` get the tail and
    the released rows together, told apart by ``_new``, with their time in microseconds as ``_us_at``.
    """

    #: Whether rows wait for the watermark; if not, a batch is computed as it arrives.
    waits = True

    def __init__(self, keys: Sequence[str], et: str, order: Sequence[str], rows_per_task: int | None = None) -> None:
        self.keys, self.et, self.order = list(keys), et, list(order)
        self.rows_per_task = rows_per_task

    @property
    def in_time(self) -> list[str]:
        return list(dict.fromkeys([self.et, *self.order]))

    def picked(self, df: DataFrame, *payload: str) -> DataFrame:
        return df.select(*dict.fromkeys([*self.keys, self.et, *self.order, *payload]))

    def rows(self, df: DataFrame) -> DataFrame:
        return self.picked(df)

    def results(self, both: DataFrame, watermark_us: int) -> DataFrame:
        raise NotImplementedError

    def tail(self, both: DataFrame, watermark_us: int) -> DataFrame:
        raise NotImplementedError

    def last_rows(self, both: DataFrame, n: int) -> DataFrame:
        """The last ``n`` rows of each key; map tasks send no more than that."""
        if n <= 0:
            return both.limit(0)
        latest = Window.partitionBy(*self.keys).orderBy(*[F.col(c).desc() for c in self.in_time])
        return both.withColumn("_rank", F.row_number().over(latest)).filter(F.col("_rank") <= n).drop("_rank")


class RowFrame(Step):
    """Sum over the current and the ``preceding`` rows; the tail is these rows."""

    def __init__(self, keys, et, order, value: str, preceding: int, rows_per_task: int | None = None) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.value, self.preceding = value, preceding

    def rows(self, df):
        over._require_exact(df, self.value)
        return self.picked(df, self.value)

    def results(self, both, watermark_us):
        return over.over_rows(both, self.keys, self.in_time, self.value, self.preceding, rows_per_task=self.rows_per_task)

    def tail(self, both, watermark_us):
        return self.last_rows(both, self.preceding)


class TimeFrame(Step):
    """Sum over the time frame that ends now; the tail is one time frame."""

    def __init__(self, keys, et, order, value: str, length: str, rows_per_task: int | None = None) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.value, self.length = value, length

    def rows(self, df):
        over._require_exact(df, self.value)
        return self.picked(df, self.value)

    def results(self, both, watermark_us):
        return over.over_range_time(
            both, self.keys, self.et, self.value, self.length, tie=self.order, rows_per_task=self.rows_per_task
        )

    def tail(self, both, watermark_us):
        return both.filter(F.col(US) > watermark_us - duration_ms(self.length) * 1000)


class Unbounded(Step):
    """Sum over everything so far; the tail is one total a key."""

    def __init__(self, keys, et, order, value: str, rows_per_task: int | None = None) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.value = value

    def rows(self, df):
        over._require_exact(df, self.value)
        total = F.col(self.value).cast(_sum_type(df, self.value)).alias("_total")
        return self.picked(df, self.value).select("*", total)

    def results(self, both, watermark_us):
        kind = both.schema["_total"].dataType
        summed = over.over_range_unbounded(both, self.keys, self.et, "_total", tie=self.order, rows_per_task=self.rows_per_task)
        return summed.withColumn("sum_num", F.col("sum_num").cast(kind)).drop("_total")

    def tail(self, both, watermark_us):
        kind = both.schema["_total"].dataType
        totals = both.groupBy(*self.keys).agg(
            F.sum("_total").cast(kind).alias("_total"), F.max(self.et).alias(self.et), F.max(US).alias(US)
        )
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in both.schema.fields if f.name not in totals.columns]
        return totals.select("*", *others)


class Repeats(Step):
    """All runs of ``at_least`` to ``at_most`` events, with the list of their events.

    The tail holds an event once, whatever number of open runs it is part of: the last
    ``at_most - 1`` events of a key, without those that the bound has passed.
    """

    def __init__(
        self, condition: Column, keys, et, order, at_least: int, at_most: int, events: Sequence[str] = (),
        payload: Sequence[str] = (), within: str | None = None, rows_per_task: int | None = None,
    ) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.condition, self.at_least, self.at_most = condition, at_least, at_most
        self.events, self.payload, self.within = list(events), list(payload), within

    def rows(self, df):
        return self.picked(df.filter(self.condition), *self.events, *self.payload)

    def results(self, both, watermark_us):
        found = patterns.times(
            both, F.lit(True), self.in_time, self.at_least, self.at_most, self.keys, [*self.events, NEW],
            self.within, self.et, self.rows_per_task,
        )
        # A run is reported by the batch that completes it.
        done = found.filter(F.element_at("matched", -1)[NEW]).withColumn(NEW, F.lit(True))
        return done.withColumn("matched", F.transform("matched", lambda m: m.dropFields(NEW)))

    def tail(self, both, watermark_us):
        kept = self.last_rows(both, self.at_most - 1)
        return kept if self.within is None else kept.filter(F.col(US) > watermark_us - duration_ms(self.within) * 1000)


class Succession(Step):
    """A first event and its very next one, in time, or the timeout of the first, by ``kind``.

    The tail is the open first event of a key.
    """

    def __init__(
        self, first: Column, second: Column, within: str, keys, et, order, payload: Sequence[str] = (),
        rows_per_task: int | None = None,
    ) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.first, self.second, self.within_us, self.payload = first, second, duration_ms(within) * 1000, list(payload)

    def rows(self, df):
        flags = {"_opens": self.first, "_meets": self.second}
        staged = df.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()})
        return self.picked(staged, *self.payload, *flags)

    def results(self, both, watermark_us):
        staged = ordered.bounded_window(
            both, self.keys, self.in_time,
            lambda w: {"next_et": F.lead(self.et).over(w), "_next": F.lead(F.struct("_meets", NEW, US)).over(w)},
            following=1, rows_per_task=self.rows_per_task,
        )
        after = F.col("_next")
        in_time = after[US] - F.col(US) < self.within_us
        kind = F.when(after.isNull(), F.when(F.col(US) + self.within_us <= watermark_us, "timeout")).when(
            after[NEW], F.when(~in_time, "timeout").when(after["_meets"], "match")
        )
        found = staged.filter("_opens").withColumn("kind", kind).filter(F.col("kind").isNotNull())
        # An open event of the tail is answered by this batch, so it counts as new.
        next_et = F.when(F.col("kind") == "match", F.col("next_et"))
        return found.withColumns({"next_et": next_et, NEW: F.lit(True)}).drop("_opens", "_meets", "_next")

    def tail(self, both, watermark_us):
        return self.last_rows(both, 1).filter(F.col("_opens") & (F.col(US) + self.within_us > watermark_us))


class RepeatAlert(Step):
    """Rows that complete ``at_least`` events of their key inside the time frame; the tail is one frame."""

    def __init__(self, keys, et, order, task: str, within: str, at_least: int = 5, rows_per_task: int | None = None) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.task, self.within, self.at_least = task, within, at_least

    def rows(self, df):
        return self.picked(df, self.task)

    def results(self, both, watermark_us):
        return patterns.repeat_alert(
            both, self.keys, self.in_time, self.task, self.within, self.at_least, self.et, self.rows_per_task
        )

    def tail(self, both, watermark_us):
        return both.filter(F.col(US) > watermark_us - duration_ms(self.within) * 1000)


class RetractCount(Step):
    """Every change of the running count per key, in order of arrival; the tail is one count a key."""

    waits = False

    def __init__(self, key: str, order, value: str = "num", rows_per_task: int | None = None) -> None:
        super().__init__([key], order[0], order, rows_per_task)
        self.key, self.value = key, value

    def rows(self, df):
        counts = {"_rows": F.lit(1).cast("long"), "_counted": F.col(self.value).isNotNull().cast("long")}
        return self.picked(df.withColumns(counts), *counts)

    def results(self, both, watermark_us):
        counted = ordered.running_total(
            both.withColumnsRenamed({"_rows": "_n", "_counted": "_c"}), self.keys, [NEW, *self.order],
            {"_rows": F.col("_n"), "_count": F.col("_c")}, self.rows_per_task,
        )
        changed = changelog.changes(counted.filter(NEW), self.key, self.order, F.col("_c") == 1)
        return changed.withColumn(NEW, F.lit(True))

    def tail(self, both, watermark_us):
        totals = both.groupBy(*self.keys).agg(F.sum("_rows").alias("_rows"), F.sum("_counted").alias("_counted"))
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in both.schema.fields if f.name not in totals.columns]
        return totals.select("*", *others)


class SessionFirst(Step):
    """The first row of each session, in the batch in which the session opens.

    Rows do not wait: a row that no open session reaches opens one and is out at once.  The tail is
    first and last time of the sessions a later row may still reach, two numbers each.  A row
    between two open sessions joins them and is out of neither.
    """

    waits = False

    def __init__(self, keys, gap: str, et, order, payload: Sequence[str] = (), rows_per_task: int | None = None) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.gap_us, self.payload = duration_ms(gap) * 1000, list(payload)

    def rows(self, df):
        # A session of the tail is two rows: 1 where it begins, -1 where it ends.
        return self.picked(df, *self.payload).withColumn("_side", F.lit(0))

    def _sessions(self, both: DataFrame) -> DataFrame:
        """All rows with the number of their session, ``_session``, inside their key."""
        side = F.col("_side")
        # At equal times: begins, rows, ends.
        place = [US, "_turn", *self.order]
        turned = both.withColumn("_turn", -side)
        inside = ordered.running_total(turned, self.keys, place, {"_open": side}, self.rows_per_task)
        apart = ordered.bounded_window(
            inside, self.keys, place, lambda w: {"_before": F.lag(US).over(w)}, preceding=1, rows_per_task=self.rows_per_task
        )
        # Open sessions before this row; inside one nothing begins, however far the row before is.
        begins = (F.col("_open") - side == 0) & (
            F.col("_before").isNull() | (F.col(US) - F.col("_before") > self.gap_us)
        )
        return ordered.running_total(
            apart, self.keys, place, {"_session": F.when(begins, 1).otherwise(0).cast("long")}, self.rows_per_task
        ).drop("_turn", "_open", "_before")

    def results(self, both, watermark_us):
        named = self._sessions(both)
        row = F.struct(*[F.col(c) for c in dict.fromkeys([self.et, *self.order, *self.payload])])
        first = named.groupBy(*self.keys, "_session").agg(
            F.min(F.when(F.col("_side") == 0, row)).alias("_first"), F.max(F.abs("_side")).alias("_known")
        )
        opened = first.filter(F.col("_known") == 0).select(*self.keys, "_first.*")
        return opened.withColumn(NEW, F.lit(True))

    def tail(self, both, watermark_us):
        spans = self._sessions(both).groupBy(*self.keys, "_session").agg(F.min(US).alias("_low"), F.max(US).alias("_high"))
        open_ = spans.filter(F.col("_high") + self.gap_us >= watermark_us)
        ends = F.explode(F.array(
            F.struct(F.col("_low").alias(US), F.lit(1).alias("_side")), F.struct(F.col("_high").alias(US), F.lit(-1).alias("_side"))
        )).alias("_end")
        carried = open_.select(*self.keys, ends).select(*self.keys, "_end.*")
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in both.schema.fields if f.name not in carried.columns]
        return carried.select("*", *others)


class Sessions(Step):
    """Aggregates per key and session, once the watermark has passed its end.

    Rows of a batch are merged to sessions first, by the batch operator, and these with the open sessions
    of the tail, of which a key has one at most.  ``aggregates`` is as for ``windows.session``.
    """

    def __init__(self, keys, gap: str, et, order, aggregates, rows_per_task: int | None = None) -> None:
        super().__init__(keys, et, order, rows_per_task)
        self.gap, self.gap_us, self.aggregates = gap, duration_ms(gap) * 1000, dict(aggregates)

    def rows(self, df):
        """Each row is a session of its own, its aggregates are partial results."""
        windows._columns(self.aggregates)
        one = {"count": lambda c: F.col(c).isNotNull().cast("long"), "sum": lambda c: F.col(c).cast(_sum_type(df, c))}
        parts = {n: one.get(f, F.col)(c) for n, (f, c) in self.aggregates.items()}
        return self.picked(df.withColumns({"_last": epoch_us(self.et), **parts}), "_last", *parts)

    def _merged(self, both: DataFrame) -> DataFrame:
        """``_low`` and ``_high`` of all sessions with their aggregates."""
        more = {n: ({"count": "sum"}.get(f, f), n) for n, (f, _) in self.aggregates.items()}
        arrived = windows.session(
            both.filter(NEW), self.et, self.gap, self.keys, {"_low": ("min", US), "_high": ("max", "_last"), **more},
            self.order, self.rows_per_task,
        ).drop("w_start", "w_end")
        carried = both.filter(~F.col(NEW)).select(*self.keys, F.col(US).alias("_low"), F.col("_last").alias("_high"), *more)
        place = ["_low", "_high"]
        before = ordered.bounded_window(
            arrived.unionByName(carried), self.keys, place, lambda w: {"_before": F.lag("_high").over(w)}, preceding=1,
            rows_per_task=self.rows_per_task,
        )
        opens = F.col("_before").isNull() | (F.col("_low") - F.col("_before") > self.gap_us)
        numbered = ordered.running_total(
            before, self.keys, place, {"_session": F.when(opens, 1).otherwise(0).cast("long")}, self.rows_per_task
        )
        kinds = {f.name: f.dataType for f in both.schema.fields}
        return numbered.groupBy(*self.keys, "_session").agg(
            F.min("_low").alias("_low"), F.max("_high").alias("_high"),
            *[getattr(F, f)(n).cast(kinds[n]).alias(n) for n, (f, _) in more.items()],
        )

    def results(self, both, watermark_us):
        done = self._merged(both).filter(F.col("_high") + self.gap_us <= watermark_us)
        start, end = F.timestamp_micros("_low"), F.timestamp_micros(F.col("_high") + self.gap_us)
        return done.select(*self.keys, start.alias("w_start"), end.alias("w_end"), *self.aggregates, F.lit(True).alias(NEW))

    def tail(self, both, watermark_us):
        open_ = self._merged(both).filter(F.col("_high") + self.gap_us > watermark_us)
        kept = open_.select(
            *self.keys, F.timestamp_micros("_low").cast(both.schema[self.et].dataType).alias(self.et),
            F.col("_low").alias(US), F.col("_high").alias("_last"), *self.aggregates,
        )
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in both.schema.fields if f.name not in kept.columns]
        return kept.select("*", *others)


class OrderedBatches:
    """The ``foreachBatch`` target that runs a step; results go to ``target``, state to ``state``."""

    def __init__(self, step: Step, target: str, state: str, delay: str = "1 second") -> None:
        self.step, self.target, self.state = step, target, state
        self.delay_us = duration_ms(delay) * 1000
        self.schema = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, step = batch.sparkSession, self.step
        here = partition_of(batch, batch_id)
        before = f"{self.state}/{RUN_COLUMN}={run_of(batch)}/{BATCH_COLUMN}={batch_id - 1}"
        timed = F.lit(0).cast("long") if isinstance(step, RetractCount) else epoch_us(step.et)
        rows = step.rows(batch).withColumn(US, timed).filter(F.col(US).isNotNull()).persist()
        try:
            passed, late = None, 0
            carried = tables.exists(spark, f"{before}/clock")
            if carried:
                clock = spark.read.parquet(f"{before}/clock").first()
                passed, late = clock.watermark_us, clock.late
            in_time = F.lit(True) if passed is None or isinstance(step, RetractCount) else F.col(US) > passed
            seen = rows.agg(F.max(US).alias("last"), F.count_if(~in_time).alias("late")).first()
            # Whole milliseconds, as Spark's own watermark.
            latest = [w for w in (passed, None if seen.last is None else seen.last // 1000 * 1000 - self.delay_us) if w is not None]
            watermark = max(latest, default=None)
            arrived = rows.filter(in_time)
            if carried and step.waits:
                arrived = arrived.unionByName(spark.read.schema(rows.schema).parquet(f"{before}/waiting"))
            due = F.lit(True) if not step.waits else F.col(US) <= watermark if watermark is not None else F.lit(False)
            both = arrived.filter(due).withColumn(NEW, F.lit(True))
            if carried:
                both = both.unionByName(spark.read.schema(rows.schema).parquet(f"{before}/tail").withColumn(NEW, F.lit(False)))
            moment = -(1 << 62) if watermark is None else watermark
            found = step.results(both, moment).filter(NEW).drop(NEW, US)
            self.schema = found.schema
            found.write.mode("overwrite").parquet(f"{self.target}/{here}")
            place = f"{self.state}/{here}"
            step.tail(both, moment).select(*rows.columns).write.mode("overwrite").parquet(f"{place}/tail")
            if step.waits:
                arrived.filter(~due).write.mode("overwrite").parquet(f"{place}/waiting")
            spark.range(1).select(
                F.lit(watermark).cast("long").alias("watermark_us"), F.lit(late + seen.late).cast("long").alias("late")
            ).coalesce(1).write.mode("overwrite").parquet(f"{place}/clock")
        finally:
            rows.unpersist()
        self._forget(spark, run_of(batch), batch_id - 2)

    def _forget(self, spark: SparkSession, run: str, batch_id: int) -> None:
        """Remove state that no retry can read any more."""
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.state}/{RUN_COLUMN}={run}/{BATCH_COLUMN}={batch_id}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    def late_rows(self, spark: SparkSession) -> int:
        """Rows dropped as late by all runs so far."""
        kept = spark.read.schema(f"watermark_us BIGINT, late BIGINT, {RUN_COLUMN} STRING, {BATCH_COLUMN} BIGINT")
        clocks = kept.option("recursiveFileLookup", "false").parquet(f"{self.state}/{RUN_COLUMN}=*/{BATCH_COLUMN}=*/clock")
        runs = F.regexp_extract(F.input_file_name(), f"{RUN_COLUMN}=([^/]+)/", 1)
        return clocks.groupBy(runs.alias("r")).agg(F.max("late").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def drain(df: DataFrame, step: Step, delay: str = "1 second", base: str | None = None) -> DataFrame:
    """Run ``step`` over what a stream has, and return all results written below ``base`` so far."""
    spark = df.sparkSession
    base = base or sinks.run_folder(spark)
    target = OrderedBatches(step, f"{base}/data", f"{base}/state", delay)
    sinks.drain(sinks.each_batch(df, target, f"{base}/checkpoint"))
    if target.schema is None:  # nothing came
        nothing = step.rows(spark.createDataFrame([], df.schema)).withColumn(US, F.lit(0).cast("long"))
        target.schema = step.results(nothing.withColumn(NEW, F.lit(True)), 0).drop(NEW, US).schema
        if not tables.exists(spark, f"{base}/data"):
            return spark.createDataFrame([], target.schema)
    # Folders of runs and batches are no columns of the result.
    return spark.read.schema(target.schema).parquet(f"{base}/data").select(*target.schema.names)
