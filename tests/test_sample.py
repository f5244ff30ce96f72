"""A sample of rates as headerless CSV part files, against totals counted in plain Python.

The sample follows a rule: one record every 100 to 117 ms, the code changes every few records, and the
number advances by one with each change.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate, changelog, dedup, joins, over, patterns, project, windows
from tidemark.sources import files

CODES = ("BEF", "CNY", "DEM", "EUR", "HKD", "ITL", "USD")
START = 1_622_600_000_000


def _rows() -> list[tuple[int, str, int]]:
    rows, ts, change = [], START, 0
    for i in range(495):
        if i and (i * 7) % 11 == 0:
            change += 1 + i % 3
        rows.append((ts, CODES[(change * 3) % len(CODES)], change % 10))
        ts += 100 + (i * 5) % 18
    return rows


ROWS = _rows()
BY_CODE: dict[str, list[tuple[int, int]]] = defaultdict(list)
for _ts, _code, _num in ROWS:
    BY_CODE[_code].append((_ts, _num))


@pytest.fixture(scope="module")
def rates(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sample")
    for part in range(12):
        lines = [f"{ts},{code},{num}\n" for ts, code, num in ROWS[part::12]]
        (folder / str(part + 1)).write_text("".join(lines))
    return project.with_event_time(files.read_rate_csv(spark, str(folder))).persist()


def total(df, column="sum_num"):
    return df.agg(F.sum(column)).first()[0]


def buckets(width, *parts):
    return len({(ts // width, *[(code, num)[p] for p in parts]) for ts, code, num in ROWS})


def sessions(gap, key):
    """Length of each session of each key."""
    out, last = [], {}
    for ts, code, num in ROWS:
        k = key(code, num)
        if k not in last or ts - last[k][0] > gap:
            out.append(0)
            last[k] = (ts, len(out) - 1)
        at = last[k][1]
        out[at] += 1
        last[k] = (ts, at)
    return out


def framed(before):
    """Sum over all rows of the numbers that ``before`` picks of the code's rows up to each."""
    return sum(sum(n for _, n in before(own[: i + 1])) for own in BY_CODE.values() for i in range(len(own)))


def test_groups(rates):
    counts = Counter(code for _, code, _ in ROWS)
    sums = {code: sum(n for _, n in own) for code, own in BY_CODE.items()}
    assert {r.hbdm: r.cnt_num for r in aggregate.group_count(rates).collect()} == counts
    assert {r.hbdm: r.sum_num for r in aggregate.group_sum_sql(rates).collect()} == sums


def test_dedup(rates):
    assert dedup.dedup_bucket(rates, "10 seconds", ["ts"]).count() == buckets(10_000, 0)
    assert dedup.dedup_bucket(rates, "1 second", ["ts"]).count() == buckets(1_000, 0)
    assert dedup.dedup_window(rates, "30 seconds", ["ts"], ["hbdm"]).count() == buckets(30_000, 0)
    assert dedup.dedup_session_first(rates, ["hbdm", "num"], "30 seconds", ["ts"]).count() == len(
        sessions(30_000, lambda code, num: (code, num))
    )


@pytest.mark.parametrize("split", [None, 20])
def test_windows(rates, split):
    assert windows.rate_summary(rates).count() == buckets(1_000, 0)
    hops = {(ts // 1_000 + k, code) for ts, code, _ in ROWS for k in (0, 1)}
    assert windows.sql_hop(rates, "1 second", "2 seconds").count() == len(hops)
    found = windows.session(rates, "et", "1 second", ["hbdm"], {"n": ("count", "num")}, rows_per_task=split)
    assert sorted(r.n for r in found.collect()) == sorted(sessions(1_000, lambda code, num: code))


@pytest.mark.parametrize("split", [None, 20])
def test_over(rates, split):
    by = {"rows_per_task": split}
    assert total(over.over_rows(rates, ["hbdm"], ["ts"], "num", 10, **by)) == framed(lambda own: own[-11:])
    assert total(over.over_range_unbounded(rates, ["hbdm"], "et", "num", **by)) == framed(lambda own: own)
    in_frame = framed(lambda own: [r for r in own if r[0] >= own[-1][0] - 10_000])
    assert total(over.over_range_time(rates, ["hbdm"], "et", "num", "10 seconds", **by)) == in_frame


@pytest.mark.parametrize("split", [None, 20])
def test_changelog_and_patterns(rates, split):
    by = {"rows_per_task": split}
    assert changelog.retract_count(rates, "hbdm", ["ts"], **by).count() == 2 * len(ROWS) - len(BY_CODE)
    is_cny, n = F.col("hbdm") == "CNY", len(BY_CODE["CNY"])
    runs = patterns.times(rates, is_cny, ["et"], 5, 6, **by).groupBy("length").count()
    assert {r.length: r["count"] for r in runs.collect()} == {5: n - 4, 6: n - 5}
    side = project.split_routes(rates, {"side": is_cny})
    assert (side["side"].count(), side["main"].count()) == (n, len(ROWS) - n)
    times = [ts for ts, _ in BY_CODE["CNY"]]
    close = sum(b - a < 10_000 for a, b in zip(times, times[1:]))
    assert patterns.next_within(side["side"], is_cny, is_cny, "10 seconds", ["et"], **by).count() == close


@pytest.mark.parametrize("salt", [1, 4])
def test_join(rates, salt):
    orders = rates.select(
        "et", "ts", F.lit("A").alias("catlog"), F.lit(0).alias("subcat"), "hbdm", F.col("num").alias("value")
    )
    joined = joins.order_rate_join(orders, rates, "10 seconds", salt)
    groups = defaultdict(list)
    for ts, code, num in ROWS:
        groups[code, ts // 10_000].append(num)
    assert joined.count() == sum(len(g) ** 2 for g in groups.values())
    assert total(joined, "amount") == sum(sum(g) ** 2 for g in groups.values())
