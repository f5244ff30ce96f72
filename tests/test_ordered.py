"""The chunked plans against the plain ones and against plain Python."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import functions as F

import fixtures
from tidemark.operators import changelog, dedup, over, patterns, windows
from tidemark.plans import ordered

ROWS = fixtures.skewed()
GROUPS = fixtures.by_key(ROWS)

# None keeps the plain plan, the others cut the hot key into few and many chunks.
SPLITS = [None, 60, 7]
ORDER = ["ts", "id"]


@pytest.fixture(scope="module")
def rates(spark):
    return fixtures.frame(spark, ROWS).persist()


def as_dict(df, column):
    rows = df.select("id", column).collect()
    assert len(rows) == len(ROWS)
    return {r[0]: r[1] for r in rows}


def test_split_is_measured(rates):
    assert ordered.chunks_needed(rates, ["hbdm"], 10_000) == 0
    assert ordered.chunks_needed(rates, ["hbdm"], 60) == 4
    assert ordered.chunks_needed(rates, ["id"], 60) == 0
    assert ordered.chunks_needed(rates, [], 60) == 4


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("preceding", [0, 1, 10])
def test_over_rows(rates, split, preceding):
    expected = {}
    for rows in GROUPS.values():
        for i, row in enumerate(rows):
            frame = rows[max(0, i - preceding) : i + 1]
            expected[row[0]] = fixtures.total(r[3] for r in frame)
    got = over.over_rows(rates, ["hbdm"], ORDER, "num", preceding, rows_per_task=split)
    assert as_dict(got, "sum_num") == expected


@pytest.mark.parametrize("split", SPLITS)
def test_neighbours_on_both_sides(rates, split):
    got = ordered.bounded_window(
        rates,
        ["hbdm"],
        ORDER,
        lambda w: {"near": F.concat_ws(",", F.lag("id", 2).over(w), F.lead("id", 3).over(w))},
        preceding=2,
        following=3,
        rows_per_task=split,
    )
    expected = {}
    for rows in GROUPS.values():
        for i, row in enumerate(rows):
            near = [str(rows[j][0]) for j in (i - 2, i + 3) if 0 <= j < len(rows)]
            expected[row[0]] = ",".join(near)
    assert as_dict(got, "near") == expected


@pytest.mark.parametrize("split", SPLITS)
def test_over_range_unbounded(rates, split):
    expected = {}
    for rows in GROUPS.values():
        for row in rows:
            expected[row[0]] = fixtures.total(r[3] for r in rows if r[2] <= row[2])
    got = over.over_range_unbounded(
        rates, ["hbdm"], "et", "num", tie=["id"], rows_per_task=split
    )
    assert as_dict(got, "sum_num") == expected


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seconds", [1, 10])
def test_over_range_time(rates, split, seconds):
    expected = {}
    for rows in GROUPS.values():
        for row in rows:
            expected[row[0]] = fixtures.total(
                r[3] for r in rows if row[2] - seconds * 1000 <= r[2] <= row[2]
            )
    got = over.over_range_time(
        rates, ["hbdm"], "et", "num", f"{seconds} seconds", tie=["id"], rows_per_task=split
    )
    assert as_dict(got, "sum_num") == expected


def test_frames_of_floating_point_are_refused(rates):
    with pytest.raises(TypeError):
        over.over_range_time(
            rates.withColumn("num", F.col("num").cast("double")), ["hbdm"], "et", "num", "1 second"
        )


@pytest.mark.parametrize("split", SPLITS)
def test_retract_count(rates, split):
    expected = []
    for key, rows in GROUPS.items():
        count = 0
        for i, row in enumerate(sorted(rows)):
            if row[3] is not None:
                if i:
                    expected.append((False, key, count, row[0]))
                count += 1
                expected.append((True, key, count, row[0]))
            elif i == 0:
                expected.append((True, key, 0, row[0]))
    got = changelog.retract_count(rates, "hbdm", ["id"], rows_per_task=split)
    order = lambda r: (r[3], r[0])
    assert sorted((tuple(r) for r in got.collect()), key=order) == sorted(expected, key=order)


def test_first_arrival_retracts_nothing(spark):
    one = fixtures.frame(spark, [(1, "A", fixtures.BASE_MS, 5)])
    assert [tuple(r) for r in changelog.retract_count(one, "hbdm", ["id"]).collect()] == [
        (True, "A", 1, 1)
    ]


def sessions(rows, gap):
    found = []
    for row in rows:
        if found and row[2] - found[-1][-1][2] <= gap:
            found[-1].append(row)
        else:
            found.append([row])
    return found


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("gap", [900, 1000, 100_000])
def test_session(rates, split, gap):
    aggregates = {
        "rows": ("count", "id"),
        "total": ("sum", "num"),
        "low": ("min", "num"),
        "high": ("max", "num"),
    }
    got = windows.session(
        rates, "et", f"{gap} milliseconds", ["hbdm"], aggregates, ["id"], rows_per_task=split
    ).select(
        "hbdm",
        F.unix_millis("w_start"),
        F.unix_millis("w_end"),
        *aggregates,
    )
    expected = []
    for key, rows in GROUPS.items():
        for s in sessions(rows, gap):
            known = [r[3] for r in s if r[3] is not None]
            expected.append(
                (
                    key,
                    s[0][2],
                    s[-1][2] + gap,
                    len(s),
                    fixtures.total(known),
                    min(known, default=None),
                    max(known, default=None),
                )
            )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("size, slide", [(5000, 1000), (1000, 1000), (2500, 1000)])
def test_hop(rates, size, slide):
    aggregates = {"rows": ("count", "id"), "total": ("sum", "num"), "low": ("min", "num")}
    got = windows.hop(
        rates, "et", f"{size} milliseconds", f"{slide} milliseconds", ["hbdm"], aggregates
    )
    expected: dict = {}
    for key, rows in GROUPS.items():
        for row in rows:
            start = row[2] - row[2] % slide
            while start > row[2] - size:
                expected.setdefault((key, start), []).append(row[3])
                start -= slide
    assert sorted(
        repr((r.hbdm, r.s, r.e, r.rows, r.total, r.low))
        for r in got.withColumns({"s": F.unix_millis("w_start"), "e": F.unix_millis("w_end")}).collect()
    ) == sorted(
        repr(
            (key, start, start + size, len(v), fixtures.total(v), min((x for x in v if x is not None), default=None))
        )
        for (key, start), v in expected.items()
    )


def test_unmergeable_functions_are_refused(rates):
    with pytest.raises(ValueError):
        windows.session(rates, "et", "1 second", ["hbdm"], {"x": ("avg", "num")})


@pytest.mark.parametrize("split", SPLITS)
def test_dedup_session_first(rates, split):
    got = dedup.dedup_session_first(rates, ["hbdm"], "1 second", ["et", "id"], rows_per_task=split)
    expected = {s[0][0] for rows in GROUPS.values() for s in sessions(rows, 1000)}
    assert sorted(r.id for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("keys", [[], ["num"]])
def test_times(rates, split, keys):
    got = patterns.times(
        rates,
        F.col("hbdm") == "CNY",
        ["et", "id"],
        2,
        4,
        keys,
        events=["id"],
        rows_per_task=split,
    ).collect()
    groups: dict = {}
    for row in GROUPS["CNY"]:
        groups.setdefault(row[3] if keys else None, []).append(row[0])
    expected = [
        tuple(ids[i : i + n]) for ids in groups.values() for n in (2, 3, 4) for i in range(len(ids) - n + 1)
    ]
    assert sorted(tuple(e["id"] for e in r.matched) for r in got) == sorted(expected)
    assert all(r.length == len(r.matched) and r.id == r.matched[0]["id"] for r in got)


@pytest.mark.parametrize("events, matches", [(4, []), (5, [5]), (6, [5, 5, 6])])
def test_times_five_to_six(spark, events, matches):
    rows = [(i, "CNY", fixtures.BASE_MS + i, 0) for i in range(events)]
    got = patterns.times(
        fixtures.frame(spark, rows), F.col("hbdm") == "CNY", ["et", "id"], 5, 6
    ).collect()
    assert sorted(r.length for r in got) == matches


@pytest.mark.parametrize("split", SPLITS)
def test_times_within_and_timeout(rates, split):
    condition, order = F.col("hbdm") == "CNY", ["et", "id"]
    matched = patterns.times(
        rates, condition, order, 3, 3, events=["id"], within="2 seconds", rows_per_task=split
    ).collect()
    lost = patterns.times_timed_out(
        rates, condition, order, 3, "2 seconds", rows_per_task=split
    ).collect()
    rows = GROUPS["CNY"]
    good = {r[0] for i, r in enumerate(rows[:-2]) if rows[i + 2][2] - r[2] < 2000}
    assert {r.id for r in matched} == good
    assert {r.id for r in lost} == {r[0] for r in rows} - good
    counts = {
        r[0]: sum(1 for s in rows[i : i + 3] if s[2] - r[2] < 2000) for i, r in enumerate(rows)
    }
    assert all(r.matched_count == counts[r.id] for r in lost)


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("keys", [[], ["hbdm"]])
def test_succession(rates, split, keys):
    order = ["et", "id"]
    first, second = F.col("num") >= 0, F.col("num") > 0
    matched = patterns.next_within(
        rates, first, second, "1 second", order, keys, rows_per_task=split
    ).collect()
    lost = patterns.timed_out(rates, first, "1 second", order, keys, rows_per_task=split).collect()
    streams = list(GROUPS.values()) if keys else [sorted(ROWS, key=lambda r: (r[2], r[0]))]
    good, late = set(), set()
    for rows in streams:
        for row, after in zip(rows, [*rows[1:], None], strict=True):
            if row[3] is None or row[3] < 0:
                continue
            if after is None or after[2] - row[2] >= 1000:
                late.add(row[0])
            elif after[3] is not None and after[3] > 0:
                good.add(row[0])
    assert sorted(r.id for r in matched) == sorted(good)
    assert sorted(r.id for r in lost) == sorted(late)


@pytest.mark.parametrize("split", SPLITS)
def test_repeat_alert(rates, split):
    got = patterns.repeat_alert(
        rates, ["hbdm"], ["et", "id"], "id", "4 seconds", 5, rows_per_task=split
    ).collect()
    expected = []
    for rows in GROUPS.values():
        times = [r[2] for r in rows]
        for row in rows:
            low, high = bisect_left(times, row[2] - 4000), bisect_right(times, row[2])
            if high - low >= 5:
                expected.append((row[0], high - low, rows[low][0]))
    assert expected
    assert sorted((r.id, r.cnt, r.first_task) for r in got) == sorted(expected)


def test_empty_input(spark):
    none = fixtures.frame(spark, [])
    assert over.over_rows(none, ["hbdm"], ORDER, "num", 10).count() == 0
    assert over.over_range_time(none, ["hbdm"], "et", "num", "1 second").columns[-1] == "sum_num"
    assert changelog.retract_count(none, "hbdm", ["id"]).columns == ["acc", "hbdm", "cnt_num", "id"]
    assert patterns.times(none, F.lit(True), ["et", "id"], 5, 6).count() == 0
    assert windows.session(none, "et", "1 second", ["hbdm"], {"n": ("count", "id")}).count() == 0
