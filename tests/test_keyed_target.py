"""The compacted keyed target, and consolidated changelogs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changelog
from tidemark.sources.upsert import CompactedLog


def _batch(spark, n):
    """Twenty keys of which a batch writes five, some twice."""
    rows = [((n * 3 + i) % 20, 10 * n + i, f"v{n}-{i}") for i in range(5)] + [((n * 3) % 20, 10 * n + 7, f"v{n}-last")]
    return spark.createDataFrame(rows, "k long, at long, v string").coalesce(1), rows


def test_many_batches_leave_few_runs(spark, tmp_path):
    log, expected = CompactedLog(str(tmp_path / "log"), ["k"], ["at"], fan=3), {}
    for n in range(40):
        frame, rows = _batch(spark, n)
        log.write(frame, n)
        for k, at, v in sorted(rows, key=lambda r: r[1]):
            expected[k] = (at, v)
        assert log.live_runs(spark) <= 2 * 4
    assert {r.k: (r.at, r.v) for r in log.read(spark).collect()} == expected
    assert log.vacuum(spark) > 0
    assert {r.k: (r.at, r.v) for r in log.read(spark).collect()} == expected
    assert len(log._listed(spark, "runs")) == log.live_runs(spark) and len(log._listed(spark, "manifests")) == 1


def test_a_later_batch_wins_whatever_its_order(spark, tmp_path):
    log = CompactedLog(str(tmp_path / "log"), ["k"], ["at"], fan=2)
    for n, (at, v) in enumerate([(9, "first"), (5, "second"), (7, "third")]):
        log(spark.createDataFrame([(1, at, v)], "k long, at long, v string"), n)
    assert [r.v for r in log.read(spark).collect()] == ["third"]


def test_crash_before_the_commit_and_retry_after_it(spark, tmp_path, monkeypatch):
    log = CompactedLog(str(tmp_path / "log"), ["k"], ["at"], fan=2)
    log.write(_batch(spark, 0)[0], 0)
    before = sorted(map(tuple, log.read(spark).collect()))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(CompactedLog, "_commit", crash)
        with pytest.raises(OSError):
            log.write(_batch(spark, 1)[0], 1)
    assert sorted(map(tuple, log.read(spark).collect())) == before
    log.write(_batch(spark, 1)[0], 1)
    after = sorted(map(tuple, log.read(spark).collect()))
    log.write(_batch(spark, 1)[0], 1)  # retried after its commit
    log.write(_batch(spark, 0)[0], 0)
    assert after != before and sorted(map(tuple, log.read(spark).collect())) == after
    version, runs, done = log._manifest(spark)
    with pytest.raises(RuntimeError, match="another writer"):
        log._commit(spark, version, runs, done)
    with pytest.raises(ValueError, match="nothing"):
        CompactedLog(str(tmp_path / "none"), ["k"], ["at"]).read(spark)


CHANGES = [
    (True, "A", 1, 1), (False, "A", 1, 2), (True, "A", 2, 2), (False, "A", 2, 3), (True, "A", 3, 3),
    (False, "B", 5, 1), (True, "B", 6, 1), (False, "B", 6, 2), (True, "B", 5, 2),
    (False, "C", 4, 1), (True, "D", 1, 1), (False, "D", 1, 2), (True, None, 1, 4),
]


def test_net_changes(spark):
    frame = spark.createDataFrame(CHANGES, "acc boolean, k string, n long, at long").repartition(3)
    got = changelog.net_changes(frame, ["k"], "n", ["at"]).collect()
    # B returns to where it was; D comes and goes; C is taken back.
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(True, "A", 3), (False, "C", 4), (True, None, 1)]))
    rows = changelog.as_upserts(frame, ["k"], "n", ["at"]).collect()
    assert {(r.k, r.n) for r in rows} == {("A", 3), (None, 1)}


def test_net_changelog_applied_is_the_state(spark):
    rows = [(i, f"k{i * i % 7}", None if i % 5 == 0 else i) for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, k string, num long")
    changes = changelog.retract_count(frame, "k", ["id"])
    state = {}
    for batch in range(4):
        own = changes.filter((F.col("id") >= 50 * batch) & (F.col("id") < 50 * batch + 50))
        net = changelog.net_changes(own, ["k"], "cnt_num", ["id"]).collect()
        for r in sorted(net, key=lambda r: r.acc):
            if r.acc:
                state[r.k] = r.cnt_num
            else:
                assert state.pop(r.k) == r.cnt_num
        assert len(net) <= 2 * 7
    assert state == {r.k: r.n for r in frame.groupBy("k").agg(F.count("num").alias("n")).collect()}
