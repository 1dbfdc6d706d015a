"""Merge M and the change log."""

import tempfile

import pytest

from learnstream.operators.state import ChangeLog, merge, update_existing


def test_merge_modes(spark):
    old = spark.createDataFrame([(1, "a", 10, "t1"), (2, "b", 5, "t2")], "k int, v string, n long, c string")
    new = spark.createDataFrame([(2, "B", 7, "t9"), (3, "C", 1, "t3")], "k int, v string, n long, c string")
    out = merge(old, new, ["k"], replace=["v"], accumulate=["n"], keep_first=["c"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "a", 10, "t1"), (2, "B", 12, "t2"), (3, "C", 1, "t3")]


def test_merge_null_key_is_a_key(spark):
    old = spark.createDataFrame([(None, 1)], "k string, n long")
    new = spark.createDataFrame([(None, 2)], "k string, n long")
    assert [tuple(r) for r in merge(old, new, ["k"], accumulate=["n"]).collect()] == [(None, 3)]


def test_update_existing_only(spark):
    old = spark.createDataFrame([(1, 10, None), (2, 20, None)], "page_id int, num long, jump_rate string")
    new = spark.createDataFrame([(2, "50%"), (3, "9%")], "page_id int, jump_rate string")
    got = sorted(tuple(r) for r in update_existing(old, new, ["page_id"], ["jump_rate"]).collect())
    assert got == [(1, 10, None), (2, 20, "50%")]


def _log(spark, **kw):
    return ChangeLog(spark, tempfile.mkdtemp(prefix="state-", dir="/tmp"), ["k"], **kw)


def test_change_log_replay_is_idempotent(spark):
    log = _log(spark, add=["n"])
    batch = spark.createDataFrame([(1, 5)], "k int, n long")
    for n in (0, 1, 1):                      # batch 1 twice
        log.write(batch, n)
    assert [tuple(r) for r in log.read().collect()] == [(1, 10)]
    assert [tuple(r) for r in log.read(before=1).collect()] == [(1, 5)]


def test_change_log_needs_its_predecessor(spark):
    log = _log(spark, add=["n"])
    batch = spark.createDataFrame([(1, 5)], "k int, n long")
    log.write(batch, 0)
    with pytest.raises(RuntimeError):
        log.read(before=2)                   # batch 1 is missing
    log.write(batch, 2)
    with pytest.raises(RuntimeError):
        log.read()


def test_change_log_folders_stay_bounded(spark):
    added, last = _log(spark, add=["n"], every=3), _log(spark, every=3)
    for n in range(13):
        batch = spark.createDataFrame([(n % 3, n)], "k int, n long").coalesce(1)
        for log in (added, last):
            log.write(batch, n)
            log.write(batch, n)              # every batch is run again
            assert len(log.held("b")) + len(log.held("base")) <= 9
    assert sorted(map(tuple, added.read().collect())) == [(k, sum(range(k, 13, 3))) for k in range(3)]
    assert sorted(map(tuple, last.read().collect())) == [(0, 12), (1, 10), (2, 11)]
