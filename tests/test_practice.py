import random

from pyspark.sql import functions as F

from learnstream.operators import practice

SCHEMA = "userid int, courseid int, pointid int, questionid string, istrue string, createtime string"
ODD = ["7", "07", " 7", "-1", "-64", "-65", "63", "64", "9223372036854775807", "-9223372036854775808",
       "9223372036854775808", "", "x", "1.0", None]


def attempts(rnd, n, keys=5):
    out = []
    for _ in range(n):
        key = (0 if rnd.random() < 1 / 3 else rnd.randrange(keys), 1, 2)
        q = rnd.choice(ODD) if rnd.random() < 0.2 else str(rnd.randrange(200))
        out.append((*key, q, rnd.choice(["0", "1"]), f"2019-07-16 10:{rnd.randrange(60):02d}:00"))
    return out


def plain(batches):
    """Sets of ids, sums, and the first batch's smallest create time of a key."""
    held = {}
    for rows in batches:
        first = {}
        for *key, q, right, at in rows:
            own = held.setdefault(tuple(key), [0, set(), 0, None])
            own[0] += 1
            own[1].add(q)
            own[2] += right == "1"
            first[tuple(key)] = min(at, first.get(tuple(key), at))
        for key, at in first.items():
            held[key][3] = held[key][3] or at
    return {k: (n, len(s), right, at) for k, (n, s, right, at) in held.items()}


def test_bitmaps_unite_like_sets(spark):
    rnd = random.Random(3)
    batches = [attempts(rnd, n) for n in (300, 1, 400, 150)]
    state = None
    for rows in batches:
        new = practice.state_from(spark.createDataFrame(rows, SCHEMA))
        state = new if state is None else practice.merge_state(state, new)
    got = {(r.userid, r.courseid, r.pointid): (r.qz_sum, r.qz_count, r.qz_istrue, r.createtime)
           for r in practice.detail_of_state(state).collect()}
    assert got == plain(batches)
    assert state.where("word IS NOT NULL").groupBy(*practice.STATE).count().where(F.col("count") > 1).count() == 0


def test_bitmaps_against_question_sets(spark):
    rows = spark.createDataFrame(attempts(random.Random(4), 500), SCHEMA)
    names = ["qz_sum", "qz_count", "qz_istrue", "correct_rate", "mastery_rate"]
    got = practice.detail_of_state(practice.state_from(rows)).select(*practice.KEY, *names)
    assert got.exceptAll(practice.point_detail(rows).select(*practice.KEY, *names)).count() == 0


def test_an_empty_side_merges(spark):
    rows = spark.createDataFrame(attempts(random.Random(5), 50), SCHEMA)
    none, some = practice.state_from(rows.limit(0)), practice.state_from(rows)
    want = practice.detail_of_state(some)
    for old, new in ((none, some), (some, none)):
        got = practice.detail_of_state(practice.merge_state(old, new))
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert practice.merge_state(none, none).count() == 0
