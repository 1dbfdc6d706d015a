"""Coverage fold: the interval cases of FIXTURES.md section 4 and
properties against a brute-force model of unit cells."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from learnstream.operators import watch

LEARN = ("uid int, cwareid int, videoid int, chapterid int, edutypeid int, subjectid int, "
         "sourcetype string, speed int, ts bigint, te bigint, ps int, pe int, secs bigint")
STATE = ("userid int, cwareid int, videoid int, totaltime bigint, effecttime bigint, "
         "completetime bigint, intervals array<struct<s:int,e:int>>")


def plays_df(spark, plays, key=(1, 1, 1)):
    """plays: (ps, pe, ts, secs)"""
    rows = [(*key, 1, 1, 1, "PC", 1, ts, ts + secs * 1000, ps, pe, secs) for ps, pe, ts, secs in plays]
    return spark.createDataFrame(rows, LEARN)


def history(spark, intervals, key=(1, 1, 1)):
    return spark.createDataFrame([(*key, 0, 0, 0, [(s, e) for s, e in intervals])], STATE)


CASES = [  # play against history 10-20: (ps, pe, new, merged intervals)
    (12, 15, 0, "10-20"), (10, 20, 0, "10-20"), (5, 15, 5, "5-20"), (15, 25, 5, "10-25"),
    (5, 25, 10, "5-25"), (10, 30, 10, "10-30"), (0, 20, 10, "0-20"), (20, 25, 5, "10-25"),
    (30, 40, 10, "10-20,30-40"), (30, 30, 0, "10-20"), (30, 12, 0, "10-20"),
]


def test_interval_cases_against_history(spark):
    for ps, pe, new, merged in CASES:
        out = watch.incremental(history(spark, [(10, 20)]), plays_df(spark, [(ps, pe, 0, 20)]))
        r = out.select("completetime", "effecttime",
                       watch.interval_text(F.col("intervals")).alias("iv")).first()
        assert (r.completetime, r.iv) == (new, merged), (ps, pe)
        exp_eff = int(20 / (pe - ps) * new) if pe > ps else 0
        assert r.effecttime == exp_eff, (ps, pe)


def test_two_history_intervals(spark):
    out = watch.incremental(history(spark, [(0, 10), (30, 40)]), plays_df(spark, [(0, 40, 0, 40)]))
    r = out.select("completetime", watch.interval_text(F.col("intervals")).alias("iv")).first()
    assert (r.completetime, r.iv) == (20, "0-40")


def brute(plays):
    """Per-play new units and the merged islands, by unit cells."""
    covered, news = set(), []
    for ps, pe, ts, secs in sorted(plays, key=lambda p: (p[0], p[2], p[2] + p[3] * 1000, p[1])):
        cells = set(range(ps, pe))
        news.append(len(cells - covered))
        covered |= cells
    islands, cur = [], None
    for x in sorted(covered):
        if cur and x == cur[1]:
            cur[1] = x + 1
        else:
            cur = [x, x + 1]
            islands.append(cur)
    return sum(news), ",".join(f"{a}-{b}" for a, b in islands)


# backward and zero-length plays too; several hours, so that starts are cut
play = st.tuples(st.integers(0, 60), st.integers(-8, 15), st.integers(0, 10_000_000), st.integers(0, 30))


@settings(max_examples=12, deadline=None)
@given(st.lists(play, min_size=1, max_size=40))
def test_coverage_matches_brute_force(spark, raw):
    plays = [(ps, ps + ln, ts, secs) for ps, ln, ts, secs in raw]
    df = plays_df(spark, plays)           # one hot key
    r = watch.watch_detail(df).first()
    iv = watch.video_intervals(df).first().play_interval
    total, islands = brute(plays)
    assert r.completetime == total
    assert r.totaltime == sum(p[3] for p in plays)
    assert iv == islands


@settings(max_examples=5, deadline=None)
@given(st.lists(play, min_size=2, max_size=30), st.randoms())
def test_split_into_history_and_batch(spark, raw, rnd):
    """Completed time and intervals do not depend on the batch split;
    replaying every play adds nothing."""
    plays = [(ps, ps + ln, ts, secs) for ps, ln, ts, secs in raw]
    cut = rnd.randint(1, len(plays) - 1)
    hist = watch.state_from(plays_df(spark, plays[:cut]))
    both = watch.incremental(hist, plays_df(spark, plays[cut:]))
    r = both.select("completetime", "totaltime",
                    watch.interval_text(F.col("intervals")).alias("iv")).first()
    total, islands = brute(plays)
    assert (r.completetime, r.iv) == (total, islands)
    again = watch.incremental(both, plays_df(spark, plays)).first()
    assert again.completetime == total


def test_a_backward_play_in_history_credits_nothing_later(spark):
    hist = watch.state_from(plays_df(spark, [(0, 10, 0, 5), (15, 25, 1, 5), (30, 20, 2, 5)]))
    r = watch.incremental(hist, plays_df(spark, [(26, 40, 3, 14)])).first()
    assert (r.completetime, r.totaltime) == (34, 29)


def test_one_key_with_a_third_of_the_plays(spark):
    hot = [(k % 60, k % 60 + k % 7 - 2, k * 600_000, 3) for k in range(300)]
    rest = [plays_df(spark, [(k % 9, k % 9 + 4, k, 2)], (2 + k % 50, 1, 1)) for k in range(6)]
    df = plays_df(spark, hot)
    for other in rest:
        df = df.union(other)
    r = watch.watch_detail(df).where("userid = 1").first()
    assert r.completetime == brute(hot)[0]


def test_many_stored_intervals_of_one_key(spark):
    """10,000 stored intervals, plays across some, in some and beyond all of them."""
    stored = [(k * 10, k * 10 + 1 + k % 9) for k in range(10_000)]
    held = [(0, 35_005, 1, 9), (17, 18, 2, 4), (50_003, 50_700, 3, 50), (99_990, 120_000, 4, 7), (30_000, 60_000, 5, 3),
            (200_000, 200_010, 6, 1), (7, 7, 7, 2), (9, 3, 8, 2)]
    r = watch.incremental(history(spark, stored), plays_df(spark, held)).first()
    cells = {x for s, e in stored for x in range(s, e)}
    news, eff = 0, 0
    for ps, pe, _, secs in sorted(held):
        new = set(range(ps, pe)) - cells
        cells |= new
        news += len(new)
        eff += int(secs / (pe - ps) * len(new)) if pe != ps else 0
    assert (r.completetime, r.effecttime, r.totaltime) == (news, eff, sum(p[3] for p in held))
    assert sum(x.e - x.s for x in r.intervals) == len(cells)


def test_lengths_ahead_of_a_point(spark):
    points = spark.createDataFrame([(1, 1, 1, x) for x in range(0, 45)] + [(2, 1, 1, 5)],
                                   "userid int, cwareid int, videoid int, x int")
    got = {(r.userid, r.x): r.before for r in watch.covered_before(history(spark, [(10, 20), (30, 40)]), points).collect()}
    cells = {*range(10, 20), *range(30, 40)}
    assert got == {(1, x): len([c for c in cells if c < x]) for x in range(45)} | {(2, 5): 0}
