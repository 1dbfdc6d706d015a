"""Streaming = batch, and restart/replay without double counting."""

import random
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from learnstream.operators import watch
from learnstream.plans import catalog
from learnstream.sources import adapters
from learnstream.sources.feeds import replay_to_dir, stream_feed, topic_cap
from learnstream.streaming import jobs
from learnstream.streaming.sinks import latest, partition_writer, staging_writer


def _feed_dir(spark, feed, parts):
    """Write the feed lines of the small events table as ``parts`` text
    files, split by event id, so a stream sees several triggers."""
    d = tempfile.mkdtemp(prefix=f"feed-{feed}-", dir="/tmp")
    lines = catalog.lines(spark, SMALL, feed)
    for i in range(parts):
        (lines.where(F.col("pos") % parts == i).select("value").coalesce(1)
         .write.mode("overwrite").text(f"{d}/part{i}"))
    return d


def _src(spark, d, i):
    return f"{d}/part{i}"


def test_register_total_stream_equals_batch(spark):
    d = _feed_dir(spark, "register", 1)
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    feed = stream_feed(spark, directory=_src(spark, d, 0), files_per_trigger=1)
    q = jobs.register_total_job(feed, root=root, name="reg_total_t", available_now=True)
    q.awaitTermination(120)
    got = {r.channel: r.n for r in spark.sql("SELECT * FROM reg_total_t").collect()}
    want = {r.channel: r.n for r in catalog.CATALOG["register_channel_total"](spark, SMALL).collect()}
    assert got == want


def test_practice_stream_equals_batch_and_replays(spark):
    d = tempfile.mkdtemp(prefix="feed-qz-", dir="/tmp")
    lines = catalog.lines(spark, SMALL, "qz")
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    # first half, then restart from the checkpoint with the second half
    lines.where("pos < 500").select("value").coalesce(1).write.text(f"{d}/a")
    feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
    jobs.practice_job(feed, root=root, name="qz", available_now=True).awaitTermination(120)
    lines.where("pos >= 500").select("value").coalesce(1).write.text(f"{d}/b")
    feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
    jobs.practice_job(feed, root=root, name="qz", available_now=True).awaitTermination(120)
    got = jobs.practice_rows(spark, root, "qz")
    want = catalog.CATALOG["qz_point_detail"](spark, SMALL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_practice_stream_holds_odd_question_ids_and_a_hot_key(spark):
    """A third of the attempts on one key, ids beyond one bitmap row, ids that are no number's usual form."""
    rnd = random.Random(8)
    ids = ["0", "7", "07", "63", "64", "-1", "128", "x", "", "9223372036854775807", "9223372036854775808"]
    rows = [(1 if k % 3 == 0 else rnd.randrange(2, 6), 1, rnd.choice(ids), k) for k in range(600)]
    text = ["\t".join([str(u), "1", str(p), q, rnd.choice("01"), f"2019-07-12 11:{k // 60:02d}:{k % 60:02d}"])
            for u, p, q, k in rows]
    d, root = tempfile.mkdtemp(prefix="feed-qz-", dir="/tmp"), tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    for k, part in enumerate((text[:100], text[100:101], text[101:])):
        spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.text(f"{d}/{k}")
    feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
    jobs.practice_job(feed, root=root, name="qz", available_now=True).awaitTermination(120)
    names = [*jobs.practice.KEY, "qz_sum", "qz_count", "qz_istrue", "createtime"]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in jobs.practice_rows(spark, root, "qz").select(*names).collect()}
    want: dict = {}
    for line in text:
        u, c, p, q, right, at = line.split("\t")
        n, questions, rights, first = want.get((int(u), int(c), int(p)), (0, set(), 0, at))
        want[int(u), int(c), int(p)] = (n + 1, questions | {q}, rights + (right == "1"), min(first, at))
    assert {k: (n, len(q), r, at) for k, (n, q, r, at) in want.items()} == got


def _watch_of(spark, df):
    return {(r.userid, r.cwareid, r.videoid): (r.totaltime, r.completetime, r.iv) for r in df.select(
        *watch.KEY, "totaltime", "completetime", watch.interval_text(F.col("intervals")).alias("iv")).collect()}


def test_watch_stream_matches_batch_and_restarts(spark):
    """Three triggers and a restart between; totals, completed time and intervals do not depend on
    batch cuts. Effective time of one trigger is that of the batch query."""
    d = _feed_dir(spark, "course_learn", 3)
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    for folder in ("part[01]", "part[012]"):
        feed = stream_feed(spark, directory=f"{d}/{folder}", files_per_trigger=1)
        for job in (jobs.watch_job, jobs.watch_rollup_job):
            job(feed, root=root, name=job.__name__, available_now=True).awaitTermination(300)
    rows = catalog.rows(spark, SMALL, "course_learn")
    assert _watch_of(spark, jobs.watch_rows(spark, root, "watch_job")) == _watch_of(spark, watch.state_from(rows))
    assert sorted(map(tuple, jobs.watch_rollup(spark, root, "watch_rollup_job").collect()), key=str) == sorted(
        map(tuple, catalog.CATALOG["learn_rollup"](spark, SMALL).collect()), key=str)
    one = stream_feed(spark, directory=f"{d}/*")
    jobs.watch_job(one, root=root, name="once", available_now=True).awaitTermination(300)
    want = catalog.CATALOG["video_watch_detail"](spark, SMALL)
    got = jobs.watch_rows(spark, root, "once").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_watch_stream_with_a_third_of_the_plays_on_one_key(spark):
    d = tempfile.mkdtemp(prefix="feed-hot-", dir="/tmp")
    line = '{"uid":%d,"cwareid":1,"videoid":1,"ts":%d,"te":%d,"ps":%d,"pe":%d}'
    plays = [line % (1 if k % 3 else 2 + k, k * 1000, k * 1000 + 9000, k * 7 % 600, k * 7 % 600 + k % 23 - 3)
             for k in range(900)]
    for part in range(3):
        spark.createDataFrame([(p,) for p in plays[part::3][::-1] + plays[part:40:3]], "value string").coalesce(1).write.text(
            f"{d}/{part}")
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
    jobs.watch_job(feed, root=root, name="hot", available_now=True).awaitTermination(300)
    from learnstream.sources import parse
    rows = parse.parse_learn(spark.read.text(f"{d}/*"))
    assert _watch_of(spark, jobs.watch_rows(spark, root, "hot")) == _watch_of(spark, watch.state_from(rows))


def test_a_stream_of_every_malformed_line_ends_and_counts(spark):
    """All fixtures' odd lines, and hostile numbers; counts are those of the batch query."""
    from test_parsers import HOSTILE
    counts = {r.feed: (r.kept, r.rejected) for r in catalog.CATALOG["feed_reject_count"](spark, SMALL).collect()}
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    ranges = adapters.province_ranges(catalog.table(spark, SMALL, "nation"))
    todo = {"register": jobs.register_total_job, "qz": jobs.practice_job, "course_learn": jobs.watch_job,
            "page": lambda feed, **o: jobs.page_job(feed, ranges, **o)}
    extra = {"course_learn": ["{%s}" % x for x in HOSTILE] + ['{"uid":"1","ts":1,"te":2}]'], "page": ['{"uid":"1"}] junk']}
    for kind, job in todo.items():
        d = _feed_dir(spark, kind, 2)
        odd = extra.get(kind, [])
        spark.createDataFrame([(x,) for x in odd], "value string").coalesce(1).write.text(f"{d}/odd")
        feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
        q = job(feed, root=root, name=f"odd_{kind}", available_now=True)
        q.awaitTermination(300)
        assert jobs.line_counts(q) == {"kept": counts[kind][0], "rejected": counts[kind][1] + len(odd)}
        for _ in range(2):                       # a second start adds nothing
            jobs.rejects_job(feed, kind, root=root, available_now=True).awaitTermination(300)
        held = [r.value for r in jobs.rejects(spark, kind, root).collect()]
        assert len(held) == counts[kind][1] + len(odd) and set(odd) <= set(held)


def test_page_rows_in_state_follow_the_merge_rule(spark):
    """Any split of the feed: the stream's table is the batches merged one after the other."""
    from learnstream.operators import pages
    from learnstream.sources import parse
    d = tempfile.mkdtemp(prefix="feed-page-", dir="/tmp")
    lines = catalog.lines(spark, SMALL, "page")
    cuts = [(0, 1), (1, 300), (300, 310), (310, 10 ** 9)]
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    state = None
    for k, (a, b) in enumerate(cuts):
        part = lines.where(f"pos >= {a} AND pos < {b}").select("value")
        # further page ids, and neighbours that a later batch would choose otherwise
        more = '{"page_id":"%d","last_page_id":"%d","next_page_id":"9"}' % (7 + k % 2, 5 - k)
        part = part.union(spark.createDataFrame([(more,), (more.replace("7", "x").replace("8", "x"),)], "value string"))
        part.coalesce(1).write.text(f"{d}/{k}")
        feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
        jobs.page_state_job(feed, root=root, available_now=True).awaitTermination(300)
        new = pages.page_batch(pages.jump_count(parse.parse_page(part)))
        state = spark.createDataFrame((new if state is None else pages.merge_pages(state, new)).collect(), new.schema)
    got = jobs.page_rows(spark, root)
    assert sorted(map(tuple, got.select(*state.columns).collect())) == sorted(map(tuple, state.collect()))


class Broken(Exception):
    pass


def test_a_batch_that_fails_behind_its_write_stands_once(spark):
    """The sink writes and fails in batch 1; started again, every batch's rows are there once."""
    ranges = adapters.province_ranges(catalog.table(spark, SMALL, "nation"))
    todo = {"register": jobs.register_window_job, "qz": jobs.practice_job, "course_learn": jobs.watch_job,
            "page": lambda feed, **o: jobs.page_job(feed, ranges, **o)}
    for kind, job in todo.items():
        d, root = _feed_dir(spark, kind, 3), tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
        write = partition_writer(f"{root}/table")
        seen = []

        def sink(df, batch_id, write=write, seen=seen):
            write(df, batch_id)
            seen.append(batch_id)
            if seen == [0, 1]:
                raise Broken(batch_id)

        for _ in range(2):
            feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
            q = job(feed, root=root, name="t", available_now=True, sink=sink)
            try:
                q.awaitTermination(300)
            except Exception as e:                # noqa: BLE001  wrapped by the query
                assert "Broken" in str(e)
        assert seen == [0, 1, 1, 2]
        table = spark.read.parquet(f"{root}/table")
        keys = [c for c in table.columns if c in {"pane", "channel", *jobs.practice.KEY, *watch.KEY, "last_page_id", "page_id",
                                                   "next_page_id"}]
        assert table.groupBy("batch_id", *keys).count().where("count > 1").count() == 0
        assert sorted(r.batch_id for r in table.select("batch_id").distinct().collect()) == [0, 1, 2]
        if kind == "qz":
            want = catalog.CATALOG["qz_point_detail"](spark, SMALL)
            last = latest(table, jobs.practice.KEY).select(*want.columns)
            assert sorted(map(tuple, last.collect())) == sorted(map(tuple, want.collect()))


def test_folder_cap_by_bytes_and_topic_cap(spark):
    d = tempfile.mkdtemp(prefix="feed-bytes-", dir="/tmp") + "/lines"
    replay_to_dir(catalog.lines(spark, SMALL, "register"), d)
    size = max(f.stat().st_size for f in Path(d).glob("part-*"))
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    feed = stream_feed(spark, directory=d, bytes_per_trigger=2 * size)
    q = jobs.register_total_job(feed, root=root, name="reg_bytes", available_now=True)
    q.awaitTermination(120)
    rows = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    most = max(sum(1 for _ in f.open()) for f in Path(d).glob("part-*"))
    assert len(rows) >= 4 and max(rows) <= 3 * most
    assert topic_cap("page", 4) == 100 * 3 * 4
    for wrong in (("qz", None), ("qz", 0), (None, 4), ("quiz", 4)):
        with pytest.raises(ValueError):
            topic_cap(*wrong)
    with pytest.raises(ValueError):
        stream_feed(spark, directory=d, files_per_trigger=1, bytes_per_trigger=1)


def test_register_window_stream_equals_batch(spark):
    """Ten interleaved files, one a trigger: late rows are all counted and the
    last windows are there."""
    d = tempfile.mkdtemp(prefix="feed-register-", dir="/tmp") + "/lines"
    replay_to_dir(catalog.lines(spark, SMALL, "register"), d)
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    feed = stream_feed(spark, directory=d, files_per_trigger=1)
    q = jobs.register_window_job(feed, root=root, name="reg_win_t", available_now=True)
    q.awaitTermination(180)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 10
    got = jobs.register_windows(spark, root, "reg_win_t")
    want = catalog.CATALOG["register_channel_window"](spark, SMALL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_page_stream_publishes_batch_tables(spark):
    d = _feed_dir(spark, "page", 2)
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    ranges = adapters.province_ranges(catalog.table(spark, SMALL, "nation"))
    feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
    jobs.page_job(feed, ranges, root=root, name="p", available_now=True).awaitTermination(180)
    for name, got in jobs.page_tables(spark, root, "p").items():
        want = catalog.CATALOG[name](spark, SMALL)
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_console_sink_runs(spark):
    d = _feed_dir(spark, "register", 1)
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    feed = stream_feed(spark, directory=_src(spark, d, 0))
    q = jobs.register_total_job(feed, root=root, sink="console", name="reg_console", available_now=True)
    q.awaitTermination(120)
    assert q.exception() is None and q.lastProgress["sink"]["description"].startswith(
        "org.apache.spark.sql.execution.streaming.ConsoleTable")


def test_a_sink_gets_the_changed_rows_of_every_batch(spark):
    d = _feed_dir(spark, "qz", 2)
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    feed = stream_feed(spark, directory=f"{d}/*", files_per_trigger=1)
    jobs.practice_job(feed, root=root, name="qz_s", available_now=True,
                      sink=staging_writer("json", path=f"{root}/staging")).awaitTermination(120)
    staged = spark.read.json(f"{root}/staging")
    assert sorted(r.batch_id for r in staged.select("batch_id").distinct().collect()) == [0, 1]
    last = staged.groupBy("userid", "courseid", "pointid").agg(F.max_by("qz_sum", "batch_id").alias("n"))
    want = catalog.CATALOG["qz_point_detail"](spark, SMALL)
    assert {tuple(r) for r in last.collect()} == {(r.userid, r.courseid, r.pointid, r.qz_sum) for r in want.collect()}
