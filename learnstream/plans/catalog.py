"""The query catalogue: name -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's parquet tables (``events``, ``nation``),
derives the raw feed lines from them and runs the engine's transforms over
the whole table. Output columns are aliased exactly as in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnstream.operators import registrations as reg
from learnstream.operators import pages, practice, state, watch
from learnstream.session import ensure_checkpoint_dir
from learnstream.sources import adapters, parse
from learnstream.sources.feeds import replay_frame

Query = Callable[[SparkSession, str], DataFrame]
WATCH = ["uid", "cwareid", "videoid", "ps", "pe", "ts", "te", "secs"]
CATALOG: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        CATALOG[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return adapters.FEEDS[feed](table(spark, sf_dir, "events"))


def rows(spark: SparkSession, sf_dir: str, feed: str, **options) -> DataFrame:
    return parse.PARSERS[feed](lines(spark, sf_dir, feed), **options)


def event_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """History (event id below half the event count) and batch events. The
    mark is a scalar subquery, the bound a filter on the scan."""
    events = table(spark, sf_dir, "events")
    half = events.select((F.count(F.lit(1)) / 2).alias("half")).scalar()
    return events.where(F.col("event_id") < half), events.where(F.col("event_id") >= half)


def halves(spark: SparkSession, sf_dir: str, feed: str) -> tuple[DataFrame, DataFrame]:
    hist, batch = event_halves(spark, sf_dir)
    return adapters.FEEDS[feed](hist), adapters.FEEDS[feed](batch)


# ---- registrations (J1, J2) ----------------------------------------------

@query("replay_register_lines")
def replay_register_lines(spark, sf_dir):
    return replay_frame(lines(spark, sf_dir, "register"))


@query("register_valid_rows")
def register_valid_rows(spark, sf_dir):
    return rows(spark, sf_dir, "register")


@query("register_channel_total")
def register_channel_total(spark, sf_dir):
    return reg.channel_total(rows(spark, sf_dir, "register"))


@query("register_channel_window")
def register_channel_window(spark, sf_dir):
    return reg.channel_window(rows(spark, sf_dir, "register"))


# ---- watch time (J5) -------------------------------------------------------

@query("learn_rows")
def learn_rows(spark, sf_dir):
    return rows(spark, sf_dir, "course_learn")


def _learn_total(dim):
    def run(spark, sf_dir):
        return watch.total_by(rows(spark, sf_dir, "course_learn", columns=[dim, "secs"]), dim)
    return run


for _name, _dim in [("learn_by_chapter", "chapterid"), ("learn_by_cware", "cwareid"),
                    ("learn_by_edutype", "edutypeid"), ("learn_by_source", "sourcetype"),
                    ("learn_by_subject", "subjectid")]:
    query(_name)(_learn_total(_dim))


@query("learn_rollup")
def learn_rollup(spark, sf_dir):
    return watch.rollup(rows(spark, sf_dir, "course_learn", columns=[*watch.ROLLUP_DIMS, "secs"]))


@query("play_new_coverage")
def play_new_coverage(spark, sf_dir):
    return watch.play_new_coverage(rows(spark, sf_dir, "course_learn", columns=WATCH))


@query("video_watch_detail")
def video_watch_detail(spark, sf_dir):
    return watch.watch_detail(rows(spark, sf_dir, "course_learn", columns=WATCH))


@query("video_intervals")
def video_intervals(spark, sf_dir):
    return watch.video_intervals(rows(spark, sf_dir, "course_learn", columns=WATCH))


@query("video_watch_incremental")
def video_watch_incremental(spark, sf_dir):
    hist, batch = halves(spark, sf_dir, "course_learn")
    ensure_checkpoint_dir(spark)
    # written once each, as they are read several times: both halves' plays and the stored state
    old, new = (parse.parse_learn(half, columns=WATCH).checkpoint() for half in (hist, batch))
    merged = watch.incremental(watch.state_from(old).checkpoint(), new)
    return merged.select(*watch.KEY, "totaltime", "effecttime", "completetime",
                         watch.interval_text(F.col("intervals")).alias("play_interval"))


# ---- practice (J3) ---------------------------------------------------------

@query("qz_valid_rows")
def qz_valid_rows(spark, sf_dir):
    return rows(spark, sf_dir, "qz")


@query("qz_question_set")
def qz_question_set(spark, sf_dir):
    return practice.question_set(rows(spark, sf_dir, "qz"))


@query("qz_point_history")
def qz_point_history(spark, sf_dir):
    clock = table(spark, sf_dir, "events").select(F.max("ts")).scalar()
    return practice.point_history(rows(spark, sf_dir, "qz"), clock)


@query("qz_point_detail")
def qz_point_detail(spark, sf_dir):
    return practice.point_detail(rows(spark, sf_dir, "qz"))


@query("qz_latest_attempt")
def qz_latest_attempt(spark, sf_dir):
    return practice.latest_attempt(rows(spark, sf_dir, "qz"))


@query("qz_latest_by_answer")
def qz_latest_by_answer(spark, sf_dir):
    return practice.latest_by_answer(rows(spark, sf_dir, "qz"))


@query("qz_dedup_rate")
def qz_dedup_rate(spark, sf_dir):
    return practice.dedup_rate(rows(spark, sf_dir, "qz"))


@query("qz_point_detail_incremental")
def qz_point_detail_incremental(spark, sf_dir):
    hist, batch = halves(spark, sf_dir, "qz")
    old = practice.state_from(parse.parse_qz(hist))
    new = practice.state_from(parse.parse_qz(batch))
    return practice.detail_of_state(practice.merge_state(old, new))


# ---- pages (J4) ------------------------------------------------------------

@query("page_valid_rows")
def page_valid_rows(spark, sf_dir):
    return rows(spark, sf_dir, "page")


@query("page_jump_count")
def page_jump_count(spark, sf_dir):
    return pages.jump_count(rows(spark, sf_dir, "page"))


@query("page_view_total")
def page_view_total(spark, sf_dir):
    return pages.view_total(rows(spark, sf_dir, "page"))


@query("page_convert_rate")
def page_convert_rate(spark, sf_dir):
    return pages.convert_rate(pages.view_total(rows(spark, sf_dir, "page")))


@query("province_clicks_top3")
def province_clicks_top3(spark, sf_dir):
    ranges = adapters.province_ranges(table(spark, sf_dir, "nation"))
    return pages.province_top(rows(spark, sf_dir, "page"), ranges)


@query("province_clicks_nested")
def province_clicks_nested(spark, sf_dir):
    """Clicks per most specific province of nested and overlapping ranges."""
    ranges = adapters.nested_ranges(table(spark, sf_dir, "nation"))
    return pages.province_clicks(rows(spark, sf_dir, "page"), pages.flatten(ranges))


@query("page_view_incremental")
def page_view_incremental(spark, sf_dir):
    hist, batch = halves(spark, sf_dir, "page")
    return pages.merge_totals(pages.view_total(parse.parse_page(hist)),
                              pages.view_total(parse.parse_page(batch)))


@query("page_state_incremental")
def page_state_incremental(spark, sf_dir):
    hist, batch = halves(spark, sf_dir, "page")
    old, new = (pages.page_batch(pages.jump_count(parse.parse_page(x))) for x in (hist, batch))
    return pages.merge_pages(old, new)


@query("feed_reject_count")
def feed_reject_count(spark, sf_dir):
    """Lines of every feed that its parser keeps and rejects."""
    def counted(feed):
        flagged = rows(spark, sf_dir, feed, keep_rejects=True)
        return flagged.agg(F.count_if("valid").alias("kept"), F.count_if(~F.col("valid")).alias("rejected")).select(
            F.lit(feed).alias("feed"), "kept", "rejected")
    parts = [counted(feed) for feed in adapters.FEEDS]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


# ---- state merges (S6-S12) -------------------------------------------------

PROGRESS_GROUP = "learnstream"


@query("merge_replace")
def merge_replace(spark, sf_dir):
    """Per user the type of the latest event: history half, then the batch
    half replaces it where the user appears again."""
    hist, batch = event_halves(spark, sf_dir)

    def latest(df):
        return df.groupBy(F.col("user_id").alias("key")).agg(
            F.max_by("event_type", "event_id").alias("value"))
    old, new = latest(hist), latest(batch)
    return state.merge(old, new, ["key"], replace=["value"])


@query("merge_accumulate")
def merge_accumulate(spark, sf_dir):
    hist, batch = halves(spark, sf_dir, "course_learn")
    need = ["chapterid", "secs"]
    old = watch.total_by(parse.parse_learn(hist, columns=need), "chapterid")
    new = watch.total_by(parse.parse_learn(batch, columns=need), "chapterid")
    return state.merge(old, new, ["chapterid"], accumulate=["totaltime"])


@query("feed_progress")
def feed_progress(spark, sf_dir):
    def until(events):
        rec = events.select(F.col("event_type").alias("topic"),
                            (F.col("event_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"))
        return state.progress(rec, PROGRESS_GROUP)
    hist, batch = event_halves(spark, sf_dir)
    old, new = until(hist), until(batch)
    return state.merge(old, new, ["grp", "topic", "partition"], replace=["until_offset"])
