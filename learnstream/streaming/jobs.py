"""Structured Streaming jobs J1-J5 over the same transforms as the batch
queries.

* J1 registrations, running total: streaming aggregation, ``complete`` mode.
* J2 registrations, sliding minute: counts per 6 s pane of every batch, added
  up over batches; a window is ten panes on reading. Panes are few (14,400 a
  day and channel), so late rows need no watermark and none is dropped.
* J3 practice: streaming aggregation in ``update`` mode; Spark's state store
  keeps totals and question bitmaps, one row for 64 questions of a key, each
  trigger emits only the changed rows. Rows per key are added up on reading.
* J4 pages: every batch adds its transition counts and its clicks
  per province, the tables are made of them on reading. The page rows (first
  neighbours, views, rates) are keyed state of their own query.
* J5 watch time: totals and covered intervals per key in the state store,
  rollups as a streaming aggregation of their own query.

Every job takes a feed (``stream_feed``), a checkpoint location under the
shared checkpoint folder, and a trigger (3 s by default, ``availableNow`` in
tests). A malformed record costs that record: every job counts the lines it keeps and
rejects on the parse itself (``observedMetrics`` of its progress, ``line_counts``), and
``rejects_job`` writes the rejected lines. Change logs and sinks are written per batch
id: a batch that is run again after a failure rewrites its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from learnstream.operators import pages, practice, registrations, watch
from learnstream.operators.state import ChangeLog
from learnstream.session import ensure_checkpoint_dir
from learnstream.sources import parse
from learnstream.sources.feeds import BATCH_SECONDS
from learnstream.streaming import page_state, watch_state
from learnstream.streaming.sinks import Sink


def _root(spark: SparkSession, root: str | None) -> str:
    return (root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobs").rstrip("/")


def _trigger(writer, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{BATCH_SECONDS} seconds")


def _checkpoint(spark: SparkSession, root: str | None, name: str) -> str:
    return f"{_root(spark, root)}/{name}/_checkpoint"


# ---- malformed records -------------------------------------------------------

def _rows(feed: DataFrame, kind: str, **options) -> DataFrame:
    """The feed's valid rows; both kinds of lines are counted where they are parsed."""
    flagged = parse.PARSERS[kind](feed, keep_rejects=True, **options).drop("line")
    counted = flagged.observe("lines", F.count_if("valid").alias("kept"), F.count_if(~F.col("valid")).alias("rejected"))
    return counted.where("valid").drop("valid")


def line_counts(query: StreamingQuery) -> dict[str, int]:
    """Lines kept and rejected over the triggers a query still remembers."""
    out = {"kept": 0, "rejected": 0}
    for p in query.recentProgress:
        if row := p["observedMetrics"].get("lines"):
            out = {k: n + row[k] for k, n in out.items()}
    return out


def rejects_job(feed: DataFrame, kind: str, *, root: str | None = None, name: str | None = None,
                available_now: bool = False) -> StreamingQuery:
    """Every rejected line of a feed, once, as text files (``rejects`` reads them)."""
    spark, name = feed.sparkSession, name or f"rejects_{kind}"
    w = (parse.rejected(feed, kind).writeStream.format("text").outputMode("append")
         .option("path", f"{_root(spark, root)}/{name}/lines")
         .option("checkpointLocation", _checkpoint(spark, root, name)))
    return _trigger(w, available_now).start()


def rejects(spark: SparkSession, kind: str, root: str | None = None, name: str | None = None) -> DataFrame:
    return spark.read.schema("value string").text(f"{_root(spark, root)}/{name or f'rejects_{kind}'}/lines")


# ---- J1, J2 ----------------------------------------------------------------

def register_total_job(feed: DataFrame, *, root: str | None = None, sink: str = "memory",
                       name: str = "register_channel_total",
                       available_now: bool = False) -> StreamingQuery:
    spark = feed.sparkSession
    agg = registrations.channel_total(_rows(feed, "register"))
    w = (agg.writeStream.outputMode("complete").format(sink).queryName(name)
         .option("checkpointLocation", f"{_root(spark, root)}/{name}/_checkpoint"))
    if sink == "console":
        w = w.option("numRows", 10)
    return _trigger(w, available_now).start()


def _log(spark: SparkSession, root: str | None, name: str, keys, add=(), every: int = 20) -> ChangeLog:
    return ChangeLog(spark, f"{_root(spark, root)}/{name}", keys, add, every)


def _hand_on(sink: Sink | None, log: ChangeLog, batch_id: int) -> None:
    """Give the sink what a batch wrote to a change log."""
    if sink:
        sink(log.spark.read.parquet(f"{log.path}/b={batch_id}"), batch_id)


def pane_log(spark: SparkSession, root: str | None = None, name: str = "register_channel_window") -> ChangeLog:
    return _log(spark, root, f"{name}/panes", ["pane", "channel"], ["n"])


def register_window_job(feed: DataFrame, *, root: str | None = None,
                        name: str = "register_channel_window",
                        available_now: bool = False, sink: Sink | None = None) -> StreamingQuery:
    """J2; ``register_windows`` reads the windows. The sink gets a batch's panes."""
    log = pane_log(feed.sparkSession, root, name)

    def write(df: DataFrame, batch_id: int) -> None:
        log.write(registrations.channel_panes(df), batch_id)
        _hand_on(sink, log, batch_id)

    w = (_rows(feed, "register").writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{_root(feed.sparkSession, root)}/{name}/_checkpoint"))
    return _trigger(w, available_now).start()


def register_windows(spark: SparkSession, root: str | None = None,
                     name: str = "register_channel_window") -> DataFrame:
    """Sign-ups per channel in 60 s windows sliding by 6 s, over all batches."""
    return registrations.windows_of_panes(pane_log(spark, root, name).read())


# ---- J3 --------------------------------------------------------------------

def practice_log(spark: SparkSession, root: str | None = None, name: str = "qz_point_detail") -> ChangeLog:
    """Bitmap rows (``practice.state_from``) that batches changed."""
    return _log(spark, root, f"{name}/changes", practice.STATE)


def practice_rows(spark: SparkSession, root: str | None = None, name: str = "qz_point_detail") -> DataFrame:
    """The current row per key."""
    return practice.detail_of_state(practice_log(spark, root, name).read())


def practice_job(feed: DataFrame, *, root: str | None = None, name: str = "qz_point_detail",
                 available_now: bool = False, sink: Sink | None = None) -> StreamingQuery:
    """J3; ``practice_rows`` reads the rows per key. The sink gets those of the keys a batch changed."""
    log = practice_log(feed.sparkSession, root, name)

    def write(df: DataFrame, batch_id: int) -> None:
        log.write(df, batch_id)
        if sink:
            changed = log.spark.read.parquet(f"{log.path}/b={batch_id}").select(*practice.KEY).distinct()
            held = log.read(before=batch_id + 1).join(changed, practice.KEY, "left_semi")
            sink(practice.detail_of_state(held), batch_id)

    w = (practice.state_from(_rows(feed, "qz")).writeStream.outputMode("update")
         .foreachBatch(write)
         .option("checkpointLocation", f"{_root(feed.sparkSession, root)}/{name}/_checkpoint"))
    return _trigger(w, available_now).start()


# ---- J4 --------------------------------------------------------------------

def page_logs(spark: SparkSession, root: str | None = None, name: str = "page") -> tuple[ChangeLog, ChangeLog]:
    """Transition counts and clicks per province."""
    return (_log(spark, root, f"{name}/jumps", ["last_page_id", "page_id", "next_page_id"], ["num"]),
            _log(spark, root, f"{name}/provinces", ["province"], ["n"]))


def page_job(feed: DataFrame, ranges: DataFrame, *, root: str | None = None,
             name: str = "page", available_now: bool = False, sink: Sink | None = None) -> StreamingQuery:
    """J4; ``page_tables`` reads the results. Ranges may be nested. The sink gets a batch's transition counts."""
    spark = feed.sparkSession
    jumps, provinces = page_logs(spark, root, name)
    # nested ranges are flattened once, not in every batch
    flat = f"{_root(spark, root)}/{name}/ranges"
    pages.flatten(ranges).write.mode("overwrite").parquet(flat)
    ranges = spark.read.parquet(flat)

    def add(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            jumps.write(pages.jump_count(df), batch_id)
            provinces.write(pages.province_clicks(df, ranges), batch_id)
            _hand_on(sink, jumps, batch_id)
        finally:
            df.unpersist()

    w = (_rows(feed, "page").writeStream.foreachBatch(add)
         .option("checkpointLocation", f"{_root(feed.sparkSession, root)}/{name}/_checkpoint"))
    return _trigger(w, available_now).start()


def page_tables(spark: SparkSession, root: str | None = None, name: str = "page") -> dict[str, DataFrame]:
    """Jump counts, conversion and top provinces over all batches."""
    jumps, provinces = (log.read() for log in page_logs(spark, root, name))
    return {"page_jump_count": jumps,
            "page_convert_rate": pages.convert_rate(pages.view_total_from_counts(jumps)),
            "province_clicks_top3": pages.top_of(provinces)}


def _keyed(rows: DataFrame, checkpoint: str, available_now: bool, sink: Sink | None) -> StreamingQuery:
    """A keyed-state query: its result is its state; the sink gets the rows a trigger changed."""
    w = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return _trigger(w.foreachBatch(sink) if sink else w.format("noop"), available_now).start()


def page_state_job(feed: DataFrame, *, root: str | None = None, name: str = "page_state",
                   available_now: bool = False, sink: Sink | None = None) -> StreamingQuery:
    """J4's page rows; ``page_rows`` reads them."""
    watch_state.use_rocksdb(feed.sparkSession)
    return _keyed(page_state.folded(_rows(feed, "page")), _checkpoint(feed.sparkSession, root, name),
                  available_now, sink)


def page_rows(spark: SparkSession, root: str | None = None, name: str = "page_state") -> DataFrame:
    return page_state.stored(spark, _checkpoint(spark, root, name))


# ---- J5 --------------------------------------------------------------------

def watch_job(feed: DataFrame, *, root: str | None = None, name: str = "watch",
              available_now: bool = False, sink: Sink | None = None) -> StreamingQuery:
    """J5 per video key; ``watch_rows`` reads the current rows."""
    watch_state.use_rocksdb(feed.sparkSession)
    plays = watch.plays(_rows(feed, "course_learn"))
    changed = watch_state.with_intervals(watch_state.folded(plays))
    return _keyed(changed, _checkpoint(feed.sparkSession, root, name), available_now, sink)


def watch_rows(spark: SparkSession, root: str | None = None, name: str = "watch") -> DataFrame:
    return watch_state.stored(spark, _checkpoint(spark, root, name))


def watch_rollup_job(feed: DataFrame, *, root: str | None = None, name: str = "watch_rollup",
                     available_now: bool = False, sink: Sink | None = None) -> StreamingQuery:
    """J5's five totals as one aggregation by (dim, key); ``watch_rollup`` reads them."""
    rows = _rows(feed, "course_learn", columns=[*watch.ROLLUP_DIMS, "secs"])
    dims = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("key")) for d in watch.ROLLUP_DIMS])
    totals = rows.select("secs", F.inline(dims)).groupBy("dim", "key").agg(F.sum("secs").alias("totaltime"))
    return _keyed(totals, _checkpoint(feed.sparkSession, root, name), available_now, sink)


def watch_rollup(spark: SparkSession, root: str | None = None, name: str = "watch_rollup") -> DataFrame:
    state = spark.read.format("statestore").load(_checkpoint(spark, root, name))
    return state.select("key.*", "value.*").toDF("dim", "key", "totaltime")
