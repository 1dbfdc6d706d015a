"""Video watch time.

Rollups (A11-A16) are plain partial/final aggregates; A16 does all five in one
scan with ``GROUPING SETS``. The per-(user, courseware, video) fold of the
reference (A17-A19) is re-expressed without a per-group procedure:

plays of a key are taken in the total order ``(ps, ts, te, pe)``; ``m`` is the
running max of ``pe`` over earlier plays. Because earlier plays start no later,
they can only cover a prefix of the current play, so

    lo  = greatest(ps, coalesce(m, ps))
    new = greatest(0, pe - lo) - |[lo, pe] intersected with history H|
    eff = trunc(secs / (pe - ps) * new), 0 when pe = ps

and a covered island starts where ``m`` is null or ``ps > m`` (touching
intervals merge). A play with ``pe <= ps`` (seeking back, no length) covers
nothing: its seconds count, it is in no island and in no ``m``.

``m`` is found in three levels, so that no window gathers a hot key: the
maxima per (key, ps, hour of ts) are aggregated map-side; a window over the
starts of a key and one over the hours of a start see these maxima only (at
most one row a second of video, one an hour); plays meet in a window only
within one (key, ps, hour).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnstream.operators.state import merge

KEY = ["userid", "cwareid", "videoid"]
HOUR_MS = 3_600_000
ROLLUP_DIMS = ["chapterid", "cwareid", "edutypeid", "sourcetype", "subjectid"]


# ---- A11-A16 ---------------------------------------------------------------

def total_by(rows: DataFrame, dim: str) -> DataFrame:
    """Watched seconds per one dimension."""
    return rows.groupBy(dim).agg(F.sum("secs").alias("totaltime"))


def rollup(rows: DataFrame) -> DataFrame:
    """All five totals from one scan (one Expand + one aggregate)."""
    gid = F.col("_gid")
    dim = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    n = len(ROLLUP_DIMS)
    for i, d in enumerate(ROLLUP_DIMS):
        # grouping_id has bit (n-1-i) clear exactly for the set grouped by d
        only_d = (1 << n) - 1 - (1 << (n - 1 - i))
        dim = F.when(gid == only_d, F.lit(d)).otherwise(dim)
        key = F.when(gid == only_d, F.col(d).cast("string")).otherwise(key)
    return (rows.groupingSets([[d] for d in ROLLUP_DIMS], *ROLLUP_DIMS)
            .agg(F.sum("secs").alias("totaltime"), F.grouping_id(*ROLLUP_DIMS).alias("_gid"))
            .select(dim.alias("dim"), key.alias("key"), "totaltime"))


# ---- A17-A19 ---------------------------------------------------------------

def plays(rows: DataFrame) -> DataFrame:
    """Parsed learn rows -> plays keyed by (userid, cwareid, videoid)."""
    return rows.select(F.col("uid").alias("userid"), "cwareid", "videoid",
                       "ps", "pe", "ts", "te", "secs")


def _reach() -> Column:
    """Where a play's cover ends; null if it covers nothing."""
    return F.when(F.col("pe") > F.col("ps"), F.col("pe"))


def _earlier(value: str, keys: list[str], *order: str) -> Column:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.max(value).over(w)


def _effective(secs: Column, ps: Column, pe: Column, new: Column) -> Column:
    """trunc(secs / (pe - ps) * new) in double arithmetic; 0 when pe = ps."""
    ratio = secs.cast("double") / F.nullif(pe - ps, F.lit(0))
    return F.coalesce((ratio * new).cast("long"), F.lit(0).cast("long"))


def scan_plays(p: DataFrame) -> DataFrame:
    """Adds ``lo``: the end of what earlier plays of the key cover of this
    play's start, see the module text. One shuffle of the plays."""
    start, cell = [*KEY, "ps"], [*KEY, "ps", "_hour"]
    p = p.withColumn("_hour", F.floor(F.col("ts") / HOUR_MS)).withColumn("_reach", _reach())
    cells = p.groupBy(*cell).agg(F.max("_reach").alias("_top"))
    starts = cells.groupBy(*start).agg(F.max("_top").alias("_top")).select(
        *start, _earlier("_top", KEY, "ps").alias("_m1"))
    before = cells.select(*cell, _earlier("_top", start, "_hour").alias("_m2")).join(starts, start)
    own = p.withColumn("_m3", _earlier("_reach", cell, "ts", "te", "pe"))
    m = F.greatest("_m1", "_m2", "_m3")
    return (own.join(before, cell)
            .withColumn("lo", F.greatest(F.col("ps"), F.coalesce(m, F.col("ps"))))
            .drop("_hour", "_reach", "_m1", "_m2", "_m3"))


def _with_new(scanned: DataFrame, covered: Column) -> DataFrame:
    """Adds new and effective seconds; ``covered`` is what history covers of
    the part from ``lo`` on."""
    new = F.when(F.col("pe") > F.col("lo"), F.col("pe") - F.col("lo") - covered).otherwise(0)
    return (scanned.withColumn("new_seconds", new.cast("long"))
            .withColumn("effective_seconds",
                        _effective(F.col("secs"), F.col("ps"), F.col("pe"), F.col("new_seconds"))))


def coverage(p: DataFrame) -> DataFrame:
    """Per play without history: new (completed) and effective seconds."""
    return _with_new(scan_plays(p), F.lit(0))


def play_new_coverage(rows: DataFrame) -> DataFrame:
    """A18 per play."""
    return coverage(plays(rows)).select(
        *KEY, "ps", "ts", "te", "pe", "secs", "new_seconds", "effective_seconds")


def _totals(cov: DataFrame) -> DataFrame:
    return cov.groupBy(*KEY).agg(F.sum("secs").alias("totaltime"),
                                 F.sum("effective_seconds").alias("effecttime"),
                                 F.sum("new_seconds").alias("completetime"))


def watch_detail(rows: DataFrame) -> DataFrame:
    """Total, effective and completed seconds per key."""
    return _totals(coverage(plays(rows)))


def _unite(spans: DataFrame) -> DataFrame:
    """Covered intervals per key from spans (key, s, e), touching ones merged;
    a null ``e`` covers nothing but keeps its key. Spans of one start are
    combined map-side, so a window sees a row a second of video at most."""
    tops = spans.groupBy(*KEY, "s").agg(F.max("e").alias("e"))
    tops = tops.withColumn("m", _earlier("e", KEY, "s"))
    opens = F.col("e").isNotNull() & (F.col("m").isNull() | (F.col("s") > F.col("m")))
    held = tops.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.when(opens, F.struct("s", F.col("m").alias("before"))))).alias("_starts"),
        F.max("e").alias("_last"))
    starts = F.col("_starts")
    # an island ends where the running max stood when the next one opened
    ended = F.transform(starts, lambda x, i: F.struct(
        x["s"].alias("s"),
        F.coalesce(F.get(starts, i + 1)["before"], F.col("_last")).alias("e")))
    return held.select(*KEY, ended.alias("intervals"))


def interval_text(intervals: Column) -> Column:
    """``[{s,e}, ...]`` -> ``"s-e,s-e"``."""
    return F.array_join(F.transform(intervals, lambda x: F.concat(
        x["s"].cast("string"), F.lit("-"), x["e"].cast("string"))), ",")


def intervals(rows: DataFrame) -> DataFrame:
    """Merged covered intervals per key, as ``array<struct<s,e>>``."""
    return _unite(plays(rows).select(*KEY, F.col("ps").alias("s"), _reach().alias("e")))


def video_intervals(rows: DataFrame) -> DataFrame:
    return intervals(rows).select(*KEY, interval_text(F.col("intervals")).alias("play_interval"))


# ---- incremental: batch plays against stored history -----------------------

TOTALS = ("totaltime", "effecttime", "completetime")


def state_from(rows: DataFrame) -> DataFrame:
    """Watch state of a set of plays with no prior history: per key the
    totals and the covered intervals."""
    return watch_detail(rows).join(intervals(rows), KEY).select(*KEY, *TOTALS, "intervals")


def covered_before(state: DataFrame, points: DataFrame) -> DataFrame:
    """(key, x, before): the length that the stored intervals of a key cover ahead of x. Starts of
    intervals and points are one ordered scan a key: a point's length is the sum of those that
    started, less what the last of them has behind x. Both are bounded by the video's seconds."""
    none = F.lit(None).cast("int")
    starts = state.select(*KEY, F.inline("intervals")).select(
        *KEY, F.col("s").alias("x"), F.lit(0).alias("point"), F.col("e"), (F.col("e") - F.col("s")).alias("length"))
    events = starts.unionByName(points.select(*KEY, "x", F.lit(1).alias("point"), none.alias("e"), F.lit(0).alias("length")))
    w = Window.partitionBy(*KEY).orderBy("x", "point").rowsBetween(Window.unboundedPreceding, 0)
    behind = F.greatest(F.coalesce(F.last("e", ignorenulls=True).over(w) - F.col("x"), F.lit(0)), F.lit(0))
    return events.select(*KEY, "x", "point", (F.sum("length").over(w) - behind).alias("before")).where("point = 1").drop("point")


def _covered(scanned: DataFrame, batch: DataFrame, state: DataFrame) -> DataFrame:
    """Adds ``_covered``: what history covers of a play from ``lo`` to ``pe``. Plays meet
    the lengths of their own ends only, one row each, however many intervals are stored. (``lo`` is
    a play's own start or an earlier one's end.)"""
    points = batch.select(*KEY, F.explode(F.array("ps", "pe")).alias("x")).distinct()
    length = covered_before(state, points)
    for end in ("lo", "pe"):
        own = length.select(*KEY, F.col("x").alias(end), F.col("before").alias(f"_at_{end}"))
        scanned = scanned.join(own, [*KEY, end], "left")
    return scanned.withColumn("_covered", F.coalesce(F.col("_at_pe") - F.col("_at_lo"), F.lit(0)))


def incremental(state: DataFrame, rows: DataFrame) -> DataFrame:
    """Merge a batch of plays into watch state (totals and ``intervals`` per
    key). Returns the new state over the keys of both sides."""
    batch = plays(rows)
    p = _covered(scan_plays(batch), batch, state)
    totals = merge(state, _totals(_with_new(p, F.col("_covered"))), KEY, accumulate=TOTALS)
    old = state.select(*KEY, F.inline_outer("intervals"))
    new = batch.select(*KEY, F.col("ps").alias("s"), _reach().alias("e"))
    return totals.join(_unite(old.unionByName(new)), KEY).select(*KEY, *TOTALS, "intervals")
