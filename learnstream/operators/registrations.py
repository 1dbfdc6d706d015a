"""Sign-ups per channel, running total (A1) and sliding minute (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnstream.functions.scalar import epoch_seconds_of_text

WINDOW_SECONDS = 60
SLIDE_SECONDS = 6


def channel_total(rows: DataFrame) -> DataFrame:
    """A1: every channel with its count so far. Partial + final hash
    aggregate: a hot channel is combined map-side before the shuffle."""
    return rows.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


def channel_panes(rows: DataFrame, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Count per channel and ``slide``-second pane of the create time; rows
    whose create time does not parse are not counted."""
    sec = epoch_seconds_of_text(F.col("createtime"))
    return (rows.select("channel", F.floor(sec / slide).cast("long").alias("pane"))
            .where(F.col("pane").isNotNull())
            .groupBy("pane", "channel").agg(F.count(F.lit(1)).alias("n")))


def windows_of_panes(panes: DataFrame, window: int = WINDOW_SECONDS,
                     slide: int = SLIDE_SECONDS) -> DataFrame:
    """Spread each pane to the ``window/slide`` windows that hold it. Windows
    are ``[start, start + window)`` aligned to the epoch."""
    if window % slide:
        raise ValueError("window must be a multiple of slide")
    per = window // slide
    spread = panes.select(
        "channel", "n",
        F.explode(F.sequence(F.col("pane") - (per - 1), F.col("pane"))).alias("wpane"))
    return (spread.groupBy((F.col("wpane") * slide).alias("window_start"), "channel")
            .agg(F.sum("n").alias("n")))


def channel_window(rows: DataFrame, window: int = WINDOW_SECONDS,
                   slide: int = SLIDE_SECONDS) -> DataFrame:
    """A2 by panes: the 10x expansion touches panes, not rows."""
    return windows_of_panes(channel_panes(rows, slide), window, slide)
