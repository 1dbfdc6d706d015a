"""J4's stored page rows in Spark's state store (S9-S11): a page's views add up, its
neighbours stay those of its first batch, and rates are set from all pages' views on reading.

A page takes a large share of all views, so a task counts the transitions of its own
rows first; a page's state then meets a few rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from learnstream.operators import pages
from learnstream.streaming.watch_state import state_of

VARIABLE = "page"
HELD = "last_page_id string, next_page_id string, num long"
JUMP = ["page_id", "last_page_id", "next_page_id"]


class PageFold(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState(VARIABLE, HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)
        old = self.held.get()                  # None for a new page
        last, following = old[:2] if old is not None else min((r.last_page_id, r.next_page_id) for r in rows)
        num = (old[2] if old is not None else 0) + sum(r.num for r in rows)
        self.held.update((last, following, num))
        yield Row(page_id=key[0], last_page_id=last, next_page_id=following, num=num)

    def close(self) -> None:
        pass


def _counted(frames):
    for df in frames:
        yield df.groupby(JUMP, as_index=False).size().rename(columns={"size": "num"})


def folded(rows: DataFrame) -> DataFrame:
    """Streaming page rows -> the new row of every page that a trigger touches.
    Page ids that are no whole number have no row."""
    jumps = rows.select(F.col("page_id").try_cast("int").alias("page_id"), "last_page_id", "next_page_id")
    counts = jumps.where("page_id IS NOT NULL").mapInPandas(
        _counted, "page_id int, last_page_id string, next_page_id string, num long")
    return counts.groupBy("page_id").transformWithState(
        statefulProcessor=PageFold(), outputStructType=f"page_id int, {HELD}", outputMode="Update", timeMode="None")


def stored(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The page rows after the last trigger, with their rates."""
    held = state_of(spark, checkpoint, VARIABLE).select("key.page_id", "value.*")
    rates = pages.convert_rate(held.select("page_id", "num")).select("page_id", "jump_rate")
    return held.join(rates, "page_id").select("last_page_id", "page_id", "next_page_id", "num", "jump_rate")
