"""J5's keyed state: totals and covered intervals of a (user, courseware,
video) in Spark's state store (RocksDB), folded play by play.

A trigger brings the plays of a key to that key's state; nothing else is read or
written, so a trigger's work follows its own plays and not what is stored. The plays of a key
within one trigger are sorted in a task: the intake cap of the feed bounds them. What
is stored of a key is bounded by its video's length. The fold is that of
``operators.watch`` (module text there), against the intervals stored before.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from learnstream.operators import watch

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VARIABLE = "watch"
HELD = "totaltime long, effecttime long, completetime long, starts array<int>, ends array<int>"
CHANGED = f"userid int, cwareid int, videoid int, {HELD}"


def state_of(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """(key, value) of a state variable after the last trigger, read from the checkpoint."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs this store; a session that names another one keeps its own."""
    if "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def fold(held: tuple, plays: list[tuple]) -> tuple:
    """(totals, starts, ends) after plays (ps, ts, te, pe, secs) met those stored."""
    total, effective, complete, starts, ends = held
    before = [0]                              # length covered ahead of every stored interval
    for s, e in zip(starts, ends):
        before.append(before[-1] + e - s)

    def covered_to(x: int) -> int:
        k = bisect_right(starts, x)
        return before[k] - max(0, ends[k - 1] - x) if k else 0

    reach, spans = None, []
    for ps, _, _, pe, secs in sorted(plays):
        lo = ps if reach is None else max(ps, reach)
        new = pe - lo - (covered_to(pe) - covered_to(lo)) if pe > lo else 0
        total += secs
        complete += new
        if pe != ps:
            effective += int(secs / (pe - ps) * new)
        if pe > ps:
            reach = pe if reach is None else max(reach, pe)
            spans.append((ps, pe))
    return total, effective, complete, *unite(starts, ends, spans)


def unite(starts: list[int], ends: list[int], spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Stored intervals and sorted new spans; touching ones are one."""
    new: list[list[int]] = []
    for s, e in spans:
        if new and s <= new[-1][1]:
            new[-1][1] = max(new[-1][1], e)
        else:
            new.append([s, e])
    starts, ends = list(starts), list(ends)
    for s, e in new:
        a, b = bisect_left(ends, s), bisect_right(starts, e)     # those it touches
        if a < b:
            s, e = min(s, starts[a]), max(e, ends[b - 1])
        starts[a:b], ends[a:b] = [s], [e]
    return starts, ends


class WatchFold(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState(VARIABLE, HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.held.get()                  # None for a new key
        old = (old[0], old[1], old[2], list(old[3]), list(old[4])) if old is not None else (0, 0, 0, [], [])
        new = fold(old, [(r.ps, r.ts, r.te, r.pe, r.secs) for r in rows])
        self.held.update(new)
        yield Row(**dict(zip(watch.KEY, key)), totaltime=new[0], effecttime=new[1], completetime=new[2],
                  starts=new[3], ends=new[4])

    def close(self) -> None:
        pass


def folded(plays: DataFrame) -> DataFrame:
    """Streaming plays -> the new row of every key that a trigger touches."""
    return plays.groupBy(*watch.KEY).transformWithState(
        statefulProcessor=WatchFold(), outputStructType=CHANGED, outputMode="Update", timeMode="None")


def with_intervals(held: DataFrame) -> DataFrame:
    pairs = F.transform(F.arrays_zip("starts", "ends"), lambda x: F.struct(x["starts"].alias("s"), x["ends"].alias("e")))
    return held.select(*watch.KEY, *watch.TOTALS, pairs.alias("intervals"))


def stored(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of every key after the last trigger."""
    state = state_of(spark, checkpoint, VARIABLE)
    return with_intervals(state.select(*[F.col(f"key.{k}").alias(k) for k in watch.KEY], "value.*"))
