"""Operator 12: periodic runs of words, by tiles per octave of periods.

A run is a stretch of consecutive words with smallest period q, at least
``max(min_length, 2 q)`` long, that no neighbouring word extends. A word is
dropped if any run contains it behind that run's first q words.

1. A document is exploded into overlapping tiles for every octave of periods
   ``[P, 2 P)``: one tile around every multiple b of P, of the words
   ``[b - 2 P, b + 4 P)`` (the periods below 8 share tiles of ``P = 4``). A run
   of period q has a boundary b among its words with q more words behind it, as
   it is 2 q long. A tile needs nothing but its own words.
2. A tile's boundary Z-functions give, for every period q of its octave, how far
   the words from b on agree with those from b + q on (``z``), and how far those
   before them do (``back``); ``[b - back, b + q + z)`` has period q. It is
   a fragment of a run if ``z + back`` is long enough and, by the same Z-function, no
   divisor of q is a period. All pairs (b, q) of a group of tiles are answered
   together by hashes of word blocks of doubling length; a first
   look at 4 words leaves few pairs.
3. A tile is cut at its ends, so a long run shows as overlapping fragments.
   Fragments are shuffled by (document, period) and stitched where they overlap
   by q words or more; touching fragments of one group of tiles are
   stitched before the shuffle.

Work is of the order of n log n for n words, whatever they repeat. Tiles are
solved in groups of ``PAIRS`` pairs; of a text, its words and the block hashes (for
block lengths up to its longest match) are held at a time.

Nulls: a null text has no words; a null id is a document like any other, as are
repeated rows, each on its own. Columns other than doc_id and text are
ignored. Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnstream.functions.scalar import idiv
from learnstream.llm.common import bound_batches, materialize, per_batch, text_groups
from learnstream.llm.shingles import PLACES, mix

MIN_LENGTH = 12
SMALL = 8                # periods below this share the tiles of the first octave
PAIRS = 1 << 20          # pairs (boundary, period) solved at once


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Blocks:
    """Hashes of all blocks of 1, 2, 4, ... words, built as far as they are asked for."""

    def __init__(self, ids: np.ndarray):
        self.levels = [mix(ids.astype(np.uint64) + np.uint64(1))]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            h, half = self.levels[-1], 1 << (len(self.levels) - 1)
            n = max(len(h) - half, 0)
            self.levels.append(mix(h[:n] * PLACES[0] + h[half:half + n] * PLACES[1]))
        return self.levels[k]

    def z(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from a and from b on agree (``back``: up to a and up
        to b), at most ``limit``: ever longer blocks, then ever shorter ones."""
        out = np.zeros(len(a), np.int64)

        def grow(live, k):
            live = live[out[live] + (1 << k) <= limit[live]]
            x, y = (a[live] - out[live] - (1 << k), b[live] - out[live] - (1 << k)) if back else (
                a[live] + out[live], b[live] + out[live])
            h = self.level(k)
            hit = live[h[x] == h[y]]
            out[hit] += 1 << k
            return hit

        live, seen = np.arange(len(a)), []
        while len(live):
            hit = grow(live, len(seen))
            seen.append(live)
            live = hit
        for k in range(len(seen) - 1, -1, -1):   # what met a difference within 2^k words
            grow(seen[k], k)
        return out

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from a and from b on agree (n > 0)."""
        k = np.frexp(n.astype(np.float64))[1] - 1
        out = np.zeros(len(a), bool)
        for one in np.unique(k).tolist():
            own = np.flatnonzero(k == one)
            h, end = self.level(one), n[own] - (1 << one)
            out[own] = (h[a[own]] == h[b[own]]) & (h[a[own] + end] == h[b[own] + end])
        return out


def smallest_factors(top: int) -> np.ndarray:
    """The smallest prime factor of every number up to ``top``."""
    f = np.arange(top + 1)
    for p in range(2, int(top ** 0.5) + 1):
        if f[p] == p:
            own = f[p * p::p]
            own[own == np.arange(p * p, top + 1, p)] = p
    return f


def primitive(blocks: Blocks, b: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the q words from b on are no repetition of fewer words."""
    ok = np.ones(len(b), bool)
    if not len(q):
        return ok
    factor, rest = smallest_factors(int(q.max())), q.copy()
    live = np.flatnonzero(rest > 1)
    while len(live):
        r = factor[rest[live]]
        p = q[live] // r
        again = blocks.same(b[live], b[live] + p, q[live] - p)
        ok[live[again]] = False
        rest[live] //= r
        live = live[~again & (rest[live] > 1)]
    return ok


def solve(blocks: Blocks, first: np.ndarray, last: np.ndarray, b: np.ndarray, q: np.ndarray, step: int,
          min_length: int) -> tuple[np.ndarray, ...]:
    """Fragments (document, start, end, period, whole) of the tiles around ``b`` for
    the periods ``q``; a document's words are ``[first, last)``. ``whole`` if its ends are not the tile's."""
    low, high = np.maximum(first, b - 2 * step), np.minimum(last, b + 4 * step)
    # A whole run has so many words that agree; one cut on the left has 2 steps.
    need = np.maximum(q, np.minimum(2 * step, min_length - q)) if step * 2 == SMALL else q
    # half of them, or more, are on one side of b: a first look at 2 or 4 words
    look = 1 if step * 2 == SMALL else 2
    h = blocks.level(look)
    gram = 1 << look
    ahead, behind = b + q + gram <= high, b - gram >= low
    ahead[ahead] = h[b[ahead]] == h[b[ahead] + q[ahead]]
    behind[behind] = h[b[behind] - gram] == h[b[behind] + q[behind] - gram]
    own = np.flatnonzero(ahead | behind)
    b, q, low, high, need = b[own], q[own], low[own], high[own], need[own]
    z = blocks.z(b, b + q, high - b - q)
    back = blocks.z(b, b + q, b - low, back=True)
    found = np.flatnonzero(z + back >= need)
    found = found[primitive(blocks, b[found], q[found])]
    own, b, q, low, high = own[found], b[found], q[found], low[found], high[found]
    start, end = b - back[found], b + q + z[found]
    whole = ((start > low) | (low == first[own])) & ((end < high) | (high == last[own]))
    keep = ~whole | (end - start >= np.maximum(min_length, 2 * q))
    return own[keep], start[keep], end[keep], q[keep]


def shortest(step: int) -> int:
    """Words of the shortest run of an octave."""
    return 2 if step * 2 == SMALL else 2 * step


def tiles(sizes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, boundary) of every tile of an octave: all multiples of
    ``step`` in documents that are long enough for its periods."""
    n = np.where(sizes >= shortest(step), -(-sizes // step), 0)
    doc = np.repeat(np.arange(len(sizes)), n)
    return doc, (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step


def fragments(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> tuple[np.ndarray, ...]:
    """(document, period, start, end) of all fragments, stitched where they
    touch; sorted by document, period and start."""
    if min_length < 5:
        raise ValueError("a run of fewer than 5 words may have no boundary of a tile")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    at = ends - sizes
    blocks = Blocks(ids)
    out = []
    step = SMALL // 2
    sizes = np.where(sizes < min_length, 0, sizes)
    while len(sizes) and shortest(step) <= sizes.max():
        periods = np.arange(1, SMALL) if step * 2 == SMALL else np.arange(step, 2 * step)
        doc, b = tiles(sizes, step)
        rows = max(1, PAIRS // len(periods))
        for k in range(0, len(doc), rows):
            d, c = doc[k:k + rows], b[k:k + rows]
            # a boundary needs q words behind it
            most = np.minimum(sizes[d] - c, periods[-1]) - periods[0] + 1
            pick = most > 0
            d, c, most = d[pick], c[pick], most[pick]
            if not len(d):
                continue
            own = np.repeat(np.arange(len(d)), most)
            q = periods[0] + np.arange(len(own)) - np.repeat(np.cumsum(most) - most, most)
            d = d[own]
            one, start, end, q = solve(blocks, at[d], ends[d], at[d] + c[own], q, step, min_length)
            d = d[one]
            out.append(stitch(d, q, start - at[d], end - at[d]))
        step *= 2
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return stitch(*(np.concatenate(x) for x in zip(*out)))


def stitch(doc: np.ndarray, q: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fragments of a document and period that overlap by the period or more are
    one. Sorted, both starts and ends of different runs of a period ascend."""
    order = np.lexsort((end, start, q, doc))
    doc, q, start, end = doc[order], q[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (q[1:] != q[:-1]) | (start[1:] > end[:-1] - q[1:])
    first = np.flatnonzero(new)
    return doc[first], q[first], start[first], np.maximum.reduceat(end, first) if len(first) else end


# ---- Spark side ------------------------------------------------------------

SOLVED = "row long, doc_id long, text string, fragments array<struct<period:long,start:long,end:long>>"
KIND = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
RUNS = "array<struct<start:long,period:long,length:long>>"


def solved(docs: DataFrame, min_length: int) -> DataFrame:
    """Per document its words joined by one space and its fragments."""
    bound_batches(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for at, group in text_groups(texts):
                own = [words(t) for t in group]
                doc, q, start, end = fragments(own, min_length)
                flat = pa.StructArray.from_arrays([pa.array(q), pa.array(start), pa.array(end)],
                                                  fields=list(KIND.value_type))
                places = np.searchsorted(doc, np.arange(len(group) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(row, row + len(group)), pa.int64()), batch.column(0).slice(at, len(group)),
                    pa.array([b" ".join(w).decode("utf-8", "replace") for w in own], pa.string()),
                    pa.ListArray.from_arrays(pa.array(places), flat, type=KIND)],
                    ["row", "doc_id", "text", "fragments"])
                row += len(group)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SOLVED)


def stitched(found: DataFrame, min_length: int) -> DataFrame:
    """(row, period, start, length) of the runs of fragments (row, period, start, end)."""
    w = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = before.isNull() | (F.col("start") > before - F.col("period"))
    parts = found.withColumn("new", new.cast("int")).withColumn("part", F.sum("new").over(w))
    whole = parts.groupBy("row", "period", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    return whole.where(length >= F.greatest(F.lit(min_length), 2 * F.col("period"))).select(
        "row", "period", "start", length.alias("length"))


def _collapse(b: pa.RecordBatch) -> pa.RecordBatch:
    """The text without the words that a run repeats."""
    out = []
    for text, runs in zip(b.column("text").to_pylist(), b.column("runs").to_pylist()):
        own = words(text)
        edge = np.zeros(len(own) + 1, np.int64)
        for r in runs:
            edge[r["start"] + r["period"]] += 1
            edge[r["start"] + r["length"]] -= 1
        gone = np.cumsum(edge) > 0
        out.append(b" ".join(w for w, g in zip(own, gone) if not g).decode("utf-8", "replace"))
    return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("runs"), pa.array(out, pa.string())],
                                      ["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, runs (start, period, length; by start, then period) and
    ``collapsed``, the kept words joined by one space; one row per row of ``docs``."""
    own = materialize(solved(docs, min_length), "tiles", compression="zstd")
    found = own.where(F.size("fragments") > 0).select("row", F.inline("fragments"))
    runs = stitched(found, min_length).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    texts = own.where(F.size("fragments") > 0).select("row", "doc_id", "text")
    held = texts.join(runs, "row", "left").select(
        "doc_id", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), "text")
    done = held.mapInArrow(per_batch(_collapse), f"doc_id long, runs {RUNS}, collapsed string")
    free = own.where(F.size("fragments") == 0).select(
        "doc_id", F.array().cast(RUNS).alias("runs"), F.col("text").alias("collapsed"))
    return done.unionByName(free)


# ---- the query's documents and digests ---------------------------------------

def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, with a repetition put into about every tenth document, by
    a fixed rule on the crc32 of its id: from word a on, the p words from there
    over and over. The words of other documents stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = idiv(h, 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = idiv(n - a, 3 + g % 8) + 1
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i))), " "))

    own = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(h % 10 == 0, F.get(F.transform(F.array(own), repeated), F.lit(0))).otherwise(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The query's columns of ``periodic_runs``."""
    best = F.get(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"),
        r["length"].alias("length")))), F.lit(0))
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    ends = F.transform(line, lambda x: F.concat(x, F.lit("\n")))
    one = found.withColumn("best", best)
    return one.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        idiv(F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(ends, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
