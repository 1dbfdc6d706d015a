"""Operator 6: benchmark items inside training documents.

1. An item's seeds are its word triples at the places of ``SHAPES``. A triple
   is known by its words and their order alone, so that a word put in, left
   out or replaced beside them leaves seeds of another shape equal.
2. One pass over the documents counts the documents that hold each seed and
   makes passages: seeds no farther apart than the longest item that has one
   of them, kept with the words around them if they hold two different ones.
3. Passages and items meet by a join on seeds, equal sets of seeds once. A pair
   goes on if two different seeds match and one of them is rare (in at most
   one of ``RARE`` documents), or if one of ``COMMON`` of the item's seeds match,
   however common they are: a copy in every document is still found.
4. Smith-Waterman alignment of the item's words with the passage scores
   edited copies: the share of the score of an exact copy. From ``LEAK`` on the
   pair is reported. It holds one row of cells. A pair with too few words in
   common to get there, whatever their order, is not aligned.

Items of fewer than ``MIN_WORDS`` words, and those with one seed only (one word
over and over), are looked up whole in the same pass: exact copies alone.

Seeds of at most ``SLICE_SEEDS`` are sent to the tasks at once; a larger
benchmark is taken in slices, one pass each. Words are lower-cased runs of
what is neither white space nor ASCII punctuation.

Nulls: a null text, of a document or an item, has no words, and such an item
is in no document; a null id is kept as such. Rows that repeat a doc_id (or an
item_id) are reported once per pair, at their best score. Ties are kept. Extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, materialize, per_batch, text_groups
from learnstream.llm.shingles import PLACES, mix, ngram_hashes, word_hashes

SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4))
SEED = 5                     # words that a shape spans at most
MIN_WORDS = 4
RARE, COMMON = 1000, 12
MATCH, MISMATCH, GAP = 2, -1, -1
LEAK = 0.4
SLICE_SEEDS = 2_000_000      # 16 MB, and 8 MB of lengths
BITS = 22

#: A-Z to lower case, ASCII punctuation and controls to spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def joined(own: list[bytes]) -> str:
    return b" ".join(own).decode("utf-8", "replace")


def triples(h: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Hash of the words at the shape's places, from every word on."""
    n = max(0, len(h) - shape[-1])
    out = np.full(n, 3, np.uint64)
    for k, place in enumerate(shape):
        out += h[place:place + n] * PLACES[k]
    return mix(out)


def whole_hash(h: np.ndarray) -> np.uint64:
    """Hash of all words of an item (or of as many of a document)."""
    return polynomial(h, len(h))[0]


def polynomial(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, for any n, from sums by doubling."""
    if n <= len(PLACES):
        return ngram_hashes(h, n)
    half = polynomial(h, n // 2)
    rest = polynomial(h, n - n // 2)
    m = max(0, len(h) - n + 1)
    return mix(half[:m] * PLACES[0] + rest[n // 2:n // 2 + m] * PLACES[1] + np.uint64(n))


class Seeds:
    """Membership in a sorted array, behind a bitmap of the hashes' top bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.map = np.zeros(1 << BITS, bool)
        self.map[hashes >> np.uint64(64 - BITS)] = True

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` that hold a member, and which."""
        at = np.flatnonzero(self.map[h >> np.uint64(64 - BITS)])
        if not len(self.hashes):
            return at, at
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        hit = self.hashes[k] == h[at]
        return at[hit], k[hit]


def item_seeds(items: DataFrame) -> DataFrame:
    """item_id, item (words joined by spaces), n_words, seeds (none if the item
    is looked up whole), whole (its hash then) of every item with words."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not (own := words(t)):
                continue
            h = word_hashes(own)
            seeds = np.unique(np.concatenate([triples(h, s) for s in SHAPES])).view(np.int64)
            whole = None
            if len(own) < MIN_WORDS or len(seeds) < 2:
                seeds, whole = seeds[:0], whole_hash(h).view(np.int64)
            rows.append((i, joined(own), len(own), seeds, whole))
        return batch(rows, ITEM) if rows else None

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(per_batch(run), ITEM)


KINDS = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[kind]) for c, (_, kind) in zip(zip(*rows), fields)],
                                      [name for name, _ in fields])


ITEM = "item_id long, item string, n_words long, seeds array<long>, whole long"
# a passage; a whole short item (its words as window, counts null); or the
# documents that hold each seed (doc_id, window null)
PASSAGE = ("passage long, doc_id long, mark long, start long, seeds array<long>, window string, "
           "whole long, counts array<long>")


def passages(docs: DataFrame, seeds: np.ndarray, reach: np.ndarray, short: dict[int, np.ndarray]) -> DataFrame:
    """Passages, whole items and counts of seeds. ``reach`` is the longest item
    of each seed; ``short`` holds hashes of whole items by their words."""
    sent = docs.sparkSession.sparkContext.broadcast((seeds, reach, short))

    def run(batches):
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 40
        seeds, reach, short = sent.value
        own, wholes = Seeds(seeds), {n: Seeds(h) for n, h in short.items()}
        for b in batches:
            ids, marks, rows = b.column(0).to_pylist(), b.column(2).to_pylist(), []
            for base, group in text_groups([t or "" for t in b.column(1).to_pylist()]):
                split = [words(t) for t in group]
                ends = np.cumsum([len(w) for w in split])
                h = word_hashes([w for s in split for w in s])

                def hits_of(member, hashes, span):
                    """Places, documents and members of hits inside one text."""
                    hits, which = member.places(hashes)
                    doc = np.searchsorted(ends, hits, side="right")
                    inside = hits + span <= ends[doc] if len(hits) else np.zeros(0, bool)
                    return hits[inside], doc[inside], which[inside]

                for n, member in wholes.items():
                    hits, doc, which = hits_of(member, polynomial(h, n), n)
                    if not len(hits):
                        continue
                    _, first = np.unique(np.stack([doc, which]), axis=1, return_index=True)
                    for k in first:
                        start = int(hits[k] - ends[doc[k]]) + len(split[doc[k]])
                        rows.append((None, ids[base + doc[k]], marks[base + doc[k]], start, [],
                                     joined(split[doc[k]][start:start + n]),
                                     int(member.hashes[which[k]].view(np.int64)), None))

                found = [hits_of(own, triples(h, s), s[-1] + 1) for s in SHAPES]
                hits, doc, which = (np.concatenate(c) for c in zip(*found))
                if not len(hits):
                    continue
                order = np.argsort(hits, kind="stable")
                hits, doc, which = hits[order], doc[order], which[order]
                pairs = np.unique(doc * np.int64(len(seeds)) + which) % len(seeds)
                held, n = np.unique(pairs, return_counts=True)
                rows.append((None, None, None, None, seeds[held].view(np.int64), None, None, n))

                far = reach[which].astype(np.int64)
                new = np.concatenate([[True], (doc[1:] != doc[:-1])
                                      | (np.diff(hits) > np.maximum(far[1:], far[:-1]))])
                cuts = np.append(np.flatnonzero(new), len(hits))
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    members = np.unique(which[lo:hi])
                    if len(members) < 2:
                        continue
                    k = doc[lo]
                    first = int(ends[k]) - len(split[k])
                    start = max(0, int((hits[lo:hi] - far[lo:hi]).min()) - first)
                    stop = int((hits[lo:hi] + far[lo:hi]).max()) - first + SEED
                    rows.append((at, ids[base + k], marks[base + k], start, seeds[members].view(np.int64),
                                 joined(split[k][start:stop]), None, None))
                    at += 1
            if rows:
                yield batch(rows, PASSAGE)

    own = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    return own.mapInArrow(run, PASSAGE)


def align(item: list[str], window: list[str]) -> tuple[int, int, int, int]:
    """Smith-Waterman: score, equal words, first word and word behind the last
    of the best local alignment (the earliest end of equals). Every cell carries
    the start and the equal words of its alignment, so one row is held."""
    code: dict[str, int] = {}
    a = [code.setdefault(w, len(code)) for w in item]
    b = np.array([code.setdefault(w, len(code)) for w in window], np.int64)
    n = len(b)
    slope, place = GAP * np.arange(n + 1), np.arange(n + 1)
    score, first, equal = np.zeros(n + 1, np.int64), place.copy(), np.zeros(n + 1, np.int64)
    best = (0, 0, 0, 0)
    for w in a:
        same = b == w
        # from above: a gap in the window
        row, start, hits = score + GAP, first.copy(), equal.copy()
        step = score[:-1] + np.where(same, MATCH, MISMATCH)
        take = step >= row[1:]
        row[1:] = np.where(take, step, row[1:])
        start[1:] = np.where(take, first[:-1], start[1:])
        hits[1:] = np.where(take, equal[:-1] + same, hits[1:])
        empty = row <= 0
        row[empty], start[empty], hits[empty] = 0, place[empty], 0
        # a gap in the item: the best earlier cell less GAP a word
        level = row - slope
        top = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == top, place, 0))
        score = top + slope
        first, equal = start[source], hits[source]
        j = int(score.argmax())
        if score[j] > best[0]:
            best = (int(score[j]), int(equal[j]), int(first[j]), j)
    return best


FOUND = "doc_id long, mark long, item_id long, score double, n_equal long, n_words long, start long, stop long"


def _aligned(b: pa.RecordBatch) -> pa.RecordBatch | None:
    rows = []
    for r in b.to_pylist():
        item, window = r["item"].split(" "), r["window"].split(" ")
        # every equal word is a MATCH at best
        if (Counter(item) & Counter(window)).total() / len(item) < LEAK:
            continue
        score, equal, first, stop = align(item, window)
        share = score / (MATCH * len(item))
        if share >= LEAK:
            rows.append((r["doc_id"], r["mark"], r["item_id"], share, equal, len(item), r["start"] + first,
                         r["start"] + stop))
    return batch(rows, FOUND) if rows else None


def leaks(docs: DataFrame, items: DataFrame, by_text: bool = False) -> DataFrame:
    """doc_id, item_id, score (1: an exact copy), n_equal, n_words (of the
    item), start and stop (words of the document) of every leaked item. With
    ``by_text`` a document is an id and a text, and a mark (xxhash64 of the text)
    comes behind doc_id."""
    spark = docs.sparkSession
    bound_batches(spark)
    bench = materialize(item_seeds(items), "items")
    facts = bench.agg(F.sum(F.greatest(F.size("seeds"), F.lit(1))).alias("seeds")).first()
    slices = -(-(facts["seeds"] or 0) // SLICE_SEEDS)
    found = None
    for k in range(slices):
        own = bench.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(slices)) == k)
        part = _slice(docs, own)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    key = ["doc_id", "mark", "item_id"] if by_text else ["doc_id", "item_id"]
    best = F.max(F.struct("score", "n_equal", "n_words", -F.col("start"), "stop")).alias("b")
    return found.groupBy(*key).agg(best).select(
        *key, "b.score", "b.n_equal", "b.n_words", (-F.col("b.col4")).alias("start"), "b.stop")


def _slice(docs: DataFrame, bench: DataFrame) -> DataFrame:
    bench = bench.withColumn("key", F.xxhash64("item_id", "item"))
    pairs = bench.select("key", F.size("seeds").alias("of"), F.explode("seeds").alias("seed"), "n_words")
    # SLICE_SEEDS at most, in expectation
    known = pairs.groupBy("seed").agg(F.max("n_words").alias("n")).toLocalIterator()
    both = np.array([(r["seed"], r["n"]) for r in known], np.int64).reshape(-1, 2)
    seeds = np.ascontiguousarray(both[:, 0]).view(np.uint64)
    order = np.argsort(seeds)
    short: dict[int, list[int]] = {}
    for r in bench.where("whole IS NOT NULL").select("n_words", "whole").distinct().toLocalIterator():
        short.setdefault(r["n_words"], []).append(r["whole"])
    own = materialize(passages(docs, seeds[order], both[order, 1].astype(np.int32),
                               {n: np.sort(np.array(h, np.int64).view(np.uint64)) for n, h in short.items()}), "passages")

    counts = (own.where("counts IS NOT NULL").select(F.explode(F.arrays_zip("seeds", "counts")).alias("c"))
              .groupBy(F.col("c.seeds").alias("seed")).agg(F.sum("c.counts").alias("n_docs")))
    rare = counts.select("seed", (F.col("n_docs") <= F.greatest(F.lit(1), F.lit(docs.count()) / RARE)).alias("rare"))
    windows = (own.where("passage IS NOT NULL")
               .select("doc_id", "mark", "start", "window", "seeds", F.xxhash64("seeds").alias("set")))
    sets = windows.groupBy("set").agg(F.first("seeds").alias("seeds"))
    hits = sets.select("set", F.explode("seeds").alias("seed"))
    asked = pairs.select("key", "of", "seed").distinct().join(rare, "seed")
    near = (hits.join(asked, "seed").groupBy("set", "key", "of")
            .agg(F.count(F.lit(1)).alias("n"), F.max("rare").alias("rare"))
            .where(F.col("n") >= 2).where(F.col("rare") | (F.col("n") * COMMON >= F.col("of"))))
    texts = bench.select("key", "item_id", "item").dropDuplicates(["key"])
    edited = (near.select("set", "key").join(texts, "key").join(windows.drop("seeds"), "set")
              .select("doc_id", "mark", "item_id", "item", "start", "window").mapInArrow(per_batch(_aligned), FOUND))
    if not short:
        return edited
    items = bench.where("whole IS NOT NULL").select("item_id", "item", "n_words", "whole")
    exact = (own.where("whole IS NOT NULL").drop("seeds", "counts").join(items, "whole").where("item = window")
             .select("doc_id", "mark", "item_id", F.lit(1.0).alias("score"), F.col("n_words").alias("n_equal"), "n_words",
                     "start", (F.col("start") + F.col("n_words")).alias("stop")))
    return edited.union(exact.distinct())
