"""Operator 13: ranked lexical search with accumulators that queries share.

Every item (query) gets its k best documents by an integer BM25 score:

    w(t)   = floor(1000 ln((2 N + 2) / (2 df + 1)))
    m(d)   = 100 - B + (B n N) div L
    score  = sum over the item's terms, repeats included, of
             w * ((10^9 tf) div (1000 tf + 8 m))

with N documents that hold a term, L terms in them, n terms of the document,
df documents with the term and tf its occurrences in the document.

1. Items are taken in blocks of about ``BLOCK_CHARS`` characters, which bounds what is
   sent to the tasks: terms, weights and the plan. A pass over the texts
   keeps, per document, its length and the counts of the block's terms; N,
   L and df are sums over these rows.
2. The block's items are mined for shared term sets: the pairs of summands that
   most items share become a node of their own, again and again, until no two
   items share a pair. The result is a DAG: a node adds two earlier ones,
   an item adds what is left of its terms. A repeated term is a summand a
   repetition.
3. A task computes, per batch of documents, each term's summand and each
   node's partial accumulator once, and combines them along the DAG to the items'
   scores. It keeps the k best of an item; those of all tasks are merged by
   (score, doc_id).

Terms are the maximal runs of ASCII letters and digits and of all characters beyond
ASCII; A-Z are lower-cased. A null text has none. A null doc_id counts
in N, L and df and comes last among ties. Repeated documents count and are ranked
each. Of rows with one item_id the smallest text is taken (null: no terms); a null item_id
takes no part. An item without a document of positive score has no row. An
empty table of either kind gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, materialize, running_total

K = 10
B = 75                   # per cent of the length's share in m
SCALE = 1_000_000_000
BLOCK_CHARS = 1 << 18    # characters of the items that are searched in one pass
CELLS = 1 << 21          # accumulators held at once (nodes x documents)
LAST = np.iinfo(np.int64).max

OUT = "item_id long, rank int, doc_id long, score long"

#: Bytes that part terms become spaces, A-Z small letters (UTF-8 keeps its own bytes).
TERM_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


# ---- the plan of a block of items ----------------------------------------------

class Plan:
    """Summands of a block of items.

    Nodes ``0 .. len(vocabulary)-1`` are terms; ``adds[k]`` are the two nodes that node
    ``len(vocabulary) + k`` adds; ``sums`` are the nodes an item adds, as
    (item, node) pairs sorted by item."""

    def __init__(self, items: dict[int, list[bytes]]):
        self.item_ids = np.array(sorted(items), np.int64)
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for own in items.values() for t in own}))}
        # the j-th repetition of a term in an item is a symbol of its own
        symbol: dict[tuple[int, int], int] = {(t, 0): t for t in range(len(self.vocabulary))}
        sets = []
        for i in self.item_ids.tolist():
            count, own = Counter(), set()
            for t in items[i]:
                key = (self.vocabulary[t], count[t])
                own.add(symbol.setdefault(key, len(symbol)))
                count[t] += 1
            sets.append(own)
        self.term_of = np.array([t for t, _ in symbol], np.int64)
        self.adds, self.levels = share(sets, len(symbol))
        pairs = [(i, node) for i, own in enumerate(sets) for node in sorted(own)]
        self.sums = np.array(pairs, np.int64).reshape(-1, 2)


def share(sets: list[set[int]], n: int) -> tuple[np.ndarray, list[int]]:
    """Mine shared pairs: (pairs of added nodes, first pair of every round).
    ``sets`` are changed to what is left. A round counts the pairs of every set
    and takes, most shared first, those whose nodes no pair of the round
    has taken, each in the sets that still hold both; so nodes of a round add nodes
    of earlier rounds only."""
    adds: list[tuple[int, int]] = []
    starts = []
    while True:
        seen = Counter(n for own in sets for n in own)
        held = defaultdict(list)
        for k, own in enumerate(sets):
            shared = sorted(x for x in own if seen[x] > 1)
            for i, a in enumerate(shared):
                for b in shared[i + 1:]:
                    held[a, b].append(k)
        best = sorted((p for p, own in held.items() if len(own) > 1), key=lambda p: (-len(held[p]), p))
        if not best:
            return np.array(adds, np.int64).reshape(-1, 2), starts
        starts.append(len(adds))
        taken: set[int] = set()
        for a, b in best:
            if a in taken or b in taken:
                continue
            taken |= {a, b}
            for k in held[a, b]:
                sets[k] -= {a, b}
                sets[k].add(n)
            adds.append((a, b))
            n += 1


class Scorer:
    """Scores of batches of documents against a plan's items."""

    def __init__(self, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int):
        self.plan, self.weights, self.n_docs, self.n_terms = plan, weights, n_docs, n_terms
        rounds = [*plan.levels, len(plan.adds)]
        self.rounds = list(zip(rounds, rounds[1:]))
        self.symbols = len(plan.term_of)
        self.first = np.searchsorted(plan.sums[:, 0], np.arange(len(plan.item_ids)))
        self.full = np.flatnonzero(np.diff(np.append(self.first, len(plan.sums))) > 0)

    def scores(self, lengths: np.ndarray, rows: np.ndarray, cols: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """items x documents from (document, term, tf) triples."""
        m = 100 - B + (B * lengths * self.n_docs) // self.n_terms
        own = np.zeros((len(self.plan.vocabulary), len(lengths)), np.int64)
        own[cols, rows] = self.weights[cols] * ((SCALE * tf) // (1000 * tf + 8 * m[rows]))
        nodes = np.empty((self.symbols + len(self.plan.adds), len(lengths)), np.int64)
        nodes[:self.symbols] = own[self.plan.term_of]
        for low, high in self.rounds:                  # every node once, from earlier ones
            a, b = self.plan.adds[low:high].T
            nodes[self.symbols + low:self.symbols + high] = nodes[a] + nodes[b]
        out = np.zeros((len(self.plan.item_ids), len(lengths)), np.int64)
        if len(self.full):
            # in steps, so that no more rows are gathered than there are nodes
            ends = np.append(self.first, len(self.plan.sums))
            for i in self.full.tolist():
                out[i] = nodes[self.plan.sums[ends[i]:ends[i + 1], 1]].sum(0)
        return out


class Best:
    """The k best (score, doc_id) of every item: highest score, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.zeros(items, np.int64)         # a score must be above 0
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(items)]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        hit = (scores > 0) & (scores >= self.floor[:, None])
        for i in np.flatnonzero(hit.any(1)).tolist():
            own = np.flatnonzero(hit[i])
            s, d = np.concatenate([self.held[i][0], scores[i, own]]), np.concatenate([self.held[i][1], ids[own]])
            order = np.lexsort((d, -s))[:self.k]
            self.held[i] = s[order], d[order]
            if len(order) == self.k:
                self.floor[i] = s[order[-1]]


# ---- Spark side ------------------------------------------------------------

COUNTED = "doc_id long, n long, terms binary, counts binary"


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: its number of terms and the counts of the vocabulary's
    terms in it (32-bit numbers). Documents without a term are left out."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = sent.value.get
        for b in batches:
            n, ids, counts, keep = [], [], [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                own = terms(text)
                if own:
                    found = Counter(map(number, own))
                    found.pop(None, None)
                    keep.append(k)
                    n.append(len(own))
                    ids.append(np.fromiter(found.keys(), np.uint32, len(found)).tobytes())
                    counts.append(np.fromiter(found.values(), np.uint32, len(found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int32())), pa.array(n, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COUNTED)


def document_counts(rows: DataFrame) -> DataFrame:
    """(term, df) over ``counted`` rows: summed in every task, then over tasks."""
    def run(batches):
        seen = np.zeros(0, np.int64)
        for b in batches:
            own = np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), np.uint32), minlength=len(seen))
            own[:len(seen)] += seen
            seen = own
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["term", "df"])

    return rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def searched(rows: DataFrame, plan: Plan, k: int) -> DataFrame:
    """item_id, doc_id, score: the k best of every item in every task."""
    facts = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = facts["docs"], facts["terms"] or 0
    weights = np.zeros(len(plan.vocabulary), np.int64)
    for r in document_counts(rows).collect():          # at most one row a term of the block
        weights[r["term"]] = weight(n_docs, r["df"])
    sent = rows.sparkSession.sparkContext.broadcast(Scorer(plan, weights, n_docs, n_terms))

    def run(batches):
        scorer = sent.value
        best = Best(len(plan_ids := scorer.plan.item_ids), k)
        step = max(16, CELLS // (scorer.symbols + len(scorer.plan.adds) + len(plan_ids) + 1))
        for b in batches:
            ids = np.array([LAST if i is None else i for i in b.column("doc_id").to_pylist()], np.int64)
            lengths = b.column("n").to_numpy()
            own, counts = b.column("terms").to_pylist(), b.column("counts").to_pylist()
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                sizes = [len(x) // 4 for x in own[part]]
                scores = scorer.scores(
                    lengths[part], np.repeat(np.arange(len(sizes)), sizes),
                    np.frombuffer(b"".join(own[part]), np.uint32).astype(np.int64),
                    np.frombuffer(b"".join(counts[part]), np.uint32).astype(np.int64))
                best.add(scores, ids[part])
        for i, (s, d) in zip(plan_ids.tolist(), best.held):
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(s), pa.int64()), pa.array([None if x == LAST else x for x in d.tolist()], pa.int64()),
                     pa.array(s, pa.int64())], ["item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def blocks_of(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """One row an item id with the number of its block, and the blocks."""
    own = (items.where("item_id IS NOT NULL").groupBy(F.col("item_id").cast("long").alias("item_id"))
           .agg(F.min("text").alias("text")).withColumn("chars", F.coalesce(F.length("text"), F.lit(0)).cast("long") + 1))
    placed = running_total(own, [F.col("item_id")], "chars", "items")
    placed = placed.withColumn("block", F.floor(F.col("before") / BLOCK_CHARS)).drop("before")
    return placed, sorted(r["block"] for r in placed.select("block").distinct().collect())


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    placed, blocks = blocks_of(items)
    found = None
    for block in blocks:
        own = placed.where(F.col("block") == block).select("item_id", "text").collect()
        plan = Plan({r["item_id"]: terms(r["text"]) for r in own})
        rows = materialize(counted(docs, plan.vocabulary), "counted")
        part = searched(rows, plan, k)
        if len(blocks) > 1:
            part = materialize(part, "found")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], OUT)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
