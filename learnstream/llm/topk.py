"""Operator 4: exact top-k inner products by pivot-table elimination.

A vector becomes integers, floor(256 x). With M the largest norm, a candidate
x gets one more coordinate sqrt(M^2 - |x|^2) and a query q a zero, which turns
the inner product into a Euclidean distance:
d(q, x)^2 = |q|^2 + M^2 - 2 q.x. For pivots p, |d(q, p) - d(x, p)| is a lower
bound of d(q, x), so an upper bound of the score.

1. Candidates are dealt by nearest pivot into blocks that carry their ids,
   vectors and distances to all pivots (the pivot table), written once.
2. Queries are taken in blocks of a fixed size, small enough to send to every
   task. First each query's k-th best score over a bounded sample gives a
   floor under its k-th best score.
3. A task takes the candidate blocks; for each query the blocks are ordered by
   the bound of their ranges, in a block the candidates by their own bound,
   and evaluation stops at the first bound below the k-th best score so far.
   The k best of a query in every task are merged by (score, id).

Pivots come from a bounded sample (``SAMPLE`` rows, farthest first); which ones
they are changes the work, never the result.

Vectors that are null or hold a null, NaN or infinite component take no part.
A shorter vector counts as filled up with zeros. Ties go to the smaller
vec_id. Candidates are all rows with another id than the query's; repeated
rows of a query's id are one query, answered once, repeated rows of a
candidate each count. A null vec_id takes no part. Components beyond 2^20 in
integers are computed in Python integers; scores beyond a long end at its
limits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, materialize

K = 5
EVERY = 50               # queries: vec_id divisible by this
SCALE = 256
PIVOTS = 16
SAMPLE = 2000            # rows that pivots and first floors come from, at most
QUERY_BLOCK = 4096       # queries sent to the tasks at once
BLOCK_ROWS = 2048
SAFE = 1 << 20           # components up to this give exact products in doubles

OUT = "query_id long, rank int, vec_id long, score long"


def integers(vector: Column) -> Column:
    """floor(SCALE * x) of every component as double (whole numbers)."""
    return F.transform(vector, lambda x: _floor(x.cast("double") * SCALE))


def _floor(x: Column) -> Column:
    """floor that stays a double, so that huge components survive."""
    return F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and integer vector (as doubles) of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.where(v.isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.col("vec_id").cast("long"), integers(v).alias("v")))


def matrix(rows, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of one integer vector with many."""
    if max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) <= SAFE and len(q) <= 1 << 12:
        return (x @ q).astype(np.int64)
    own = [int(a) for a in q]
    exact = (sum(a * int(b) for a, b in zip(own, row)) for row in x)
    return np.array([min(max(s, -2 ** 63), 2 ** 63 - 1) for s in exact], np.int64)


def distances(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, pivot_lift: np.ndarray) -> np.ndarray:
    square = ((x ** 2).sum(1) + lift ** 2)[:, None] + ((pivots ** 2).sum(1) + pivot_lift ** 2)[None]
    return np.sqrt(np.maximum(square - 2 * (x @ pivots.T) - 2 * lift[:, None] * pivot_lift[None], 0))


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """Rows of x, each the farthest from those before."""
    chosen, near = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


class Best:
    """The k best (score, id) of a query: highest score, then smallest id."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        own = np.lexsort((i, -s))[:self.k]
        self.scores, self.ids = s[own], i[own]
        if len(own) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def search_block(best: Best, q, q_id, dq, limit, ids, x, table) -> None:
    """Candidates of a block in the order of their bounds, in growing steps,
    until a bound lies below the floor. ``limit(lower)`` is the score bound."""
    bound = limit(np.abs(table - dq).max(1))
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] >= best.floor]
    at, step = 0, 4 * best.k
    while at < len(order) and bound[order[at]] >= best.floor:
        own = order[at:at + step]
        own = own[(bound[own] >= best.floor) & (ids[own] != q_id)]
        if len(own):
            best.add(products(q, x[own]), ids[own])
        at, step = at + step, step * 4


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = materialize(usable(vectors).withColumn(
        "norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), "vectors")
    facts = rows.agg(F.max("norm").alias("m"), F.max(F.size("v")).alias("dim")).first()
    top, dim = facts["m"] or 0.0, max(facts["dim"] or 0, 1)
    draw = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vec_id", "v").limit(SAMPLE).collect()
    if not draw:
        return spark.createDataFrame([], OUT)
    sample_ids = np.array([r["vec_id"] for r in draw], np.int64)
    sample = matrix([r["v"] for r in draw], dim)
    lift = lambda x: np.sqrt(np.maximum(top - (x ** 2).sum(1), 0))
    lifted = farthest_first(np.hstack([sample, lift(sample)[:, None]]), PIVOTS)
    pivots, pivot_lift = lifted[:, :-1], lifted[:, -1]

    def block(frames):
        """Rows of a task in blocks of one nearest pivot each."""
        held: dict[int, list] = {}

        def out(cell):
            own = pd.concat(held.pop(cell))
            x = matrix(own["v"].tolist(), dim)
            return pd.DataFrame({"ids": [own["vec_id"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()],
                                 "d": [distances(x, lift(x), pivots, pivot_lift).tobytes()]})

        for df in frames:
            if len(df):
                x = matrix(df["v"].tolist(), dim)
                df = df.assign(cell=distances(x, lift(x), pivots, pivot_lift).argmin(1))
                for cell, own in df.groupby("cell"):
                    held.setdefault(cell, []).append(own)
                    if sum(map(len, held[cell])) >= BLOCK_ROWS:
                        yield out(cell)
        for cell in list(held):
            yield out(cell)

    blocks = materialize(rows.select("vec_id", "v").mapInPandas(block, "ids binary, x binary, d binary"), "pivot-table")
    # one vector a query id, the least one, before any come to the driver
    asked = materialize(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    # runs of ids in order, put together to blocks of at most QUERY_BLOCK
    runs = (asked.select("vec_id").distinct().sort("vec_id")
            .mapInPandas(_runs_of(QUERY_BLOCK // 4), "first long, n long"))
    starts, room = [], 0
    for r in sorted(runs.collect()):
        if r["n"] > room:
            starts.append(r["first"])
            room = QUERY_BLOCK
        room -= r["n"]
    merged = None
    for at, first in enumerate(starts):
        group = asked.where(F.col("vec_id") >= first)
        if at + 1 < len(starts):
            group = group.where(F.col("vec_id") < starts[at + 1])
        own = {r["vec_id"]: r["v"] for r in group.collect()}
        q_ids = np.array(sorted(own), np.int64)
        q = matrix([own[i] for i in q_ids.tolist()], dim)
        part = _answer(blocks, q_ids, q, pivots, pivot_lift, top, sample_ids, sample, k, dim)
        if len(starts) > 1:
            part = materialize(part, "answers")
        merged = part if merged is None else merged.union(part)
    return merged if merged is not None else spark.createDataFrame([], OUT)


def _runs_of(n: int):
    """(first id, how many) of runs of at most ``n`` sorted ids of a task."""
    def run(frames):
        ids = [i for df in frames for i in df["vec_id"].tolist()]
        yield pd.DataFrame({"first": ids[::n], "n": [len(ids[k:k + n]) for k in range(0, len(ids), n)]}).astype("int64")
    return run


def _answer(blocks, q_ids, q, pivots, pivot_lift, top, sample_ids, sample, k, dim) -> DataFrame:
    sc = blocks.sparkSession.sparkContext
    dq = distances(q, np.zeros(len(q)), pivots, pivot_lift)
    norm = (q ** 2).sum(1)
    floors = np.full(len(q), -2 ** 63, np.int64)
    for i in range(len(q)):
        s = products(q[i], sample[sample_ids != q_ids[i]])
        if len(s) >= k:
            floors[i] = np.partition(s, len(s) - k)[len(s) - k]
    sent = sc.broadcast((q_ids, q, dq, norm, floors))

    def search(frames):
        q_ids, q, dq, norm, floors = sent.value
        best = [Best(k, int(f)) for f in floors]
        for df in frames:
            held = [(np.frombuffer(r.ids, np.int64), np.frombuffer(r.x).reshape(-1, dim),
                     np.frombuffer(r.d).reshape(-1, len(pivots))) for r in df.itertuples()]
            if not held:
                continue
            low = np.array([d.min(0) for _, _, d in held])
            high = np.array([d.max(0) for _, _, d in held])
            for i in range(len(q)):
                def limit(lower, i=i):
                    # rounding of the distances is covered by the slack
                    return (norm[i] + top - lower ** 2) / 2 + 1e-6 * (norm[i] + top) + 1
                bound = limit(np.maximum(np.maximum(low - dq[i], dq[i] - high), 0).max(1))
                for b in np.argsort(-bound, kind="stable"):
                    if bound[b] < best[i].floor:
                        break
                    search_block(best[i], q[i], q_ids[i], dq[i], limit, *held[b])
        for i, b in enumerate(best):
            if len(b.ids):
                yield pd.DataFrame({"query_id": q_ids[i], "vec_id": b.ids, "score": b.scores})

    found = blocks.mapInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
