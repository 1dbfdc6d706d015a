"""Operator 11: n-gram Jaccard join by a token-group matrix.

A document's set is that of its distinct word shingles. Two documents link when
``100 * intersection >= share * union``; a document's component is the
smallest id it reaches over links.

1. Sets are cut into parts by the hash of their tokens. Sets that link differ
   in at most ``(100 - share) / (100 + share)`` of their summed sizes, so of
   more parts than that number some are the same in both. Every part
   has a signature; the number of parts is that of the pair's larger size class (a
   set close below a class takes part in it, too). Sets that share fewer signatures than a
   link leaves are no candidates: no link is lost, and a passage that many documents share
   fills a whole part by chance only.
2. Candidates are partitioned into groups: a document goes to the document it shares
   most signatures with, among those that are the smallest of a signature; large groups
   are split. The matrix has one row a group: its members and the union of their
   tokens (of 32 bits each: a collision can only raise a bound).
3. A group is opened to its own members first. Then the groups of a
   signature query the group of its smallest member, and those of
   signatures that are still in several components query each other. A query
   set meets a group's union first: it has no link in the group if the overlap is below
   ``share`` of 100 of its size, and only a qualifying group is opened: the
   overlaps with all its members are counted at once, on full sets.
4. Components over all links, carried back to the documents.

Links are exact up to collisions of 64-bit hashes of shingles, parts and sets. Links
inside a component found before are not looked for, so a large group of near
copies needs few comparisons; documents of a large group of which no link is found are
compared group by group.

Nulls: a null text, and one without words, has an empty set and no links; its
component is its own id. A null id is never the smallest; a component of null ids
only has none. Repeated rows are equal sets. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, materialize, per_batch, release, text_groups
from learnstream.llm.neardup import components
from learnstream.llm.shingles import PLACES, mix, shingle_set

SHINGLE = 3
SHARE, OF = 90, 100
SPARE = 2                # parts more than a link needs (and an eighth): so links share several
GROUP = 128              # members of a group, about, at most
GROUP_TOKENS = 1 << 20   # summed sizes of a group's sets, about, at most
QUERIES = 512            # query documents that meet a group in one task, about


# ---- signatures of parts -------------------------------------------------------

def most_different(a: int, b: int, share: int) -> int:
    """Tokens in one of two linked sets of these sizes only, at most."""
    return (OF - share) * (a + b) // (OF + share)


def classes(size: int, share: int):
    """(class, parts, need) of every size class in which a set of ``size`` may meet one as
    large or larger; a class reaches from c to about 1.5 c. Sets of the class that link
    differ in so few tokens that they have ``need`` parts or more in common."""
    low, k = 1, 0
    while share * low <= OF * size:
        high = max(low + 1, low * 3 // 2)
        if size < high:
            d = most_different(high - 1, high - 1, share)
            if d:        # sets that may not differ are equal: one node
                parts = d + 1 + SPARE + d // 8
                yield k, parts, parts - most_different(size, min(OF * size // share, high - 1), share)
        low, k = high, k + 1


def signatures(tokens: np.ndarray, share: int) -> tuple[np.ndarray, int]:
    """64-bit signatures of the parts of a sorted set, and how many of them a set that links with it
    has at least. Empty parts are left out (and not counted) as long as one is left."""
    total = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mix(tokens + PLACES[3]), out=total[1:])
    high = tokens >> np.uint64(32)
    out, least = [np.zeros(0, np.uint64)], None
    for k, parts, need in classes(len(tokens), share):
        edge = np.searchsorted((high * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1))
        held = total[edge[1:]] - total[edge[:-1]]
        place = np.arange(1, parts + 1, dtype=np.uint64) * PLACES[1]
        level = np.full(parts, k + 1, np.uint64) * PLACES[2]
        filled = edge[1:] > edge[:-1]
        need -= int((~filled).sum())
        if need < 1:
            filled[:], need = True, 1
        out.append(mix(held * PLACES[0] + place + level)[filled])
        least = need if least is None else min(least, need)
    return np.concatenate(out), least or 0


SKETCH = ("row long, doc_id long, n_shingles long, node long, need int, "
          "sigs binary, also binary, firsts binary, packed binary")


def sketches(docs: DataFrame, share: int) -> DataFrame:
    """One row per document: its set's size and 64-bit hash (``node``; null if empty). The first of
    equal sets of a batch has its compressed text, the number of signatures that a link shares at least
    (``need``) and ``sigs``, the signatures that no document before it in the batch has; those that one
    has are in ``also``, with that one's node in ``firsts``. So a batch gives one posting a signature,
    however many near copies it holds."""
    bound_batches(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        row, zstd = TaskContext.get().partitionId() << 40, zstandard.ZstdCompressor(level=3)
        for b in batches:
            for at, texts in text_groups([t or "" for t in b.column(1).to_pylist()]):
                k = len(texts)
                sets = [shingle_set(t, SHINGLE) for t in texts]
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else 0 for s in sets], np.uint64)
                _, first = np.unique(nodes, return_index=True)
                first = [i for i in np.sort(first).tolist() if len(sets[i])]
                own = {i: signatures(sets[i], share) for i in first}
                of = np.repeat(np.array(first, np.int64), [len(own[i][0]) for i in first])
                sigs = np.concatenate([*(x for x, _ in own.values()), np.zeros(0, np.uint64)])
                _, lead, which = np.unique(sigs, return_index=True, return_inverse=True)
                pivot = of[lead[which]] if len(sigs) else of
                columns = {"sigs": [None] * k, "also": [None] * k, "firsts": [None] * k, "packed": [None] * k}
                ends = np.searchsorted(of, np.arange(k + 1))
                for i in first:
                    part = slice(ends[i], ends[i + 1])
                    new = pivot[part] == i
                    columns["sigs"][i] = sigs[part][new].tobytes()
                    columns["also"][i] = sigs[part][~new].tobytes()
                    columns["firsts"][i] = nodes[pivot[part][~new]].tobytes()
                    columns["packed"][i] = zstd.compress(texts[i].encode("utf-8", "surrogatepass"))
                empty = np.array([not len(s) for s in sets], bool)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(row, row + k), pa.int64()), b.column(0).slice(at, k),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes.view(np.int64), mask=empty),
                    pa.array([own[i][1] if i in own else None for i in range(k)], pa.int32()),
                    *[pa.array(c, pa.binary()) for c in columns.values()]],
                    ["row", "doc_id", "n_shingles", "node", "need", *columns])
                row += k

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SKETCH)


def _postings(name: str):
    """(sig, node) rows of a column of signatures; of ``also``, those of the first documents as well."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        held = b.column(name).to_pylist()
        sigs = np.frombuffer(b"".join(held), np.int64)
        nodes = np.repeat(b.column("node").to_numpy(), [len(x) // 8 for x in held])
        if name == "also":
            firsts = np.frombuffer(b"".join(b.column("firsts").to_pylist()), np.int64)
            sigs, nodes = np.concatenate([sigs, sigs]), np.concatenate([nodes, firsts])
        return pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(nodes)], ["sig", "node"])
    return per_batch(run)


def members(sk: DataFrame) -> DataFrame:
    """(sig, node) of all signatures that different sets share. Of a batch of documents a
    signature has one row here, so the rows of one signature are few; they are dealt once."""
    own = sk.where("sigs IS NOT NULL")
    posted = own.select("node", "sigs").mapInArrow(_postings("sigs"), "sig long, node long")
    w = Window.partitionBy("sig")
    shared = (posted.withColumn("lo", F.min("node").over(w)).withColumn("hi", F.max("node").over(w))
              .where("lo != hi").select("sig", "node"))
    near = own.where(F.length("also") > 0).select("node", "also", "firsts").mapInArrow(
        _postings("also"), "sig long, node long")
    return shared.union(near).distinct()


def pruned(member: DataFrame, first: DataFrame) -> DataFrame:
    """The members that can have a link: a set that shares fewer signatures than one
    needs has none, and a signature of one set left is not shared any more."""
    for _ in range(2):
        own = materialize(member.groupBy("node").agg(F.count("sig").alias("n")).join(first, "node")
                          .where("n >= need").select("node"), "alive")
        member = materialize(member.join(own, "node"), "members-left")
        alive = materialize(member.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
                            .where("lo != hi").select("sig"), "shared")
        member = materialize(member.join(alive, "sig"), "members-left")
    return member


# ---- groups and their unions -----------------------------------------------------

def unpacked(packed) -> list[np.ndarray]:
    zstd = zstandard.ZstdDecompressor()
    return [shingle_set(zstd.decompress(p).decode("utf-8", "surrogatepass"), SHINGLE) for p in packed]


def short(tokens: np.ndarray) -> np.ndarray:
    """Tokens as they are in a group's union."""
    return np.unique((tokens >> np.uint64(32)).astype(np.uint32))


class Opened:
    """The members of a group by token: overlaps of a query set with all of them at once."""

    def __init__(self, nodes: np.ndarray, sets: list[np.ndarray]):
        self.nodes, self.sizes = nodes, np.array([len(s) for s in sets], np.int64)
        tokens, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.of = of[order]
        self.tokens, first = np.unique(tokens[order], return_index=True)
        self.edge = np.append(first, len(order))

    def links(self, x: np.ndarray, share: int) -> np.ndarray:
        """Places of the members that link with the set ``x``."""
        at = np.searchsorted(self.tokens, x)
        at = at[(at < len(self.tokens)) & (self.tokens[np.minimum(at, len(self.tokens) - 1)] == x)]
        n = self.edge[at + 1] - self.edge[at]
        rows = np.repeat(self.edge[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.of[rows], minlength=len(self.sizes))
        return np.flatnonzero(OF * both >= share * (len(x) + self.sizes - both))


class Joined:
    """Links found in a task, only those that join what no link joined before."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.found: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def add(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[x] = y
            self.found.append((a, b))


def _group_row(pdf: pd.DataFrame, share: int) -> pd.DataFrame:
    """The matrix row of a group, and the links among its members."""
    pdf = pdf.sort_values("node")
    nodes, sets = pdf["node"].to_numpy(), unpacked(pdf["packed"])
    joined = Joined()
    if len(nodes) > 1:
        opened = Opened(nodes, sets)
        for k, s in enumerate(sets):
            for j in opened.links(s, share).tolist():
                joined.add(int(nodes[k]), int(nodes[j]))
    links = np.array(joined.found, np.int64).reshape(-1, 2)
    return pd.DataFrame({"group": [pdf["group"].iloc[0]], "n": [len(nodes)], "nodes": [nodes.tolist()],
                         "packed": [pdf["packed"].tolist()], "tokens": [short(np.concatenate(sets)).tobytes()],
                         "links": [[{"a": a, "b": b} for a, b in links.tolist()]]})


MATRIX = ("group long, n int, nodes array<long>, packed array<binary>, tokens binary, "
          "links array<struct<a:long,b:long>>")


def qualifies(x: np.ndarray, union: np.ndarray, share: int) -> bool:
    """Whether a set may link with a member of a group: whether its overlap
    with the group's union is no smaller than that of a link."""
    own = (x >> np.uint64(32)).astype(np.uint32)
    at = np.minimum(np.searchsorted(union, own), len(union) - 1)
    return OF * int((union[at] == own).sum()) >= share * len(x)


def _open(pdf: pd.DataFrame, share: int) -> pd.DataFrame:
    """Query groups against one group: the bound first, then the members."""
    target = pdf[pdf["target"]].iloc[0]
    union = np.frombuffer(target["tokens"], np.uint32)
    opened, joined = None, Joined()
    for q in pdf[~pdf["target"]].itertuples():
        for node, x in zip(q.nodes.tolist(), unpacked(q.packed)):
            if qualifies(x, union, share):
                if opened is None:
                    opened = Opened(np.asarray(target["nodes"]), unpacked(target["packed"]))
                for j in opened.links(x, share).tolist():
                    joined.add(int(node), int(opened.nodes[j]))
    return pd.DataFrame(joined.found, columns=["a", "b"]).astype("int64")


def grouped(sk: DataFrame, first: DataFrame, member: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """(node, group, need) and the matrix of all candidates."""
    pivots = materialize(member.groupBy("sig").agg(F.min("node").alias("pivot")), "pivots")
    votes = member.join(pivots, "sig").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n"))
    lead = votes.groupBy("node").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("lead"))
    own = materialize(lead.join(first, "node"), "leads")
    size = own.groupBy("lead").agg(F.greatest(
        F.ceil(F.count("node") / GROUP), F.ceil(F.sum("n_shingles") / GROUP_TOKENS)).alias("parts"))
    own = materialize(own.join(size, "lead").select("node", "row", "need", F.xxhash64(
        "lead", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("group")), "group-of")
    # a merge join at every size: the compressed texts are dealt once
    texts = sk.select("row", "packed").join(own.hint("merge"), "row").select("node", "group", "packed")
    matrix = materialize(texts.groupBy("group").applyInPandas(lambda pdf: _group_row(pdf, share), MATRIX), "matrix")
    return own.select("node", "group", "need"), matrix


def opened(pairs: DataFrame, matrix: DataFrame, share: int) -> DataFrame:
    """Links (a, b) of the pairs (query group, target group)."""
    sizes = matrix.select(F.col("group").alias("query"), "n")
    pairs = materialize(pairs.join(sizes, "query"), "group-pairs")
    chunks = pairs.groupBy("of").agg(F.ceil(F.sum("n") / QUERIES).alias("chunks"))
    dealt = materialize(pairs.join(chunks, "of").select(
        "of", "query", F.pmod(F.xxhash64("query"), F.col("chunks")).alias("chunk")), "dealt-groups")
    blobs = matrix.select("group", "nodes", "packed", "tokens")
    queries = dealt.join(blobs.drop("tokens"), F.col("query") == F.col("group")).select(
        "of", "chunk", F.lit(False).alias("target"), "nodes", "packed", F.lit(None).cast("binary").alias("tokens"))
    targets = dealt.select("of", "chunk").distinct().join(blobs, F.col("of") == F.col("group")).select(
        "of", "chunk", F.lit(True).alias("target"), "nodes", "packed", "tokens")
    return queries.union(targets).groupBy("of", "chunk").applyInPandas(
        lambda pdf: _open(pdf, share), "a long, b long")


def links_of(sk: DataFrame, share: int) -> DataFrame:
    """(node, root) of every set with a link."""
    spark = sk.sparkSession
    first = materialize(sk.where("sigs IS NOT NULL").groupBy("node").agg(
        F.min("row").alias("row"), F.max("n_shingles").alias("n_shingles"), F.max("need").alias("need")), "nodes")
    member = pruned(materialize(members(sk), "members"), first)
    group, matrix = grouped(sk, first, member, share)
    inner = materialize(matrix.select(F.inline("links")), "inner-links")
    root = components(inner, "roots")

    def labelled(root: DataFrame) -> DataFrame:
        out = member.join(group.drop("need"), "node").join(root, "node", "left")
        out = materialize(out.select("sig", "node", "group", F.coalesce("root", "node").alias("root")), "labelled")
        mixed = materialize(out.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                                   F.min(F.struct("node", "group")).alias("first"))
                            .where("lo != hi").select("sig", F.col("first.group").alias("pivot")), "mixed")
        return materialize(out.join(mixed, "sig"), "mixed-members")

    # every group of a signature queries that of its smallest member
    left = labelled(root)
    star = materialize(left.where("group != pivot").select(
        F.greatest("group", "pivot").alias("query"), F.least("group", "pivot").alias("of")).distinct(), "star")
    outer = materialize(opened(star, matrix, share), "star-links")
    links = inner.union(outer)
    root = components(links, "roots")
    release(spark, left)

    # what is still in several components queries all groups it shares enough signatures with
    left = labelled(root).groupBy("sig", "group").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    left = materialize(left, "mixed-groups")
    a = left.select("sig", F.col("group").alias("query"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
    b = left.select("sig", F.col("group").alias("of"), "lo", "hi")
    pairs = a.join(b, "sig").where("query > of AND NOT (lo_a = hi_a AND lo = hi AND lo_a = lo)")
    pairs = materialize(pairs.groupBy("query", "of").agg(F.count("sig").alias("shared")), "pairs")
    need = materialize(group.groupBy("group").agg(F.min("need").alias("need")), "needs")
    for side in ("query", "of"):
        pairs = pairs.join(need.withColumnRenamed("group", side), side).where("shared >= need").drop("need")
    pairs = pairs.select("query", "of").join(star, ["query", "of"], "left_anti")
    more = materialize(opened(pairs, matrix, share), "more-links")
    return components(links.union(more), "final")


def join(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id; one row per document."""
    sk = materialize(sketches(docs, share), "sketch")
    root = links_of(sk, share)
    ids = sk.select("doc_id", "n_shingles", "node")
    placed = materialize(ids.where("n_shingles > 0").join(root, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "node").alias("root")), "placed")
    least = materialize(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    found = placed.join(least, "root").select("doc_id", "n_shingles", "component_id")
    alone = ids.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.union(alone)
