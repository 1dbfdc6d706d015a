"""Operator 3: near-duplicate documents by HyperMinHash sketches.

A document's set is that of its distinct word shingles. Documents whose sets
have ``100 * intersection >= 85 * union`` are linked (the pipeline: 80); a
document's component is the smallest id it reaches over links.
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
from learnstream.llm.shingles import mix, shingle_set

SHINGLE = 5
SHARE, OF = 85, 100          # linked: OF * intersection >= SHARE * union
REGISTERS, ROWS = 256, 6     # 42 bands of 6 registers; those left over are only estimated with
MANTISSA = 10                # bits kept behind the leading one of a bucket's minimum
PROBES = 4096


def _probe_table() -> np.ndarray:
    at = np.arange(PROBES * REGISTERS, dtype=np.uint64)
    return (mix(at + np.uint64(1)) >> np.uint64(56)).astype(np.uint8).reshape(PROBES, REGISTERS)


PROBE = _probe_table()


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers, one row per non-empty set: of every bucket
    (top 8 bits of the hash) the smallest rest as leading zeros and mantissa.
    An empty bucket takes the register of the first filled one among the
    buckets that a fixed sequence names for it, so that every register agrees
    with the probability of the sets' similarity, for small sets too."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    filled = np.zeros((len(sets), REGISTERS), bool)
    for k, s in enumerate(sets):
        bucket = (s >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = (s[first] << np.uint64(8)) >> np.uint64(8)
        # frexp is exact enough: 10 bits are kept of 53
        part, power = np.frexp(rest.astype(np.float64) + 1)
        value = (56 - power.clip(0, 56)) * (1 << MANTISSA) + ((part * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
        out[k, bucket[first]] = value + 1
        filled[k, bucket[first]] = True
    row, col = np.nonzero(~filled)
    for probe in PROBE:
        if not len(row):
            break
        got = filled[row, probe[col]]
        out[row[got], col[got]] = out[row[got], probe[col[got]]]
        row, col = row[~got], col[~got]
    for r, c in zip(row, col):
        out[r, c] = out[r, np.flatnonzero(filled[r])[0]]
    return out


def band_keys(regs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` registers and row of ``registers``."""
    bands = REGISTERS // rows
    part = regs[:, :bands * rows].reshape(len(regs), bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)[None, :] + np.zeros((len(regs), 1), np.uint64)
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
    return key


# ---- Spark side ------------------------------------------------------------

SLACK = 6            # standard errors below the threshold at which an estimate rules a pair out
CHUNK = 128          # documents compared with a pivot in one group
BLOCK = 512          # documents of one block of a group that is compared in blocks
#: Two different minima of a bucket share 10 mantissa bits and a zero count so often.
COLLISION = 1 / 3 / (1 << MANTISSA)


def estimate_min(share: int) -> float:
    return share / OF - SLACK * (share / OF * (1 - share / OF) / REGISTERS) ** 0.5


SKETCH = "row long, doc_id long, mark long, n_shingles long, node long, registers binary, packed binary"


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document, under a row number of its own: a hash of the text
    (mark), its set's size and 64-bit hash (node; null if empty); the first of equal
    sets of a batch has the registers and the compressed text."""
    bound_batches(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        row, zstd = TaskContext.get().partitionId() << 40, zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = b.column(1).to_pylist()
            for at, group in text_groups([t or "" for t in texts]):
                sets = [shingle_set(t, SHINGLE) for t in group]
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
                k = len(group)
                empty = np.array([not len(s) for s in sets], bool)
                first = np.zeros(k, bool)
                first[np.unique(nodes, return_index=True)[1]] = True
                first &= ~empty
                regs = iter(registers([s for s, own in zip(sets, first) if own]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(row, row + k), pa.int64()), b.column(0).slice(at, k), b.column(2).slice(at, k),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes.view(np.int64), mask=empty),
                    pa.array([next(regs).tobytes() if own else None for own in first], pa.binary()),
                    pa.array([zstd.compress(t.encode("utf-8", "surrogatepass")) if own else None
                              for t, own in zip(group, first)], pa.binary())],
                    ["row", "doc_id", "mark", "n_shingles", "node", "registers", "packed"])
                row += k

    own = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    return own.mapInArrow(run, SKETCH)


def _keys_of(b: pa.RecordBatch, rows: int) -> pa.RecordBatch:
    """(key, node, posted): one posted row a key, that of its first node in the
    batch; a key of several nodes has its other rows, and its first one again, unposted."""
    regs = np.frombuffer(b"".join(b.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    keys = band_keys(regs, rows)
    nodes = np.repeat(b.column("node").to_numpy(), keys.shape[1])
    own, first, which, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    several = np.flatnonzero(n[which.ravel()] > 1)
    key = np.concatenate([own, keys.ravel()[several]])
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(np.concatenate([nodes[first], nodes[several]])),
         pa.array(np.arange(len(key)) < len(own))], ["key", "node", "posted"])


def buckets(sk: DataFrame, rows: int) -> DataFrame:
    """(key, node) of all band keys that different nodes share. A batch posts a key once, so the rows of
    one key are few where they meet; they are dealt once."""
    keys = sk.where("registers IS NOT NULL").select("node", "registers").mapInArrow(
        per_batch(lambda b: _keys_of(b, rows)), "key long, node long, posted boolean")
    keys = materialize(keys, "bands")
    w = Window.partitionBy("key")
    shared = (keys.where("posted").withColumn("lo", F.min("node").over(w)).withColumn("hi", F.max("node").over(w))
              .where("lo != hi").select("key", "node"))
    out = materialize(shared.union(keys.where("NOT posted").select("key", "node")).distinct(), "buckets")
    release(sk.sparkSession, keys)
    return out


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b); nodes of a component
    share a root. Each round hangs every node on its smallest neighbour, takes
    one step up from there, and contracts the edges, so that only edges between
    different parts go on; a star is done in two rounds, a chain shrinks at
    least by half. Tables of a round are written to the shared folder."""
    spark = edges.sparkSession
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    left = materialize(edges.select(low, high).where("a != b").distinct(), name)
    roots = None
    while roots is None or left.limit(1).count():
        both = left.union(left.select(F.col("b"), F.col("a")))
        up = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("up")), name)
        far = up.select(F.col("node").alias("up"), F.col("up").alias("root"))
        up = materialize(up.join(far, "up").select("node", "root"), name)
        step = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = up if roots is None else materialize(
            roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), name)
        a = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = left.join(a, "a").join(b, "b").where("ra != rb")
        rest = materialize(rest.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), name)
        release(spark, left)
        roots, left = moved, rest
    return roots


def similar(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    """The exact test on two sorted sets."""
    if OF * min(len(a), len(b)) < share * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= share * (len(a) + len(b) - both)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Jaccard estimates of one register row against many, corrected for
    registers that agree by chance."""
    same = (many == one).mean(1)
    return (same - COLLISION) / (1 - COLLISION)


def unpacked_sets(packed) -> list[np.ndarray]:
    zstd = zstandard.ZstdDecompressor()
    return [shingle_set(zstd.decompress(p).decode("utf-8", "surrogatepass"), SHINGLE) for p in packed]


def _near_pivot(pdf: pd.DataFrame, share: int) -> pd.DataFrame:
    """Nodes of a chunk whose registers say that they may link with the pivot."""
    nodes = pdf["node"].to_numpy()
    regs = np.frombuffer(b"".join(pdf["registers"]), np.uint16).reshape(-1, REGISTERS)
    at = int(np.flatnonzero(nodes == pdf["pivot"].iloc[0])[0])
    near = (estimate(regs[at], regs) >= estimate_min(share)) & (nodes != nodes[at])
    return pd.DataFrame({"pivot": nodes[at], "node": nodes[near]})


def _against_pivot(pdf: pd.DataFrame, share: int) -> pd.DataFrame:
    sets, nodes = unpacked_sets(pdf["packed"]), pdf["node"].to_numpy()
    at = int(np.flatnonzero(nodes == pdf["pivot"].iloc[0])[0])
    hit = [k for k in range(len(nodes)) if k != at and similar(sets[at], sets[k], share)]
    return pd.DataFrame({"a": nodes[at], "b": nodes[hit]})


def in_chunks(star: DataFrame, rows: DataFrame) -> DataFrame:
    """(pivot, chunk, node, ...) of stars (pivot, node): a chunk has some nodes of a
    pivot and the pivot, with their ``rows``."""
    chunks = materialize(star.groupBy("pivot").agg(F.ceil(F.count("node") / CHUNK).alias("chunks")), "chunks")
    dealt = materialize(star.join(chunks, "pivot").select(
        "pivot", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"), "node"), "dealt")
    return dealt.union(dealt.select("pivot", "chunk", F.col("pivot").alias("node")).distinct()).join(rows, "node")


def _in_blocks(pdf: pd.DataFrame, share: int) -> pd.DataFrame:
    """Links of two blocks of a group (or within one) that join components
    not yet joined here."""
    nodes, roots, side = (pdf[c].to_numpy() for c in ("node", "root", "side"))
    sets = unpacked_sets(pdf["packed"])
    regs = registers(sets)
    parent = {r: r for r in roots.tolist()}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    left = np.flatnonzero(side == 0)
    others = np.flatnonzero(side == 1)
    for k, at in enumerate(left):
        rest = others if len(others) else left[k + 1:]
        rest = rest[roots[rest] != roots[at]]
        if len(rest):
            for j in rest[estimate(regs[at], regs[rest]) >= estimate_min(share)]:
                a, b = find(roots[at]), find(roots[j])
                if a != b and similar(sets[at], sets[j], share):
                    parent[a] = b
                    out.append((nodes[at], nodes[j]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def near_duplicates(docs: DataFrame, share: int = SHARE, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per document. Documents
    are linked from ``share`` of 100 on; bands have ``rows`` registers.

    1. sketch every document and write the sketches; equal sets are one node (a
       64-bit hash of the set);
    2. nodes that share the key of a band are candidates: every bucket's
       members are compared with its smallest node, in chunks, by their registers
       first and those that are left in full;
    3. buckets whose members are then still in several components are
       gathered to groups, and each group is compared in blocks of 512: no
       pair becomes a row but those found similar;
    4. components over all links, carried back to the documents.

    A register pair agrees with the probability of the sets' similarity, so
    at 0.85 a pair shares none of 42 bands of 6 with probability 2e-9 (at 0.8,
    none of 51 bands of 5), and an estimate is 6 standard errors too low with 1e-9. Every link is confirmed
    on the full sets.

    Nulls: a null text, and one without words, has an empty set and no links;
    a null id is never the smallest and is kept only if alone without one.
    Repeated rows are equal sets. Extra columns are ignored."""
    placed = _placed(docs, share, rows)
    least = materialize(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return placed.join(least, "root").select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def documents(docs: DataFrame, share: int = SHARE, rows: int = ROWS) -> DataFrame:
    """doc_id, mark (xxhash64 of the text), n_rows, kept: one row per id and
    text, of which one a component is kept, that of the smallest id (a null id
    is the largest), then of the smallest mark."""
    own = materialize(_placed(docs, share, rows).groupBy("doc_id", "mark").agg(
        F.min("root").alias("root"), F.count(F.lit(1)).alias("n_rows")), "documents")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    least = materialize(own.groupBy("root").agg(first), "least")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    return own.join(least, "root").select("doc_id", "mark", "n_rows", kept.alias("kept"))


def _placed(docs: DataFrame, share: int, rows: int) -> DataFrame:
    """doc_id, mark, n_shingles, root: documents of a component share a root."""
    sk = materialize(sketches(docs), "sketch")
    first = sk.where("registers IS NOT NULL").groupBy("node").agg(F.min("row").alias("row"))
    member = buckets(sk, rows)
    # Aggregates that are joined back to their own rows are written first: the
    # join then deals both sides itself and can split the rows of a hot key.
    pivots = materialize(member.groupBy("key").agg(F.min("node").alias("pivot")), "pivots")
    member = materialize(member.join(pivots, "key"), "members")
    star = materialize(member.where("node != pivot").select("pivot", "node").distinct(), "star")
    near = materialize(member.select("node").distinct().join(first, "node"), "near")
    # a merge join at every size: registers and texts are dealt once, those of candidates again
    wanted = materialize(sk.select("row", "registers", "packed").join(near.hint("merge"), "row").drop("row"), "wanted")

    # registers first; only what they leave is compared in full
    close = in_chunks(star, wanted.select("node", "registers")).groupBy("pivot", "chunk").applyInPandas(
        lambda pdf: _near_pivot(pdf, share), "pivot long, node long")
    close = materialize(close, "close")
    links = materialize(in_chunks(close, wanted.select("node", "packed")).groupBy("pivot", "chunk").applyInPandas(
        lambda pdf: _against_pivot(pdf, share), "a long, b long"), "links")
    root = components(links, "components")

    labelled = materialize(member.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")), "labelled")
    mixed = materialize(labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                        .where("lo != hi").select("key"), "mixed-keys")
    left = materialize(labelled.join(mixed, "key").select("pivot", "node", "root").distinct(), "mixed")
    group = components(left.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")),
                       "groups").select("node", F.col("root").alias("group"))
    own = materialize(left.select("node", "root").distinct().join(group, "node"), "own")
    size = materialize(own.groupBy("group").agg(F.ceil(F.count("node") / BLOCK).cast("int").alias("blocks")), "sizes")
    own = own.join(size, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = own.select("*", other.alias("other")).select(
        "group", "node", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"))
    more = own.join(wanted.select("node", "packed"), "node").groupBy("group", "i", "j").applyInPandas(
        lambda pdf: _in_blocks(pdf, share), "a long, b long")
    final = components(links.union(more), "final")

    placed = sk.select("doc_id", "mark", "n_shingles", "row", "node").join(final, "node", "left")
    return materialize(placed.select("doc_id", "mark", "n_shingles", F.coalesce("root", "node", "row").alias("root")),
                       "placed")
