"""Operator 9: repeated line runs by a suffix array over line ids.

A document is the sequence of its lines. A run of consecutive lines with at
least ``MIN_WORDS`` words that also occurs earlier (by doc_id, then place) is
a later copy, and its lines are deleted; the first copy stays. So a line is
deleted exactly if some such run covers it.

1. Lines get ids; distributed prefix doubling ranks all suffixes by their
   first 1, 2, 4, ... lines: the rank at 2h sorts the pairs (rank at h, rank at
   h lines further on). Suffixes whose prefix is unique leave at once: nothing
   longer can repeat there. What stays at a depth are the suffix array's
   longest-common-prefix intervals of that depth.
2. A run of n lines from i is equal to one from j exactly if the ranks at the
   largest power of two h <= n agree at i and j and at i + n - h and j + n - h,
   that is if both suffixes lie in one interval of depth n.
3. Every repeated run with enough words is covered by shortest runs with
   enough words, those from a line on and those up to a line. Only these are
   looked up: those that are not the first of their interval are deleted.

Rank pairs are counted before they are sorted, so a line that a third of all
rows share is one pair, and joins back split its rows.

Nulls: a null text has no lines and stays null; a null id comes first. Rows
that repeat an id and a text are one document and get one result. Words are
the runs between ASCII white space; of characters of scripts without spaces
(``UNSPACED``) two are a word. A blank line has none. Extra columns are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from learnstream.llm.common import bound_batches, free_names, materialize, per_batch, running_total

MIN_WORDS = 10
#: Thai and Lao, Burmese, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
                      "\U00020000-\U0003ffff]")
#: known: whether there is an id (doc_id is 0 without), so that joins keep such
#: documents and they sort first; mark: hash of the text, so that a repeated id
#: does no harm.
DOC = ["known", "doc_id", "mark"]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def n_words(line: str) -> int:
    if line.isascii():
        return len(line.encode().split())
    spaced, n = UNSPACED.subn(" ", line)
    return len(spaced.encode("utf-8", "surrogatepass").split()) + (n + 1) // 2


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line: its hash, the lines of the shortest run with enough
    words from it on (ahead) and up to it (back); null where the document ends."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, marks, places, hashes, aheads, backs = [], [], [], [], [], []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            lines = text.split("\n")
            n = len(lines)
            words = np.fromiter(map(n_words, lines), np.int64, n)
            before = np.concatenate([[0], np.cumsum(words)])
            place = np.arange(n)
            ahead = np.searchsorted(before, before[:-1] + min_words) - place
            start = np.searchsorted(before, before[1:] - min_words, side="right") - 1
            back = np.where(start >= 0, place + 1 - start, -1)
            ids += [doc_id] * n
            marks += [signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))] * n
            places.append(place)
            hashes += [signed(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))) for x in lines]
            aheads.append(np.where(place + ahead <= n, ahead, -1))
            backs.append(back)
        columns = [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(np.concatenate(places)),
                   pa.array(hashes, pa.int64()), pa.array(np.concatenate(aheads)), pa.array(np.concatenate(backs))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "place", "line", "ahead", "back"])

    rows = (docs.where(F.col("text").isNotNull()).select("doc_id", "text")
            .mapInArrow(per_batch(run), "doc_id long, mark long, place long, line long, ahead long, back long"))
    return rows.withColumns({"known": F.col("doc_id").isNotNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})


def ranked(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """Rows whose key is repeated, with the key's rank instead of the key."""
    held = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .withColumn("one", F.lit(1).cast("long")))
    ranks = running_total(held, [F.col(c) for c in key], "one", f"{name}-ranks").select(
        *key, F.col("before").alias("new"))
    return materialize(rows.join(ranks, key).drop(*key).withColumnRenamed("new", "rank"), name)


def copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The later copies: doc_id, mark, first line, line behind the last, and
    the id of the document of the first copy."""
    lines = materialize(line_table(docs, min_words).repartition(*DOC).dropDuplicates([*DOC, "place"]), "lines")
    level = ranked(lines.select(*DOC, "place", "line"), ["line"], "level-0")
    ahead = lines.where("ahead > 0").select(*DOC, "place", F.col("ahead").alias("n"))
    back = lines.where("back > 0").select(*DOC, (F.col("place") + 1 - F.col("back")).alias("place"),
                                          F.col("back").alias("n"))
    runs = ahead.union(back).distinct().join(level.select(*DOC, "place"), [*DOC, "place"])
    runs = materialize(runs, "runs")
    deepest = runs.agg(F.max("n")).first()[0] or 0
    found, h = None, 1
    while h <= deepest:
        own = runs.where((F.col("n") >= h) & (F.col("n") < 2 * h))
        tail = level.select(*DOC, F.col("place").alias("last"), F.col("rank").alias("end_rank"))
        part = (own.join(level, [*DOC, "place"]).withColumn("last", F.col("place") + F.col("n") - h)
                .join(tail, [*DOC, "last"]).select(*DOC, "place", "n", "rank", "end_rank"))
        found = part if found is None else found.union(part)
        h *= 2
        if h <= deepest:
            at = Window.partitionBy(*DOC).orderBy("place").rangeBetween(h // 2, h // 2)
            pairs = level.withColumn("next", F.max("rank").over(at)).where("next IS NOT NULL")
            level = ranked(pairs, ["rank", "next"], f"level-{h}")
    if found is None:
        found = level.select(*DOC, "place", F.lit(1).cast("long").alias("n"), "rank",
                             F.lit(0).cast("long").alias("end_rank")).limit(0)
    found = materialize(found, "found")
    key = ["n", "rank", "end_rank"]
    # written, so that the join below deals both sides itself and can split a hot run
    first = materialize(found.groupBy(*key).agg(F.min(F.struct(*DOC, "place")).alias("first"),
                                                F.count(F.lit(1)).alias("times"))
                        .where("times > 1").drop("times"), "first")
    return (found.join(first, key).where(~F.struct(*DOC, "place").eqNullSafe(F.col("first")))
            .select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "mark", "place",
                    (F.col("place") + F.col("n")).alias("end"),
                    F.when(F.col("first.known"), F.col("first.doc_id")).alias("source")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS,
                names: tuple[str, str, str] = ("n_lines", "deleted", "sources")) -> DataFrame:
    """All columns of ``docs`` with the later copies cut out of ``text``, then,
    as ``names`` (columns of these names, in any case of letters, are replaced): the number of lines, the
    deleted intervals of lines, the ids of the documents whose lines they repeat."""
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    lines_, sources_, id_, mark_, own_ = free_names(docs.columns, "_lines", "_sources", "_id", "_mark", "_own")
    cut = (copies(docs, min_words).groupBy("doc_id", "mark")
           .agg(F.collect_set(F.struct("place", "end")).alias(lines_), F.collect_set("source").alias(sources_))
           .withColumnsRenamed({"doc_id": id_, "mark": mark_}))
    fields = [docs.schema[c] for c in kept]
    at = kept.index("text")

    def mark(b: pa.RecordBatch) -> pa.RecordBatch:
        own = [None if t is None else signed(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")))
               for t in b.column(at).to_pylist()]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int64())], [*b.schema.names, own_])

    span = StructType().add("place", LongType()).add("end", LongType())
    out = (StructType(list(fields)).add(names[0], IntegerType()).add(names[1], ArrayType(span))
           .add(names[2], ArrayType(LongType())))
    span_type = pa.list_(pa.struct([("place", pa.int64()), ("end", pa.int64())]))

    def cut_out(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_lines, deleted = [], [], []
        for text, spans in zip(b.column(at).to_pylist(), b.column(lines_).to_pylist()):
            lines = [] if text is None else text.split("\n")
            spans = merged(spans or [])
            n_lines.append(len(lines))
            deleted.append([{"place": s, "end": e} for s, e in spans])
            if spans:
                rest, free = [], 0
                for s, e in spans:
                    rest += lines[free:s]
                    free = e
                text = "\n".join(rest + lines[free:])
            texts.append(text)
        columns = [pa.array(texts, pa.string()) if k == at else b.column(k) for k in range(len(kept))]
        sources = [sorted(x for x in s if x is not None) if s else [] for s in b.column(sources_).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(n_lines, pa.int32()), pa.array(deleted, span_type),
             pa.array(sources, pa.list_(pa.int64()))], [*kept, *names])

    marked = docs.select(*kept).mapInArrow(per_batch(mark), StructType(list(fields)).add(own_, LongType()))
    joined = marked.join(cut, marked["doc_id"].eqNullSafe(cut[id_]) & (marked[own_] == cut[mark_]), "left")
    return joined.select(*[marked[c] for c in kept], lines_, sources_).mapInArrow(per_batch(cut_out), out)


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["place"], x["end"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]
