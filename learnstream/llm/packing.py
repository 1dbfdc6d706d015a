"""Operator 1: best-fit packing of tokenised documents into sequences.

Every document becomes its token ids followed by an end id. A document over
the capacity is cut into full pieces behind a first, shorter one, so at most
one piece of a document is not full. What has to be packed is then fully
described by a histogram of piece lengths, at most ``capacity`` rows:

1. tokenise in the scan tasks; each piece gets its rank among the pieces of
   its length in its task (written once to the shared folder);
2. pack the histogram: pieces above a third of the capacity are matched
   greedily, largest with the largest partner that fits, at most two to a
   sequence; smaller ones go, longest first, to the tightest gap that takes
   them. Equal pieces and equal gaps are handled as runs, so the work depends
   on the capacity alone, not on the number of documents;
3. every piece finds its run by its global rank within its length, which is
   its rank in the task plus the counts of the earlier tasks.

Nulls: a null text is empty (one piece, the end id); a null id is kept. Ties
and repeated rows are separate documents. Extra columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, materialize, per_batch, text_groups

CAPACITY = 1024
END_ID = 2
CACHE_CHARS = 4_000_000      # of words whose ids a worker keeps, some 400,000 words

PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
                "nth long, task int")
#: Letters, digits and signs whose classes no Unicode version disputes.
UNUSUAL = re.compile(r"[^\n\x20-\x7e\xa1-ɏ]")


def same_vocabulary(lib, specials: set[str]):
    """A byte-level vocabulary of tokenizers as a tiktoken encoding, and the
    bytes of each id. Byte-level files write the bytes that print as
    themselves and the others, in order, as the characters from 256 on."""
    import public_tokenizers
    import tiktoken
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(prints)]
    byte_of = {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in lib.get_vocab().items() if t not in specials}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}), sizes


class WordEncoder:
    """Ids of many texts at once. The vocabulary's pre-tokeniser cuts in front
    of every space that a visible character follows and around a lone line
    feed, so such words are encoded once and looked up afterwards. Texts where
    that does not hold (other white space, unusual characters, special
    strings) go through the library as a whole. New words are encoded by
    tiktoken over the ranks of the same vocabulary, which gives the same ids
    (tests compare them) several times faster."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.fast, self.token_bytes = same_vocabulary(self.lib, set(self.specials))
        self.clear()

    def clear(self) -> None:
        self.ids_of: dict[str, bytes] = {"\n": packed(self.lib.encode("\n").ids)}
        self.held = 0

    def simple(self, t: str) -> bool:
        return (t[0] not in " \n" and t[-1] not in " \n" and "  " not in t and " \n" not in t
                and "\n " not in t and "\n\n" not in t
                and UNUSUAL.search(t) is None and not any(s in t for s in self.specials))

    def learn(self, words: list[str]) -> None:
        """A carriage return in front marks a word that a line feed, no space, precedes.
        All are encoded as one text and cut apart by their bytes."""
        spaced = [w for w in words if w[0] != "\r"]
        bare = [w for w in words if w[0] == "\r"]
        for own, text, skip in ((spaced, " " + " ".join(spaced), 0),
                                (bare, "\n" + "\n".join(w[1:] for w in bare), 1)):
            if own:
                self.held += len(text)
                ids = self.fast.encode_to_numpy(text, disallowed_special=())
                sizes = np.fromiter((len(w.encode()) + 1 - skip for w in own), np.int64, len(own))
                to = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum(sizes)) + 1
                raw, ends = ids.astype("<u4").tobytes(), (4 * to).tolist()
                # behind a line feed, its own id comes first
                starts = [4 * skip] + [e + 4 * skip for e in ends[:-1]]
                self.ids_of.update((w, raw[s:e]) for w, s, e in zip(own, starts, ends))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if self.held > CACHE_CHARS:
            self.clear()
        split = [("\r" + t.replace("\n", " \n \r")).split(" ") if t and self.simple(t) else None for t in texts]
        missing = set().union(*filter(None, split)).difference(self.ids_of)
        if missing:
            self.learn(list(missing))
        get = self.ids_of.__getitem__
        return [b"".join(map(get, own)) if own else
                packed(self.lib.encode(t, add_special_tokens=False).ids) if t else b""
                for t, own in zip(texts, split)]


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of one document's ids."""
    n, raw = len(ids) // 4, memoryview(ids)
    start, piece = 0, 0
    end = n - (-(-n // capacity) - 1) * capacity
    while start < n:
        yield piece, start, end - start, zlib.crc32(raw[4 * start:4 * end])
        start, piece, end = end, piece + 1, end + capacity


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document (``PIECE_SCHEMA``); ``nth`` is the
    piece's rank among those of its length in its task."""
    bound_batches(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        enc, stop = WordEncoder(path), packed([end_id])
        seen = [0] * (capacity + 1)
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            texts = [t or "" for t in b.column(1).to_pylist()]
            for at, group in text_groups(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[at:], enc.encode(group)):
                    for piece, start, length, crc in cut(ids + stop, capacity):
                        rows.append((doc_id, piece, start, length, crc, seen[length], task))
                        seen[length] += 1
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "task"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, PIECE_SCHEMA)


class Gaps:
    """Open sequences by remaining room: runs of (first sequence, how many)."""

    def __init__(self):
        self.runs: dict[int, list[list[int]]] = {}
        self.rooms: list[int] = []

    def add(self, room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            if room not in self.runs:
                self.runs[room] = []
                insort(self.rooms, room)
            self.runs[room].append([first, count])

    def tightest(self, size: int) -> int | None:
        at = bisect_left(self.rooms, size)
        return self.rooms[at] if at < len(self.rooms) else None

    def take(self, room: int, most: int) -> tuple[int, int]:
        """At most ``most`` sequences of one run with this room."""
        run = self.runs[room][-1]
        first, count = run[0], min(most, run[1])
        run[0], run[1] = first + count, run[1] - count
        if not run[1]:
            self.runs[room].pop()
            if not self.runs[room]:
                del self.runs[room]
                self.rooms.remove(room)
        return first, count


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, how many, first sequence, to a sequence,
    offset of the first): the piece of rank r in a run lies in sequence
    ``first + (r - first rank) // per`` behind ``(r - first rank) % per`` others."""
    left = {s: n for s, n in counts.items() if n > 0}
    rank = dict.fromkeys(left, 0)
    runs, gaps, sequences = [], Gaps(), 0

    def place(size, n, first, per, room):
        runs.append((size, rank[size], n, first, per, capacity - room))
        rank[size] += n
        left[size] -= n

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((s for s in large if s <= capacity - a and left[s] - (s == a) > 0), None)
            n = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
            place(a, n, sequences, 1, capacity)
            if b is not None:
                place(b, n, sequences, 1, capacity - a)
            gaps.add(capacity - a - (b or 0), sequences, n)
            sequences += n
    for s in sorted((s for s in left if left[s]), reverse=True):
        while left[s]:
            room = gaps.tightest(s)
            if room is None:
                per, n = capacity // s, left[s]
                fresh = -(-n // per)
                gaps.add(capacity, sequences, fresh)
                sequences, room = sequences + fresh, capacity
            per = room // s
            if left[s] >= per:
                first, count = gaps.take(room, left[s] // per)
                place(s, count * per, first, per, room)
                gaps.add(room - per * s, first, count)
            else:
                n = left[s]
                first, _ = gaps.take(room, 1)
                place(s, n, first, per, room)
                gaps.add(room - n * s, first, 1)
    return runs


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(token_pieces(docs, path, capacity, end_id), "pieces")
    held = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # At most `capacity` rows, whatever the input.
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.array(sorted(pack_histogram(histogram, capacity)), np.int64).reshape(-1, 6)

    def locate(b: pa.RecordBatch) -> pa.RecordBatch:
        length, nth = (b.column(n).to_numpy() for n in ("length", "rank"))
        span = (runs[:, 1] + runs[:, 2]).max()
        at = np.searchsorted(runs[:, 0] * span + runs[:, 1], length * span + nth, side="right") - 1
        _, first_rank, _, first, per, offset = runs[at].T
        k = nth - first_rank
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays(
            [b.column(n) for n in names]
            + [pa.array(first + k // per), pa.array(offset + k % per * length)],
            names + ["sequence_id", "offset"])

    ranked = pieces.join(base, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(per_batch(locate), "doc_id long, piece int, start long, length long, "
                             "ids_crc32 long, sequence_id long, offset long")
