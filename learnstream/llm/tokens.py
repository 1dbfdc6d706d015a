"""Operator 7: token counts of a sentencepiece BPE vocabulary.

Rank-synchronous merging: the distinct pre-tokens of a batch are held as one
ragged array of symbol ids. In each step every pre-token applies its
lowest-rank pair (the leftmost of equals), all at once, until none has a pair
that is a piece; the symbols that survive are its tokens. That is the order
in which the library merges, one pair at a time, so the counts are the same.

A pre-token is a run of ``▁`` (written for a space) with what follows it: no
piece of the vocabulary has ``▁`` behind another character, which is checked
on loading. A character outside the vocabulary counts its UTF-8 bytes.
Pre-tokens over ``LONG`` characters are merged one by one with a heap, as a
step of the arrays would touch them once per merge.

Nulls: a null text is empty, 0 tokens; a null id is kept. Repeated rows are
answered each on its own. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, per_batch, text_groups

SPACE = "▁"
LIMIT = 4096
LONG = 200
CACHE_WORDS = 400_000
PRETOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NO_RANK = np.int64(1) << 40


class MergeTable:
    """Pairs of symbols and the symbol they merge to, from a piece list."""

    def __init__(self, path: str):
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = {lib.id_to_piece(i): i for i in range(lib.get_piece_size())
                 if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) or lib.is_byte(i))}
        odd = next((p for p in plain if re.search(f"[^{SPACE}]{SPACE}", p)), None)
        if odd is not None:
            raise ValueError(f"piece {odd!r} has a space inside: pre-tokens would not be independent")
        self.symbol = {p: k for k, p in enumerate(sorted(plain, key=lambda p: -lib.get_score(plain[p])))}
        self.size = len(self.symbol) + 1           # the last symbol stands for any unknown character
        rows = [(self.symbol[p[:k]] * self.size + self.symbol[p[k:]], s)
                for p, s in self.symbol.items() for k in range(1, len(p))
                if p[:k] in self.symbol and p[k:] in self.symbol]
        rows.sort()
        self.keys = np.array([r[0] for r in rows], np.int64)
        self.ranks = np.array([r[1] for r in rows], np.int64)   # rank and new symbol are one number
        self.pairs = dict(rows)
        # a hash table of twice the size answers a pair in about one look
        self.mask = (1 << int(np.ceil(np.log2(len(rows) * 4)))) - 1
        self.table = np.full(self.mask + 1, -1, np.int64)
        slots = self.slot(self.keys)
        order = np.arange(len(rows))
        self.depth = 0
        while len(order):
            free = self.table[slots[order]] < 0
            self.table[slots[order][free]] = order[free]
            order = order[self.table[slots[order]] != order]
            slots[order] = (slots[order] + 1) & self.mask
            self.depth += 1
        self.cache: dict[str, int] = {}

    def slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(40)).astype(np.int64) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Symbol that each pair merges to (its rank), NO_RANK if none."""
        keys = left * self.size + right
        out = np.full(len(keys), NO_RANK)
        at, todo = self.slot(keys), np.arange(len(keys))
        for _ in range(self.depth):
            row = self.table[at]
            hit = (row >= 0) & (self.keys[row] == keys[todo])
            out[todo[hit]] = self.ranks[row[hit]]
            go = (row >= 0) & ~hit
            todo, at = todo[go], (at[go] + 1) & self.mask
            if not len(todo):
                break
        return out

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all characters, and what each counts as a token."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, back = np.unique(points, return_inverse=True)
        unknown = self.size - 1
        known = np.array([self.symbol.get(chr(c), unknown) for c in kinds], np.int64)
        bytes_ = np.where(kinds < 0x80, 1, np.where(kinds < 0x800, 2, np.where(kinds < 0x10000, 3, 4)))
        return known[back], np.where(known == unknown, bytes_, 1)[back]

    def merge(self, words: list[str]) -> np.ndarray:
        """Token counts of short pre-tokens."""
        sym, cost = self.symbols(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        seq = np.repeat(np.arange(len(words)), lens)
        total = np.bincount(seq, cost, len(words)).astype(np.int64)
        pair = self._pairs(sym, seq)
        while True:
            # per sequence its lowest rank, leftmost first
            first = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            low = np.minimum.reduceat(pair, first)
            active = low < NO_RANK
            if not active.any():
                return total
            # finished sequences leave the arrays
            ends = np.append(first[1:], len(seq))
            keep = np.repeat(active, ends - first)
            sym, seq, pair = sym[keep], seq[keep], pair[keep]
            low = np.repeat(low[active], (ends - first)[active])
            hits = np.flatnonzero(pair == low)
            hits = hits[np.concatenate([[True], seq[hits[1:]] != seq[hits[:-1]]])]
            total[seq[hits]] -= 1
            sym[hits] = pair[hits]
            stay = np.ones(len(sym), bool)
            stay[hits + 1] = False
            moved = hits - np.arange(len(hits))
            sym, seq, pair = sym[stay], seq[stay], pair[stay]
            # only the pairs at and before a merged symbol change
            for at in (moved, moved - 1):
                at = at[at >= 0]
                nxt = np.minimum(at + 1, len(sym) - 1)
                inside = (nxt > at) & (seq[at] == seq[nxt])
                pair[at] = np.where(inside, self.rank(sym[at], sym[nxt]), NO_RANK)

    def _pairs(self, sym: np.ndarray, seq: np.ndarray) -> np.ndarray:
        pair = np.full(len(sym), NO_RANK)
        inside = np.flatnonzero(seq[1:] == seq[:-1])
        pair[inside] = self.rank(sym[inside], sym[inside + 1])
        return pair

    def merge_long(self, word: str) -> int:
        """The same for one long pre-token, with a heap over a linked list."""
        sym, cost = self.symbols([word])
        sym, total = sym.tolist(), int(cost.sum())
        n = len(sym)
        nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def pair(i):
            return self.pairs.get(sym[i] * self.size + sym[nxt[i]]) if 0 <= i and nxt[i] < n else None

        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = nxt[i] if live[i] else n
            if j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], live[j], nxt[i] = rank, False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            total -= 1
            for k in (prv[i], i):
                if (r := pair(k)) is not None:
                    heapq.heappush(heap, (r, k, sym[k], sym[nxt[k]]))
        return total

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. In the cache a word without ``▁`` in front
        stands for itself behind a single one."""
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        cache, split = self.cache, []
        for t in texts:
            t = t.replace(" ", SPACE)
            if SPACE * 2 in t or t[:1] == SPACE or t[-1:] == SPACE:
                own = PRETOKEN.findall(SPACE + t)
                split.append([w if w[1:2] in ("", SPACE) else w[1:] for w in own])
            else:
                split.append(t.split(SPACE) if t else [])
        words = [w for own in split for w in own]
        missing = {w for w in set(words) if w not in cache}
        long = {w: self.merge_long(w if w[0] == SPACE else SPACE + w) for w in missing if len(w) >= LONG}
        if short := [w for w in missing if w not in long]:
            cache.update(zip(short, self.merge([w if w[0] == SPACE else SPACE + w for w in short]).tolist()))
        get = (cache | long if long else cache).__getitem__
        each = np.fromiter(map(get, words), np.int64, len(words))
        ends = np.cumsum([len(own) for own in split])
        sums = np.concatenate([[0], np.cumsum(each)])
        return (sums[ends] - sums[np.concatenate([[0], ends[:-1]])]).tolist()


COLUMNS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """n_bytes (UTF-8), n_tokens and n_tokens > limit of every document."""
    bound_batches(docs.sparkSession)

    def run(batches):
        merges = MergeTable(path)

        def count(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = [c for _, group in text_groups(texts) for c in merges.counts(group)]
            return pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array([k > limit for k in n])],
                [c.split()[0] for c in COLUMNS.split(", ")])

        yield from per_batch(count)(batches)

    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "text", n_bytes).mapInArrow(run, COLUMNS)
