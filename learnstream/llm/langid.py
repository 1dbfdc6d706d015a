"""Operator 10: language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's probability is the sum over all ways to cut it into pieces of the
product of their probabilities (forward algorithm); a text's is the product
over its words. The probabilities are learned by expectation maximisation on
the words of a bounded, hashed sample of labelled documents (long words, as those of
scripts without spaces, in pieces).

Words are the runs between white space, ASCII punctuation, digits and
controls, with A-Z lower-cased.

Nulls: a null text, and one without a letter, is ``und`` with score 0. A null
id is not held out and not learned from. Without any labelled document every
text is ``und``. Ties go to the first language by name. Repeated rows are
answered each on its own. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from learnstream.llm.common import bound_batches, materialize, per_batch, text_groups

FOLDS, HELD_OUT = 5, 0
TRAIN_DOCS = 1500        # labelled documents a language is learned from, about
ROUNDS = 2               # of expectation maximisation
FLOOR = 1e-3             # share of every distribution that is spread over all pieces
UNKNOWN = 1e-9           # probability of a character that is no piece
CACHE_WORDS, CACHE_BYTES = 300_000, 32 << 20
CUT = 30                 # characters; longer words are learned from in pieces of that length
SMALLEST = 690           # -log of the smallest number that plain products may come to
UNDETERMINED = "und"

SPACE = "▁"
LETTER = re.compile(r"[^\W\d_]")
KEPT = bytes(range(97, 123)) + bytes(range(128, 256))
FOLD = bytes(b if b in KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


class Pieces:
    """The vocabulary's text pieces behind a hash table, and word lattices."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        text = {lib.id_to_piece(i) for i in range(lib.get_piece_size())
                if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))}
        self.index = {p: k for k, p in enumerate(sorted(text))}
        self.unknown = len(self.index)
        self.longest = max(map(len, self.index))
        powers = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(self.longest):
                powers.append(powers[-1] * self.BASE)
        self.powers = np.array(powers, np.uint64)
        self.hashes = []         # by length: sorted hashes and their pieces
        for n in range(1, self.longest + 1):
            own = [p for p in self.index if len(p) == n]
            points = np.array([[ord(c) for c in p] for p in own], np.uint64).reshape(len(own), n)
            h = (points * self.powers[n - 1::-1][:n]).sum(1, dtype=np.uint64)
            order = np.argsort(h)
            self.hashes.append((h[order], np.array([self.index[p] for p in own], np.int64)[order]))

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list]:
        """Nodes of all words (one before each character and one at the end):
        first nodes, last nodes, and by start place the edges (from, to, piece)."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first = np.cumsum(lens + 1) - (lens + 1)
        word = np.repeat(np.arange(len(words)), lens)
        place = np.arange(len(points)) - np.repeat(np.cumsum(lens) - lens, lens)
        room = np.repeat(lens, lens) - place
        node = first[word] + place
        h = np.zeros(len(points), np.uint64)
        edges: list[list] = [[] for _ in range(int(lens.max(initial=0)))]
        at = np.arange(len(points))
        for n in range(1, self.longest + 1):
            at = at[room[at] >= n]
            if not len(at):
                break
            h[at] = h[at] * self.BASE + points[at + n - 1]
            keys, pieces = self.hashes[n - 1]
            if len(keys):
                k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
                hit = keys[k] == h[at]
                src, piece = at[hit], pieces[k[hit]]
            else:
                hit, src, piece = np.zeros(len(at), bool), at[:0], at[:0]
            if n == 1:           # a character that is no piece still has an edge
                src = np.concatenate([src, at[~hit]])
                piece = np.concatenate([piece, np.full(int((~hit).sum()), self.unknown)])
            order = np.argsort(place[src], kind="stable")
            src, piece = src[order], piece[order]
            cuts = np.searchsorted(place[src], np.arange(len(edges) + 1))
            for p in range(len(edges)):
                if cuts[p] < cuts[p + 1]:
                    own = slice(cuts[p], cuts[p + 1])
                    edges[p].append((node[src[own]], node[src[own]] + n, piece[own]))
        return first, first + lens, edges

    def log_probabilities(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """log P(word | language), words x languages, for words up to ``plain_length``."""
        first, last, edges = self.lattice(words)
        alpha = np.zeros((int(last[-1]) + 1 if len(words) else 0, p.shape[1]))
        alpha[first] = 1
        for group in edges:
            for src, dst, piece in group:
                alpha[dst] += alpha[src] * p[piece]
        return np.log(alpha[last])

    @staticmethod
    def plain_length(p: np.ndarray) -> int:
        """Characters of a word whose probability cannot underflow, whatever they are."""
        return int(SMALLEST / -np.log(p.min()))

    def long_log_probability(self, word: str, p: np.ndarray) -> np.ndarray:
        """The same for one word of any length: every node is kept relative
        to the nodes it can be reached from, so nothing underflows."""
        logs = [np.zeros(p.shape[1])]
        for end in range(1, len(word) + 1):
            parts = [logs[s] + np.log(p[self.index.get(word[s:end], self.unknown)])
                     for s in range(max(0, end - self.longest), end)
                     if s == end - 1 or word[s:end] in self.index]
            logs.append(np.logaddexp.reduce(parts))
        return logs[-1]

    def expected(self, words: list[str], counts: np.ndarray, lang: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected piece counts, pieces x languages, of weighted words that
        each belong to one language and have about CUT characters at most."""
        first, last, edges = self.lattice(words)
        nodes = int(last[-1]) + 1
        of = np.repeat(lang, last - first + 1)
        weight = np.repeat(counts, last - first + 1)
        alpha, beta = np.zeros(nodes), np.zeros(nodes)
        alpha[first], beta[last] = 1, 1
        for group in edges:
            for src, dst, piece in group:
                alpha[dst] += alpha[src] * p[piece, of[src]]
        out = np.zeros(p.shape)
        total = np.repeat(alpha[last], last - first + 1)
        for group in reversed(edges):
            for src, dst, piece in group:
                beta[src] += beta[dst] * p[piece, of[src]]
            for src, dst, piece in group:
                np.add.at(out, (piece, of[src]),
                          weight[src] * alpha[src] * p[piece, of[src]] * beta[dst] / total[src])
        return out


def cut(word: str) -> list[str]:
    return [word[k:k + CUT] for k in range(0, len(word), CUT)]


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Piece probabilities from counts; the last row is the unknown character."""
    known = counts[:-1]
    p = (1 - FLOOR) * known / np.maximum(known.sum(0), 1e-300) + FLOOR / len(known)
    return np.vstack([p, np.full(counts.shape[1], UNKNOWN)])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray | None]:
    """Languages and piece probabilities (pieces + 1) x languages. What comes
    to the driver is bounded by the vocabulary times the languages."""
    spark = docs.sparkSession
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                          & F.col("doc_id").isNotNull() & ~held_out())
    held = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(held)
    if not langs:
        return [], None
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, train_docs / held[lang]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(draw < share[F.col("lang")]).select("lang", "text")

    def words(b: pa.RecordBatch) -> pa.RecordBatch:
        held: Counter = Counter()
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held.update((lang, w) for w in words_of(text))
        rows = [(lang, part, n) for (lang, w), n in held.items() for part in cut(SPACE + w.decode("utf-8", "replace"))]
        return pa.RecordBatch.from_pylist([dict(zip(("lang", "word", "n"), r)) for r in rows],
                                          pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    table = materialize(sample.mapInArrow(per_batch(words), "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    size = Pieces(path).unknown
    p = np.vstack([np.full((size, len(langs)), 1 / size), np.full((1, len(langs)), UNKNOWN)])
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(p)

        def expect(frames):
            pieces, total = Pieces(path), np.zeros((size + 1, len(langs)))
            for df in frames:
                of = df["lang"].map({lang: k for k, lang in enumerate(langs)}).to_numpy()
                for at in range(0, len(df), 20_000):
                    own = slice(at, at + 20_000)
                    total += pieces.expected(df["word"].iloc[own].tolist(),
                                             df["n"].to_numpy(float)[own], of[own], sent.value)
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})

        got = (table.mapInPandas(expect, "piece long, lang long, n double")
               .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())
        counts = np.zeros((size + 1, len(langs)))
        counts[got["piece"], got["lang"]] = got["n"]
        p = smoothed(counts)
        sent.destroy()
    return langs, p


def with_background(langs: list[str], p: np.ndarray | None) -> tuple[list[str], np.ndarray | None]:
    """The languages and, as ``und``, one in which every piece is as likely as
    any. What it explains best is in none of the languages: pieces that they do
    not have cost them 1 / ``FLOOR`` more than it."""
    if not langs:
        return langs, p
    size = len(p) - 1
    even = np.append(np.full(size, 1 / size), UNKNOWN / FLOOR)
    return [*langs, UNDETERMINED], np.column_stack([p, even])


class Scorer:
    def __init__(self, path: str, p: np.ndarray):
        self.pieces, self.p, self.plain = Pieces(path), p, Pieces.plain_length(p)
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.logs, self.used, self.held = np.zeros((1 << 14, self.p.shape[1])), 0, 0

    def learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 20_000):
            own = words[at:at + 20_000]
            text = [SPACE + w.decode("utf-8", "replace") for w in own]
            logs = np.zeros((len(own), self.p.shape[1]))
            short = [k for k, w in enumerate(text) if len(w) <= self.plain]
            if short:
                logs[short] = self.pieces.log_probabilities([text[k] for k in short], self.p)
            for k, w in enumerate(text):
                if len(w) > self.plain:
                    logs[k] = self.pieces.long_log_probability(w, self.p)
            assert np.isfinite(logs).all()
            while self.used + len(own) > len(self.logs):
                self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
            self.logs[self.used:self.used + len(own)] = logs
            self.index.update(zip(own, range(self.used, self.used + len(own))))
            self.used += len(own)
            self.held += sum(map(len, own))

    def texts(self, texts: list[str]) -> np.ndarray:
        """log P(text | language), texts x languages."""
        if self.used > CACHE_WORDS or self.held > CACHE_BYTES:
            self.clear()
        split = [words_of(t) for t in texts]
        words = [w for own in split for w in own]
        index = self.index
        if missing := [w for w in set(words) if w not in index]:
            self.learn(missing)
        rows = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        sizes = np.array([len(own) for own in split])
        out, some = np.zeros((len(texts), self.p.shape[1])), np.flatnonzero(sizes)
        if len(some):        # each text's sum of its own words, whatever texts are around it
            out[some] = np.add.reduceat(self.logs[rows], (np.cumsum(sizes) - sizes)[some], axis=0)
        return out


def scorer(langs: list[str], path: str, sent):
    """Function of texts -> (languages, scores); ``sent`` is the broadcast table."""
    own = Scorer(path, sent.value) if langs else None

    def predict(texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for _, group in text_groups(texts) if langs else [(0, texts)]:
            logs = own.texts(group) if langs else None
            for k, t in enumerate(group):
                if not langs or not LETTER.search(t):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                best = int(np.argmax(logs[k]))
                names.append(langs[best])
                scores.append(float(1 / np.exp(logs[k] - logs[k][best]).sum()))
        return names, scores

    return predict


def with_language(docs: DataFrame, langs: list[str], p: np.ndarray | None, path: str,
                  names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs``, then the language and its score as ``names``
    (which must not be columns already)."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(p)
    at = docs.columns.index("text")

    def run(batches):
        predict = scorer(langs, path, sent)

        def add(b: pa.RecordBatch) -> pa.RecordBatch:
            told, scores = predict([t or "" for t in b.column(at).to_pylist()])
            return pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(told, pa.string()), pa.array(scores, pa.float64())],
                [*b.schema.names, *names])

        yield from per_batch(add)(batches)

    schema = StructType([*docs.schema.fields]).add(names[0], StringType()).add(names[1], DoubleType())
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    langs, p = train(docs, path, train_docs)
    out = with_language(docs.select(F.col("doc_id").cast("long"), "text"), langs, p, path)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
