import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest_llm import EMPTY, ODD, docs_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from learnstream.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def check(rows, texts, capacity=packing.CAPACITY):
    """Every piece in place, sequences gapless and within the capacity."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for own in by_seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = LIB.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert sum(r.length for r in pieces) == len(ids)
        assert len(pieces) == -(-len(ids) // capacity)
        for k, r in enumerate(pieces):
            own = ids[r.start:r.start + r.length]
            assert r.piece == k and r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    return len(by_seq)


def test_pieces_and_sequences(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    used = check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert used <= 1.02 * sum(r.length for r in rows) / packing.CAPACITY + 1


def test_odd_rows(spark):
    rows = packing.pack(docs_of(spark, ODD, extra=True), PATH).collect()
    texts = dict(ODD)
    del texts[3]
    check([r for r in rows], texts)
    assert sum(r.doc_id == 3 for r in rows) == 2


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], EMPTY), PATH).count() == 0


def test_words_give_the_library_ids():
    enc = packing.WordEncoder(PATH)
    rnd = random.Random(5)
    bits = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "don't", "it's", "é", "ß", "日本", "😀", "...", "12", "x1", "²",
            "<|endoftext|>", " ", "\r", "!", " The", "ing", "\x1c", "'S", "ǅ"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(2000)]
    for t, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == LIB.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_histogram_packing(counts):
    capacity = 40
    runs = packing.pack_histogram(counts, capacity)
    placed, bins = defaultdict(int), defaultdict(list)
    for size, first_rank, n, first, per, offset in runs:
        assert first_rank == placed[size]
        placed[size] += n
        for k in range(n):
            bins[first + k // per].append((offset + k % per * size, size))
    assert dict(placed) == counts
    for own in bins.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= capacity
        assert sum(3 * s > capacity for _, s in own) <= 2
    rooms = []                       # plain first fit, longest first
    for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        at = next((k for k, room in enumerate(rooms) if room >= s), None)
        if at is None:
            rooms.append(capacity - s)
        else:
            rooms[at] -= s
    assert len(bins) <= 1.1 * len(rooms) + 1
