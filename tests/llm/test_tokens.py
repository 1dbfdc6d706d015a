import random

import public_tokenizers
import sentencepiece
from conftest_llm import EMPTY, ODD, docs_of

from learnstream.llm import tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)


def count(t):
    return len(LIB.encode(t))


def test_counts_equal_the_library():
    rnd = random.Random(1)
    bits = ["a", "b", " ", "  ", "▁", "the", "ing", "\n", "\t", "é", "日本", "😀", "\x00", "=", "==", "aaaa", "0",
            "123", "<s>", "</s>", "<unk>", "   ", "..", "<0x0A>", "　", "ﬁ"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    texts += ["a" * 5000, "ab" * 3000, "x" * 199, "x" * 200, "x" * 201, " " * 1000, "日" * 500, "the" * 400,
              "".join(rnd.choice("abcdeth") for _ in range(20_000))]
    assert tokens.MergeTable(PATH).counts(texts) == [count(t) for t in texts]


def test_array_and_heap_agree():
    rnd = random.Random(2)
    words = ["▁" + "".join(rnd.choice("abcdehinorst=é日") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    table = tokens.MergeTable(PATH)
    assert table.merge(words).tolist() == [table.merge_long(w) for w in words]


def test_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in tokens.token_counts(docs, PATH, limit=500).collect()}
    for r in docs.collect():
        n = count(r.text)
        assert tuple(got[r.doc_id]) == (r.doc_id, len(r.text.encode()), n, n > 500)


def test_odd_rows_and_empty_table(spark):
    rows = tokens.token_counts(docs_of(spark, ODD, extra=True), PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted((i or 0, count(t or "")) for i, t in ODD)
    assert tokens.token_counts(spark.createDataFrame([], EMPTY), PATH).count() == 0
