import math
import zlib

import public_tokenizers
from conftest_llm import EMPTY, ODD, docs_of

import numpy as np

from learnstream.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")


def table():
    pieces = langid.Pieces(PATH)
    rnd = np.random.default_rng(3)
    return pieces, langid.smoothed(rnd.random((pieces.unknown + 1, 2)))


def all_segmentations(pieces, p, word):
    if not word:
        return np.ones(p.shape[1])
    total = np.zeros(p.shape[1])
    for n in range(1, len(word) + 1):
        at = pieces.index.get(word[:n], pieces.unknown if n == 1 else None)
        if at is not None:
            total = total + p[at] * all_segmentations(pieces, p, word[n:])
    return total


def test_forward_sums_all_segmentations():
    pieces, p = table()
    words = ["▁the", "▁éa", "▁tion", "▁日x", "▁", "▁ananas"]
    got = pieces.log_probabilities(words, p)
    for k, w in enumerate(words):
        want = np.log(all_segmentations(pieces, p, w))
        assert np.allclose(got[k], want) and np.allclose(pieces.long_log_probability(w, p), want)
    assert np.isfinite(pieces.long_log_probability("▁" + "ab" * 3000, p)).all()


def test_expected_counts_use_every_character_once():
    pieces, p = table()
    words = ["▁thetion", "▁on"]
    counts = pieces.expected(words, np.array([2.0, 1.0]), np.array([0, 1]), p)
    lens = np.array([len(x) for x in pieces.index] + [1])
    assert math.isclose((counts[:, 0] * lens).sum(), 2 * len(words[0]))
    assert math.isclose((counts[:, 1] * lens).sum(), len(words[1]))


def test_held_out_accuracy_and_fold(spark, small):
    docs = spark.read.parquet(small.replace("0.001", "0.01") + "/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify(docs, PATH).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_prediction_uses_the_text_alone(spark, small):
    """Held-out labels, sources and ids do not matter."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{small}/documents.parquet")
    other = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang"))).withColumn(
        "source", F.lit("y"))
    a, b = (sorted(map(tuple, langid.identify(d, PATH).collect())) for d in (docs, other))
    assert [x[:3] for x in a] == [x[:3] for x in b] and np.allclose([x[3] for x in a], [x[3] for x in b])


def test_long_unknown_words_stay_finite_and_alone():
    """30 to 45 characters that are no piece, beside ordinary texts: no text's
    score depends on its neighbours."""
    pieces, p = table()
    own = langid.Scorer(PATH, p)
    plain = ["bonjour le monde", "", "the hello of it"]
    alone = [own.texts([t])[0] for t in plain]
    for n in range(28, 46):
        odd = "\u1200" * n
        got = own.texts([odd, plain[0], odd + " x", plain[1], plain[2]])
        assert np.isfinite(got).all()
        for k, want in zip((1, 3, 4), alone):
            assert (got[k] == want).all()
        assert np.allclose(got[0], pieces.long_log_probability(langid.SPACE + odd, p))


def test_scripts_without_spaces_are_learned(spark):
    """Texts that are one run of 60 to 200 characters, in two alphabets of one script."""
    rnd = np.random.default_rng(5)
    own = [p for p in langid.Pieces(PATH).index if len(p) == 1 and "\u4e00" <= p <= "\u9fff"]
    half = len(own) // 2
    rows = []
    for i in range(300):
        chars = own[:half + half // 2] if i % 2 else own[half // 2:]
        rows.append((i, "".join(rnd.choice(chars, int(rnd.integers(60, 200)))), "ab"[i % 2]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(docs, PATH).collect()}
    held = [(r.lang_pred, rows[i][2]) for i, r in got.items() if r.held_out]
    assert len(held) > 30 and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_odd_rows_and_empty_table(spark, small):
    known = spark.read.parquet(f"{small}/documents.parquet")
    odd = docs_of(spark, ODD, extra=False).selectExpr("doc_id + 100000 AS doc_id", "text", "CAST(NULL AS STRING) AS lang")
    rows = langid.identify(known.select("doc_id", "text", "lang").union(odd).withColumnRenamed("n_chars", "score"),
                           PATH).where("doc_id >= 100000 OR doc_id IS NULL").collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and by[None].held_out is False
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (100001, 100002))
    none = langid.identify(docs_of(spark, ODD, extra=True).withColumn("lang", langid.F.lit(None).cast("string")), PATH)
    assert {r.lang_pred for r in none.collect()} == {"und"}
    empty = spark.createDataFrame([], EMPTY).withColumn("lang", langid.F.lit("en"))
    assert langid.identify(empty, PATH).count() == 0
