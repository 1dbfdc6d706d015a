import random

import numpy as np

from learnstream.llm import topk


def brute(rows, k=5, every=50):
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, vq in {i: v for i, v in good if i % every == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(vq, v)), i) for i, v in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string, v long"
                               if rows and len(rows[0]) == 4 else "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, **kw).collect()))
    assert got == brute([r[:2] for r in rows], **kw)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(i % 7, 1) for _ in range(6)]) for i in range(600)]
    check(spark, rows, every=20)


def test_odd_vectors_ties_and_large_values(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 0.0]), (4, [float("inf"), 0.0]),
            (5, [1.0]), (6, []), (None, [1.0, 1.0]), (50, [0.5, 0.5])]
    rows += [(k, [1.0, 1.0]) for k in range(10, 30)] + [(60, [1e9, -1e9]), (61, [1e9, 1e9]), (61, [1e9, 1e9])]
    check(spark, [(*r, "x", 7) for r in rows])


def test_few_rows_and_empty_table(spark):
    check(spark, [(0, [1.0]), (1, [2.0])])
    check(spark, [(0, [1.0])])
    check(spark, [])


def test_conflicting_rows_of_a_query_and_empty_vectors(spark):
    """The least vector of a query's id, however rows are dealt; vectors without components score 0."""
    rows = [(0, [2.0, 0.0]), (0, [1.0, 5.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])]
    want = sorted(brute([rows[1], *rows[2:]]))
    for order in (rows, rows[::-1], [rows[2], rows[1], rows[3], rows[0], rows[4]]):
        for n in (1, 3):
            df = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(n)
            assert sorted(map(tuple, topk.top_k(df).collect())) == want
    check(spark, [(0, []), (1, []), (2, [])])
