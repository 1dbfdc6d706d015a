import random
import re

import numpy as np
from conftest_llm import EMPTY, ODD, docs_of

from learnstream.llm import neardup
from learnstream.llm.shingles import shingle_set

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """doc_id -> (set size, component) over all pairs."""
    sets = {i: sets_of(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if 85 * len(sets[b]) > 100 * len(sets[a]):
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(spark, rows):
    got = {r.doc_id: r for r in neardup.near_duplicates(docs_of(spark, rows)).collect()}
    want = brute(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def mutated(rnd, words, share):
    return " ".join(f"w{rnd.randrange(10 ** 6)}" if rnd.random() < share else w for w in words)


def test_components_equal_brute_force(spark, small, monkeypatch):
    """Real texts, a chain of edits, and a large group around the threshold
    that is compared in blocks and in chunks."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "CHUNK", 8)
    rnd = random.Random(4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    base = [f"b{rnd.randrange(500)}" for _ in range(120)]
    for k in range(60):
        rows.append((10_000 + k, mutated(rnd, base, rnd.choice([0, 0.005, 0.01, 0.02, 0.03]))))
    chain = list(base) + [f"c{k}" for k in range(200)]
    for k in range(30):
        chain[rnd.randrange(len(chain))] = f"z{k}"
        rows.append((20_000 + k, " ".join(chain).upper()))
    for k in range(12):
        rows.append((30_000 + k, " ".join(f"s{j}" for j in range(k % 6))))
    check(spark, rows)


def test_register_agreement_estimates_jaccard():
    rnd = np.random.default_rng(0)
    for n in (30, 300, 3000):
        a = np.unique(rnd.integers(0, 2 ** 63, n, np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[:int(0.9 * n)], rnd.integers(0, 2 ** 63, n // 10, np.uint64) * np.uint64(2)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        regs = neardup.registers([a, b])
        assert abs(neardup.estimate(regs[0], regs[1:])[0] - true) < 0.12
        assert (neardup.band_keys(regs)[0] == neardup.band_keys(regs)[1]).any()


def test_odd_rows_and_empty_table(spark):
    rows = neardup.near_duplicates(docs_of(spark, ODD, extra=True)).collect()
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in rows)
    assert got == [(0, 0), (1, 1), (2, 2), (3, 3), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 7)]
    assert neardup.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0
    assert len(shingle_set("\x00\t\r\n  　é", 5)) == 1
