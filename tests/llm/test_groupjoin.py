import random
import re

import numpy as np
import pytest
from conftest_llm import EMPTY, ODD, docs_of

from learnstream.llm import groupjoin

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()


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
            if 90 * len(sets[b]) > 100 * len(sets[a]):
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in groupjoin.join(docs_of(spark, rows)).collect()}
    assert got == brute(rows)
    return got


def edited(rnd, words, share):
    return [f"w{rnd.randrange(10 ** 6)}" if rnd.random() < share else w for w in words]


def pair_at(rnd, size, extra_a, extra_b):
    both = rnd.integers(0, 2 ** 63, size, np.uint64) * np.uint64(2)
    new = lambda n: rnd.integers(0, 2 ** 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    return np.unique(np.concatenate([both, new(extra_a)])), np.unique(np.concatenate([both, new(extra_b)]))


def test_linked_sets_share_the_signatures_they_need():
    """At the very threshold, for all small sizes and many large ones, several ways to
    place the difference: no pair with fewer common parts than either side needs."""
    rnd = np.random.default_rng(0)
    for both in [*range(1, 200), *range(300, 4000, 217)]:
        most = both * 10 // 90
        for a in {0, most // 3, most // 2, most}:
            x, y = pair_at(rnd, both, a, most - a)
            assert 100 * len(np.intersect1d(x, y)) >= 90 * len(np.union1d(x, y))
            if len(x) != len(y) or not (x == y).all():
                (p, m), (q, n) = groupjoin.signatures(x, 90), groupjoin.signatures(y, 90)
                assert len(np.intersect1d(p, q)) >= max(m, n) >= 1, (both, a)


def test_a_shared_passage_gives_few_signatures():
    """Unrelated documents of which a third is the same passage share no part, nearly."""
    rnd = np.random.default_rng(1)
    for both, other in ((100, 200), (200, 100)):
        own = [[groupjoin.signatures(s, 90) for s in pair_at(rnd, both, other, other)] for _ in range(100)]
        assert np.mean([len(np.intersect1d(p, q)) >= max(m, n) for (p, m), (q, n) in own]) < 0.05


def test_bound_and_overlaps_are_exact():
    rnd = np.random.default_rng(2)
    sets = [np.unique(rnd.integers(0, 400, n, np.uint64) << np.uint64(40)) for n in (300, 320, 5, 340, 350)]
    opened = groupjoin.Opened(np.arange(5), sets)
    union = groupjoin.short(np.concatenate(sets))
    for x in [*sets, np.unique(rnd.integers(0, 500, 200, np.uint64) << np.uint64(40))]:
        want = [k for k, s in enumerate(sets) if 10 * len(np.intersect1d(x, s)) >= 5 * len(np.union1d(x, s))]
        assert opened.links(x, 50).tolist() == want
        assert groupjoin.qualifies(x, union, 50) or not want
    assert not groupjoin.qualifies(np.arange(1, 9, dtype=np.uint64) << np.uint64(50), union, 90)


@pytest.mark.parametrize("group", [4, 128])
def test_components_equal_brute_force(spark, small, monkeypatch, group):
    """Real texts, near copies around the threshold in groups of many, a chain of edits, short
    sets, and a passage that unrelated documents share."""
    monkeypatch.setattr(groupjoin, "GROUP", group)
    monkeypatch.setattr(groupjoin, "QUERIES", 8)
    rnd = random.Random(4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    base = [f"b{rnd.randrange(500)}" for _ in range(120)]
    for k in range(80):
        rows.append((10_000 + k, " ".join(edited(rnd, base, rnd.choice([0, 0.005, 0.01, 0.02, 0.03])))))
    chain = list(base) + [f"c{k}" for k in range(200)]
    for k in range(30):
        for _ in range(2):
            chain[rnd.randrange(len(chain))] = f"z{rnd.randrange(10 ** 6)}"
        rows.append((20_000 + k, " ".join(chain).upper()))
    for k in range(40):
        rows.append((30_000 + k, " ".join(f"s{j}" for j in range(k % 14))))
        rows.append((40_000 + k, " ".join(base + [f"u{k}-{j}" for j in range(60 + k)])))
    got = check(spark, rows)
    assert len({c for i, (_, c) in got.items() if 20_000 <= i < 20_030}) == 1


def test_odd_rows_and_empty_table(spark):
    rows = groupjoin.join(docs_of(spark, ODD, extra=True)).collect()
    got = sorted((r.doc_id or 0, r.component_id or 0, r.n_shingles > 0) for r in rows)
    assert got == [(0, 0, True), (1, 1, False), (2, 2, False), (3, 3, True), (3, 3, True), (4, 4, True), (5, 5, True),
                   (6, 6, True), (7, 7, True), (8, 7, True)]
    assert groupjoin.join(spark.createDataFrame([], EMPTY)).count() == 0
