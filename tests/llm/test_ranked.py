import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import EMPTY, ODD, docs_of

from learnstream.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k=10):
    own = [(i, Counter(terms_of(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, total = len(own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        found = []
        for i, c, n in own:
            m = 25 + (75 * n * n_docs) // total
            s = sum(w[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms_of(text) if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [200, 1 << 18])
def test_ranks_equal_brute_force(spark, small, monkeypatch, block):
    """Real documents and items, in one block of items and in many."""
    monkeypatch.setattr(ranked, "BLOCK_CHARS", block)
    monkeypatch.setattr(ranked, "CELLS", 1 << 12)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    items = items[:8] + [(900, "the the the THE unheardofterm"), (901, "unheardofterm"), (902, ""), (903, None)]
    got = sorted(map(tuple, ranked.search(docs_of(spark, docs), items_of(spark, items)).collect()))
    assert got == sorted(brute(docs, items))


def test_terms_are_those_of_the_pattern():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(chr(rnd.choice([rnd.randrange(128), rnd.randrange(128, 400), 0x1F600, 0x3000])) for _ in range(40))
        assert [t.decode() for t in ranked.terms(text)] == terms_of(text)


def test_plan_shares_sums_and_keeps_every_item():
    """Nodes of the plan, taken apart again, are the items' terms; shared sets
    are added once."""
    rnd = random.Random(2)
    base = [b"t%d" % k for k in range(12)]
    items = {i: base[:rnd.randrange(13)] * rnd.choice([1, 1, 2]) + [b"r%d" % rnd.randrange(30) for _ in range(3)]
             for i in range(25)}
    plan = ranked.Plan(dict(items))
    names, symbols = sorted(plan.vocabulary, key=plan.vocabulary.get), len(plan.term_of)

    def apart(node):
        if node < symbols:
            return Counter([names[plan.term_of[node]]])
        a, b = plan.adds[node - symbols]
        assert max(a, b) < node
        return apart(a) + apart(b)

    for k, i in enumerate(plan.item_ids.tolist()):
        own = Counter()
        for node in plan.sums[plan.sums[:, 0] == k, 1].tolist():
            own += apart(node)
        assert own == Counter(items[i])
    assert len(plan.adds) + len(plan.sums) < 0.7 * sum(map(len, items.values()))
    # nodes of a round add nodes of earlier rounds only
    bounds = [*plan.levels, len(plan.adds)]
    assert all(np.all(plan.adds[a:b] < symbols + a) for a, b in zip(bounds, bounds[1:]))


def test_ties_repeats_odd_rows_and_empty_tables(spark):
    items = [(1, "five same TEXT here"), (1, "zzz"), (None, "same"), (2, "word"), (3, "x" * 200_000), (4, "é")]
    rows = [*ODD, *((100 + k, "same text here") for k in range(12))]
    want = [(1, "five same TEXT here"), *items[3:]]
    key = lambda r: tuple((x is None, x) for x in r)
    extra = items_of(spark, items).selectExpr("*", "1 AS n", "2 AS score", "3 AS chars")
    got = ranked.search(docs_of(spark, rows, extra=True), extra).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, want), key=key)
    empty_items = items_of(spark, [])
    assert ranked.search(docs_of(spark, rows), empty_items).count() == 0
    assert ranked.search(spark.createDataFrame([], EMPTY), items_of(spark, want)).count() == 0
