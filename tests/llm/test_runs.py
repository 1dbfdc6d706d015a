import hashlib
import random
import re
import zlib

import pytest
from conftest_llm import EMPTY, ODD, docs_of
from hypothesis import given, settings
from hypothesis import strategies as st

from learnstream.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=12):
    """(start, period, length) of all runs, period by period."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in out.items())


def solved(texts):
    doc, q, start, end = (x.tolist() for x in runs.fragments(texts))
    out = [[] for _ in texts]
    for d, p, s, e in zip(doc, q, start, end):
        if e - s >= max(12, 2 * p):
            out[d].append((s, p, e - s))
    return [sorted(x) for x in out]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=24), st.integers(1, 9)), max_size=6))
def test_all_runs_of_powers_are_found(parts):
    texts = [w * k for w, k in parts] + [[x for w, k in parts for x in w * k]]
    assert solved(texts) == [brute(w) for w in texts]


@pytest.mark.parametrize("pairs", [40, 1 << 20])
def test_runs_across_groups_of_tiles(monkeypatch, pairs):
    """Long runs, in one group of tiles and cut by many; strings full of squares."""
    monkeypatch.setattr(runs, "PAIRS", pairs)
    rnd = random.Random(3)
    texts = [[b"w"] * 700, [b"%d" % (k % 133) for k in range(900)], [b"%d" % rnd.randrange(2) for _ in range(600)]]
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(11):
        a, b = b, b + a
    thue = [b"%d" % (bin(k).count("1") % 2) for k in range(512)]
    texts += [b, thue, [], [b"x"], texts[1][:400] + texts[2] + texts[1][:400]]
    assert solved(texts) == [brute(w) for w in texts]


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    w = WORD.findall(text or "")
    w = w if doc_id is None else planted(doc_id, w)
    found = brute(w)
    gone = {i for s, q, n in found for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(found, key=lambda r: (-r[2], r[0], r[1]), default=None)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, q, n in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_brute_force(spark, small):
    from learnstream.llm.queries import QUERIES
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, small).collect()))
    assert got == sorted(expected(r.doc_id, r.text) for r in rows)
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows_and_empty_table(spark):
    rows = [(i, (t or "")[:4000] or t) for i, t in ODD]
    got = runs.digests(runs.periodic_runs(runs.planted(docs_of(spark, rows, extra=True)))).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    long = runs.periodic_runs(docs_of(spark, ODD)).where("size(runs) > 0").collect()
    assert [(r.doc_id, r.runs[0].length, r.collapsed) for r in long] == [(4, 50_000, "word")]
    assert runs.periodic_runs(spark.createDataFrame([], EMPTY)).count() == 0


def test_fragments_are_stitched_by_document_and_period(spark):
    """Cut fragments of one run, two runs that overlap by less than their period,
    other periods and documents."""
    found = spark.createDataFrame(
        [(1, 5, 0, 30), (1, 5, 20, 60), (1, 5, 57, 90), (1, 7, 0, 30), (2, 5, 20, 60), (1, 5, 100, 108)],
        "row long, period long, start long, end long")
    got = sorted(map(tuple, runs.stitched(found, 12).collect()))
    assert got == [(1, 5, 0, 60), (1, 5, 57, 33), (1, 7, 0, 30), (2, 5, 20, 40)]


def test_too_short_runs_are_refused():
    with pytest.raises(ValueError):
        runs.fragments([[b"a"] * 9], 4)
