import random

import pytest
from conftest_llm import EMPTY, ODD, docs_of

from learnstream.llm import decontam


def plain_alignment(a, b):
    """Best local alignment score by the full recurrence."""
    best, prev = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, prev[j - 1] + (decontam.MATCH if x == y else decontam.MISMATCH),
                           prev[j] + decontam.GAP, row[-1] + decontam.GAP))
        best, prev = max(best, *row), row
    return best


def test_alignment_equals_the_recurrence():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(1, 12))] for _ in range(2))
        score, equal, first, stop = decontam.align(a, b)
        assert score == plain_alignment(a, b) and 0 <= first <= stop <= len(b)
        assert equal <= min(len(a), stop - first)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


WORDS = [f"w{k}" for k in range(400)]


def planted():
    rnd = random.Random(6)
    items = [(k, " ".join(rnd.choice(WORDS) for _ in range(30))) for k in range(8)]
    docs, want = [], {}
    for k in range(60):
        text = [rnd.choice(WORDS) for _ in range(200)]
        if k % 3 == 0:
            item = k // 3 % 8
            copy = items[item][1].upper().split()
            if k % 2:                                # an edited copy
                for j in range(0, 30, 6):
                    copy[j] = "new"
                del copy[14]
            at = rnd.randrange(200)
            text[at:at] = [w + "," for w in copy]
            want[k] = item
        docs.append((k, " ".join(text)))
    return docs, items, want


@pytest.mark.parametrize("seeds", [decontam.SLICE_SEEDS, 60])
def test_planted_copies_are_found_and_clean_documents_left(spark, monkeypatch, seeds):
    monkeypatch.setattr(decontam, "SLICE_SEEDS", seeds)
    docs, items, want = planted()
    rows = decontam.leaks(docs_of(spark, docs), items_of(spark, items)).collect()
    assert {r.doc_id: r.item_id for r in rows} == want and len(rows) == len(want)
    for r in rows:
        assert (r.score == 1) == (r.doc_id % 2 == 0) and r.n_words == 30
        text = dict(docs)[r.doc_id].split()
        assert text[r.start].lower().strip(",") in (items[r.item_id][1].split()[0], items[r.item_id][1].split()[1])
        assert r.stop - r.start in range(28, 32)


def test_a_passage_in_a_third_of_all_documents(spark):
    item = " ".join(f"q{k}" for k in range(20))
    docs = [(k, f"a{k} b{k} " + (item if k % 3 == 0 else f"c{k}")) for k in range(300)]
    rows = decontam.leaks(docs_of(spark, docs), items_of(spark, [(1, item)])).collect()
    assert sorted(r.doc_id for r in rows) == list(range(0, 300, 3))


EDITS = {
    "every 3rd word replaced": lambda w, rnd: ["new" if k % 3 == 2 else x for k, x in enumerate(w)],
    "every 4th word replaced": lambda w, rnd: ["new" if k % 4 == 3 else x for k, x in enumerate(w)],
    "every 5th word replaced": lambda w, rnd: ["new" if k % 5 == 4 else x for k, x in enumerate(w)],
    "every 3rd word left out": lambda w, rnd: [x for k, x in enumerate(w) if k % 3 != 2],
    "a word behind every 2nd": lambda w, rnd: [y for k, x in enumerate(w) for y in ([x, "new"] if k % 2 else [x])],
    "a quarter at random": lambda w, rnd: ["new" if rnd.random() < 0.25 else x for x in w],
}


@pytest.mark.parametrize("share", [1, 3])
def test_recall_of_edited_copies(spark, share):
    """Of the pairs that plain alignment reports, by kind of edit: edited copies in all
    documents, where no seed is rare for long, and in a third of them."""
    rnd = random.Random(12)
    items = [(k, " ".join(rnd.choice(WORDS) for _ in range(rnd.choice([15, 30, 57])))) for k in range(12)]
    docs, want = [], {}
    for copy in range(1 if share == 1 else 20):
        for name, edit in EDITS.items():
            for i, item in items:
                k, new = len(docs), edit(item.split(), rnd)
                noise = [[rnd.choice(WORDS) for _ in range(60)] for _ in range(2)]
                docs.append((k, " ".join(noise[0] + new + noise[1])))
                if plain_alignment(item.split(), new) / (decontam.MATCH * len(item.split())) >= decontam.LEAK:
                    want[k, i] = name
    docs += [(len(docs) + k, " ".join(rnd.choice(WORDS) for _ in range(200))) for k in range((share - 1) * len(docs))]
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs_of(spark, docs), items_of(spark, items)).collect()}
    for name in EDITS:
        own = [pair for pair, of in want.items() if of == name]
        assert len(own) >= 12 and len(got & set(own)) >= 0.95 * len(own), name


def test_short_items_and_one_word_over_and_over_are_found_whole(spark):
    items = items_of(spark, [(1, "Alpha"), (2, "beta gamma"), (3, "one two three"), (4, "ha " * 21), (5, "no such words")])
    docs = docs_of(spark, [(1, "x alpha, y"), (2, "beta-gamma beta gamma"), (3, "one two"), (4, "zero one two three"),
                           (5, "ha " * 20), (6, "so " + "ha " * 30), (7, "beta"), (8, "gamma beta"), (9, "one two"),
                           (9, "three")])
    rows = decontam.leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.score, r.start, r.stop) for r in rows) == [
        (1, 1, 1.0, 1, 2), (2, 2, 1.0, 0, 2), (4, 3, 1.0, 1, 4), (6, 4, 1.0, 1, 22)]


def test_windows_are_as_long_as_the_items_of_their_seeds(spark):
    """One long item does not widen the passages of others; alignment holds one row."""
    rnd = random.Random(5)
    long_item, short_item = " ".join(f"l{k}" for k in range(20_000)), " ".join(f"s{k}" for k in range(15))
    docs = [(1, " ".join(rnd.choice(WORDS) for _ in range(5000)) + " " + short_item + " z" * 5000), (2, long_item)]
    found, kept = decontam.passages, []

    def spy(*args):
        kept.append(found(*args))
        return kept[-1]

    decontam.passages = spy
    try:
        rows = decontam.leaks(docs_of(spark, docs), items_of(spark, [(1, long_item), (2, short_item)])).collect()
    finally:
        decontam.passages = found
    assert sorted((r.doc_id, r.item_id, r.score) for r in rows) == [(1, 2, 1.0), (2, 1, 1.0)]
    windows = {r.doc_id: len(r.window.split()) for r in kept[0].where("window IS NOT NULL").collect()}
    assert windows[1] <= 15 * 3 + decontam.SEED and windows[2] == 20_000


def test_runs_of_any_number_of_words_have_hashes():
    import numpy as np
    h = np.arange(60, dtype=np.uint64)
    for n in (1, 2, 8, 9, 17, 40, 60):
        runs = decontam.polynomial(h, n)
        assert len(set(runs.tolist())) == len(runs) == 61 - n
        assert runs[3 if n < 58 else 0] == decontam.whole_hash(h[3:3 + n] if n < 58 else h[:n])
    assert len(decontam.polynomial(h[:5], 9)) == 0


def test_odd_rows_and_empty_tables(spark):
    items = items_of(spark, [(1, None), (2, ""), (3, "too short"), (None, "a null id has words, five of them"),
                             (4, "same text here and more"), (4, "same text here and more")])
    docs = docs_of(spark, ODD + [(9, "Same text here, AND more.")] * 2, extra=True)
    rows = decontam.leaks(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in rows) == [(0, 0), (9, 4)]
    assert decontam.leaks(docs, items_of(spark, [])).count() == 0
    assert decontam.leaks(spark.createDataFrame([], EMPTY), items).count() == 0


@pytest.mark.parametrize("n_docs", [30, 900])
def test_edited_copies_in_a_third_of_all_documents_equal_plain_alignment(spark, n_docs):
    """Few seeds of the items survive, in many documents; whether a pair is
    reported depends on its alignment alone, not on the size of the corpus."""
    items = [(1, " ".join(f"p{k}" for k in range(15))), (2, " ".join(f"q{k}" for k in range(40))),
             (3, " ".join(f"r{k}" for k in range(40)))]
    fourth = " ".join("new" if k % 4 == 3 else f"p{k}" for k in range(15))
    # one run of four words, two seeds, then two words of every three
    two_seeds = " ".join("new" if k > 3 and k % 3 == 1 else f"q{k}" for k in range(40))
    half = " ".join(f"r{k}" for k in range(20))
    less = " ".join(f"r{k}" for k in range(12))
    docs = [(k, f"a{k} b{k} " + (f"{fourth} x{k} {two_seeds} y{k} {half}" if k % 3 == 0 else less) + f" c{k}")
            for k in range(n_docs)]
    rows = decontam.leaks(docs_of(spark, docs), items_of(spark, items)).collect()
    want = {}
    for k, text in docs[:6]:
        for i, item in items:
            score = plain_alignment(item.split(), text.split()) / (decontam.MATCH * len(item.split()))
            if score >= decontam.LEAK:
                want[k, i] = score
    assert len(want) == 6
    assert {(r.doc_id, r.item_id): r.score for r in rows} == {
        (k, i): want[k % 6, i] for k, _ in docs for i, _ in items if (k % 6, i) in want}
