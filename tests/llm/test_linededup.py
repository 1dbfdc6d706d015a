import random
from collections import defaultdict

from conftest_llm import EMPTY, ODD, docs_of

from learnstream.llm import linededup


def n_words(line):
    """Words one character at a time."""
    spaced, n, inside = 0, 0, False
    for c in line:
        unspaced = any(a <= ord(c) <= b for a, b in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF),
                                                     (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x3FFFF)))
        word = not unspaced and c not in " \t\n\v\f\r"
        spaced += word and not inside
        n, inside = n + unspaced, word
    return spaced + (n + 1) // 2


def brute(rows, min_words):
    """doc -> kept lines: every run of enough words, of any length, whose
    lines occur as a run at an earlier place goes."""
    docs = {i: t.split("\n") for i, t in rows if t is not None}
    gone = defaultdict(set)
    places = defaultdict(list)
    for i in sorted(docs):
        for at, line in enumerate(docs[i]):
            places[line].append((i, at))
    for i in sorted(docs):
        for at in range(len(docs[i])):
            for j, b in places[docs[i][at]]:
                if (j, b) >= (i, at):
                    break
                n = 0
                while at + n < len(docs[i]) and b + n < len(docs[j]) and docs[i][at + n] == docs[j][b + n]:
                    n += 1
                if sum(map(n_words, docs[i][at:at + n])) >= min_words:
                    gone[i] |= set(range(at, at + n))
    return {i: [x for k, x in enumerate(docs[i]) if k not in gone[i]] for i in docs}


def check(spark, rows, min_words=10):
    got = {r.doc_id: r for r in linededup.dedup_lines(docs_of(spark, rows), min_words).collect()}
    want = brute(rows, min_words)
    for i, t in rows:
        if t is None:
            assert got[i].text is None
        else:
            kept = got[i].n_lines - sum(x.end - x.place for x in got[i].deleted)
            assert kept == len(want[i]) and got[i].text == "\n".join(want[i]), i


MIXED = ["一" * 20, "一" * 19 + " a", "一" * 17 + "。x", "a\tb\tc\td\te\tf\tg\th\ti\tj", "ไทย" * 7, "a  b   c d e f g h i",
         "カタカナ hiragana ひらがな 漢字 𠀀 é è", " \t ", "a\u00a0b\u3000c\x1cd", "한국어 는 띄어쓰기 가 있다"]


def test_words_of_lines_equal_the_plain_count_and_sql():
    import re
    import duckdb
    from learnstream.llm.oracle import SQL
    counts = [n_words(x) for x in MIXED]
    assert [linededup.n_words(x) for x in MIXED] == counts and counts[:4] == [10, 11, 10, 10]
    form = re.search(r"SELECT \*, (.*?) AS w", SQL["op9_line_dedup"], re.S).group(1)
    got = [duckdb.execute(f"SELECT {form} FROM (SELECT ? AS line)", [x]).fetchone()[0] for x in MIXED]
    assert got == counts


def test_lines_without_spaces_equal_brute_force(spark):
    rnd = random.Random(9)
    check(spark, [(k, "\n".join(rnd.choice(MIXED) for _ in range(rnd.randint(1, 5)))) for k in range(40)])


def test_random_lines_equal_brute_force(spark):
    rnd = random.Random(8)
    lines = ["a b c", "d e", "f", "", "g h i j k", "l m n o p q r s t u v w", "x y"]
    rows = [(k, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 14)))) for k in range(120)]
    rows += [(200 + k, rows[k][1]) for k in range(0, 120, 7)] + [(300, "\n".join(["x y"] * 40)), (301, None)]
    check(spark, rows)


def test_real_texts_equal_brute_force(spark, small):
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()])


def test_first_copy_stays_and_sources_are_named(spark):
    run = "one two three four five six\nseven eight nine ten eleven"
    rows = [(5, "start\n" + run), (9, run + "\nend"), (7, "x\n" + run + "\ny")]
    got = {r.doc_id: r for r in linededup.dedup_lines(docs_of(spark, rows)).collect()}
    assert got[5].text == rows[0][1] and got[7].text == "x\ny" and got[9].text == "end"
    assert got[5].sources == [] and got[7].sources == [5] and got[9].sources == [5]


def test_odd_rows_and_empty_table(spark):
    rows = linededup.dedup_lines(docs_of(spark, ODD, extra=True)).collect()
    got = sorted((r.doc_id or 0, r.text) for r in rows if r.doc_id != 1)
    assert got == sorted((i or 0, t) for i, t in ODD if i != 1)      # nothing repeats ten words
    assert rows[0].lang == "x" and len(rows) == len(ODD)
    twice = [(1, "word " * 12), (1, "word " * 12), (2, "word " * 12)]
    texts = sorted(r.text for r in linededup.dedup_lines(docs_of(spark, twice)).collect())
    assert texts == ["", "word " * 12, "word " * 12]                 # equal rows are one document
    assert linededup.dedup_lines(spark.createDataFrame([], EMPTY)).count() == 0


def test_a_document_without_id_comes_first(spark):
    run, other = ("\n".join(f"{x}{j} b c d e f" for j in range(3)) for x in "ab")
    rows = [(None, run + "\nx"), (0, run + "\ny"), (-7, "z\n" + run), (None, "p\n" + other + "\nq\n" + other)]
    got = {r.text: (r.doc_id, r.n_deleted, r.sources) for r in linededup.dedup_lines(docs_of(spark, rows)).selectExpr(
        "text", "doc_id", "size(deleted) AS n_deleted", "sources").collect()}
    assert got == {run + "\nx": (None, 0, []), "y": (0, 1, []), "z": (-7, 1, []), "p\n" + other + "\nq": (None, 1, [])}
