import hashlib
import random
import re
import time

from conftest_llm import EMPTY, ODD, docs_of

from learnstream.llm import pii


def plain(t):
    """The base kinds by their patterns, nothing clever."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
        if 13 <= len(digits) <= 19 and (sum(digits[::-2]) + sum(doubled)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def base(t):
    return [s[:3] for s in pii.find(t) if s[0] in pii.BASE_KINDS]


def test_base_spans_equal_the_patterns():
    rnd = random.Random(3)
    bits = ["1", "2", "255", "256", ".", "@", "a", "b.c", "-", " ", "+", "(", ")", "4111 1111 1111 1111",
            "+1 (658) 555-3225", "x@y.z", "é", "10.0.0.1", "9", "\n"]
    for _ in range(20_000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30)))
        assert base(t) == plain(t), t


def test_long_runs_take_linear_time():
    text = "1" * 300_000 + "." * 100_000 + "a" * 300_000 + "@" + "1-" * 100_000 + "+1" + " " * 300_000
    t0 = time.perf_counter()
    pii.find(text)
    assert time.perf_counter() - t0 < 5


def test_added_kinds_need_a_checksum_or_context():
    assert [s[0] for s in pii.find("iban GB82 WEST 1234 5698 7654 32.")] == ["iban"]
    assert pii.find("iban GB83 WEST 1234 5698 7654 32.") == []
    assert [s[0] for s in pii.find("social security 078-05-1120")] == ["ssn"]
    assert pii.find("part 078-05-1120") == []
    for behind in ("", ".", " BIC COBADEFF", " und", " 12"):
        assert [(k, a, b) for k, a, b, _ in pii.find("IBAN DE89 3704 0044 0532 0130 00" + behind)] == [("iban", 5, 32)]
    assert pii.find("IBAN DE89 3704 0044 0532 0130 001") == []
    assert all(pii.find(f"ssn {x}") == [] for x in ("000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000"))
    with_words, without = (pii.find(t)[0][3] for t in ("my visa card 4111111111111111", "order 4111111111111111"))
    assert with_words > without


def test_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for r in docs.collect():
        want = plain(r.text or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        own = got[r.doc_id]
        assert own.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [own.n_email, own.n_ip, own.n_card, own.n_phone] == [
            sum(k == kind for k, _, _ in want) for kind in pii.BASE_KINDS]
        assert set(text.split(",")) - {""} <= set(own.spans.split(","))


def test_odd_rows_and_empty_table(spark):
    rows = pii.personal_data(docs_of(spark, ODD, extra=True)).collect()
    assert len(rows) == len(ODD) and all(r.n_email == 0 and r.spans == "" for r in rows)
    assert pii.personal_data(spark.createDataFrame([], EMPTY)).count() == 0
