"""Operator 2: personal data in texts.

Regular expressions propose spans, validators confirm them (part range of an
IP address, Luhn for card numbers, digit count of phone numbers, mod 97 for
IBANs), and words near a span raise or lower its score. Base kinds (email,
ip, card, phone) are kept whatever their score; the kinds that the method
adds (iban, ssn) are kept from ``ACCEPT`` on.

All patterns run in time linear in the text: emails are found from their
``@``, and no pattern starts twice inside one run of digits.

Nulls: a null text is empty and has no spans; a null id is kept. Repeated
rows are answered each on its own. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, per_batch

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
ACCEPT = 0.5
CONTEXT_CHARS = 40           # text looked at on either side of a span
CONTEXT_STEP = 0.2
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}

# Context words by kind: those that speak for it, those against (fixed values).
FOR = {
    "email": {"email", "mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "login"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "payment", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono"},
    "iban": {"iban", "bank", "account", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
}
AGAINST = {
    "email": set(), "ip": {"version", "release", "section"}, "card": {"order", "isbn", "serial"},
    "phone": {"version", "order"}, "iban": {"serial"}, "ssn": {"order", "part", "serial"},
}

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9][0-9.]*+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
NUMBER = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Characters of an IBAN by country (public registry).
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22,
    DK=18, DO=28, EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28,
    IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24,
    ME=22, MK=19, MR=27, MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31,
    SE=24, SI=19, SK=24, SM=27, ST=25, SV=28, TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20)
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NOT_DIGIT = re.compile(r"[^0-9]+")
WORD = re.compile(r"[a-z]+")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    """The doubled digits, every second from the right, add their own digits."""
    n = [int(d) for d in reversed(digits)]
    return (sum(n[::2]) + sum(d // 5 + 2 * d % 10 for d in n[1::2])) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[Span]:
    """The characters before an ``@`` reach back to the previous match at most."""
    free = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            free = m.end()


def ips(text: str) -> Iterator[Span]:
    for run in DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in IP.finditer(text, run.start(), run.end()):
                parts = [p.lstrip("0") for p in m.groups()]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    yield m.span()


def cards(text: str) -> Iterator[Span]:
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[Span]:
    """As many characters as the country's have, with single spaces between; of a country
    without a known length, all there are."""
    free = 0
    for m in IBAN_START.finditer(text):
        at, n = m.start(), IBAN_LENGTHS.get(m[0][:2])
        if at < free:
            continue
        if n:
            own = IBAN_OF[n].match(text, at)
        else:
            own = IBAN.match(text, at)
        if own and mod97(own[0].replace(" ", "")):
            free = own.end()
            yield own.span()


IBAN_OF = {n: re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in set(IBAN_LENGTHS.values())}


def ssns(text: str) -> Iterator[Span]:
    """Without the areas, groups and serials that are never issued."""
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def score(text: str, kind: str, span: Span) -> float:
    near = text[max(0, span[0] - CONTEXT_CHARS):span[0]] + " " + text[span[1]:span[1] + CONTEXT_CHARS]
    seen = set(WORD.findall(near.lower()))
    value = PRIOR[kind] + CONTEXT_STEP * (len(seen & FOR[kind]) - len(seen & AGAINST[kind]))
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start; code points."""
    out = []
    finders = {"email": emails} if "@" in text else {}
    if DOTTED.search(text):
        finders |= {"ip": ips, "card": cards}
        if "+" in text:
            finders["phone"] = phones
        finders |= {"iban": ibans, "ssn": ssns}
    for kind, finder in finders.items():
        for start, end in finder(text):
            value = score(text, kind, (start, end))
            if kind in BASE_KINDS or value >= ACCEPT:
                out.append((kind, start, end, value))
    return out


def written(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


COLUMNS = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
           "spans string, scores string")


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, all spans and scores."""
    bound_batches(docs.sparkSession)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [find(t or "") for t in b.column(1).to_pylist()]
        base = [[s for s in spans if s[0] in BASE_KINDS] for spans in found]
        cols = [b.column(0)]
        cols += [pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64())
                 for kind in BASE_KINDS]
        cols += [pa.array(c, pa.string()) for c in (
            [hashlib.sha256(written(s).encode()).hexdigest() for s in base],
            [written(s) for s in found],
            [",".join(f"{s[3]:.2f}" for s in spans) for spans in found])]
        return pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_batch(run), COLUMNS)
