"""Raw feed lines derived from the driver's ``events`` / ``nation`` tables.

The reference consumes four text feeds that are not shipped; FIXTURES.md
section 3 fixes deterministic rules that turn each ``events`` row into a
feed line (integer arithmetic on ``event_id``, ``user_id``, the ``k`` in
``props`` and ``ts``), and every so often into a further, malformed or odd line
that the parsers must drop or cope with.
Every adapter returns ``(pos bigint, value string)``: ``pos`` plays the
part of the feed position (it is the event id) and ``value`` the record text.
All of it is narrow projection over the scan: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnstream.functions.scalar import TAB, TIME_FORMAT, epoch_millis

# Fixed values of the feed rules (FIXTURES.md section 3).
PAGE_OF_EVENT = {"click": 1, "view": 2, "purchase": 3}
CORRECT_EVENTS = ("purchase", "view")                     # istrue = 1 for these
LEAST_LONG, LARGEST_LONG = "-9223372036854775808", "9223372036854775807"
SOURCE_TYPES = ("PC", "APP", "Other")                     # sourceType by id % 3


def _s(c: Column) -> Column:
    return c.cast("string")


def _emit(df: DataFrame, pos: Column, *lines: Column) -> DataFrame:
    """``(pos, value)`` rows: of every event its record and the further lines
    that are not null. They go through a generator, so that a line is built
    once, like a record read from a feed: a parser's filter on ``value`` is
    not pushed below it, so it does not build the line again."""
    made = F.array(*[F.struct(pos.alias("pos"), line.alias("value")) for line in lines])
    return df.select(F.inline(made)).where(F.col("value").isNotNull())


def base_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("u"),
        "event_type",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.date_format("ts", TIME_FORMAT).alias("t"),
        epoch_millis(F.col("ts")).alias("ms"),
    )


def _json(fields: list[tuple[str, Column, bool]]) -> Column:
    """Compact JSON object text from (name, value, quoted) triples."""
    parts: list[Column] = [F.lit("{")]
    for i, (name, value, quoted) in enumerate(fields):
        sep = "," if i else ""
        q = '"' if quoted else ""
        parts += [F.lit(f'{sep}"{name}":{q}'), _s(value), F.lit(q)]
    parts.append(F.lit("}"))
    return F.concat(*parts)


def register_lines(events: DataFrame) -> DataFrame:
    e = base_events(events).where(F.col("event_type") == "signup")
    u, c, t, i = _s(F.col("u")), _s(F.col("id") % 4), F.col("t"), F.col("id")
    return _emit(e, i, F.concat_ws(TAB, u, c, t),
                 F.when(i % 17 == 0, F.concat_ws(TAB, u, c)),
                 F.when(i % 19 == 0, F.concat_ws(TAB, u, c, F.lit(""))),
                 F.when(i % 23 == 0, F.concat_ws(TAB, u, F.lit(""), t)))


def qz_lines(events: DataFrame) -> DataFrame:
    e = base_events(events)
    i, k, t = F.col("id"), F.col("k"), F.col("t")
    uid = _s(F.col("u"))
    course = _s(501 + i % 2)
    point = _s(10 + k % 3)
    istrue = F.when(F.col("event_type").isin(*CORRECT_EVENTS), "1").otherwise("0")
    return _emit(e, i, F.concat_ws(TAB, uid, course, point, _s(k), istrue, t),
                 F.when(i % 17 == 0, F.concat_ws(TAB, uid, course)),
                 F.when(i % 19 == 0, F.concat_ws(TAB, uid, F.lit("501"), F.lit("10"), _s(k),
                                                 F.lit("1"), F.lit(""))),
                 F.when(i % 23 == 0, F.concat_ws(TAB, F.lit("x"), course, point, _s(k), F.lit("1"), t)))


def page_lines(events: DataFrame) -> DataFrame:
    e = base_events(events)
    i, u = F.col("id"), F.col("u")
    page = F.lit(None).cast("int")
    for kind, number in PAGE_OF_EVENT.items():
        page = F.when(F.col("event_type") == kind, number).otherwise(page)
    e = e.withColumn("page", page).where(F.col("event_type").isin(*PAGE_OF_EVENT))
    p = F.col("page")
    ip = F.concat_ws(".", F.lit("10"), _s(u % 256), _s(i % 256), F.lit("1"))
    full = _json([("uid", u, True), ("app_id", i % 2 + 1, True), ("device_id", i % 50, True),
                  ("ip", ip, True), ("last_page_id", p - 1, True), ("page_id", p, True),
                  ("next_page_id", p + 1, True)])
    return _emit(e, i, full,
                 F.when(i % 29 == 0, F.lit("not json")),
                 F.when(i % 31 == 0, F.lit("[1]")),
                 F.when(i % 37 == 0, F.lit("")),
                 F.when(i % 41 == 0, _json([("uid", u, True), ("page_id", p, False)])),
                 F.when(i % 43 == 0, F.concat(full, F.lit(" x"))),
                 F.when(i % 53 == 0, F.concat(full, F.lit("] junk"))))


def learn_lines(events: DataFrame) -> DataFrame:
    e = base_events(events)
    i, ms = F.col("id"), F.col("ms")
    src = (F.when(i % 3 == 0, SOURCE_TYPES[0]).when(i % 3 == 1, SOURCE_TYPES[1])
           .otherwise(SOURCE_TYPES[2]))
    ps = (i * 37) % 600
    head = [("uid", F.col("u"), False), ("cwareid", i % 4, False),
            ("videoid", i % 5, False), ("chapterid", i % 10, False)]
    edu = [("edutypeid", i % 3 + 1, False)]
    mid = [("subjectid", i % 6, False), ("sourceType", src, True), ("speed", i % 2 + 1, False)]
    te = ms + (i * 7919) % 90000
    times = [("ts", ms, False), ("te", te, False)]
    tail = [("ps", ps, False), ("pe", ps + (i * 13) % 61, False)]
    full = _json(head + edu + mid + times + tail)
    text = [(name, value, True) for name, value, _ in head + edu + mid + times]
    half = [("ps", F.concat(_s(ps), F.lit(".5")), False), ("pe", ps + 20, False)]
    # numbers that a long, and an int, cannot subtract
    far = [("ts", F.lit(LEAST_LONG), False), ("te", F.lit(LARGEST_LONG), False)]
    wide = [("ps", F.lit(-2147483648), False), ("pe", F.lit("1e12"), False)]
    back = [("ps", ps + 30, False), ("pe", ps + 10, False)]
    return _emit(e, i, full,
                 F.when(i % 29 == 0, F.lit("not json")),
                 F.when(i % 31 == 0, _json(head + edu + mid + tail)),
                 F.when(i % 37 == 0, _json(head + mid + times + tail)),
                 F.when(i % 41 == 0, _json(text + half)),
                 F.when(i % 43 == 0, F.concat(full, F.lit(" x"))),
                 F.when(i % 47 == 0, _json(head + edu + mid + times + back)),
                 F.when(i % 53 == 0, F.concat(full, F.lit("]"))),
                 F.when(i % 59 == 0, _json(head + edu + mid + far + tail)),
                 F.when(i % 61 == 0, _json(head + edu + mid + times + wide)))


def province_ranges(nation: DataFrame) -> DataFrame:
    """One IPv4 range per nation: ``10.(6n).0.0`` to ``10.(6n+5).255.255``."""
    n = F.col("n_nationkey").cast("long")
    base = 10 * 16777216
    return nation.select(
        F.col("n_name").alias("province"),
        (F.lit(base) + n * 6 * 65536).alias("ip_from"),
        (F.lit(base) + (n * 6 + 5) * 65536 + 65535).alias("ip_to"),
    )


def nested_ranges(nation: DataFrame) -> DataFrame:
    """Ranges within and across those of ``province_ranges``: one around all of them, per
    nation an inner one with one more inside, and a small one across its border."""
    n, base = F.col("n_nationkey").cast("long"), 10 * 16777216
    at = lambda a, b: F.lit(base) + (n * 6 + a) * 65536 + b

    def per_nation(name: str, low: Column, high: Column) -> DataFrame:
        return nation.select(F.concat(F.col("n_name"), F.lit(name)).alias("province"),
                             low.alias("ip_from"), high.alias("ip_to"))
    whole = nation.agg(F.min("n_name")).select(F.lit("ANY").alias("province"), F.lit(base).cast("long").alias("ip_from"),
                                               F.lit(base + 255 * 65536 + 65535).cast("long").alias("ip_to"))
    return (whole.union(province_ranges(nation))
            .union(per_nation(" CITY", at(1, 0), at(2, 32767)))
            .union(per_nation(" PARK", at(2, 4096), at(2, 20479)))
            .union(per_nation(" EDGE", at(5, 32768), at(6, 16383))))


FEEDS = {
    "register": register_lines,
    "qz": qz_lines,
    "page": page_lines,
    "course_learn": learn_lines,
}
