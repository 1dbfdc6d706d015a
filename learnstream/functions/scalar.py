"""Column-expression helpers. All are built-in Spark expressions (JVM side,
inside whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's meaning:
#   register platform code "1" is channel "PC", "2" is "APP"; anything else
#   (empty and unknown text included) is "Other".
CHANNEL_CODES = {"1": "PC", "2": "APP"}
OTHER_CHANNEL = "Other"
TAB = "\t"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def idiv(num: Column, den: Column | int) -> Column:
    """Integral division truncating toward zero (Java ``/`` on longs)."""
    if not isinstance(den, Column):
        den = F.lit(den)
    return F.call_function("div", num, den)


def drop_trailing_tabs(line: Column) -> Column:
    """Line without trailing tabs, so that splitting counts fields the way
    Java's ``String.split`` does (trailing empty fields vanish)."""
    return F.regexp_replace(line, r"\t+$", "")


def tsv_width(line: Column) -> Column:
    """Number of tab-separated fields, trailing empty fields not counted."""
    return F.size(F.split(drop_trailing_tabs(line), TAB))


def field(line: Column, i: int) -> Column:
    """The ``i``-th (0-based) tab-separated field of a line; null when the
    line is shorter."""
    return F.get(F.split(line, TAB), F.lit(i))


def channel_of(platform: Column) -> Column:
    expr = F.lit(OTHER_CHANNEL)
    for code, name in reversed(list(CHANNEL_CODES.items())):
        expr = F.when(platform == code, name).otherwise(expr)
    return expr


def watched_seconds(ts: Column, te: Column) -> Column:
    """Whole seconds between two epoch-millisecond stamps, toward zero."""
    return idiv(te - ts, 1000)


def epoch_millis(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ wall clock read as UTC, floored.
    Built from the date and clock parts, so no session-time-zone (or DST)
    conversion is involved."""
    days = F.date_diff(F.to_date(ts_ntz), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86400000 + F.hour(ts_ntz).cast("long") * 3600000
            + F.minute(ts_ntz).cast("long") * 60000
            + F.floor(F.date_part(F.lit("SECOND"), ts_ntz) * 1000).cast("long"))


TIME_TEXT = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"


def parse_time_text(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> TIMESTAMP_NTZ; null when malformed."""
    part = [F.regexp_extract(text, TIME_TEXT, i).try_cast("int") for i in range(1, 7)]
    return F.when(text.rlike(TIME_TEXT), F.try_make_timestamp_ntz(*part))


def epoch_seconds_of_text(text: Column) -> Column:
    """Epoch seconds of ``yyyy-MM-dd HH:mm:ss`` text read as a UTC wall
    clock; null for malformed text. Session-time-zone independent."""
    return F.floor(epoch_millis(parse_time_text(text)) / 1000).cast("long")


def half_even_percent(num: Column, den: Column) -> Column:
    """``num/den`` as whole-percent text rounded half to even, computed in
    exact integer arithmetic; ``"0%"`` when ``den`` is 0."""
    n100 = num.cast("long") * 100
    q = idiv(n100, F.nullif(den, F.lit(0)))
    r2 = (n100 - q * den) * 2
    rounded = (F.when(r2 > den, q + 1)
               .when((r2 == den) & (q % 2 == 1), q + 1)
               .otherwise(q))
    return F.when(den == 0, F.lit("0%")).otherwise(
        F.concat(rounded.cast("string"), F.lit("%")))


def two_decimals(num: Column, den: Column) -> Column:
    """``num/den`` rounded half up to two decimals, via integers:
    ``((200*num + den) div (2*den)) / 100``; null when ``den`` is 0."""
    return (idiv(num.cast("long") * 200 + den, F.nullif(den.cast("long") * 2, F.lit(0)))
            .cast("double") / 100.0)


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text to its 32-bit number; null for malformed text."""
    parts = [F.split_part(ip, F.lit("."), F.lit(i)).try_cast("long") for i in range(1, 5)]
    ok = F.size(F.split(ip, r"\.")) == 4
    for p in parts:
        ok = ok & p.isNotNull() & (p >= 0) & (p <= 255)
    return F.when(ok, parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3])
