"""Feed parsers: raw ``value`` text -> typed rows.

Each parser is a narrow projection, a one-element generator and a filter, in
one whole-stage-codegen span with the scan. ``keep_rejects=True`` keeps malformed rows
with ``valid = false`` and every row's ``line`` instead of dropping them, for reject
counts and quarantine.

A number that its column cannot hold rejects its record: integers beyond 32 bits,
stamps outside ``0 .. MAX_STAMP`` and places in a video beyond ``MAX_PLACE`` seconds. What passes
can be subtracted and summed without overflow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnstream.functions.scalar import channel_of, field, tsv_width, watched_seconds

REGISTER_WIDTH = 3
QZ_WIDTH = 6

END = "_end"             # a mark of the parser behind a text, see ``_json_object``
PAGE_FIELDS = ("uid", "app_id", "device_id", "ip", "last_page_id", "page_id", "next_page_id")
MAX_STAMP = 253_402_300_799_999      # the last millisecond of the year 9999
MAX_PLACE = 1_000_000_000            # two of them differ by less than 2^31
MAX_INT = 2_147_483_647
LEARN_INTS = ("uid", "cwareid", "videoid", "chapterid", "edutypeid", "subjectid", "speed", "ps", "pe")
LEARN_COLUMNS = ("uid", "cwareid", "videoid", "chapterid", "edutypeid", "subjectid", "sourcetype",
                 "speed", "ts", "te", "ps", "pe", "secs")


def _finish(df: DataFrame, valid: Column, keep_rejects: bool) -> DataFrame:
    """Keep the valid rows (or flag them). The record passes through a
    one-element generator and is filtered above it: a filter is not pushed
    below a generator, so a line is parsed once, in generated code, where a
    plain ``where`` would run the parse again for every field it tests."""
    ok = F.coalesce(valid, F.lit(False))
    if keep_rejects:
        return df.withColumn("valid", ok)
    rec = F.struct(*[F.col(c) for c in df.columns], ok.alias("_keep"))
    return df.select(F.inline(F.array(rec))).where("_keep").drop("_keep")


def parse_register(lines: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """P1 + P2: exactly three tab fields -> uid, channel, createtime."""
    v = F.col("value")
    ok = tsv_width(v) == REGISTER_WIDTH
    out = lines.select(
        field(v, 0).try_cast("int").alias("uid"),
        channel_of(field(v, 1)).alias("channel"),
        field(v, 2).alias("createtime"),
        ok.alias("_ok"),
        *_line(keep_rejects),
    )
    return _finish(out, F.col("_ok"), keep_rejects).drop("_ok")


def parse_qz(lines: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """P1 + P3 + P7: six tab fields; user/course/point must be integers."""
    v = F.col("value")
    out = lines.select(
        field(v, 0).try_cast("int").alias("userid"),
        field(v, 1).try_cast("int").alias("courseid"),
        field(v, 2).try_cast("int").alias("pointid"),
        field(v, 3).alias("questionid"),
        field(v, 4).alias("istrue"),
        field(v, 5).alias("createtime"),
        (tsv_width(v) == QZ_WIDTH).alias("_ok"),
        *_line(keep_rejects),
    )
    ok = (F.col("_ok") & F.col("userid").isNotNull() & F.col("courseid").isNotNull()
          & F.col("pointid").isNotNull())
    return _finish(out, ok, keep_rejects).drop("_ok")


def _line(keep_rejects: bool) -> list[Column]:
    return [F.col("value").alias("line")] if keep_rejects else []


def _json_object(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``j``: the text's JSON object with these fields as text; ``_ok``: whether
    the text is one JSON object and nothing else. Read as the first of two elements of an
    array: text behind the object makes it malformed, or hides the closing mark (a
    hash of the text, which the text cannot well hold itself), or adds an element."""
    schema = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in (*fields, END)]))
    mark = F.xxhash64("value").cast("string")
    text = F.concat(F.lit("["), F.col("value"), F.lit(f',{{"{END}":"'), mark, F.lit('"}]'))
    read = lines.select("value", F.from_json(text, schema).alias("j"))
    closed = (F.size("j") == 2) & (F.get("j", F.lit(1))[END] == mark)
    return read.select("value", F.get("j", F.lit(0)).alias("j"), closed.alias("_ok")).withColumn(
        "_ok", F.col("_ok") & F.col("j").isNotNull())



def _whole(text: Column, low: int, high: int) -> tuple[Column, Column]:
    """(number, too large): text of a number as a whole one between two bounds,
    decimals cut toward zero; null for text that is no number, and for a number
    outside the bounds, which is flagged."""
    n, d = text.try_cast("bigint"), text.try_cast("double")
    # decimals and whole numbers beyond a long; NaN is no number
    other = F.when(d.isNotNull() & ~F.isnan(d), F.greatest(F.least(d, F.lit(9e18)), F.lit(-9e18)).cast("bigint"))
    whole = F.coalesce(n, other)
    return F.when(whole.between(low, high), whole), F.coalesce(~whole.between(low, high), F.lit(False))


def parse_page(lines: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """P4 + P5: JSON objects only; seven text fields, absent or null -> ''."""
    out = _json_object(lines, PAGE_FIELDS).select(
        *[F.coalesce(F.col("j")[f], F.lit("")).alias(f) for f in PAGE_FIELDS], "_ok", *_line(keep_rejects))
    return _finish(out, F.col("_ok"), keep_rejects).drop("_ok")


def parse_learn(lines: DataFrame, keep_rejects: bool = False,
                columns: Sequence[str] = LEARN_COLUMNS) -> DataFrame:
    """P4 + P6 + P8: JSON objects with both ``ts`` and ``te``; numbers may be
    written as text; absent ints, and those that are no number, -> 0; numbers beyond
    their bounds reject the record, whichever columns are asked for. ``secs``
    is whole watched seconds. Only the number fields and those that ``columns`` need are read."""
    g = F.col("j")
    need = [*LEARN_INTS, "ts", "te", *(["sourceType"] if "sourcetype" in columns else [])]
    bounds = dict.fromkeys(LEARN_INTS, (-MAX_INT - 1, MAX_INT)) | dict.fromkeys(("ps", "pe"), (-MAX_PLACE, MAX_PLACE))
    bounds |= dict.fromkeys(("ts", "te"), (0, MAX_STAMP))
    made, wrong = {}, F.lit(False)
    for c, (low, high) in bounds.items():
        made[c], beyond = _whole(g[c], low, high)
        wrong = wrong | beyond
    made |= {c: F.coalesce(made[c].cast("int"), F.lit(0)) for c in LEARN_INTS} | {"sourcetype": g["sourceType"]}
    held = [c for c in LEARN_COLUMNS if c in ("ts", "te") or c in columns and c != "secs"]
    out = _json_object(lines, need).select(
        *[made[c].alias(c) for c in held], (F.col("_ok") & ~wrong).alias("_ok"), *_line(keep_rejects))
    out = out.withColumn("_ok", F.col("_ok") & F.col("ts").isNotNull() & F.col("te").isNotNull())
    rows = _finish(out, F.col("_ok"), keep_rejects)
    rows = rows.withColumn("secs", watched_seconds(F.col("ts"), F.col("te")))
    return rows.select(*columns, *(["line", "valid"] if keep_rejects else []))


PARSERS = {
    "register": parse_register,
    "qz": parse_qz,
    "page": parse_page,
    "course_learn": parse_learn,
}


def rejected(lines: DataFrame, feed: str) -> DataFrame:
    """The lines of a feed that its parser rejects, as ``value``."""
    flagged = PARSERS[feed](lines, keep_rejects=True)
    return flagged.where(~F.col("valid")).select(F.col("line").alias("value"))
