"""Practice accuracy and mastery per (user, course, point) (A3-A6,
A20-A22).

Everything is aggregated in two levels: first per question of a key (a hot
key is combined map-side and spread by question), then per key over the
distinct questions, whose number is bounded by the question bank, not by the
data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnstream.functions.scalar import TIME_FORMAT, two_decimals

KEY = ["userid", "courseid", "pointid"]
# Fixed value: questions per knowledge point, the mastery denominator.
QUESTIONS_PER_POINT = 30


def _right(istrue: Column) -> Column:
    """Only the text "1" is a correct answer."""
    return F.when(istrue == "1", 1).otherwise(0)


def per_question(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY, "questionid").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_right(F.col("istrue"))).cast("long").alias("right"),
        F.min("createtime").alias("first_time"))


def _sorted_questions(q: Column) -> Column:
    """Distinct question ids in numeric order (text order among non-numbers)."""
    pairs = F.sort_array(F.collect_list(F.struct(q.try_cast("long").alias("num"), q.alias("q"))))
    return F.transform(pairs, lambda x: x["q"])


def question_set(rows: DataFrame) -> DataFrame:
    """A4 + A5: distinct question ids per key and the earliest create time."""
    return (per_question(rows).groupBy(*KEY)
            .agg(F.array_join(_sorted_questions(F.col("questionid")), ",").alias("questionids"),
                 F.min("first_time").alias("createtime")))


def point_history(rows: DataFrame, now: Column) -> DataFrame:
    """The question set with ``updatetime`` (F6): the clock is passed in."""
    return question_set(rows).withColumn("updatetime", F.date_format(now, TIME_FORMAT))


def rates(qz_sum: Column, qz_count: Column, qz_istrue: Column,
          per_point: int = QUESTIONS_PER_POINT) -> list[Column]:
    """Correct rate (unrounded and two decimals) and mastery, in the
    reference's double arithmetic order; no cap at 1."""
    correct = qz_istrue.cast("double") / F.nullif(qz_sum, F.lit(0)).cast("double")
    return [correct.alias("correct_rate"),
            two_decimals(qz_istrue, qz_sum).alias("correct_rate_2"),
            ((qz_count.cast("double") / float(per_point)) * correct).alias("mastery_rate")]


def point_detail(rows: DataFrame, per_point: int = QUESTIONS_PER_POINT) -> DataFrame:
    """A3 + A6: attempts, distinct questions, correct attempts and rates."""
    agg = per_question(rows).groupBy(*KEY).agg(
        F.sum("n").cast("long").alias("qz_sum"),
        F.count(F.lit(1)).cast("long").alias("qz_count"),
        F.sum("right").cast("long").alias("qz_istrue"))
    return agg.select(*KEY, "qz_sum", "qz_count", "qz_istrue",
                      *rates(F.col("qz_sum"), F.col("qz_count"), F.col("qz_istrue"), per_point))


def latest_attempt(rows: DataFrame) -> DataFrame:
    """Latest create time per (user, course, point, question)."""
    return rows.groupBy(*KEY, "questionid").agg(F.max("createtime").alias("createtime"))


def latest_by_answer(rows: DataFrame) -> DataFrame:
    """The same with the answer in the key."""
    return rows.groupBy(*KEY, "questionid", "istrue").agg(F.max("createtime").alias("createtime"))


def dedup_rate(rows: DataFrame, per_point: int = QUESTIONS_PER_POINT) -> DataFrame:
    """A22 (D7 fixed): distinct questions, distinct questions with any right
    attempt, their ratio as a double, and mastery on that ratio."""
    agg = per_question(rows).groupBy(*KEY).agg(
        F.count(F.lit(1)).cast("long").alias("done"),
        F.sum(F.when(F.col("right") > 0, 1).otherwise(0)).cast("long").alias("right_n"))
    right_rate = F.col("right_n").cast("double") / F.col("done").cast("double")
    return agg.select(*KEY, "done", "right_n", right_rate.alias("right_rate"),
                      ((F.col("done").cast("double") / float(per_point)) * right_rate).alias("mastery"))


# ---- state and incremental merge ------------------------------------------
#
# A key's question set (A4) is a bitmap in rows: one row for 64 whole-number ids
# (``word`` is the id div 64, ``bits`` the ids in it), one row, with ``bits`` 1,
# for any other text, a null included. Sets unite by OR; no array is built.

STATE = [*KEY, "word", "text"]


def _bitmap(q: Column) -> list[Column]:
    """word, text and bit of a question id. Only a number's usual form is taken
    as one: 7 and 07 are different questions."""
    num = q.try_cast("long")
    whole = F.coalesce(num.cast("string") == q, F.lit(False))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), num.bitwiseAND(63).cast("int"))
    return [F.when(whole, F.shiftright(num, 6)).alias("word"), F.when(~whole, q).alias("text"),
            F.when(whole, bit).otherwise(F.lit(1).cast("long")).alias("bit")]


def state_from(rows: DataFrame) -> DataFrame:
    """Practice state: bitmap rows of the questions, with their attempts, right
    attempts and first create time. One aggregation, combined map-side."""
    own = rows.select(*KEY, *_bitmap(F.col("questionid")), _right(F.col("istrue")).alias("right"), "createtime")
    return own.groupBy(*STATE).agg(
        F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"),
        F.sum("right").cast("long").alias("right"), F.min("createtime").alias("createtime"))


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge M: sums accumulate, bitmaps unite, the first create time of a
    stored key is kept (S9). The sides are dealt once, by key."""
    both = (old.withColumn("stored", F.lit(True)).unionByName(new.withColumn("stored", F.lit(False)))
            .repartition(*KEY))
    one = both.groupBy(*STATE).agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n"), F.sum("right").alias("right"),
        F.min(F.when(F.col("stored"), F.col("createtime"))).alias("before"),
        F.min(F.when(~F.col("stored"), F.col("createtime"))).alias("now"))
    key = Window.partitionBy(*KEY)
    first = F.coalesce(F.min("before").over(key), F.min("now").over(key))
    return one.select(*STATE, "bits", "n", "right", first.alias("createtime"))


def detail_of_state(state: DataFrame, per_point: int = QUESTIONS_PER_POINT) -> DataFrame:
    agg = state.groupBy(*KEY).agg(
        F.sum("n").cast("long").alias("qz_sum"), F.sum(F.bit_count("bits")).cast("long").alias("qz_count"),
        F.sum("right").cast("long").alias("qz_istrue"), F.min("createtime").alias("createtime"))
    return agg.select(*KEY, "qz_sum", "qz_count", "qz_istrue",
                      *rates(F.col("qz_sum"), F.col("qz_count"), F.col("qz_istrue"), per_point), "createtime")
