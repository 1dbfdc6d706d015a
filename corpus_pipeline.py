"""The corpus pipeline: language ID, line dedup, near-duplicates, benchmark
decontamination, packing. Each stage takes (spark, docs, sf_dir) and works on
all that its predecessor kept; all but the last return the columns of
``documents``.

Null and empty texts have no letter and go in the first stage; null ids pass all stages; columns
beside doc_id, text and lang pass through whatever their names (n_chars follows a cut text), and do
not reach the packed pieces. An empty table passes as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnstream.llm import decontam, langid, linededup, neardup, packing
from learnstream.llm.common import free_names, materialize, scratch_path, table

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARE, ROWS = 80, 5          # near copies: from 80 of 100 on, found by 51 bands of 5 registers
MIN_SCORE = 0.5              # share of the best language that a document needs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, those no language has half of, and those
    that pieces drawn alike explain better than any language."""
    langs, p = langid.with_background(*langid.train(docs, VOCABULARY))
    name, score = free_names(docs.columns, "_language", "_language_score")
    told = langid.with_language(docs, langs, p, VOCABULARY, (name, score))
    kept = told.where((F.col(name) != langid.UNDETERMINED) & (F.col(score) >= MIN_SCORE))
    # without any labelled document there is nothing to decide by
    return (kept if langs else told).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later copies of line runs; documents of which nothing is left go."""
    names = free_names(docs.columns, "_n_lines", "_deleted", "_copied")
    out = linededup.dedup_lines(docs, names=tuple(names))
    whole = F.size(names[1]) == 0
    kept = out.where(whole | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        n_chars = F.when(whole, F.col("n_chars")).otherwise(F.length("text"))
        kept = kept.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose id and text (as ``mark``) are not in ``gone``. The ids
    are written first, so Spark plans the join by their size and deals no texts
    if they are few."""
    ids = materialize(gone.select("doc_id", "mark").distinct(), "gone")
    return docs.join(ids, same(docs, ids), "left_anti")


def same(docs: DataFrame, ids: DataFrame) -> Column:
    return docs["doc_id"].cast("long").eqNullSafe(ids["doc_id"]) & (F.xxhash64(docs["text"]) == ids["mark"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group: one of the smallest id."""
    found = materialize(neardup.documents(docs.select("doc_id", "text"), SHARE, ROWS)
                        .where(~F.col("kept") | (F.col("n_rows") > 1)), "found")
    rest = without(docs, found)
    again = materialize(found.where("kept").select("doc_id", "mark"), "again")
    if not again.limit(1).count():
        return rest
    # rows that repeat an id and a text
    mark, = free_names(docs.columns, "_mark")
    one = docs.join(again, same(docs, again), "left_semi").withColumn(mark, F.xxhash64("text"))
    return rest.union(one.dropDuplicates(["doc_id", mark]).select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark. An item of fewer than
    ``decontam.MIN_WORDS`` words is too common a phrase to drop documents for."""
    found = decontam.leaks(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"), by_text=True)
    return without(docs, found.where(F.col("n_words") >= decontam.MIN_WORDS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Language scores, components and packing are beyond SQL; tests check the
#: stages against brute force.
ORACLE_SQL = None
