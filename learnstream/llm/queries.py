"""The registered queries of the subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnstream.llm import chat, decontam, groupjoin, langid, linededup, neardup, packing, pii, ranked, runs, tokens, topk, warc
from learnstream.llm.common import scratch_path, table
from learnstream.llm.oracle import SQL  # noqa: F401

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"),
                               public_tokenizers.path("piece_bpe_32k.model"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), out)
    return warc.read(spark, out).drop("url")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("deleted", lambda x: F.concat_ws("-", x["place"].cast("string"), x["end"].cast("string")))
    n_deleted = F.aggregate("deleted", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["place"])
    return out.select("doc_id", "n_lines", n_deleted.alias("n_deleted"), F.array_join(spans, ",").alias("deleted"),
                      "sources", "text")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_chat_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(chat.derived(table(spark, sf_dir, "conversations")), chat.TOOLS)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(runs.planted(table(spark, sf_dir, "documents"))))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groupjoin.join(table(spark, sf_dir, "documents"))
