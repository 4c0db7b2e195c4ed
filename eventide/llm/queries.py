"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import (
    alignment, byte_bpe, feistel, line_windows, multi_index, neighbour_graph, packing, prefix_counts, pstable, revisits, sql, toxicity, trie_join, winnowing,
)
from eventide.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op3_revisits": sql.REVISITS, "op5_line_windows": sql.LINE_WINDOWS,
                           "op11_hard_negatives": sql.HARD_NEGATIVES}

#: Key of the pseudonyms in the registered query and the pipeline; a real run
#: passes a secret of its own.
PSEUDONYM_KEY = "example-key"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edit_report(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.severity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.round("severity", 6).alias("severity"), F.round("p_toxic", 6).alias("p_toxic"), "grade",
                         (F.col("p_toxic") >= 0.5).alias("toxic"))


@query
def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(revisits.captures(table(spark, sf_dir, "pages")))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select("record_id", "url", "response_id", "outcome",
                        F.when(F.col("outcome") == "resolved", headers).alias("merged"))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_windows.deduplicate(table(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", "text", "n_lines", "n_removed")


@query
def op6_pstable_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


@query
def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feistel.pseudonymize(table(spark, sf_dir, "documents"), PSEUDONYM_KEY, count="n_replaced")
    return out.select("doc_id", "text", "n_replaced")


@query
def op8_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.budgets(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = trie_join.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multi_index.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), "vec_id % 100 = 0")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_neighbour_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)
