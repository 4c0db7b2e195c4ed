"""A corpus pipeline over the documents table, in five stages.

toxicity (rejected documents go), line dedup, SimHash near-dedup (one document of
each group stays), pseudonyms for personal data, best-fit packing.  Each stage is
a function ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import feistel, line_windows, packing, toxicity, trie_join
from eventide.llm.queries import PSEUDONYM_KEY
from eventide.session import retire, shared_dir
from eventide.sources.tables import table


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_windows.deduplicate(docs, short=True))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return trie_join.deduplicate(docs, shingle=4, bits=4)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(feistel.pseudonymize(docs, PSEUDONYM_KEY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: No SQL form: the classifier, SimHash and the tokenizer have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents.  A stage's copy goes when the next one is written."""
    base, read = shared_dir(spark, "pipeline"), None
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if read:
            retire(spark, read)
        read = path
    return docs
