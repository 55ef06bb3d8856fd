"""Documents to token files in five stages; each is a table that the next one reads.

Every stage takes the columns of documents (doc_id, text, lang, source, n_chars)
by name and passes on the rows it keeps whole, other columns included; the last
one returns a row per written document.  An empty table passes through all of
them.  Rows with a null doc_id can be named by no decision on documents, so the
first three stages keep them; the mix copies them like others of their source.
Rows that repeat a doc_id are one document to the first three stages: all of them
go if the classifier or the benchmark rejects one, and one of them, whichever
comes first, stays behind the near-duplicates.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scorespark.llm.decontamination import without_benchmark
from scorespark.llm.mixing import mixed_documents
from scorespark.llm.quality import accepted
from scorespark.llm.simhash import keep_first
from scorespark.llm.token_files import token_output
from scorespark.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.7 or more; null and empty texts are scored like any other."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; one row of rows that repeat it."""
    return keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, so some rows repeat and some are gone."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, read back from the token files."""
    return token_output(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# A trained network and 64-bit XXH hashes are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
