"""Registered queries of the subpackage, each over whole tables, and the SQL to check them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.llm.decontamination import benchmark_overlaps
from scorespark.llm.html_text import visible_text
from scorespark.llm.language_model import language_model_scores
from scorespark.llm.licences import file_licences
from scorespark.llm.merkle import merkle_manifest
from scorespark.llm.mixing import mix_table
from scorespark.llm.periodic import periodic_runs
from scorespark.llm.projected_neighbours import nearest_neighbours
from scorespark.llm.quality import quality_scores
from scorespark.llm.repetition import repetition_rules
from scorespark.llm.simhash import near_duplicates
from scorespark.llm.token_files import token_output
from scorespark.llm.warc_zip import archived

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_suffix_repetition(spark, sf):
    return repetition_rules(table(spark, sf, "documents")).drop("longest_repeat")


@query
def op2_spaced_seeds(spark, sf):
    return benchmark_overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op3_page_layout(spark, sf):
    return visible_text(table(spark, sf, "pages"))


@query
def op4_licence_scan(spark, sf):
    """Documents as files of the directories source/lang; a short document that states a licence is its directory's notice."""
    docs = table(spark, sf, "documents").withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    return file_licences(docs, is_notice=F.octet_length("text") <= 400)


@query
def op5_simple8b_tokens(spark, sf):
    return token_output(table(spark, sf, "documents"), tokenizer=TOKENIZER)


@query
def op6_zip_packages(spark, sf):
    return archived(table(spark, sf, "pages"))


@query
def op7_entropy_mix(spark, sf):
    return mix_table(table(spark, sf, "documents")).drop("rate")


@query
def op8_random_indexing(spark, sf):
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op9_simhash_variants(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))


@query
def op10_gated_language_model(spark, sf):
    return language_model_scores(table(spark, sf, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Texts of one document in ten, by the CRC-32 of their id, repeat from some word on; other rows stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    planted = h % 10 == 0
    rows = docs.select("doc_id", "text", F.when(planted, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"), g.alias("g"))
    rows = rows.withColumn("n", F.size("w").cast("long")).withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    places = "transform(sequence(0L, n - 1), i -> element_at(w, cast(if(i < a, i, a + (i - a) % p) + 1 AS int)))"
    return rows.select("doc_id", F.expr(f"CASE WHEN a IS NULL THEN text ELSE array_join({places}, ' ') END AS text"))


@query
def op11_scale_tiled_runs(spark, sf):
    found = periodic_runs(with_periods(table(spark, sf, "documents")))
    top = "aggregate(runs, cast(null AS struct<start: bigint, length: bigint, period: bigint>), (a, x) -> if(a IS NULL OR x.length * a.period > a.length * x.period, x, a))"
    listed = "array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')"
    found = found.withColumn("n_runs", F.size("runs").cast("long")).withColumn("top", F.expr(top)).withColumn("listed", F.expr(listed))
    return found.selectExpr(
        *"doc_id n_words n_runs top.start top.length top.period".split(),
        "1000 * top.length div top.period AS exponent_milli",
        "sha2(listed, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


@query
def op12_projected_neighbours(spark, sf):
    return nearest_neighbours(table(spark, sf, "embeddings"), queries=F.col("vec_id") % 20 == 0)


@query
def op13_path_copying_tree(spark, sf):
    """Where 7 divides the CRC-32 of the id, one is added to n_chars."""
    docs = table(spark, sf, "documents")
    changes = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    made = merkle_manifest(docs, tampered={"n_chars": F.expr("try_add(n_chars, 1)")}, where=changes)
    siblings = F.concat_ws("", F.transform("proof", lambda step: F.substring(step, 2, 64)))
    return made.withColumn("proof_sha256", F.sha2(siblings, 256)).drop("proof", "copied")
