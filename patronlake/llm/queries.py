"""The operators of this package as named queries over a directory of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlake.llm import (
    collocations, exact_topk, licenses, mixing, quality_rules, role_repair, simhash, suffix_dedup, token_counts,
    toxicity, unigram, vector_join, warc,
)
from patronlake.llm.shared import Workspace

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 512
# Sources by domain, and weights of the mix; sources that are not named are of domain "web".
DOMAINS = {"books": (10, 11, 12, 13, 14), "reference": (15, 16, 17, 18, 19)}
MIX = mixing.Mix(
    domains={f"src{n}": domain for domain, numbers in DOMAINS.items() for n in numbers}, others="web",
    domain_weights={"web": 5, "books": 3, "reference": 2},
    lang_weights={"en": 6, "de": 2, "fr": 2, "es": 1},
    source_weights={"src0": 3}, share=60, epochs=3,
)


def vocabulary_file(name: str) -> str:
    """Path of a public tokenizer's file; the directory is the installed library's."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_warc_archives(spark: SparkSession, directory: str) -> DataFrame:
    folder = Workspace(spark, "archives").folder
    warc.write_archives(_table(spark, directory, "pages"), folder)
    return warc.read_archives(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_toxicity_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, directory, "documents"), _table(spark, directory, "labels"))


def op3_exact_topk(spark: SparkSession, directory: str) -> DataFrame:
    return exact_topk.top_k(_table(spark, directory, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_license_scan(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, directory, "documents")).drop("evidence")


def op5_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    cache = Workspace(spark, "token-cache").path("counts")
    counts = token_counts.count_tokens(
        _table(spark, directory, "documents"), vocabulary_file("byte_bpe_50k.json"), cache
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op6_simhash_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, directory, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, directory, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", F.col("__words").alias("n_words"), F.col("__chars").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"), F.col("__dup_lines").alias("n_dup_lines"),
        F.col("__repeats").alias("n_repeat_words"), F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def op8_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    documents = _table(spark, directory, "documents")
    return unigram.encode_column(documents, vocabulary_file("piece_bpe_32k.model"), keep=("doc_id",))


def op9_source_mix(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix_rows(_table(spark, directory, "documents"), MIX)


def op10_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = suffix_dedup.dedup_passages(_table(spark, directory, "documents"), with_text=False)
    return found.drop("kept")


def op11_vector_join(spark: SparkSession, directory: str) -> DataFrame:
    return vector_join.nearest(_table(spark, directory, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_role_repair(spark: SparkSession, directory: str) -> DataFrame:
    rows = role_repair.conversations(_table(spark, directory, "conversations"))
    return role_repair.repair(role_repair.damage(rows))


def op13_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return collocations.mine(_table(spark, directory, "documents"))


def llm_queries() -> dict[str, Query]:
    named = [
        op1_warc_archives, op2_toxicity_neighbours, op3_exact_topk, op4_license_scan, op5_token_counts,
        op6_simhash_dedup, op7_quality_rules, op8_sentencepiece, op9_source_mix, op10_suffix_dedup,
        op11_vector_join, op12_role_repair, op13_collocations,
    ]
    return {query.__name__: query for query in named}
