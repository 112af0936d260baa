"""From raw documents to token ids: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from patronlake.llm import mixing, quality_rules, simhash, suffix_dedup, unigram
from patronlake.llm.queries import MIX, vocabulary_file
from patronlake.llm.shared import Workspace

PIPELINE_MIX = replace(MIX, share=90, epochs=1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, and of copies, the document with the smallest id stays.

    Rows with one id are one document; rows without an id stay.
    """
    dropped = simhash.near_groups(docs).select("doc").distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["doc"], "left_anti")


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has are cut; documents left blank go."""
    return suffix_dedup.cut_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, by the weights of domains, languages and sources, no document twice."""
    return mixing.mix(docs, PIPELINE_MIX)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of whole texts: doc_id, lang, source, n_tokens, n_byte_tokens, ids, round_trip."""
    return unigram.encode_column(docs, vocabulary_file("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("source mix", source_mix),
    ("SentencePiece", token_ids),
]
# SimHash groups and the encoding are no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    space = Workspace(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = space.put(f"stage{i}", stage(spark, docs, sf_dir))
        if i:
            space.drop(f"stage{i - 1}")
    return docs
