"""Token counts by a digest cache.

The cache is a table (version, digest, n_tokens): digests of contents under digests of tokenizers. A
text's digest is looked up under the tokenizer's; only distinct texts that are not there are encoded,
once each, and appended. The tokenizer's digest covers its file, the library's version and the options,
so another tokenizer or library never meets counts that are not its own. Byte-level tokenizers see every
byte, so the normal form of a content is its UTF-8 bytes as they are.

Texts move once: the one row of each missing digest goes to its task. Everything else works on digests.
Appends are Spark's own commits: a run that fails leaves the cache as it was, and digests that two runs
append at the same time count once.

Counts are those of the `tokenizers` library. Where its file is a plain byte-level BPE with ids in merge
order, the merges run in `tiktoken`, several times faster; texts with characters whose classes the two
libraries' Unicode tables might take differently still go to `tokenizers`.

Defined results: a NULL or empty text has 0 bytes and 0 tokens; special strings in a text are their
special token, as is the library's default; nothing is truncated or padded; NULL ids and repeated rows
stay; an empty table gives an empty result and appends nothing; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlake.llm.shared import Workspace, prepare, required, whole_text

_CACHE = "digest binary, n_tokens long, version string"
# The split rule of byte-level BPE files (fixed value).
SPLIT_RULE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Latin, Greek, Cyrillic and common punctuation: classes that have not changed for many years.
_SETTLED = re.compile("[^\x00-ͷΑ-Ωα-ωЀ-ԯ‐-‧‰-⁞₠-₱←-⇿]")


class Counter:
    """Counts tokens of texts as `tokenizers` gives them. Made in each Python worker from the file."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(file.decode())
        self.exact.no_truncation()
        self.exact.no_padding()
        self.fast, self.special = self._fast(json.loads(file))

    @staticmethod
    def _fast(spec: dict):
        """A tiktoken encoding with the same merges, or None if the file is of another kind."""
        model, before = spec.get("model", {}), spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        plain = (
            model.get("type") == "BPE" and spec.get("normalizer") is None
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in added)
        )
        if not plain:
            return None, None
        shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        letters = {chr(b): b for b in shown}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        specials = {t["content"] for t in added}
        vocabulary = {k: v for k, v in model["vocab"].items() if k not in specials}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        in_order = [vocabulary.get("".join(p)) for p in pairs] == list(range(256, 256 + len(pairs)))
        if not in_order or len(vocabulary) != 256 + len(pairs):
            return None, None
        import tiktoken

        ranks = {bytes(letters[c] for c in k): v for k, v in vocabulary.items()}
        fast = tiktoken.Encoding("counts", pat_str=SPLIT_RULE, mergeable_ranks=ranks, special_tokens={})
        longest_first = sorted(specials, key=len, reverse=True)
        return fast, re.compile("|".join(map(re.escape, longest_first))) if specials else None

    def count(self, text: str) -> int:
        if self.fast is None or _SETTLED.search(text):
            return len(self.exact.encode(text, add_special_tokens=False).ids)
        if not self.special:
            return len(self.fast.encode_ordinary(text))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(len(self.fast.encode_ordinary(p)) for p in parts)


def tokenizer_version(file: bytes) -> str:
    """Digest of the tokenizer's file, the library and the options of counting."""
    import tokenizers

    options = f"tokenizers {tokenizers.__version__}; no added tokens; special strings are tokens"
    return hashlib.sha256(options.encode() + b"\0" + file).hexdigest()


def _encoder(file):
    def run(batches):
        counter = Counter(file.value)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    return run


def _cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The cache's counts for a tokenizer; a cache that does not exist yet is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _CACHE).drop("version")
    stored = spark.read.schema(_CACHE).parquet(cache).filter(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer_file: str, cache: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, digest); missing counts are appended to the table at `cache`."""
    spark = docs.sparkSession
    prepare(spark)
    space = Workspace(spark, "tokens")
    file = Path(tokenizer_file).read_bytes()
    version = tokenizer_version(file)
    texts = required(docs, id_column, text_column).select(
        F.col(f"`{id_column}`").cast("long").alias("doc"), whole_text(text_column).alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    digests = space.put("digests", texts.select("doc", "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    chosen = digests.groupBy("digest").agg(F.min(F.struct("doc")).alias("one")).select("digest", "one.doc")
    misses = space.put("misses", chosen.join(_cached(spark, cache, version), "digest", "left_anti"))
    same = (texts.digest == misses.digest) & texts.doc.eqNullSafe(misses.doc)
    encoded = (
        texts.join(misses, same, "left_semi").select("digest", "text")
        .mapInArrow(_encoder(spark.sparkContext.broadcast(file)), "digest binary, n_tokens long")
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # rows with equal ids and texts
    )
    encoded.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache)
    space.drop("misses")
    space.release()
    counts = space.put("counts", digests.select("digest").distinct().join(_cached(spark, cache, version), "digest"))
    return digests.join(counts, "digest").select(F.col("doc").alias(id_column), "n_bytes", "n_tokens", "digest")
