"""Input at the ends of its range: extreme numbers and ids, names that clash, tables without rows or texts."""

from __future__ import annotations

import random

import public_tokenizers  # noqa: F401  the last stage's vocabulary
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from patronlake.llm import exact_topk, licenses, quality_rules, suffix_dedup

MOST = (1 << 63) - 1


def brute(rows, k):
    """Saturated weights, exact sums, then the nearest 64-bit score."""
    def clamp(x):
        return max(-MOST, min(MOST, x))

    whole = [(i, [max(-MOST - 1, min(MOST, int(256 * x // 1))) for x in v]) for i, v in rows]
    out = []
    for a, (q, x) in enumerate(whole):
        scored = sorted(
            (-clamp(sum(s * t for s, t in zip(x, y))), MOST if i is None else i, i is None)
            for b, (i, y) in enumerate(whole) if a != b
        )[:k]
        out += [(q, r, None if none else i, -s) for r, (s, i, none) in enumerate(scored, 1)]
    return sorted(map(str, out))


def test_topk_sums_beyond_64_bits_and_greatest_ids(table):
    draw = random.Random(4)
    rows = [(i, [draw.choice([1e30, -1e30, 3e9, -7e8, 0.5, 1.0]) for _ in range(4)]) for i in range(40)]
    rows += [(MOST, [1.0, 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]), (MOST - 1, [1.0, 0.0, 0.0, 0.0]), (-MOST - 1, [0.5] * 4)]
    df = table(rows, "vec_id long, embedding array<double>")
    for block in (8192, 8):
        found = exact_topk.top_k(df, F.lit(True), 5, candidates_per_block=block).collect()
        assert sorted(str(tuple(r)) for r in found) == brute(rows, 5)


def test_the_greatest_id_is_an_id_in_passages(table):
    passage = "a passage of more than fifty bytes that stands in three of the documents"
    rows = [(MOST, passage), (None, passage), (4, passage), (MOST - 1, passage + "!")]
    found = {r.doc_id: r.n_removed for r in suffix_dedup.dedup_passages(table(rows)).collect()}
    assert found == {4: 0, MOST - 1: len(passage), MOST: len(passage), None: len(passage)}
    # the greatest id and no id are level: neither loses to the other
    found = {r.doc_id: r.n_removed for r in suffix_dedup.dedup_passages(table(rows[:2])).collect()}
    assert found == {MOST: 0, None: 0}


def test_places_of_a_phrase_may_overlap(table):
    phrases = {"a a": "a", "x y x": "x", "one": "o"}
    text = "A a a-a aa a x y x, y x one-one"
    row = licenses.Scanner({}, phrases).scan([text.encode(), b"a", b"a a"])
    assert [r["n_base"] for r in row] == [3 + 2 + 2, 0, 1]
    assert (row[0]["first_word"], row[0]["last_word"]) == (0, 12)


EXTRA = ("__text", "__w", "__h", "__row", "__kept", "__doc", "doc", "my col", "a-b", "own", "key", "label", "place", "bytes", "id", "bucket")


def clashing(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *[F.concat(F.lit(name), F.col("n_chars").cast("string")).alias(name) for name in EXTRA]).repartition(3)


def documents():
    draw = random.Random(9)
    words = [f"{a}{b}" for a in "bcdfgjklm" for b in ("ado", "ero", "ina")] + ["the", "of", "and"]
    texts = [" ".join(draw.choice(words) for _ in range(60)) for _ in range(8)]
    long = " ".join(draw.choice(words) + str(i) for i in range(120_000)) + " the of and" * 3
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(20, texts[0]), (0, texts[0]), (21, long), (22, None), (23, ""), (None, texts[1]), (None, texts[2]), (None, None)]
    return [(i, t, ["en", None][k % 2], ["src0", None, "src11"][k % 3], len(t or "")) for k, (i, t) in enumerate(rows)]


def test_stages_leave_clashing_columns_as_they_are(spark, tmp_path):
    docs = clashing(spark, documents())
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.count() > 0, name
        if i < 4:
            assert docs.columns == columns, name
            for row in docs.collect():
                for extra in EXTRA:
                    assert row[extra].startswith(extra) and row[extra][len(extra):].isdigit(), (name, extra)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, None, "en", "src0", 0), (2, "", "en", None, 0)]])
def test_stages_over_nothing(spark, tmp_path, rows):
    for name, stage in corpus_pipeline.STAGES:
        docs = clashing(spark, rows).withColumns({c: F.lit(c) for c in EXTRA})
        found = stage(spark, docs, str(tmp_path)).collect()
        if name in ("quality rules", "suffix-array dedup"):
            assert found == []


def test_quality_rules_take_any_text_column(spark):
    docs = clashing(spark, documents()).withColumnRenamed("text", "__words")
    good = quality_rules.keep_good(docs, text_column="__words")
    plain = quality_rules.keep_good(clashing(spark, documents()))
    assert good.columns == docs.columns and good.count() == plain.count() > 0
