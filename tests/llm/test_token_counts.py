"""Counts against the library, and what the cache is asked."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

from patronlake.llm import token_counts as C

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b\n\n c\t", "<|endoftext|>", "a<|endoftext|>b<|endoftext|>", "<|endof", "don't I'll 12345 %$#",
    "ÉTÉ straße ñandú", "日本語 テキスト", "🙂🙃 a", "العربية", "  x　y\u0085z", "Ⅷ ² ½ १२३", "a" * 3000,
    "\x00\x1c\x1d\x7f", "é", "ẞꞮ\U0001e900",
]


def library_counts(texts):
    exact = Tokenizer.from_file(FILE)
    return [len(e.ids) for e in exact.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_those_of_the_library():
    counter = C.Counter(open(FILE, "rb").read())
    assert counter.fast is not None
    texts = ODD + [chr(c) * 2 + "a" for c in range(0x20, 0x530)]
    assert [counter.count(t) for t in texts] == library_counts(texts)


def test_other_kinds_of_tokenizer_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = C.Counter(open(path, "rb").read())
    assert counter.fast is None
    exact = Tokenizer.from_file(path)
    for text in ODD[:9]:
        assert counter.count(text) == len(exact.encode(text, add_special_tokens=False).ids)


def test_cache_gets_each_missing_text_once(spark, table, tmp_path):
    cache = f"{tmp_path}/cache"
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, ODD[2]), (101, None), (None, ODD[2]), (0, ODD[0])]
    found = C.count_tokens(table(rows), FILE, cache).collect()
    expected = dict(zip(ODD, library_counts(ODD)))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == sorted(
        (str(d), len((t or "").encode()), expected[t or ""]) for d, t in rows
    )
    assert spark.read.parquet(cache).count() == len(ODD)
    again = C.count_tokens(table([(1, ODD[3]), (2, "new")]), FILE, cache)
    assert {r.doc_id: r.n_tokens for r in again.collect()} == {1: 1, 2: library_counts(["new"])[0]}
    assert spark.read.parquet(cache).count() == len(ODD) + 1
    other = C.count_tokens(table([(1, ODD[3])]), public_tokenizers.path("word_bpe_49k.json"), cache)
    assert other.count() == 1 and spark.read.parquet(cache).select("version").distinct().count() == 2


def test_empty_table_and_counts_stored_twice(spark, table, tmp_path):
    cache = f"{tmp_path}/cache"
    assert C.count_tokens(table([(1, "a")]).limit(0), FILE, cache).count() == 0
    C.count_tokens(table([(1, "a b")]), FILE, cache)
    spark.read.parquet(cache).write.mode("append").partitionBy("version").parquet(f"{tmp_path}/twice")
    spark.read.parquet(cache).write.mode("append").partitionBy("version").parquet(f"{tmp_path}/twice")
    rows = C.count_tokens(table([(1, "a b", 2)], "doc_id long, text string, digest int"), FILE, f"{tmp_path}/twice").collect()
    assert [(r.doc_id, r.n_tokens) for r in rows] == [(1, 2)]
