"""Counts of the quality rules against brute force, and odd inputs."""

from __future__ import annotations

import random
import re
from collections import Counter

from patronlake.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in Q.SYMBOLS), dup, len(repeated)


def test_counts_equal_brute_force(table):
    draw = random.Random(1)
    texts = [None, "", " ", "\n\n", "a", "a b c d e a b c d e", "a " * 9, "x\x0by\x0cz\r\n w", "\x85    "]
    for _ in range(150):
        words = [draw.choice(["the", "a", "b", "#", "x|y", "né!", "🙂"]) for _ in range(draw.randint(0, 60))]
        texts.append("".join(w + draw.choice([" ", " ", "\n", "\t ", "\n\n"]) for w in words))
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "a b c d e f", 1, "x")] * 2
    df = table(rows, "doc_id long, text string, n_words int, kept string")
    judged = Q.judge(df).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert (r["__words"], r["__chars"], r["__symbols"], r["__dup_lines"], r["__repeats"]) == brute(r.text), r.text
        assert not (r["__kept"] and r["__base_failed"])
        assert r["__base_failed"] == (r["__words"] < 10 or 100 * r["__repeats"] > 20 * r["__words"])
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r["__kept"] for r in judged)
    assert Q.keep_good(df.limit(0)).count() == 0


def test_plan_has_no_python_and_no_exchange(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (Q.judge(docs), Q.keep_good(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rules_keep_what_is_labelled_good(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = Q.judge(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "__kept", "__base_failed").collect()
    good = [r for r in judged if labels.get(r.doc_id) == 1 and not r["__base_failed"]]
    bad = [r for r in judged if labels.get(r.doc_id) == 0]
    assert all(r["__kept"] for r in good) and sum(r["__kept"] for r in bad) <= 0.03 * len(bad)
