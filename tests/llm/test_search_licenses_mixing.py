"""Edge cases of top-k search, license templates and mixing; whole tables are compared with SQL."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from patronlake.llm import exact_topk, licenses, mixing
from patronlake.llm.shared import Workspace


def brute_topk(rows, k):
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in good]
    out = []
    for a, (q, x) in enumerate(whole):
        if q is None or q % 50:
            continue
        scored = [(-sum(s * t for s, t in zip(x, y)), i if i is not None else 1 << 63, i) for b, (i, y) in enumerate(whole) if a != b]
        out += [(q, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def test_topk_with_ties_repeats_nulls_and_odd_vectors(table):
    draw = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(size=6)]) for i in range(1, 160)]
    rows += [(0, rows[3][1]), (50, rows[3][1]), (50, rows[3][1]), (100, [0.0] * 6), (200, [0.0, 1.0]), (7, rows[3][1])]
    rows += [(250, None), (300, [1.0, None]), (350, [float("nan")] * 6), (400, [float("inf")]), (None, [9.0] * 6), (150, [])]
    df = table([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    for block in (8192, 16):
        found = exact_topk.top_k(df, F.col("vec_id") % 50 == 0, 5, candidates_per_block=block).collect()
        assert sorted(str(tuple(r)) for r in found) == brute_topk(rows, 5)
    assert exact_topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def every_topk(rows, k):
    """Of all rows, each a query: the nearest 64-bit score, its own row left out, ties to smaller ids, then NULL ids."""
    most = (1 << 63) - 1
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    out = []
    for a, (q, x) in enumerate(whole):
        scored = sorted(
            (-max(-most, min(most, sum(s * t for s, t in zip(x, y)))), i is None, i or 0) for b, (i, y) in enumerate(whole) if a != b
        )[:k]
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(scored, 1)]
    return sorted(map(str, out))


def test_topk_sends_no_copies_of_the_queries_through_the_driver(spark, table):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.round(draw.normal(size=64), 3)]) for i in range(400)]
    df = table(rows, "vec_id long, embedding array<double>")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1m")  # 25 copies of 400 queries were joined by broadcast: 5 MB
    try:
        found = exact_topk.top_k(df, F.lit(True), 3, candidates_per_block=16).collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert sorted(str(tuple(r)) for r in found) == every_topk(rows, 3)


def test_topk_in_many_groups_columns_and_rounds(table):
    draw = np.random.default_rng(3)

    def vector(i):
        if i % 4 == 0:  # few of many components
            v = np.zeros(300)
            v[draw.integers(0, 300, 3)] = draw.integers(1, 4, 3)
        else:
            v = draw.integers(-3, 4, 5 + i % 3) * (10.0 ** (i % 11) if i % 7 == 0 else 1.0)
        return [float(x) for x in v]

    rows = [(i // 2 if i % 9 else None, vector(i)) for i in range(200)]
    rows += [(None, [1.0, 2.0])] * 12 + [(7, [1.0, 2.0])] * 12 + [(3, [])]
    df = table(rows, "vec_id long, embedding array<double>")
    expected = every_topk(rows, 4)
    for per_group, block in ((9, 16), (50, 40), (1000, 8192)):  # the first in rounds of groups
        found = exact_topk.top_k(df, F.lit(True), 4, candidates_per_block=block, queries_per_group=per_group).collect()
        assert sorted(str(tuple(r)) for r in found) == expected


def test_topk_scores_by_product_and_by_postings():
    draw = np.random.default_rng(4)

    def row(matrix):
        n, width = matrix.shape
        numbers = np.arange(n).tobytes()
        return {"n": n, "width": width, "kind": str(matrix.dtype), "ids": numbers, "row_numbers": numbers, "weights": matrix.tobytes()}

    few = (draw.integers(1, 99, (640, 3000)) * (draw.random((640, 3000)) < 0.002)).astype(np.int16)
    many = draw.integers(-99, 99, (640, 3000)).astype(np.int16)
    for matrix, sparse in ((few, True), (many, False)):
        block = exact_topk.Block(row(matrix), slice(0, 600))
        assert block.sparse_for(few[:2]) == sparse and not block.sparse_for(many[:2])
        exact = matrix.astype(int)[:16] @ matrix[:600].astype(int).T
        assert (block.scattered(matrix[:16], True) == exact).all()
        assert (block.scattered(matrix[:16], False) == exact).all()
        assert (block.product(matrix[:16], np.float64) == exact).all()
    # a block has no more weights than BLOCK_CELLS, however long a vector among short ones is
    assert exact_topk._cuts([2, 2, 2, 2, 2], 2) == [0, 2, 4]
    assert exact_topk._cuts([2, exact_topk.BLOCK_CELLS, 2, 2], 100) == [0, 1, 2]


def accepts(template, text):
    words = licenses.words_of(text)
    return licenses.Automaton(template).longest(words, 0) == len(words)


def test_templates_accept_optional_and_replaced_words_only():
    t = "granted to <<var;most=3>> free <<beginOptional>>of any <<beginOptional>>real<<endOptional>> charge<<endOptional>> now"
    assert accepts(t, "Granted to Ann, Bob & Cy: FREE now")
    assert accepts(t, "granted to free now") and accepts(t, "granted to x free of any real charge now")
    assert accepts(t, "granted to x free of any charge now")
    for wrong in ("granted to a b c d free now", "granted to x free of any now", "granted x free now", "granted to x free"):
        assert not accepts(t, wrong)


def test_license_places_labels_and_evidence(table):
    notice = "Licensed under the Apache License (the \"License\"), Version 2.0."
    rows = [
        (1, f"ça {notice} mit-License MIT\nlicense commit license mit licenses"), (2, None), (3, "..."),
        (4, "the GNU General  Public License; general public"), (5, "apache"), (6, "license"), (None, "mit license"),
    ]
    found = {r.doc_id: r for r in licenses.scan_licenses(table(rows)).collect()}
    one = found[1]
    assert (one.n_words, one.n_base, one.first_word, one.last_word) == (19, 3, 4, 13)
    assert one.base_labels == "apache,mit" and one.labels == "apache,apache-2.0-notice,mit" and one.score == 1.0
    assert one.evidence == ["apache-2.0-notice:1-11"]
    assert (found[2].n_words, found[2].first_word, found[2].labels, found[2].score) == (0, None, "", 0.0)
    assert (found[4].base_labels, found[4].n_base, found[4].score) == ("gpl", 1, 0.5)
    assert found[5].n_base == found[6].n_base == 0 and found[None].base_labels == "mit"


def plain_deal(budget, children):
    """children: name -> (weight, capacity); the same rule step by step."""
    left, out = budget, {n: 0 for n in children}
    rest = dict(children)
    while rest:
        total = sum(w for w, _ in rest.values())
        full = [n for n, (w, c) in rest.items() if w and c * total <= left * w]
        if not full or not total:
            break
        for n in full:
            out[n] = rest[n][1]
        left -= sum(rest.pop(n)[1] for n in full)
    total = sum(w for w, _ in rest.values())
    for n, (w, _) in rest.items():
        out[n] = left * w // total if total else 0
    return out


def test_budgets_go_to_siblings_before_ancestors(spark):
    supply = [("a", "en", "s1", 100), ("a", "en", "s2", 5), ("a", "de", "s1", 3), ("b", "en", "s3", 1000), ("b", None, "s4", 0), ("c", "en", None, 50)]
    spec = mixing.Mix(domain_weights={"a": 4, "b": 1}, source_weights={"s2": 3}, share=50, epochs=2)
    df = spark.createDataFrame(supply, "domain string, lang string, source string, tokens long")
    found = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(df, spec).collect()}
    capacity = {(d, l, s): 2 * n for d, l, s, n in supply}
    domains = plain_deal(sum(n for *_, n in supply) // 2, {
        d: (spec.domain_weights.get(d, 1), sum(c for k, c in capacity.items() if k[0] == d)) for d in "abc"})
    expected = {}
    for d in "abc":
        langs = plain_deal(domains[d], {l: (1, sum(c for k, c in capacity.items() if k[:2] == (d, l))) for x, l, _ in capacity if x == d})
        for lang, budget in langs.items():
            expected |= {(d, lang, s): n for s, n in plain_deal(budget, {
                k[2]: (spec.source_weights.get(k[2], 1), c) for k, c in capacity.items() if k[:2] == (d, lang)}).items()}
    assert found == expected


def test_mix_keeps_columns_and_epochs(spark, table):
    rows = [(i, "w " * (i % 7), "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, 1) for i in range(300)] + [(None, None, None, None, 2)]
    docs = table(rows, "doc_id long, text string, lang string, source string, epoch int")
    spec = mixing.Mix(share=250, epochs=3)
    used = mixing.mix_rows(docs, spec).collect()
    total = sum(i % 7 for i in range(300))
    assert sum(r.n_tokens for r in used) <= total * 5 // 2
    assert sum(r.n_tokens for r in used) > total * 2
    per = {}
    for r in used:
        per.setdefault(r.doc_id, []).append(r.epoch)
    assert all(sorted(e) == list(range(1, len(e) + 1)) and len(e) <= 3 for e in per.values())
    kept = mixing.mix(docs, spec)
    assert kept.columns == docs.columns and kept.count() == len(used)
    whole = mixing.mix_rows(docs, mixing.Mix(share=100))
    assert sum(r.n_tokens for r in whole.collect()) == total
    assert mixing.mix_rows(docs.limit(0), spec).count() == 0
    assert [c for c in mixing.plan_mix(docs, spec, Workspace(spark, "t"))[1].columns][0] == "leaf"
