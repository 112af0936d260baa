"""Block-max search against all scores, and held-out accuracy."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa

from patronlake.llm import toxicity as X


def index(seed, n=600, k=7):
    """Examples of few terms, so that many of them tie; 25 terms, some in most examples, some in few."""
    draw = random.Random(seed)
    names = [f"t{chr(97 + i)}" for i in range(25)]
    rows = [
        {draw.choice(names[:3] if draw.random() < 0.5 else names): draw.randint(1, 5) for _ in range(draw.randint(0, 4))}
        for _ in range(n)
    ]
    ids = draw.sample(range(10 * n), n)
    return X.Index(
        ids, [int("tb" in r or "tc" in r) for r in rows],
        [np.array([X.hashed(t) for t in r], np.uint64) for r in rows], [np.array(list(r.values()), np.int32) for r in rows], k,
    )


def by_scoring_all(model, vector, k):
    """(doc_id, similarity) of the k best of all examples."""
    dense = np.zeros(len(model.terms))
    dense[vector[0]] = vector[1]
    scores = [(dense[ids] * weights).sum() for ids, weights in map(model.row, range(len(model.docs)))]
    ranked = sorted((-round(s, 12), d) for s, d in zip(scores, model.docs.tolist()) if s > 0)
    return ranked[:k]


def test_block_max_search_finds_what_scoring_all_finds_ties_included():
    for seed, sizes in ((1, (8, 256, 64)), (2, (8, 2, 4)), (3, (1, 0, 1)), (4, (64, 512, 8))):
        X.BLOCK, X.COMMON_TERMS, X.OPENED = sizes
        try:
            model, draw = index(seed), random.Random(seed)
            for _ in range(100):
                vector = model.vector_of(" ".join(f"t{chr(97 + draw.randint(0, 27))}" for _ in range(draw.randint(1, 9))))
                if vector is None:
                    continue
                at, found, opened = model.nearest(vector, 7)
                assert [(-round(s, 12), d) for d, s in zip(model.docs[at].tolist(), found.tolist())] == by_scoring_all(model, vector, 7)
                assert len(at) <= opened <= len(model.docs)
                without = int(model.fold[at[0]])
                assert (model.fold[model.nearest(vector, 7, without)[0]] != without).all()
        finally:
            X.BLOCK, X.COMMON_TERMS, X.OPENED = 8, 256, 64


def test_blocks_that_cannot_hold_a_neighbour_stay_closed():
    """A text equal to 20 examples, among examples that share one frequent word with it."""
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)]
    draw = random.Random(5)
    rows = [["the", *draw.sample(words, 30)] for _ in range(2000)] + [["the", *words[:30 + i % 2]] for i in range(20)]
    hashes = [np.array([X.hashed(w) for w in r], np.uint64) for r in rows]
    model = X.Index(range(len(rows)), [0] * len(rows), hashes, [np.ones(len(r), np.int32) for r in rows])
    at, _, opened = model.nearest(model.vector_of(" ".join(["the", *words[:30]])), 16)
    assert set(model.docs[at].tolist()) <= set(range(2000, 2020)) and opened < 200


def test_words_common_in_one_language_alone_are_columns_and_many_texts_together_find_the_same():
    """Two languages with 40 words each, of which a text has 8: a word is in a tenth of all examples."""
    draw = random.Random(9)
    names = [[f"{mark}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)] for mark in "xy"]
    rows = [draw.sample(names[i % 2], 8) for i in range(800)]
    hashes = [np.array([X.hashed(w) for w in r], np.uint64) for r in rows]
    model = X.Index(range(len(rows)), [i % 2 for i in range(800)], hashes, [np.ones(8, np.int32)] * 800, 7)
    vectors = [model.vector_of(" ".join(draw.sample(names[i % 2], 6) + names[1 - i % 2][:1])) for i in range(60)]
    for vector, (at, found, opened) in zip(vectors, model.all_nearest(vectors, 7)):
        assert [(-round(s, 12), d) for d, s in zip(model.docs[at].tolist(), found.tolist())] == by_scoring_all(model, vector, 7)
        assert opened <= 800 and model.size[vector[0]].sum() < 100  # sparse postings


ODD = "ab cdeé\u00dfI\u0130\u03a3\u03c3\u03c2\n\t_1\u00b2\u00bd\u0301\u4e2d\U0001f600\U00010400\0'\u2019\u2167\u0966"


def test_binary_columns_are_read_in_place():
    rows = [np.arange(n, dtype=np.int32) for n in (3, 0, 5, 1)]
    column = pa.array([r.tobytes() for r in rows], pa.binary())
    empty = pa.array([], pa.binary())
    for chunks in ([column], [column.slice(1, 2), empty, column.slice(3), column.slice(1, 1)], [empty], []):
        found = X._unpacked(pa.chunked_array(chunks, pa.binary()), np.int32)
        assert [r.tobytes() for r in found] == [x for c in chunks for x in c.to_pylist()]


def test_words_of_many_texts_are_those_of_each():
    draw = random.Random(8)
    texts = ["", "\n", "abc", "\u00c9_\u00e9", "\u0391\u03a3 \u0391\u03a3", *("".join(draw.choices(ODD, k=draw.randint(0, 50))) for _ in range(1500))]
    for some in (texts, texts[:1], texts[:2], texts[2:3], texts[-1:]):
        words, *found = X.words_of_all(some)
        words, seen = words.to_pylist(), [{} for _ in some]
        for text, word, count in zip(*(x.tolist() for x in found)):
            seen[text][words[word]] = count
        assert seen == [dict(X.words(text)) for text in some] and len(set(words)) == len(words)
    assert sum(X._some(texts), []) == texts


def test_texts_are_cut_and_looked_up_without_python_for_each_word(monkeypatch):
    """Each different term is hashed once, and vectors are those of plain counts of terms."""
    draw = random.Random(7)
    names = ["".join(draw.choices("abcdeé中𐐨", k=draw.randint(1, 8))) for _ in range(300)]
    texts = [" ".join(draw.choices(names, k=draw.randint(0, 40))) for _ in range(200)]
    found = [X.term_counts(t) for t in texts[:100]]
    model = X.Index(
        range(100), [i % 2 for i in range(100)], [np.array([X.hashed(t) for t in r], np.uint64) for r in found],
        [np.array(list(r.values()), np.int32) for r in found],
    )
    number = dict(zip(model.terms.tolist(), model.number.tolist()))
    expected = []
    for text in texts:
        own = {number[X.hashed(t)]: 1 + math.log(n) for t, n in X.term_counts(text).items() if X.hashed(t) in number}
        own = {i: w * model.idf[i] for i, w in sorted(own.items())}
        expected.append((list(own), np.array(list(own.values())) / math.sqrt(sum(w * w for w in own.values()) or 1)))
    different, calls, plain = {t for text in texts for t in X.term_counts(text)}, [], X.hashed
    monkeypatch.setattr(X, "hashed", lambda term: calls.append(term) or plain(term))
    monkeypatch.setattr(X, "terms_of_word", None)
    for vector, (ids, weights) in zip(model.vectors(texts), expected, strict=True):
        assert (vector is None) == (not ids)
        assert vector is None or (vector[0].tolist() == ids and np.allclose(vector[1], weights, rtol=1e-12))
    assert sorted(x for x in calls if x) == sorted(different)


def test_the_index_is_built_a_few_examples_at_a_time():
    """The same index however many are unpacked together, in less memory than all entries as 64-bit numbers take thrice."""
    tables = []
    for n in (1, 7, 10_000):
        X.BUILT_AT_ONCE = n
        try:
            tables.append({name: value for name, value in index(6).__getstate__().items()})
        finally:
            X.BUILT_AT_ONCE = 500
    for other in tables[1:]:
        for name, value in tables[0].items():
            assert np.array_equal(np.asarray(value), np.asarray(other[name])), name
    draw = np.random.default_rng(1)
    hashes = [draw.integers(0, 50_000, 400).astype(np.uint64) for _ in range(4000)]
    hashes = [np.unique(h) for h in hashes]
    counts = [np.ones(len(h), np.int32) for h in hashes]
    tracemalloc.start()
    X.Index(range(4000), [i % 2 for i in range(4000)], hashes, counts, calibrate=False)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3 * 8 * sum(map(len, hashes))


def test_whole_query_against_plain_python(spark, table):
    """TF-IDF, neighbours, similarities: from the rows on, with repeated rows, copies, ties and a long text."""
    draw = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "zeta"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 6)))) for i in range(120)]
    docs += [(500, docs[0][1]), (501, "alpha " * 200_000), (502, None), docs[3], docs[3]]
    marks = [(i, int("omega" in (t or ""))) for i, t in dict(docs).items() if i % 2]
    found = {(r.doc_id): r for r in X.score_toxicity(table(docs), spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    assert X.score_toxicity(table(docs), spark.createDataFrame(marks, "doc_id long, toxic int")).count() == len(docs)
    texts, examples = dict(docs), {}
    for i, y in marks:
        if zlib.crc32(str(i).encode()) % 3 != 1:
            text = texts[i] or ""
            d, label = examples.get(text, (i, y))
            examples[text] = (min(d, i), max(label, y))
    counts = {d: X.term_counts(text) for text, (d, _) in examples.items() if text}
    label = {d: y for text, (d, y) in examples.items() if text}
    n, marked = len(label), sum(label.values())
    terms = {t for c in counts.values() for t in c}
    a, b = ({t: sum(t in c for d, c in counts.items() if label[d] == y) for t in terms} for y in (1, 0))

    def g2(t):
        cells = [(a[t], a[t] + b[t], marked), (b[t], a[t] + b[t], n - marked)]
        cells += [(marked - a[t], n - a[t] - b[t], marked), (n - marked - b[t], n - a[t] - b[t], n - marked)]
        return max(0, 2 * sum(x * math.log(x * n / (r * c)) for x, r, c in cells if x))

    idf = {t: (math.log((1 + n) / (1 + a[t] + b[t])) + 1) * (1 + math.sqrt(g2(t))) for t in terms}
    weigh = lambda c: {t: (1 + math.log(m)) * idf[t] for t, m in c.items() if t in idf}
    unit = lambda v: {t: x / np.sqrt(sum(y * y for y in v.values())) for t, x in v.items()}
    vectors = {d: unit(weigh(c)) for d, c in counts.items()}
    for i, text in texts.items():
        own = unit(weigh(X.term_counts(text or "")))
        ranked = sorted((-round(sum(x * v.get(t, 0) for t, x in own.items()), 9), d) for d, v in vectors.items())
        assert [(-round(e.similarity, 9), e.doc_id) for e in found[i].evidence] == [r for r in ranked if r[0] < 0][:3]


def test_scores_are_probabilities_that_follow_the_votes():
    model = index(3)
    grid = np.interp(np.linspace(0, 1, 50), *model.knots)
    assert (np.diff(grid) >= 0).all() and grid.min() >= 0 and grid.max() <= 1
    assert model.score(model.vector_of("tb tb tc tc"))[0] > 0.7 > 0.5 > model.score(model.vector_of("tj tj"))[0]


def test_held_out_accuracy_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = X.score_toxicity(docs, labels)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted", "evidence"]
    rows = {r.doc_id: r for r in scored.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    truth = [(rows[r.doc_id], r.toxic) for r in labels.collect() if r.doc_id in rows]
    held = [(r, y) for r, y in truth if r.held_out]
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    toxic, clean = ([r.score for r, y in held if y == label] for label in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_without_labels_and_with_nulls(spark, table):
    docs = table([(1, None, 0.5), (2, "", 0.5), (None, "some words", 0.5)], "doc_id long, text string, score double")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = X.score_toxicity(docs, none).collect()
    assert sorted((str(r.doc_id), r.score, r.predicted) for r in rows) == [("1", 0.5, 0), ("2", 0.5, 0), ("None", 0.5, 0)]
    assert X.score_toxicity(docs.limit(0), none).count() == 0


def test_few_examples_still_search_every_text(spark):
    """51 examples, 6 of them toxic: scores differ, and toxic texts lead."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in X.score_toxicity(docs, labels).collect()}
    assert len(rows) == docs.count() and len({r.score for r in rows.values()}) > 5
    worded = {r.doc_id for r in docs.collect() if len((r.text or "").split()) >= 20}
    assert len(worded) > 150 and all(rows[d].evidence for d in worded)
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in rows}
    toxic, clean = ([rows[d].score for d, y in truth.items() if y == label] for label in (1, 0))
    assert np.mean(toxic) > np.mean(clean)


def test_a_toxic_word_of_few_examples_counts(spark, table):
    draw = random.Random(4)
    ids = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 != 1][:400]
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for n, i in enumerate(ids):
        toxic = n % 4 == 0
        mark = ("vilenessx" if n < 24 else "scumbagq") if toxic else "kindly"
        rows.append((i, " ".join([*(draw.choice(words) for _ in range(40)), mark])))
        labels.append((i, int(toxic)))
    text = " ".join(draw.choice(words) for _ in range(40))
    rows += [(5000, f"{text} vilenessx"), (5001, text), (5002, f"{text} kindly")]
    found = {r.doc_id: r for r in X.score_toxicity(table(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert found[5000].score > 0.7 > found[5002].score and all(e.label == 1 for e in found[5000].evidence)
    assert found[5001].evidence
