"""Removed passages against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from patronlake.llm import anchors, suffix_dedup
from patronlake.llm.suffix_dedup import cut_documents, dedup_passages

LAST = 1 << 62


def brute(rows, span=50):
    first = {}
    for doc, text in rows:
        data, order = (text or "").encode(), LAST if doc is None else doc
        for i in range(len(data) - span + 1):
            w = data[i : i + span]
            first[w] = min(order, first.get(w, order))
    out = []
    for doc, text in rows:
        data, order = (text or "").encode(), LAST if doc is None else doc
        covered = bytearray(len(data))
        for i in range(len(data) - span + 1):
            if first[data[i : i + span]] < order:
                covered[i : i + span] = b"\x01" * span
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out.append((doc, len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def corpus(seed):
    draw = random.Random(seed)
    words = ["the", "of", "tion", "ing", "alpha", "beta", "élan", "x", "long", "word", "zz"]

    def text(n):
        return " ".join(draw.choice(words) for _ in range(n))

    common, shared = text(30), [text(25) for _ in range(6)]
    rows = [(None, common), (None, common), (3, None), (4, ""), (5, "short"), (6, "y" * 49), (7, "y" * 50), (8, "y" * 400)]
    for i in range(10, 120):
        t = text(draw.randint(1, 80))
        if draw.random() < 0.6:
            t = t[: len(t) // 2] + draw.choice(shared)[draw.randint(0, 9) :] + t[len(t) // 2 :]
        if draw.random() < 0.3:
            t = "The The " * draw.randint(5, 90) + t
        rows.append((i, t))
        if draw.random() < 0.2:
            rows.append((i, t))
        if draw.random() < 0.2:
            at = draw.randint(0, max(0, len(t) - 1))
            rows.append((draw.randint(10, 300), t[:at] + "Q" + t[at:]))
    return rows


@pytest.mark.parametrize("batches, hot_rows", [(1, 1 << 17), (5, 1 << 17), (3, 20)])
def test_removed_bytes_equal_brute_force(table, batches, hot_rows):
    rows = corpus(batches)
    found = dedup_passages(table(rows), batches, hot_rows)
    assert sorted(str(tuple(r)) for r in found.drop("kept").collect()) == brute(rows)
    for r in found.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_an_empty_table_and_extra_columns(table):
    df = table([(1, "a", 1)], "doc_id long, text string, body int")
    assert [r.n_bytes for r in dedup_passages(df).collect()] == [1]
    assert dedup_passages(df.limit(0)).count() == 0


def test_equal_windows_have_equal_anchors():
    draw = np.random.default_rng(1)
    shared = bytes(draw.integers(97, 101, 120, dtype=np.uint8))
    texts = [bytes(draw.integers(97, 101, n, dtype=np.uint8)) + shared + b"tail" * n for n in (0, 3, 77, 500)]
    s = anchors.segments(texts)
    kept = [{(int(p), int(g)) for p, g in zip(s.prefix[s.doc == i], s.group[s.doc == i])} for i in range(4)]
    assert set.intersection(*kept)


def test_long_texts_are_scanned_in_overlapping_pieces():
    draw = np.random.default_rng(3)
    text = bytes(draw.integers(97, 123, 5000, dtype=np.uint8))
    windows = []
    for s in anchors.scan([b"short", text, b"z" * 70], most=600):
        for doc, start, a, b in zip(s.doc, s.start_in_text, s.start, s.end):
            source = [b"short", text, b"z" * 70][doc]
            assert source[start : start + b - a] == s.buffer[a:b]
            windows += [(int(doc), int(start) + i) for i in range(int(b - a) - anchors.SPAN + 1)]
    assert sorted(windows) == sorted({*((1, i) for i in range(4951)), *((2, i) for i in range(21))})


def test_documents_keep_their_columns(table):
    passage = "ä quite ordinary passage that is repeated word by word in two documents"
    rows = [(1, passage, "en", 5, "x"), (2, f"before {passage} after", "de", 5, None), (3, passage, None, None, "z"), (4, None, "en", 0, "y")]
    out = cut_documents(table(rows, "doc_id long, text string, lang string, n_chars long, own string"))
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "own"]
    found = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    assert found[1] == (passage, "en", len(passage), "x")
    assert found[2] == ("before  after", "de", 13, None) and set(found) == {1, 2}


def test_an_anchor_hot_in_one_batch_and_cold_in_another(table):
    """Documents of batch 2 share windows, not segments, with an anchor that only batch 1 has often."""
    draw = random.Random(11)

    def noise(n):
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    passage = noise(60)
    rows = [(i, passage) for i in range(1, 61)] + [(1000 + i, noise(80)) for i in range(58)]
    rows += [(2000, noise(40) + passage[:54] + noise(40)), (2001, noise(40) + passage[6:] + noise(40))]
    found = dedup_passages(table(rows), 2, 20).drop("kept").collect()
    assert {r.doc_id: r.n_removed for r in found if r.doc_id >= 2000} == {2000: 54, 2001: 54}
    assert sorted(str(tuple(r)) for r in found) == brute(rows)


def test_places_give_the_spans_that_a_scan_gives():
    draw = random.Random(21)
    text = bytes(draw.randrange(97, 123) for _ in range(4000))
    found = next(suffix_dedup.anchors.scan([text]))
    assert len(set(found.body.tolist())) == len(found.body)
    chosen = np.array(sorted(draw.sample(range(len(found.body)), 40)))
    masks = np.array([-1 if draw.random() < 0.5 else 1 << draw.randrange(max(1, int(n) - 49)) for n in (found.end - found.start)[chosen]])
    place = found.start_in_text[chosen] << 8 | (found.end - found.start)[chosen]
    scanned = suffix_dedup.removed_spans(text, dict(zip(found.body[chosen].tolist(), masks.tolist())))
    row = np.full(len(place), 1)
    assert suffix_dedup.spans_at([b"before", text, b""], row, masks, place) == [[], scanned, []] and scanned
