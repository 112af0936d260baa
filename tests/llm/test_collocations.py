"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from patronlake.llm import collocations


def plain(rows, least, longest, first):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inside = {}
        for g, a in often.items():
            for i in range(len(g)):
                for j in range(i + 2, len(g) + 1):
                    if j - i < len(g):
                        inside[g[i:j]] = max(a, inside.get(g[i:j], 0))
        for g, a in often.items():
            if 100 * inside.get(g, 0) >= 100 * a:
                continue
            score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(table, rows, **options):
    frame = table([(*r, 1, "x") for r in rows], "lang string, text string, n long, phrase string")
    return sorted(tuple(r) for r in collocations.mine(frame, **options).collect())


def texts(seed, n, words=40):
    draw = random.Random(seed)
    known = [f"w{i}" for i in range(words)] + ["ÉTÉ", "Straße", "A", "\x1f", "x\x00y"]
    weights = [1 / (i + 1) for i in range(len(known))]
    fixed = [draw.choices(known, weights, k=draw.randint(2, 6)) for _ in range(12)]
    rows = [("en", None), (None, "  "), ("", "a b. a b"), ("und", "q r q r, q r")]
    for _ in range(n):
        parts = []
        for _ in range(draw.randint(1, 12)):
            parts.append(" ".join(draw.choice(fixed) if draw.random() < 0.3 else draw.choices(known, weights, k=draw.randint(1, 5))))
            parts.append(draw.choice([" ", "\t", ".", ", ", "\n", "\r\n", "?!", "  ", " \x0b"]))
        rows.append((draw.choice(["en", "en", "de", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize("seed, least, longest, first", [(1, 2, 5, 2000), (2, 3, 5, 15), (3, 2, 2, 10), (4, 5, 4, 3)])
def test_equals_plain_counting(table, seed, least, longest, first):
    rows = texts(seed, 150)
    options = dict(least=least, longest=longest, first=first)
    assert found(table, rows, **options) == plain(rows, **options)


@pytest.mark.parametrize("open_at_first", [1, 3])
def test_rounds_and_full_bitmaps_change_nothing(table, monkeypatch, open_at_first):
    monkeypatch.setattr(collocations, "OPEN_AT_FIRST", open_at_first)
    monkeypatch.setattr(collocations, "GROWTH", 2)
    rows = texts(7, 200, words=300)
    options = dict(least=2, longest=5, first=20)
    assert found(table, rows, **options, max_bits=1 << 15) == plain(rows, **options)


def test_long_texts_are_cut_without_loss(table, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 40)
    rows = [*texts(5, 60), ("en", "no stops at all " * 500)]
    options = dict(least=2, longest=5, first=50)
    assert found(table, rows, **options) == plain(rows, **options)


def test_a_bitmap_that_says_yes_to_all_changes_nothing(table, monkeypatch):
    monkeypatch.setattr(collocations, "_has", lambda bitmap, hashes: hashes == hashes)
    rows = texts(6, 80)
    options = dict(least=3, longest=5, first=30)
    assert found(table, rows, **options) == plain(rows, **options)


def test_repeated_words_and_empty_tables(table):
    rows = [("en", "a a a a a a a"), ("en", "a a"), ("en", "b a a b")] * 2
    options = dict(least=2, longest=5, first=100)
    assert found(table, rows, **options) == plain(rows, **options)
    assert found(table, [], **options) == []
    assert found(table, [("en", None), (None, "")], **options) == []
