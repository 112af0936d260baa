"""SimHash against brute force, and the wide form on near copies."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from patronlake.llm import simhash


def plain_fingerprint(text, k=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, k=3, distance=3):
    prints = [plain_fingerprint(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((str(doc), prints[i], least.get(find(i))) for i, (doc, _) in enumerate(rows))


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["ÉTÉ", "Straße", "A"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two")]
    texts = []
    for i in range(10, 10 + n):
        if texts and draw.random() < 0.6:
            text = draw.choice(texts).split(" ")
            for _ in range(draw.randint(0, 2)):
                text[draw.randrange(len(text))] = draw.choice(words)
            text = " ".join(text)
        else:
            text = " ".join(draw.choice(words) for _ in range(draw.randint(20, 200)))
        texts.append(text)
        rows.append((i, text))
        if draw.random() < 0.1:
            rows.append((i, text))
    return rows


@pytest.mark.parametrize("hot_rows", [4096, 5])
def test_components_equal_brute_force(table, hot_rows):
    rows = corpus(3, 250)
    found = simhash.simhash_components(table(rows), hot_rows=hot_rows).collect()
    ours = sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in found)
    assert ours == plain_components(rows)


def test_extra_columns_and_an_empty_table(spark, table):
    rows = [(1, "a b c d", "x"), (2, "a b c d", "y")]
    df = table(rows, "doc_id long, text string, fp string")
    assert {r.component_id for r in simhash.simhash_components(df).collect()} == {1}
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_blocks_share_a_key_within_the_distance():
    draw = np.random.default_rng(1)
    for distinct in (10, 10**6, 10**9, 10**12):
        masks = simhash.block_masks(simhash.blocks_for(distinct))
        for _ in range(50):
            flips = sum(1 << int(b) for b in draw.choice(64, 3, replace=False))
            assert any(flips & m == 0 for m in masks)


def test_a_very_long_text_is_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_PIECE", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text.decode())


def test_forest_links_what_is_close():
    draw = np.random.default_rng(2)
    centres = draw.integers(0, 2**63, 5, dtype=np.uint64)
    fps = np.array([[c ^ np.uint64(1 << int(draw.integers(64)))] for c in centres for _ in range(20)], np.uint64)
    links = simhash.forest(fps, 3)
    assert len(links) == 95 and all(i // 20 == j // 20 for i, j in links)
    cross = simhash.forest(np.concatenate([fps[:3], fps[20:23], fps[3:5]]), 3, cross=6)
    assert {j for _, j in cross} == {6, 7}


def jaccard(a, b, k=5):
    sets = [{tuple(t.split()[i : i + k]) for i in range(len(t.split()) - k + 1)} for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_groups_catch_near_copies_and_leave_others(table):
    draw = random.Random(5)
    words = [f"v{i}" for i in range(3000)]
    originals = [[draw.choice(words) for _ in range(200)] for _ in range(120)]
    rows, near = [], set()
    for i, text in enumerate(originals):
        rows.append((i, " ".join(text)))
        if i % 2:
            continue
        edited = list(text)
        for at in draw.sample(range(200), 3):
            edited[at] = draw.choice(words)
        assert jaccard(" ".join(text), " ".join(edited)) >= 0.8
        rows.append((1000 + i, " ".join(edited)))
        near.add((1000 + i, i))
    rows += [(5000, None), (5001, ""), (None, rows[0][1]), (6000, rows[0][1])]
    found = {(r.doc, r.component) for r in simhash.near_groups(table(rows)).collect()}
    assert (6000, 0) in found and (5001, 5000) in found
    others = found - {(6000, 0), (5001, 5000)}
    assert others <= near and len(others) >= 0.9 * len(near)


def pair_at(draw, words, share, n=204):
    """Two texts of n words whose five-word shingles have Jaccard similarity `share`, by a replaced tail."""
    total = n - 4
    lost = round(total * (1 - share) / (1 + share))
    text = [draw.choice(words) for _ in range(n)]
    return text, [*text[: n - lost], *(draw.choice(words) for _ in range(lost))]


@pytest.mark.parametrize("share, linked", [(0.802, True), (0.78, False), (0.7, False)])
def test_near_groups_decide_by_exact_jaccard(table, share, linked):
    draw = random.Random(7)
    words = [f"v{i}" for i in range(30000)]
    rows = []
    for i in range(300):
        pair = [" ".join(t) for t in pair_at(draw, words, share)]
        assert (jaccard(*pair) >= 0.8) == linked and abs(jaccard(*pair) - share) < 0.01
        rows += [(2 * i, pair[0]), (2 * i + 1, pair[1])]
    found = {(r.doc, r.component) for r in simhash.near_groups(table(rows)).collect()}
    assert found <= {(2 * i + 1, 2 * i) for i in range(300)}
    assert len(found) >= 0.96 * 300 if linked else not found


def test_verified_links_equal_brute_force():
    draw = random.Random(9)
    sets = [np.unique(np.array(draw.sample(range(60), draw.randint(0, 50)), np.uint64)) for _ in range(80)]
    sets += [np.union1d(x, np.array([99], np.uint64)) for x in sets]
    exact = {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if len(a := set(sets[i]) | set(sets[j])) and len(set(sets[i]) & set(sets[j])) >= 0.8 * len(a)
    }

    def classes(links):
        root = list(range(len(sets)))
        for i, j in links:
            root = [root[i] if r == root[j] else r for r in root]
        return {tuple(i for i, r in enumerate(root) if r == x) for x in set(root)}

    assert set(simhash.similar(sets, 0.8)) <= exact and classes(simhash.similar(sets, 0.8)) == classes(exact)
    crossing = {(i, j) for i, j in exact if i < 70 <= j}
    assert classes(simhash.similar(sets, 0.8, cross=70)) == classes(crossing)


def test_merged_labels_equal_components():
    draw = np.random.default_rng(4)
    centres = draw.integers(0, 2**63, (6, 4), dtype=np.uint64)
    fps = np.array([c ^ np.array([1 << int(draw.integers(63)), 0, 0, 0], np.uint64) for c in centres for _ in range(15)])
    label = np.array([7 * (i // 2) + 3 for i in range(len(fps))])
    low, high = simhash.merged(fps, 3, label)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(i // 15, set()).add(int(label[i]))
    whole = []  # labels that lie in two groups join them
    for own in groups.values():
        own = set(own)
        for other in [x for x in whole if x & own]:
            whole.remove(other)
            own |= other
        whole.append(own)
    assert sorted(zip(low.tolist(), high.tolist())) == sorted((min(x), y) for x in whole for y in x if y != min(x))
    assert len(simhash.merged(fps, 3, np.zeros(len(fps), np.int64))[0]) == 0


def near_copies(draw, n, words):
    base = [draw.choice(words) for _ in range(400)]
    out = []
    for _ in range(n):
        text = list(base)
        for at in draw.sample(range(400), 4):
            text[at] = draw.choice(words)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("n", [300, 600])
def test_links_of_a_class_do_not_grow_with_the_number_of_keys(table, monkeypatch, n):
    rows = list(enumerate(near_copies(random.Random(11), n, [f"v{i}" for i in range(30000)])))
    seen = []
    plain = simhash.components

    def counted(edges, space, name="stars"):
        seen.append((name, edges.count()))
        return plain(edges, space, name)

    monkeypatch.setattr(simhash, "components", counted)
    found = simhash.near_groups(table(rows)).collect()
    assert {r.component for r in found} == {0} and len(found) == n - 1
    loose = [count for name, count in seen if name.startswith("loose")]
    assert len(loose) == 1 and loose[0] <= 10 * n


@pytest.mark.parametrize("set_rows", [7, 2048])
def test_large_classes_are_verified_in_chunks(spark, table, set_rows):
    draw = random.Random(12)
    words = [f"v{i}" for i in range(30000)]
    texts = near_copies(draw, 30, words) + near_copies(draw, 30, words)
    docs = table(list(enumerate(texts)))
    classes = table([(i, 0) for i in range(60)], "node long, root long")  # one loose class of two real ones
    space = simhash.Workspace(spark, "verified")
    links = simhash._verified(docs, classes, 0.8, space, "doc_id", "text", set_rows=set_rows)
    roots = {r.node: r.root for r in simhash.components(links, space).collect()}
    assert roots == {i: 0 if i < 30 else 30 for i in range(60)}
