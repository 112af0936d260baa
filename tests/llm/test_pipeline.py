"""The pipeline over a small table, stage by stage against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import public_tokenizers

import corpus_pipeline
from patronlake.llm import unigram
from patronlake.llm.quality_rules import STOP_WORDS
from patronlake.llm.queries import DOMAINS

WORDS = [f"{a}{b}" for a in "bcdfgjklmnp" for b in ("ado", "ero", "ina", "olu", "ist")] + ["the", "of", "and", "le", "der"]


def good_text(draw, n):
    return " ".join(draw.choice(WORDS[-5:] if i % 4 == 0 else WORDS) + draw.choice("abcdefgh") * (i % 3) for i in range(n))


def fixture(seed=1):
    draw = random.Random(seed)
    rows, near = [], {}
    for i in range(60):
        text = good_text(draw, draw.randint(60, 150))
        rows.append([i, text, draw.choice(["en", "de", None]), draw.choice(["src0", "src11", "src16", None])])
    for i in range(0, 12):
        edited = rows[i][1].split(" ")
        edited[len(edited) // 2] = "changed"
        rows.append([200 + i, " ".join(edited), "en", "src1"])
        near[200 + i] = i
    rows.append([300, rows[5][1], "en", "src2"])
    near[300] = 5
    passage = good_text(draw, 30)
    for i in range(400, 406):
        rows.append([i, f"{good_text(draw, 60)} {passage} {good_text(draw, 60)}", "fr", "src3"])
    junk = [None, "", "too short", "word%%% " * 80, "same line here\n" * 30, "| x " * 60]
    rows += [[500 + k, t, "en", "src0"] for k, t in enumerate(junk)]
    return [(*r, len(r[1] or "")) for r in rows], near, passage


def test_stages_do_what_they_say(spark, tmp_path):
    rows, near, passage = fixture()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    text = {r[0]: r[1] for r in rows}

    docs = stages["quality rules"](spark, docs, str(tmp_path))
    assert {r.doc_id for r in docs.collect()} == {i for i in text if i < 500}

    docs = stages["SimHash near-dedup"](spark, docs, str(tmp_path))
    left = {r.doc_id for r in docs.collect()}
    assert left == {i for i in text if i < 500} - set(near)

    docs = stages["suffix-array dedup"](spark, docs, str(tmp_path))
    cut = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert [i for i in sorted(cut) if passage in cut[i].text] == [400]
    assert all(cut[i].text == text[i] for i in cut if i < 400) and all(len(cut[i].text) == cut[i].n_chars for i in cut)
    assert all(len(text[i]) - len(cut[i].text) >= len(passage) for i in range(401, 406))

    mixed = {r.doc_id: r for r in stages["source mix"](spark, docs, str(tmp_path)).collect()}
    assert set(mixed) == plain_mix(list(cut.values()))

    out = stages["SentencePiece"](spark, docs.filter("doc_id < 10"), str(tmp_path)).collect()
    codec = unigram.Codec(unigram.read_model(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()))
    assert out and all(r.round_trip and codec.decode(r.ids) == cut[r.doc_id].text for r in out)

    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in whole.collect()} == set(mixed)


def plain_mix(docs):
    """Ids of the mix, by whole-number budgets down the tree and a prefix in the order of a hash."""
    spec = corpus_pipeline.PIPELINE_MIX
    domain = {f"src{n}": d for d, numbers in DOMAINS.items() for n in numbers}
    leaves = defaultdict(list)
    for d in docs:
        leaves[domain.get(d.source, "web"), d.lang, d.source].append((d.doc_id, len(re.findall(r"\S+", d.text))))
    size = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    weights = spec.domain_weights, spec.lang_weights, spec.source_weights

    def deal(budget, prefix):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        children = sorted({leaf[depth] for leaf in leaves if leaf[:depth] == prefix}, key=lambda c: (c is not None, c or ""))
        rest = {c: (weights[depth].get(c, 1), sum(n for leaf, n in size.items() if leaf[: depth + 1] == (*prefix, c))) for c in children}
        shares = {}
        while True:
            total = sum(w for w, _ in rest.values())
            full = [c for c, (w, cap) in rest.items() if cap * total <= budget * w]
            if not full:
                break
            for c in full:
                shares[c] = rest[c][1]
            budget -= sum(rest.pop(c)[1] for c in full)
        shares |= {c: budget * w // total for c, (w, _) in rest.items()}
        return {k: v for c, b in shares.items() for k, v in deal(b, (*prefix, c)).items()}

    chosen = set()
    for leaf, budget in deal(sum(size.values()) * spec.share // 100, ()).items():
        if budget >= size[leaf]:
            chosen |= {d for d, _ in leaves[leaf]}
            continue
        order = sorted(leaves[leaf], key=lambda d: (hashlib.md5(f"{spec.seed}:1:{d[0]}".encode()).hexdigest()[:15], d[0]))
        upto = 0
        for doc, n in order:
            upto += n
            if upto <= budget:
                chosen.add(doc)
    return chosen


def test_stop_words_are_lower_case():
    assert all(w == w.lower() for w in STOP_WORDS)
