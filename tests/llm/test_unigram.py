"""The unigram codec against brute force, the library and an exact round trip."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from patronlake.llm import unigram as U

BYTES = [f"<0x{b:02X}>" for b in range(256)]


def field(number, kind, body):
    head = bytes([number << 3 | kind])
    return head + (len(body).to_bytes(1, "little") if len(body) < 128 else bytes([len(body) & 127 | 128, len(body) >> 7])) + body if kind == 2 else head + body


def model_file(pieces):
    """A model file of (piece, score, kind); unigram, bytes for unknown characters, no normalising."""
    out = b""
    for piece, score, kind in pieces:
        entry = field(1, 2, piece.encode()) + field(2, 5, np.float32(score).tobytes()) + field(3, 0, bytes([kind]))
        out += field(1, 2, entry)
    trainer = field(3, 0, b"\x01") + bytes([35 << 3 & 127 | 128, 35 << 3 >> 7]) + b"\x01"
    normaliser = field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01")
    return out + field(2, 2, trainer) + field(3, 2, normaliser)


def small_model(seed=1):
    draw = random.Random(seed)
    pieces = {U.MARK, "a", "b", "c", "é", "日"}
    while len(pieces) < 120:
        body = "".join(draw.choice("abcé日") for _ in range(draw.randint(1, 4)))
        pieces.add(draw.choice(["", U.MARK]) + body)
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(b, -30.0, 6) for b in BYTES]
    return rows + [(p, -draw.uniform(2, 14), 1) for p in sorted(pieces)]


def texts(seed, n=150):
    draw = random.Random(seed)
    return ["", " ", "  ", "a", "x", "日 本", "▁", "a▁b", "\n", "abc\n\nabc  ", "tab\there", "🙂a"] + [
        "".join(draw.choice("abcé日x \n") for _ in range(draw.randint(1, 60))) for _ in range(n)
    ]


def ids(packed):
    return np.frombuffer(packed, "<i4").tolist()


def brute_score(codec, text):
    """Best sum over all segmentations of a text without unknown characters of its own."""
    written = U.MARK + text.replace(" ", U.MARK)
    best = [0.0] + [-np.inf] * len(written)
    usable = {p: codec.scores[i] for i, (p, k) in enumerate(zip(codec.model.pieces, codec.model.kinds)) if k == 1}
    for end in range(1, len(written) + 1):
        for begin in range(end):
            piece = written[begin:end]
            score = usable.get(piece)
            if score is None and end - begin == 1:
                score = codec.least - U.UNKNOWN_COST
            if score is not None:
                best[end] = max(best[end], best[begin] + score)
    return best[-1]


def test_best_score_and_round_trip():
    codec = U.Codec(U.read_model(model_file(small_model())))
    for text in texts(2):
        if U.MARK in text:
            continue
        found = ids(codec.encode([text])[0])
        assert codec.decode(found) == text
        if not text:
            assert found == []
            continue
        byte_runs = [i for i in found if codec.model.kinds[i] == 6]
        pieces = sum(codec.scores[i] for i in found if codec.model.kinds[i] != 6)
        unknown = len(bytes(int(codec.model.pieces[i][3:5], 16) for i in byte_runs).decode())
        assert pieces + unknown * (codec.least - U.UNKNOWN_COST) == pytest.approx(brute_score(codec, text))


def test_segments_are_those_of_the_library():
    file = model_file(small_model(4))
    library = sentencepiece.SentencePieceProcessor(model_proto=file)
    codec = U.Codec(U.read_model(file))
    many = [t for t in texts(5, 400) if U.MARK not in t]
    assert [ids(x) for x in codec.encode(many)] == library.encode(many)
    assert [codec.decode(x) for x in library.encode(many)] == many


def test_literal_markers_survive():
    codec = U.Codec(U.read_model(model_file(small_model())))
    for text in ("▁", "a▁ b", " ▁▁ "):
        assert codec.decode(ids(codec.encode([text])[0])) == text


def test_trie_has_all_its_keys_and_no_others():
    draw = random.Random(7)
    keys = {bytes(draw.choice(b"abc\xff\x00") for _ in range(draw.randint(1, 6))): i for i in range(800)}
    trie = U.DoubleArray(keys)
    data = np.frombuffer(b"".join(keys), np.uint8).astype(np.int64)
    starts = np.arange(len(data))
    found = set(zip(*(x.tolist() for x in trie.matches(data, starts, np.full(len(data), len(data))))))
    whole = data.astype(np.uint8).tobytes()
    expected = {(i, i + n, keys[whole[i : i + n]]) for i in starts.tolist() for n in range(1, 7) if whole[i : i + n] in keys and i + n <= len(data)}
    assert found == expected


def test_public_vocabulary_round_trip_over_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = U.encode_column(docs, path, keep=("doc_id", "lang")).collect()
    assert len(rows) == docs.count() and all(r.round_trip and len(r.ids) == r.n_tokens for r in rows)
    codec = U.Codec(U.read_model(open(path, "rb").read()))
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(codec.decode(r.ids) == text[r.doc_id] for r in rows)


def test_null_empty_and_repeated_rows(table):
    path = public_tokenizers.path("piece_bpe_32k.model")
    long = "word " * 100_000 + "w" * 5000
    df = table([(1, None, 1), (2, "", 2), (3, long, 3), (3, long, 3), (None, "x", 4)], "doc_id long, text string, ids int")
    rows = U.encode_column(df, path).collect()
    assert sorted((str(r.doc_id), r.n_tokens == 0, r.round_trip) for r in rows) == [
        ("1", True, True), ("2", True, True), ("3", False, True), ("3", False, True), ("None", False, True),
    ]
    assert U.encode_column(df.limit(0), path).count() == 0
