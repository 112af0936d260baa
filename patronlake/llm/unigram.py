"""SentencePiece-style encoding and decoding with a unigram model.

Text becomes pieces by the segmentation of the highest sum of log scores (Viterbi). Candidate pieces
come from a double-array trie over UTF-8 bytes. Blanks are written as U+2581 and one more is put in
front; a character that no piece covers costs `UNKNOWN_COST` below the least score and becomes its
bytes' pieces; decoding joins pieces, turns the marker back and drops the first. A U+2581 of the text
itself goes through byte pieces, so decoding always gives the text back, byte by byte.

Scores of a unigram model's file are taken as they are. A BPE model's file has ranks in place of
probabilities; the log score of rank r is then that of Zipf's law, -ln(r) - ln(1 + 1/2 + ... + 1/n).
Nothing is trained.

Pieces have the marker in front only, and no piece has a line feed, so a text falls into units that can
be segmented on their own with the same result. Each task keeps the encodings of units it has met, up to
`KEPT_UNITS`, and runs the others through trie and Viterbi together, all units in step.

Defined results: a NULL or empty text has no pieces; of segmentations with equal scores the one whose
last differing piece is longer; long texts and long units are taken whole; repeated rows and NULL ids
stay; an empty table gives an empty result; further columns stay.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlake.llm.shared import prepare, whole_text

MARK = "▁"
_LITERAL = "\ud800"  # stands for a U+2581 of the text; no valid text has a surrogate
UNKNOWN_COST = 10.0
KEPT_UNITS = 200_000
_ENCODED_AT_ONCE = 1 << 20  # characters encoded and given back together
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM = 1


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message: integers, 4-byte words and byte strings."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    pieces: list[str]
    kinds: list[int]
    scores: np.ndarray

    @property
    def byte_ids(self) -> np.ndarray:
        ids = np.full(256, -1, np.int32)
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind == _BYTE:
                ids[int(piece[1:-1], 16)] = i
        return ids


def read_model(file: bytes) -> Model:
    """Pieces, kinds and log scores of a SentencePiece model file."""
    pieces, kinds, scores, model_type = [], [], [], _UNIGRAM
    for number, value in _fields(file):
        if number == 1:
            entry = {1: b"", 2: b"\0\0\0\0", 3: _NORMAL} | dict(_fields(value))
            pieces.append(entry[1].decode())
            scores.append(float(np.frombuffer(entry[2], "<f4")[0]))
            kinds.append(entry[3])
        elif number == 2:
            model_type = dict(_fields(value)).get(3, _UNIGRAM)
    values = np.array(scores, np.float64)
    if model_type != _UNIGRAM:
        ranked = sorted((i for i, k in enumerate(kinds) if k in (_NORMAL, _USER)), key=lambda i: (-values[i], i))
        total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
        for rank, i in enumerate(ranked, 1):
            values[i] = -math.log(rank) - total
    return Model(pieces, kinds, values)


class DoubleArray:
    """A trie of byte strings in two arrays: the child of node s by byte c is t = base[s] + c + 1, if
    check[t] = s. `value` has the key's number, or -1."""

    _STEP, _BACK = 256, 2048  # places tried at a time, and how far behind the frontier gaps are filled

    def __init__(self, keys: dict[bytes, int]):
        items = sorted(keys.items())
        size = 1 << max(12, (sum(len(k) for k, _ in items) * 2).bit_length())
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0], check[0], frontier = False, -2, 0
        tries = np.arange(self._STEP)[:, None]
        todo = [(0, 0, len(items), 0)]  # node, range of keys, depth
        while todo:
            node, low, high, depth = todo.pop()
            if low < high and len(items[low][0]) == depth:
                value[node] = items[low][1]
                low += 1
            children, at = [], low
            while at < high:
                byte, begin = items[at][0][depth], at
                while at < high and items[at][0][depth] == byte:
                    at += 1
                children.append((byte, begin, at))
            if not children:
                continue
            offsets = np.array([c for c, _, _ in children]) + 1
            begin = max(0, frontier - self._BACK)
            while True:
                while begin + self._STEP + 257 > len(free):
                    base, check, value, free = (
                        np.concatenate([x, np.full(len(x), fill, x.dtype)])
                        for x, fill in ((base, 0), (check, -1), (value, -1), (free, True))
                    )
                fits = free[begin + tries + offsets].all(1)
                if fits.any():
                    begin += int(fits.argmax())
                    break
                begin += self._STEP
            base[node] = begin
            slots = begin + offsets
            check[slots], free[slots] = node, False
            frontier = max(frontier, int(slots[-1]))
            for slot, (_, a, b) in zip(slots.tolist(), children):
                todo.append((slot, a, b, depth + 1))
        used = frontier + 258
        self.base, self.check, self.value = (
            np.concatenate([x[:used], np.full(max(0, used - len(x)), -1, np.int32)]) for x in (base, check, value)
        )

    def matches(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray):
        """All keys that begin at any of the starts and end by its limit: (start, end, value)."""
        node, at = np.zeros(len(starts), np.int64), starts.copy()
        found = []
        while len(starts):
            alive = at < limits
            node, at, starts, limits = node[alive], at[alive], starts[alive], limits[alive]
            child = self.base[node] + data[at] + 1
            alive = self.check[child] == node
            node, at, starts, limits = child[alive], at[alive] + 1, starts[alive], limits[alive]
            value = self.value[node]
            hit = value >= 0
            if hit.any():
                found.append((starts[hit], at[hit], value[hit]))
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none
        return tuple(map(np.concatenate, zip(*found)))


class Codec:
    """Encodes and decodes texts with one model. Its size is that of the vocabulary, so it is broadcast."""

    def __init__(self, model: Model):
        self.model = model
        usable = {p.encode(): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (_NORMAL, _USER)}
        self.trie = DoubleArray(usable)
        normal = [model.scores[i] for i, k in enumerate(model.kinds) if k == _NORMAL]
        self.least, most = min(normal, default=0.0), max(normal, default=0.0)
        self.scores = model.scores.copy()
        for i, kind in enumerate(model.kinds):
            if kind == _USER:  # always preferred to the pieces it is made of
                self.scores[i] = len(model.pieces[i]) * most - 0.1
        self.byte_ids = model.byte_ids
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == _UNKNOWN), 0)
        self.has_bytes = bool((self.byte_ids >= 0).all())
        inner = any(MARK in p.lstrip(MARK) or "\n" in p for p in map(bytes.decode, usable))
        plain = f"[^{_LITERAL}]+" if inner else f"{MARK}*[^{MARK}\n{_LITERAL}]+|{MARK}+|\n"
        self.units = re.compile(f"{plain}|{_LITERAL}")
        self.bytes_of = [
            bytes([int(p[1:-1], 16)]) if k == _BYTE else b"" if k == _CONTROL else p.replace(MARK, " ").encode()
            for p, k in zip(model.pieces, model.kinds)
        ]
        self.kept: dict[str, bytes] = {}

    def segment(self, units: list[bytes]) -> list[bytes]:
        """The piece ids of each unit, as the bytes of 32-bit numbers."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(lengths)
        begins = ends - lengths
        data = np.frombuffer(b"".join(units), np.uint8).astype(np.int64)
        unit = np.repeat(np.arange(len(units)), lengths)
        starts = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
        start, end, piece = self.trie.matches(data, starts, ends[unit[starts]])
        # positions are shifted by the unit's number, so that each unit has an end of its own
        lead = data[starts]
        width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        single = np.zeros(len(data) + 1, bool)
        wide = np.zeros(len(data) + 1, np.int64)
        wide[starts] = width
        single[start[end - start == wide[start]]] = True
        missing = ~single[starts]
        start = np.concatenate([start, starts[missing]])
        end = np.concatenate([end, starts[missing] + width[missing]])
        score = np.concatenate([self.scores[piece], np.full(int(missing.sum()), self.least - UNKNOWN_COST)])
        piece = np.concatenate([piece, np.full(int(missing.sum()), -1)])
        owner = unit[start]
        order = np.argsort(start - begins[owner], kind="stable")
        start, end, score, piece, owner = (x[order] for x in (start, end, score, piece, owner))
        at = start - begins[owner]
        best = np.full(len(data) + len(units), -np.inf)
        back = np.zeros(len(best), np.int64)
        best[begins + np.arange(len(units))] = 0.0
        begin_slot, end_slot = start + owner, end + owner
        cuts = np.flatnonzero(np.diff(at, prepend=-1))
        for low, high in zip(cuts.tolist(), np.append(cuts[1:], len(at)).tolist()):
            total = best[begin_slot[low:high]] + score[low:high]
            better = total > best[end_slot[low:high]]
            slots = end_slot[low:high][better]
            best[slots] = total[better]
            back[slots] = np.arange(low, high)[better]
        # back from the ends, all units in step
        at_slot, live = ends + np.arange(len(units)), np.flatnonzero(lengths > 0)
        steps, owners, count = [], [], 0
        while len(live):
            edge = back[at_slot[live]]
            steps.append(edge)
            owners.append(live)
            at_slot[live] = begin_slot[edge]
            live = live[at_slot[live] > begins[live] + live]
            count += 1
        if not steps:
            return [b""] * len(units)
        edge, owner = np.concatenate(steps), np.concatenate(owners)
        order = np.lexsort((begin_slot[edge], owner))
        edge, owner = edge[order], owner[order]
        ids = piece[edge]
        if (ids < 0).any():
            ids, owner = self._spelled(data, ids, start[edge], end[edge], owner)
        packed = ids.astype("<i4").tobytes()
        sizes = np.bincount(owner, minlength=len(units)) * 4
        stops = np.cumsum(sizes)
        return [packed[a:b] for a, b in zip((stops - sizes).tolist(), stops.tolist())]

    def _spelled(self, data, ids, start, end, owner):
        """Unknown characters as byte pieces, or the unknown piece where the model has none."""
        if not self.has_bytes:
            return np.where(ids < 0, self.unknown, ids), owner
        repeat = np.where(ids < 0, end - start, 1)
        inside = np.arange(int(repeat.sum())) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        wide, begin = np.repeat(ids, repeat), np.repeat(start, repeat)
        return np.where(wide < 0, self.byte_ids[data[begin + inside]], wide), np.repeat(owner, repeat)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The piece ids of each text, as the bytes of 32-bit numbers."""
        split = [self.units.findall(MARK + t.replace(MARK, _LITERAL).replace(" ", MARK)) if t else [] for t in texts]
        if len(self.kept) > KEPT_UNITS:
            self.kept.clear()
        literal = self.byte_ids[list(MARK.encode())] if self.has_bytes else np.array([self.unknown])
        self.kept[_LITERAL] = literal.astype("<i4").tobytes()
        new = [u for u in set().union(*split) if u not in self.kept]
        for at in range(0, len(new), 1 << 15):
            part = new[at : at + (1 << 15)]
            plain = [u.encode() for u in part]
            self.kept.update(zip(part, self.segment(plain)))
        known = self.kept
        return [b"".join([known[u] for u in units]) for units in split]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of piece ids; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes_of
        joined = b"".join([table[i] for i in ids])
        return joined.removeprefix(b" ").decode("utf-8", "replace")


def _columns(shared, check: bool):
    def run(batches):
        codec: Codec = shared.value
        fallback = np.zeros(len(codec.model.pieces), bool)
        fallback[codec.byte_ids[codec.byte_ids >= 0]] = True
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in _slices(texts):
                yield encoded(codec, fallback, batch.slice(a, b - a), texts[a:b])

    def encoded(codec, fallback, batch, texts):
        packed = codec.encode(texts)
        values = np.frombuffer(b"".join(packed), "<i4")
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        spelled = np.concatenate([[0], np.cumsum(fallback[values])])
        same = None
        if check:
            table = codec.bytes_of
            same = []
            for text, a, b in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist()):
                joined = b"".join([table[i] for i in values[a:b].tolist()])
                same.append(joined.removeprefix(b" ") == text.encode())
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1], pa.array(sizes), pa.array(spelled[offsets[1:]] - spelled[offsets[:-1]]),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                pa.array(same, pa.bool_()) if check else pa.nulls(len(texts), pa.bool_()),
            ],
            names=[*batch.schema.names[:-1], "n_tokens", "n_byte_tokens", "ids", "round_trip"],
        )

    return run


def _slices(texts: list[str]):
    """Ranges of texts with about _ENCODED_AT_ONCE characters; a longer text stands alone."""
    begin, held = 0, 0
    for i, text in enumerate(texts, 1):
        held += len(text)
        if held >= _ENCODED_AT_ONCE or i == len(texts):
            yield begin, i
            begin, held = i, 0


def encode_column(
    docs: DataFrame, model_file: str, keep: tuple[str, ...] = ("doc_id",), text_column: str = "text", check: bool = True
) -> DataFrame:
    """The kept columns with n_tokens, n_byte_tokens, ids array<int> and round_trip.

    round_trip tells whether decoding gives the text's bytes back; NULL unless `check`.
    """
    spark = docs.sparkSession
    prepare(spark)
    codec = spark.sparkContext.broadcast(Codec(read_model(Path(model_file).read_bytes())))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text(text_column).alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    added = "n_tokens long, n_byte_tokens long, ids array<int>, round_trip boolean"
    return rows.mapInArrow(_columns(codec, check), f"{kept}, {added}" if kept else added)
