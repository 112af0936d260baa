"""Repeated passages by a logarithmic family of sparse suffix arrays.

A byte is removed if a `SPAN`-byte string that covers it also starts in a document with a smaller id.

- Every batch of documents gets a suffix array: the anchors of its texts (`anchors.py`), sorted by the
  suffix that starts there, each with a hash of its segment and the document.
- The batch's array is merged with the existing levels in one sorted scan. Equal segments of several
  documents are long matches: the later documents lose all windows of the segment. Unequal segments
  with equal anchors and equal bytes on one side may share some windows; these are *edges*.
- The same scan writes the new level. Levels work as a binary counter: a batch merges with all levels
  that are as large as what it has grown to, so each entry is rewritten a logarithmic number of times.
  Of equal segments a level keeps the smallest document.
- Edges bring their bytes together once, at the end, and compare window by window.
- Rows of a batch carry the place of their segment, so what is found is cut without another scan. Only
  texts that hold a lost segment more than once, and edges of older batches, are scanned again.

Batches may come in any order of ids. Scans stream through sorted rows and hold one anchor's rows at a
time, of an anchor with more than `HOT_ROWS` rows not even those: its edges, those of batches in which it
has fewer rows too, go by window instead. No group is collected and nothing is capped.

Defined results: a NULL text is empty and keeps nothing; texts below `SPAN` bytes keep all; a NULL id
counts as larger than all others; rows with equal ids are not "smaller" to each other, so equal rows
are kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlake.llm import anchors
from patronlake.llm.shared import Workspace, prepare, required, text_bytes

BATCHES = 4
HOT_ROWS = 1 << 17
NO_ID = (1 << 63) - 1

ENTRY, REMOVED, EDGE, HOT_EDGE = 0, 1, 2, 3

_ENTRY = "prefix long, near long, body long, doc long, bucket int"
# place: start of the segment in its text * 256 + length, or one of:
UNKNOWN, REPEATED = -1, -2  # of rows from levels; of segments that a text may hold more than once
MERGING, SCANNED = -3, -4  # of rows from levels while they are scanned; all others are fresh
_ROW = f"{_ENTRY}, place long"
_FOUND = f"{_ENTRY}, kind int, place long"
_ORDER = ("prefix", "near", "body", "doc")
_NO_SIDE = 0xFFFF
BUCKET_BYTES = 16 * 1024**2  # of text to a bucket of an array
MAX_BUCKETS = 1 << 16


def _near(s: anchors.Segments) -> np.ndarray:
    """The group, and 16-bit hashes of the 17 bytes after and before the anchor's 16, in one number.

    A window that two segments share reaches at least 17 bytes to one side of the anchor, so segments
    with neither side equal share none. A side that no window reaches is marked with `_NO_SIDE`.
    """
    n = len(s.buffer) - 16

    def side(*offsets):
        value = np.zeros(len(s.anchor), np.uint64)
        for offset in offsets:
            at = np.clip(s.anchor + offset, 0, n)
            value = anchors._mixed(value * anchors._M1 + eights[at])
        return (value >> np.uint64(48)).astype(np.int64) % _NO_SIDE

    eights = np.ndarray((n + 1,), "<u8", s.buffer, 0, (1,))
    right = np.where(s.end - s.anchor >= anchors.ANCHOR + 17, side(16, 24, 25), _NO_SIDE)
    left = np.where(s.anchor - s.start >= 17, side(-17, -9, -8), _NO_SIDE)
    return s.group.astype(np.int64) << 32 | right << 16 | left


def _bucket(prefix: np.ndarray, near: np.ndarray, buckets: int) -> np.ndarray:
    """Rows of one anchor are in one bucket, whatever their sides."""
    mixed = anchors._mixed(prefix.view(np.uint64) * anchors._M2 + (near.view(np.uint64) >> np.uint64(32)))
    return (mixed % np.uint64(buckets)).astype(np.int32)


def _entries(buckets: int):
    """Anchors of whole texts, one row per document and distinct segment."""

    def run(batches):
        for batch in batches:
            docs = np.asarray(batch.column(0), dtype=np.int64)
            for s in anchors.scan(batch.column(1).to_pylist()):
                if not len(s.doc):
                    continue
                # repeats inside a document: sorted by document and segment, first of each
                order = np.lexsort((s.body, s.doc))
                first = np.flatnonzero(_changes(s.doc[order], s.body[order]))
                keep = order[first]
                place = s.start_in_text[keep] << 8 | (s.end - s.start)[keep]
                place[np.diff(np.append(first, len(order))) > 1] = REPEATED
                prefix, near = s.prefix[keep], _near(s)[keep]
                columns = (
                    prefix, near, s.body[keep], docs[s.doc[keep]], _bucket(prefix, near, buckets),
                    place,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=[*_ORDER, "bucket", "place"]
                )

    return run


def _changes(*columns) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _shared(keys: np.ndarray, side: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Rows whose anchor and side another row has too, one of them new."""
    joint = keys.astype(np.uint64) << np.uint64(16) | side.astype(np.uint64)
    order = np.argsort(joint, kind="stable")
    start = np.flatnonzero(_changes(joint[order]))
    size = np.diff(np.append(start, len(joint)))
    new = np.add.reduceat(fresh[order].astype(np.int64), start) if len(start) else start
    good = np.repeat((size > 1) & (new > 0), size)
    out = np.empty(len(joint), bool)
    out[order] = good
    return out & (side != _NO_SIDE)


def _scan_part(rows: list[np.ndarray], hot: bool, keep_level: bool, skip: int):
    """Findings in whole runs of sorted rows. The first `skip` rows were reported before."""
    prefix, near, body, doc, bucket, mark = rows
    fresh, scanned = mark >= REPEATED, mark == SCANNED
    place = np.where(fresh, mark, UNKNOWN)
    key_new = _changes(prefix, near >> 32)
    seg_new = key_new | _changes(near, body)
    index = np.arange(len(prefix))
    head = np.maximum.accumulate(np.where(seg_new, index, 0))
    out = []

    def emit(kind, mask, places):
        mask = mask & (index >= skip)
        if mask.any():
            columns = [prefix[mask], near[mask], body[mask], doc[mask], bucket[mask]]
            out.append((*columns, np.full(int(mask.sum()), kind, np.int32), places[mask]))

    unknown = np.full(len(prefix), UNKNOWN, np.int64)
    emit(REMOVED, (doc > doc[head]) & (fresh | fresh[head]), place)
    if keep_level:
        # the smallest document of each segment among those that go into the new level
        inside = np.flatnonzero(~scanned)
        first = inside[_changes(head[inside])] if len(inside) else inside
        mask = np.zeros(len(prefix), bool)
        mask[first] = True
        if skip:  # the carried row stands for its segment, which is already in the level
            mask &= ~((head < skip) & (index >= skip))
        emit(ENTRY, mask, unknown)
    segs = np.flatnonzero(seg_new)
    mask = np.zeros(len(prefix), bool)
    if hot:
        mask[segs] = True
        emit(HOT_EDGE, mask, np.full(len(prefix), REPEATED, np.int64))
    elif len(segs):
        keys = np.cumsum(key_new)[segs]
        # a segment counts as new if any of its rows is
        seg_fresh = np.maximum.reduceat(fresh.astype(np.int8), segs).astype(bool)
        sides = near[segs]
        mask[segs] = _shared(keys, sides >> 16 & 0xFFFF, seg_fresh) | _shared(keys, sides & 0xFFFF, seg_fresh)
        # the head stands for all rows of its document
        again = np.append(~seg_new[1:] & (doc[1:] == doc[:-1]), False)
        emit(EDGE, mask, np.where(again, REPEATED, place))
    return out


def _scan(keep_level: bool, hot_rows: int):
    """Streams through a bucket's rows, sorted by (prefix, near, body, doc).

    Rows come sorted, as the plan moves none after sorting them; should a plan do otherwise, the bucket
    is sorted here. Rows of one anchor stand together but for their sides, which sort between group and
    body, so equal segments are neighbours.
    """
    names = [*_ORDER, "bucket", "kind", "place"]

    def flush(rows, hot, skip):
        for columns in _scan_part(rows, hot, keep_level, skip):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def last_head(rows):
        """The first row of the last segment, which stands for it in what follows."""
        head = int(np.flatnonzero(_changes(*rows[:3]))[-1])
        return [c[head : head + 1] for c in rows]

    def run(batches):
        held, hot_key, skip = None, None, 0
        for rows in _sorted_parts(batches):
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if len(held[0]) < min(1 << 16, hot_rows):
                continue
            if hot_key is not None:
                # the rest of the hot anchor first, then back to whole runs
                n = int(((held[0] == hot_key[0]) & (held[1] >> 32 == hot_key[1])).sum())
                yield from flush([c[:n] for c in held], True, skip)
                if n == len(held[0]):
                    held, skip = last_head(held), 1
                    continue
                held, hot_key, skip = [c[n:] for c in held], None, 0
            last = int(np.flatnonzero(_changes(held[0], held[1] >> 32))[-1])
            if last:
                yield from flush([c[:last] for c in held], False, 0)
                held = [c[last:] for c in held]
            if len(held[0]) > hot_rows:
                hot_key = (held[0][0], held[1][0] >> 32)
                yield from flush(held, True, 0)
                held, skip = last_head(held), 1
        if held is None:
            return
        if hot_key is not None:
            n = int(((held[0] == hot_key[0]) & (held[1] >> 32 == hot_key[1])).sum())
            yield from flush([c[:n] for c in held], True, skip)
            held = [c[n:] for c in held]
        if len(held[0]):
            yield from flush(held, False, 0)

    return run


def _sorted_parts(batches):
    last, parts = None, []
    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(rows[0]):
            continue
        if not parts:
            ascends = bool((rows[0][1:] >= rows[0][:-1]).all()) and (last is None or rows[0][0] >= last)
            if ascends:
                last = rows[0][-1]
                yield rows
                continue
            if last is not None:
                raise RuntimeError("rows of a bucket are neither sorted nor unsorted from the start")
        parts.append(rows)
    if parts:
        rows = [np.concatenate(x) for x in zip(*parts)]
        order = np.lexsort(rows[3::-1])
        yield [c[order] for c in rows]


class SuffixFamily:
    """Levels of suffix arrays. `add` reports what a batch has in common with all batches before.

    A level is a table in `buckets` buckets. A batch's rows are shuffled into as many partitions, and
    the levels are read bucket by bucket: no level is shuffled again, for scans or for merges.
    """

    def __init__(self, spark: SparkSession, space: Workspace, buckets: int, hot_rows: int = HOT_ROWS):
        self.spark, self.space, self.buckets, self.hot_rows = spark, space, buckets, hot_rows
        self.levels: list[tuple[int, str]] = []  # (rank, name), largest first
        self._batch = 0

    def _table(self, name: str) -> str:
        return f"{self.space.name}_{name}"

    def add(self, docs: DataFrame, last: bool = False) -> DataFrame:
        """Scans a batch (doc long, bytes binary) against all levels; rows (doc, prefix, group, body, kind, place) found.

        `last` writes no level: for a family that is thrown away after this batch.
        """
        merging = []
        for rank, level in enumerate(reversed(self.levels)):
            if level[0] != rank:
                break
            merging.append(level)
        rows = docs.mapInArrow(_entries(self.buckets), _ROW).repartition(self.buckets, "bucket")
        for level in self.levels:
            mark = F.lit(MERGING if level in merging else SCANNED).cast("long").alias("place")
            stored = self.spark.table(self._table(level[1])).filter(F.col("kind") == ENTRY)
            rows = rows.union(stored.select(*_ORDER, "bucket", mark))
        name = f"batch{self._batch}"
        self._batch += 1
        ordered = rows.sortWithinPartitions("bucket", *_ORDER)
        scan = _scan(not last, self.hot_rows)

        def of_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from scan(batches)

        (
            ordered.groupBy("bucket").applyInArrow(of_bucket, _FOUND).write
            .partitionBy("kind").bucketBy(self.buckets, "bucket").sortBy(*_ORDER)
            .option("compression", "zstd").option("path", self.space.path(name)).saveAsTable(self._table(name))
        )
        for level in merging:
            self.levels.remove(level)
            self._forget(level[1])
        if not last:
            self.levels.append((len(merging), name))
        schema = T.StructType.fromDDL(_FOUND)
        found = self.space.get(name, schema).filter(F.col("kind") != ENTRY)
        group = F.shiftright("near", 32).cast("int").alias("group")
        return found.select("doc", "prefix", group, "body", "kind", "place")

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {self._table(name)}")
        self.space.drop(f"{name}/kind={ENTRY}")

    def close(self) -> None:
        """Drops the levels; what was reported stays."""
        for i in range(self._batch):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(f'batch{i}')}")
            self.space.drop(f"batch{i}/kind={ENTRY}")
        self.levels = []


def _edge_bytes(batches):
    """Segments that a document must compare window by window, with their bytes.

    Most have a known place; the other texts are scanned for theirs.
    """
    names = ["prefix", "group", "body", "doc", "hot", "place", "bytes"]
    for batch in batches:
        docs, texts = np.asarray(batch.column(0), dtype=np.int64), batch.column(1).to_pylist()
        wanted = batch.column(2)
        asked = wanted.flatten()
        prefix, group, body, place = (asked.field(c).to_numpy() for c in ("prefix", "group", "body", "place"))
        hot = asked.field("hot").to_numpy(zero_copy_only=False)
        which = np.repeat(np.arange(len(docs)), np.diff(wanted.offsets.to_numpy()))

        def pieces(at, found):
            columns = [pa.array(c[at]) for c in (prefix, group, body)]
            columns += [pa.array(docs[which[at]]), pa.array(hot[at]), pa.array(place[at]), pa.array(found, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        known = np.flatnonzero(place >= 0)
        starts, lengths = place[known] >> 8, place[known] & 255
        yield pieces(known, [texts[w][a : a + n] for w, a, n in zip(which[known].tolist(), starts.tolist(), lengths.tolist())])
        rest = np.flatnonzero(place < 0)
        open_texts = np.unique(which[rest])  # ascending, as `which` is
        in_open = np.searchsorted(open_texts, which[rest])
        for s in anchors.scan([texts[i] for i in open_texts.tolist()]):
            if not len(s.doc):
                continue
            begin, end = np.searchsorted(in_open, [int(s.doc[0]), int(s.doc[-1]) + 1])
            at = _positions(s, in_open[begin:end], body[rest[begin:end]])
            got = at >= 0
            at = at[got]
            yield pieces(rest[begin:end][got], [s.buffer[a:b] for a, b in zip(s.start[at].tolist(), s.end[at].tolist())])


def _positions(s: anchors.Segments, which: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Index of a segment with the given body in the given document, or -1."""
    order = np.lexsort((s.body, s.doc))
    have = np.empty(len(order), [("d", "<i8"), ("b", "<i8")])
    have["d"], have["b"] = s.doc[order], s.body[order]
    need = np.empty(len(body), have.dtype)
    need["d"], need["b"] = which, body
    # both sides ranked together: structured search is slow, so one joint sort
    both_d = np.concatenate([have["d"], need["d"]])
    both_b = np.concatenate([have["b"], need["b"]])
    joint = np.lexsort((np.arange(len(both_d)), both_b, both_d))
    new = _changes(both_d[joint], both_b[joint])
    head = joint[np.maximum.accumulate(np.where(new, np.arange(len(joint)), 0))]
    result = np.full(len(both_d), -1, np.int64)
    result[joint] = np.where(head < len(order), head, -1)
    found = result[len(order) :]
    return np.where(found >= 0, order[np.clip(found, 0, None)] if len(order) else -1, -1)


def _window_hashes(buffer: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the SPAN bytes from each start."""
    eights = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
    one = np.zeros(len(starts), np.uint64)
    two = np.zeros(len(starts), np.uint64)
    for offset in (*range(0, anchors.SPAN - 8, 8), anchors.SPAN - 8):
        value = eights[starts + offset]
        one = anchors._mixed(one * anchors._M1 + value)
        two = anchors._mixed((two ^ value) * anchors._M2 + anchors._BASE)
    return one.view(np.int64), two.view(np.int64)


def _windows_of(segment_bytes: list[bytes]):
    """All windows of all segments: row, index in the segment, two hashes."""
    lengths = np.fromiter(map(len, segment_bytes), np.int64, len(segment_bytes))
    offsets = np.cumsum(lengths) - lengths
    count = lengths - anchors.SPAN + 1
    row = np.repeat(np.arange(len(count)), count)
    index = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, index, *_window_hashes(b"".join(segment_bytes), offsets[row] + index)


def _masks(row, index, doc_of_row, lost) -> tuple[np.ndarray, np.ndarray]:
    """Bit i of a row's mask: its i-th window is removed. Only rows that lose any."""
    row, index = row[lost], index[lost]
    bits = np.left_shift(np.int64(1), index)
    rows, start = np.unique(row, return_index=True)
    masks = np.bitwise_or.reduceat(bits, start) if len(rows) else bits
    return rows, masks


def _compare_edges(batches):
    """Rows sorted by (prefix, group): windows that also stand in a smaller document of the anchor."""
    names = ["doc", "body", "mask", "place"]

    def resolve(prefix, group, body, doc, place, texts):
        key = np.cumsum(_changes(prefix, group))
        row, index, one, two = _windows_of(texts)
        order = np.lexsort((doc[row], two, one, key[row]))
        head_new = _changes(key[row][order], one[order], two[order])
        head = np.maximum.accumulate(np.where(head_new, np.arange(len(order)), 0))
        lost = np.zeros(len(row), bool)
        lost[order] = doc[row][order] > doc[row][order][head]
        rows, masks = _masks(row, index, doc, lost)
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[rows]), pa.array(body[rows]), pa.array(masks), pa.array(place[rows])], names=names
            )

    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        if held.num_rows < 1 << 14:
            continue
        prefix, group = held.column(0).to_numpy(), held.column(1).to_numpy()
        last = int(np.flatnonzero(_changes(prefix, group))[-1])
        if last:
            yield from resolve(*_edge_columns(held.slice(0, last)))
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield from resolve(*_edge_columns(held))


def _edge_columns(batch):
    numbers = [batch.column(i).to_numpy() for i in range(5)]
    return *numbers, batch.column(5).to_pylist()


def _hot_windows(batches):
    for batch in batches:
        body, doc = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        row, index, one, two = _windows_of(batch.column(5).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (one, two, doc[row], body[row], index)],
            names=["one", "two", "doc", "body", "index"],
        )


def _lost_windows(batches):
    """Rows sorted by (one, two, doc): all windows but those of their smallest document."""
    head = None
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two, doc, body, index = (c.to_numpy() for c in batch.columns)
        if head is not None:
            one, two, doc = (np.concatenate([[h], x]) for h, x in zip(head, (one, two, doc)))
        first = np.maximum.accumulate(np.where(_changes(one, two), np.arange(len(one)), 0))
        lost = doc > doc[first]
        head = one[-1], two[-1], doc[first[-1]]
        if len(lost) > len(body):
            lost, doc = lost[1:], doc[1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[lost]), pa.array(body[lost]), pa.array(index[lost].astype(np.int64))],
            names=["doc", "body", "index"],
        )


def _union_of_intervals(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by intervals whose starts ascend."""
    if not len(start):
        return []
    reach = np.maximum.accumulate(end)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return list(zip(start[at].tolist(), reach[np.append(at[1:], len(start)) - 1].tolist()))


def removed_spans(text: bytes, lost: dict[int, int]) -> list[tuple[int, int]]:
    """Byte ranges of a text that the lost windows cover; `lost` has a mask by segment."""
    if not lost or len(text) < anchors.SPAN:
        return []
    bodies = np.fromiter(lost, np.int64, len(lost))
    masks = np.fromiter(lost.values(), np.int64, len(lost))
    order = np.argsort(bodies)
    bodies, masks = bodies[order], masks[order]
    begins, ends = [], []
    for s in anchors.scan([text]):
        at = np.clip(np.searchsorted(bodies, s.body), 0, len(bodies) - 1)
        hit = bodies[at] == s.body
        start, mask, length = s.start_in_text[hit], masks[at][hit], (s.end - s.start)[hit]
        whole = mask == -1
        begins.append(start[whole])
        ends.append((start + length)[whole])
        part, bits = start[~whole], mask[~whole]
        for i in range(anchors.REACH if len(part) else 0):
            on = (bits >> np.int64(i)) & 1 == 1
            begins.append(part[on] + i)
            ends.append(part[on] + i + anchors.SPAN)
    begin, end = np.concatenate(begins), np.concatenate(ends)
    order = np.argsort(begin, kind="stable")
    return _union_of_intervals(begin[order], end[order])


def spans_at(texts: list[bytes], row: np.ndarray, mask: np.ndarray, place: np.ndarray) -> list[list[tuple[int, int]]]:
    """Removed spans of each text from places of segments alone; `row` is the text of a segment."""
    # the texts as one line, a byte apart, so that no span joins two of them
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    base = np.cumsum(lengths) - lengths
    start, whole = (place >> 8) + base[row], mask == -1
    window, bit = np.nonzero(mask[~whole, None] >> np.arange(anchors.REACH) & 1)
    partly = start[~whole][window] + bit
    begin = np.concatenate([start[whole], partly])
    end = np.concatenate([(start + (place & 255))[whole], partly + anchors.SPAN])
    order = np.argsort(begin, kind="stable")
    runs = np.array(_union_of_intervals(begin[order], end[order]), np.int64).reshape(-1, 2)
    bounds = np.searchsorted(runs[:, 0], np.append(base, lengths.sum())).tolist()
    return [
        list(map(tuple, (runs[a:b] - at).tolist())) for a, b, at in zip(bounds, bounds[1:], base.tolist())
    ]


def _all_spans(texts: list[bytes], lost: pa.ListArray) -> list[list[tuple[int, int]]]:
    """Removed spans of each text of a batch. Only texts with a segment of unknown place are scanned."""
    flat = lost.flatten()
    body, mask, place = (flat.field(c).to_numpy() for c in ("body", "mask", "place"))
    sizes = np.fromiter((x or 0 for x in pc.list_value_length(lost).to_pylist()), np.int64, len(lost))
    row = np.repeat(np.arange(len(lost)), sizes)
    unknown = np.unique(row[place < 0])
    known = ~np.isin(row, unknown)
    out = spans_at(texts, row[known], mask[known], place[known])
    for i in unknown.tolist():
        own = row == i
        out[i] = removed_spans(texts[i], _merged(body[own].tolist(), mask[own].tolist()))
    return out


def lost_segments(docs: DataFrame, keyed: DataFrame, batches: int = BATCHES, hot_rows: int = HOT_ROWS):
    """(doc, body, mask, place): segments of which windows are removed; mask -1 stands for all of them.

    `keyed` is docs as (doc, bytes); it is shuffled by doc once, for the edges and for the caller.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "suffix")
    size = keyed.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MAX_BUCKETS, max(parts, -(-size // BUCKET_BYTES)))
    family = SuffixFamily(spark, space, buckets, hot_rows)
    bounds = _batch_bounds(keyed, batches)
    found = None
    for i, condition in enumerate(bounds):
        report = family.add(keyed.filter(condition), last=i == len(bounds) - 1)
        found = report if found is None else found.unionByName(report)
        space.release()
    family.close()
    # places are of one text: rows with one id have none
    twice = space.put("twice", keyed.groupBy("doc").count().filter("count > 1").select("doc", F.lit(True).alias("again")))
    if not twice.isEmpty():
        place = F.when(F.col("again"), F.lit(REPEATED).cast("long")).otherwise(F.col("place"))
        found = found.join(twice, "doc", "left").withColumn("place", place).drop("again")
    removed = found.filter(F.col("kind") == REMOVED).select("doc", "body", F.lit(-1).cast("long").alias("mask"), "place")
    # an anchor that was hot in any batch is hot for the pieces of all batches, or they would not meet
    hot_anchors = space.put("hot-anchors", found.filter(F.col("kind") == HOT_EDGE).select("prefix", "group").distinct())
    edges = (
        found.filter(F.col("kind") != REMOVED)
        .join(hot_anchors.withColumn("hot", F.lit(True)), ["prefix", "group"], "left")
        .groupBy("doc", "body")
        .agg(
            F.coalesce(F.max("hot"), F.lit(False)).alias("hot"), F.min("prefix").alias("prefix"), F.min("group").alias("group"),
            F.when(F.min("place") == REPEATED, F.lit(REPEATED).cast("long")).otherwise(F.max("place")).alias("place"),
        )
        .groupBy("doc")
        .agg(F.collect_list(F.struct("body", "hot", "prefix", "group", "place")).alias("wanted"))
    )
    pieces = keyed.join(edges, "doc").select("doc", "bytes", "wanted").mapInArrow(
        _edge_bytes, "prefix long, group int, body long, doc long, hot boolean, place long, bytes binary"
    )
    pieces = space.put("edges", pieces, by="hot")
    space.release()
    columns = ["prefix", "group", "body", "doc", "place", "bytes"]
    cold = (
        pieces.filter(~F.col("hot")).select(*columns).repartition("prefix", "group")
        .sortWithinPartitions("prefix", "group")
        .mapInArrow(_compare_edges, "doc long, body long, mask long, place long")
    )
    hot = (
        pieces.filter("hot").select(*columns)
        .mapInArrow(_hot_windows, "one long, two long, doc long, body long, index long")
        .repartition("one", "two").sortWithinPartitions("one", "two", "doc")
        .mapInArrow(_lost_windows, "doc long, body long, index long")
        .select(
            "doc", "body", F.expr("shiftleft(1L, cast(index AS int))").alias("mask"),
            F.lit(REPEATED).cast("long").alias("place"),
        )
    )
    return removed.unionByName(cold).unionByName(hot), space


def _batch_bounds(keyed: DataFrame, batches: int):
    """Conditions on doc that cut the documents into batches of about equal counts."""
    if batches <= 1:
        return [F.lit(True)]
    shares = [i / batches for i in range(1, batches)]
    cuts = keyed.agg(F.percentile_approx("doc", shares, 1000).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    if not cuts:
        return [F.lit(True)]
    doc = F.col("doc")
    inner = [(doc > a) & (doc <= b) for a, b in zip(cuts, cuts[1:])]
    return [doc <= cuts[0], *inner, doc > cuts[-1]]


def dedup_passages(
    docs: DataFrame, batches: int = BATCHES, hot_rows: int = HOT_ROWS,
    id_column: str = "doc_id", text_column: str = "text", with_text: bool = True,
) -> DataFrame:
    """Per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept).

    `kept` is what is left of the text, as bytes: a cut may fall inside a character. NULL unless
    `with_text`. Rows without an id come after all others, level with the greatest 64-bit id: neither
    loses a passage to the other.
    """
    prepare(docs.sparkSession)
    narrow = required(docs, id_column, text_column)
    keyed = narrow.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("doc"),
        text_bytes(text_column).alias("bytes"), F.col(f"`{id_column}`").cast("long").isNull().alias("no_id"),
    )
    lost, _ = lost_segments(docs, keyed.select("doc", "bytes"), batches, hot_rows)
    by_doc = lost.groupBy("doc").agg(F.collect_list(F.struct("body", "mask", "place")).alias("lost"))
    cut = keyed.join(by_doc, "doc", "left").select("doc", "bytes", "lost", "no_id").mapInArrow(
        _cut_texts(with_text),
        "doc long, no_id boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
    return cut.select(
        F.when(~F.col("no_id"), F.col("doc")).alias(id_column),
        "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept",
    )


def cut_documents(
    docs: DataFrame, batches: int = BATCHES, hot_rows: int = HOT_ROWS,
    id_column: str = "doc_id", text_column: str = "text", length_column: str = "n_chars",
) -> DataFrame:
    """The documents with their own columns and the text that is left; those left blank go.

    A character that a cut goes through goes whole. The column of text lengths, if any, is set anew.
    """
    prepare(docs.sparkSession)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("own")
    keyed = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("doc"),
        text_bytes(text_column).alias("bytes"), own,
    )
    lost, _ = lost_segments(docs, keyed.select("doc", "bytes"), batches, hot_rows)
    by_doc = lost.groupBy("doc").agg(F.collect_list(F.struct("body", "mask", "place")).alias("lost"))
    kind = T.StructType([keyed.schema["own"], T.StructField("text", T.StringType())])
    cut = keyed.join(by_doc, "doc", "left").select("bytes", "lost", "own").mapInArrow(
        _left_texts, kind
    ).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    columns = [
        F.col("text").alias(c) if c == text_column
        else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == length_column
        else F.col("own")[c].alias(c)
        for c in docs.columns
    ]
    return cut.select(*columns)


def _left_texts(batches):
    for batch in batches:
        texts = []
        whole = batch.column(0).to_pylist()
        for text, spans in zip(whole, _all_spans(whole, batch.column(1))):
            texts.append(cut_bytes(text, spans).decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(texts, pa.string())], names=["own", "text"])


def _merged(bodies: list[int], masks: list[int]) -> dict[int, int]:
    found: dict[int, int] = {}
    for body, mask in zip(bodies, masks):
        found[body] = found.get(body, 0) | mask
    return found


def cut_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given ascending spans."""
    if not spans:
        return text
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _cut_texts(with_text: bool):
    names = ["doc", "no_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches):
        for batch in batches:
            found = [[], [], [], [], []]
            whole = batch.column(1).to_pylist()
            for text, spans in zip(whole, _all_spans(whole, batch.column(2))):
                kept = cut_bytes(text, spans)
                values = (
                    len(text), len(text) - len(kept), len(spans),
                    hashlib.sha256(kept).hexdigest(), kept if with_text else None,
                )
                for column, value in zip(found, values):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), *map(pa.array, found, kinds)], names=names
            )

    return run
