"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has a bit for each bit of the shingles' hashes, set if over half of the hashes have it.
Two fingerprints that differ in at most `distance` bits, cut into `blocks` blocks, agree in at least
`blocks - distance` of them. So every choice of that many blocks is one join key, and all pairs within
the distance share a key. The number of blocks follows the number of distinct fingerprints, so that by
chance about one other shares a key; it changes no result.

Documents are first folded into distinct fingerprints. Rows of a key meet in one task, which compares
them and reports only a spanning forest: as many links as rows at most, whatever the number of close
pairs. A key with more than `HOT_ROWS` fingerprints is cut into chunks, and pairs of chunks are spread
over tasks. No pair within a group is emitted and no link between groups is lost.

`near_groups` is the wider form for similarities: fingerprints of `WIDE_BITS` bits, of which drawn sets
of bits are the keys. Two documents with five-word shingles of Jaccard similarity s differ in a share
arccos(2s / (1 + s)) / pi of the bits, on average. The Hamming cut lies `DEVIATIONS` above that, and the
keys are as many as give a pair at `SIMILARITY` the chance `RECALL` to pass the cut and share a key. Both
only choose candidates: classes of loosely linked documents bring their sets of shingles together, and
a link is a pair whose sets have Jaccard similarity `SIMILARITY` or more.

Keys are drawn in batches, `KEYS_AT_FIRST` first and then twice as many each time, up to `KEYS_AT_ONCE`.
Documents carry a label, at first their id, and after each batch the smallest label that theirs was
linked to. Rows of one label are not compared again, and a key reports its trees as links from the
smallest label of the tree to each other one. So a class of n near copies gives at most
KEYS_AT_FIRST * (n - 1) links in the first batch, however many keys there are, and later only links
between the labels that are left. All links together make the loose classes, once.

Defined results: a NULL or blank text has fingerprint zero and links like any other; a text with fewer
words than a shingle is one shingle; equal texts have equal fingerprints; NULL ids never are a
component's id unless there is no other; repeated rows stay; empty tables give empty results; further
columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlake.llm.components import components
from patronlake.llm.shared import Workspace, prepare, required, text_bytes

SEED = 42
SHINGLE, DISTANCE = 3, 3
HOT_ROWS = 4096
WIDE_SHINGLE, WIDE_BITS, SIMILARITY, RECALL, DEVIATIONS = 5, 256, 0.8, 0.99, 3
KEYS_AT_FIRST, KEYS_AT_ONCE = 8, 64  # shuffled at a time, which bounds the disk
SET_ROWS, SET_SHINGLES = 2048, 1 << 20  # of a class, compared in one task
_LANES = np.uint64(0x0101010101010101)
_PIECE = 1 << 16  # shingles hashed at a time, so that a very long text needs little memory
_MIXERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def shingle_hashes(text: bytes, k: int):
    """Arrays of the XXH64 of all k-word shingles, repeats included, in pieces."""
    words = text.lower().split()
    if not words:
        return
    if len(words) < k:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words) - k + 1, _PIECE):
        part = words[at : at + _PIECE + k - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = [0, *(ends[: len(part) - k] + 1).tolist()]
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], np.uint64)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, from bit 0 on."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):  # a lane of 8 bits counts to 255
        part = hashes[at : at + 255]
        for shift in range(8):
            lanes = ((part >> np.uint64(shift)) & _LANES).sum(dtype=np.uint64)
            counts[shift::8] += np.frombuffer(lanes.tobytes(), np.uint8)
    return counts


def _packed(counts: np.ndarray, n: int) -> np.ndarray:
    bits = (2 * counts > n).reshape(-1, 64)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def shingle_set(text: bytes, k: int = WIDE_SHINGLE) -> np.ndarray:
    """The distinct hashes of the shingles, ascending."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, k)]))


def fingerprint(text: bytes, k: int = SHINGLE, words: int = 1) -> np.ndarray:
    """The fingerprint as `words` unsigned 64-bit numbers; the first is that of XXH64 itself."""
    return _fingerprint(shingle_hashes(text, k), words)


def _fingerprint(pieces, words: int) -> np.ndarray:
    counts, n = np.zeros(64 * words, np.int64), 0
    for hashes in pieces:
        n += len(hashes)
        for i in range(words):
            if i:
                hashes = hashes ^ (hashes >> np.uint64(31))
                hashes = hashes * _MIXERS[i % len(_MIXERS)]
                hashes ^= hashes >> np.uint64(29)
            counts[64 * i : 64 * i + 64] += _bit_counts(hashes)
    return _packed(counts, n)


def fingerprints(docs: DataFrame, k: int, id_column="doc_id", text_column="text") -> DataFrame:
    """(doc, fp long)."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t, k) for t in batch.column(1).to_pylist()]
            fps = pa.array(np.concatenate(prints or [np.empty(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["doc", "fp"])

    return _bytes(docs, id_column, text_column).mapInArrow(run, "doc long, fp long")


def wide_fingerprints(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """(doc, fp, digest): bytes of the wide fingerprint of the set of shingles, and a digest of the set."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
            fps = pa.array([_fingerprint([x], WIDE_BITS // 64).tobytes() for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), fps, _digests(sets)], names=["doc", "fp", "digest"]
            )

    return _bytes(docs, id_column, text_column).mapInArrow(run, "doc long, fp binary, digest binary")


def _digests(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary())


def _bytes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    narrow = required(docs, id_column, text_column)
    return narrow.select(F.col(f"`{id_column}`").cast("long").alias("doc"), text_bytes(text_column).alias("bytes"))


def block_masks(blocks: int, distance: int = DISTANCE) -> list[int]:
    """A mask for each choice of blocks - distance of the blocks that 64 bits are cut into."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def blocks_for(distinct: int, distance: int = DISTANCE) -> int:
    """The fewest blocks with which about one other fingerprint shares a key by chance."""
    blocks = distance + 1
    while distinct > 2 ** (64 * (blocks - distance) / blocks) and blocks < 3 * distance + 3:
        blocks += 1
    return blocks


def forest(fps: np.ndarray, distance: int, cross: int | None = None) -> list[tuple[int, int]]:
    """Links (i, j) of a spanning forest of all pairs within the distance. fps: (n, words) of uint64.

    With `cross`, only pairs of one of the first `cross` rows with one of the rest need be compared.
    """
    n = len(fps)
    parent = np.arange(n)

    def close(i: int, others: np.ndarray) -> np.ndarray:
        return others[np.bitwise_count(fps[others] ^ fps[i]).sum(1, dtype=np.int64) <= distance]

    links = []
    for i in range(n if cross is None else cross):
        others = np.arange(max(i + 1, cross or 0), n)
        others = others[parent[others] != parent[i]]
        for j in close(i, others) if len(others) else ():
            if parent[j] != parent[i]:
                links.append((i, int(j)))
                parent[parent == parent[j]] = parent[i]
    return links


def merged(fps: np.ndarray, distance: int, label: np.ndarray, cross: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links between the labels that pairs within the distance bring together: (smallest of a tree, other).

    Rows of one label are together from the start. `cross` as in `forest`.
    """
    names, tree = np.unique(label, return_inverse=True)
    n = len(fps)
    for i in range(n if cross is None else cross):
        others = np.arange(max(i + 1, cross or 0), n)
        others = others[tree[others] != tree[i]]
        if len(others):
            near = others[np.bitwise_count(fps[others] ^ fps[i]).sum(1, dtype=np.int64) <= distance]
            if len(near):
                tree[np.isin(tree, np.append(tree[near], tree[i]))] = tree[i]
    members = np.unique(np.stack([tree, label]), axis=1)
    new = np.append(True, members[0, 1:] != members[0, :-1])
    smallest = members[1][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    return smallest[~new], members[1][~new]


def _classes_linked(distance: int, words: int):
    """Rows (key, part, side, id, label, fp) sorted by key and part: links between labels in each run."""

    def resolve(batch):
        key, part, side, label = (batch.column(i).to_numpy() for i in (0, 1, 2, 4))
        fps = np.frombuffer(b"".join(batch.column(5).to_pylist()), "<u8").reshape(-1, words)
        start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])))
        size = np.diff(np.append(start, len(key)))
        pair = start[size == 2]  # most keys that are shared at all
        near = (np.bitwise_count(fps[pair] ^ fps[pair + 1]).sum(1, dtype=np.int64) <= distance) & (label[pair] != label[pair + 1])
        x, y = label[pair[near]], label[pair[near] + 1]
        a, b = [np.minimum(x, y)], [np.maximum(x, y)]
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            own = label[s : s + n]
            if (own == own[0]).all():
                continue
            cross = int((side[s : s + n] == 0).sum())
            low, high = merged(fps[s : s + n], distance, own, cross if cross < n else None)
            a.append(low)
            b.append(high)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return _by_run(resolve)


def _linked(distance: int, words: int):
    """Rows (key, part, side, id, fp) sorted by key and part: links found in each run."""

    def columns(batch):
        fp = batch.column(4)
        if words == 1:
            fps = fp.to_numpy().view(np.uint64).reshape(-1, 1)
        else:
            fps = np.frombuffer(b"".join(fp.to_pylist()), "<u8").reshape(-1, words)
        return batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_numpy(), fps

    def resolve(batch):
        key, part, side, ids, fps = columns(batch)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        pair = start[size == 2]  # most keys that are shared at all
        near = np.bitwise_count(fps[pair] ^ fps[pair + 1]).sum(1, dtype=np.int64) <= distance
        a, b = [ids[pair[near]]], [ids[pair[near] + 1]]
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            cross = int((side[s : s + n] == 0).sum())
            links = forest(fps[s : s + n], distance, cross if cross < n else None)
            if links:
                i, j = np.array(links).T
                a.append(ids[s + i])
                b.append(ids[s + j])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return _by_run(resolve)


def _by_run(resolve):
    """Calls `resolve` with whole runs of rows that are sorted by (key, part)."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.concat_batches([held, batch])
            key, part = held.column(0).to_numpy(), held.column(1).to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]))
            if len(cut):
                yield resolve(held.slice(0, int(cut[-1]) + 1))
                held = held.slice(int(cut[-1]) + 1)
        if held is not None:
            yield resolve(held)

    return run


def _links(keyed: DataFrame, distance: int, words: int, space: Workspace, name: str, hot_rows: int) -> DataFrame:
    """Links (a, b) among rows (key long, id long, fp) that share a key; of rows with a label, between labels.

    Of keys with more than `hot_rows` rows the rows go to chunks by a hash, and every two chunks meet in
    a task of their own. What one task holds at a time is two chunks of `hot_rows` rows at most, which
    with wide fingerprints is about half a megabyte.
    """
    hot = space.put(
        f"{name}-hot",
        keyed.groupBy("key").count().filter(F.col("count") > hot_rows)
        .select("key", F.ceil(F.col("count") / hot_rows).cast("int").alias("chunks")),
    )
    plain = _parts(keyed, hot)
    linked = (_classes_linked if "label" in keyed.columns else _linked)(distance, words)
    return (
        plain.repartition("key", "part").sortWithinPartitions("key", "part", "side")
        .mapInArrow(linked, "a long, b long")
    )


def _parts(keyed: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows (key, part, side, ...): those of the keys in `hot` (key, chunks) once for each pair of chunks."""
    own = [c for c in keyed.columns if c != "key"]
    plain = keyed.select("key", F.lit(0).alias("part"), F.lit(0).alias("side"), *own)
    if hot.isEmpty():
        return plain
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    split = (
        keyed.join(hot, "key").withColumn("chunk", chunk).withColumn("other", other)
        .select(
            "key", (F.lit(1) + low * F.col("chunks") + high).alias("part"),
            F.when(F.col("chunk") <= F.col("other"), 0).otherwise(1).alias("side"), *own,
        )
    )
    return plain.join(hot, "key", "left_anti").unionByName(split)


def simhash_components(
    docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE, hot_rows: int = HOT_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, fp long, component_id): classes of documents linked within `distance` bits."""
    space = Workspace(docs.sparkSession, "simhash")
    prints = space.put("prints", fingerprints(docs, k, id_column, text_column))
    distinct = space.put("distinct", prints.groupBy("fp").agg(F.min("doc").alias("least")))
    masks = block_masks(blocks_for(distinct.count(), distance), distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)]))
    keyed = distinct.select(keys.alias("key"), F.col("fp").alias("id"), "fp")
    roots = components(_links(keyed, distance, 1, space, "links", hot_rows), space)
    classes = space.put("classes", distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = space.put("answer", classes.join(smallest, "root").select("fp", "component_id"))
    return prints.join(answer, "fp").select(F.col("doc").alias(id_column), "fp", "component_id")


def wide_plan(distinct: int, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int, int]:
    """Bits of a key, number of keys, and the largest Hamming distance of a candidate link."""
    share = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    width = max(16, math.ceil(math.log2(max(2, distinct))))
    deviation = math.sqrt(share * (1 - share) / WIDE_BITS)
    distance = math.floor((share + DEVIATIONS * deviation) * WIDE_BITS)
    keys = 1
    while chance(similarity, width, keys, distance) < recall:
        keys += 1 + keys // 50
    return width, keys, distance


def chance(similarity: float, width: int, keys: int, distance: int) -> float:
    """That a pair of the similarity is within the distance and shares one of the keys."""
    share = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    whole = math.comb(WIDE_BITS, width)
    return sum(
        math.comb(WIDE_BITS, d) * share**d * (1 - share) ** (WIDE_BITS - d)
        * (1 - (1 - math.comb(WIDE_BITS - d, width) / whole) ** keys)
        for d in range(distance + 1)
    )


def similar(sets: list[np.ndarray], similarity: float, cross: int | None = None) -> list[tuple[int, int]]:
    """Links (i, j) of a spanning forest of all pairs of sets with at least the Jaccard similarity.

    With `cross`, only pairs of one of the first `cross` sets with one of the rest need be compared.
    """
    n = len(sets)
    size = np.fromiter(map(len, sets), np.int64, n)
    owner = np.repeat(np.arange(n), size)
    _, value, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    begin = np.cumsum(count) - count
    holders = owner[np.argsort(value, kind="stable")]  # who has a value, value by value
    bounds = np.concatenate([[0], np.cumsum(size)])
    parent, index, links = np.arange(n), np.arange(n), []
    for i in range(n if cross is None else cross):
        others = (index >= max(i + 1, cross or 0)) & (parent != parent[i])
        if not others.any():
            continue
        mine = value[bounds[i] : bounds[i + 1]]
        mine = mine[count[mine] > 1]
        many = count[mine]
        at = np.repeat(begin[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        common = np.bincount(holders[at], minlength=n)
        others &= (common > 0) & (common >= similarity * (size + size[i] - common) - 1e-6)
        for j in np.flatnonzero(others).tolist():
            if parent[j] != parent[i]:
                links.append((i, j))
                parent[parent == parent[j]] = parent[i]
    return links


def _similar(similarity: float):
    """Rows (key, part, side, id, shingles) sorted by key and part: links found in each run."""

    def resolve(batch):
        key, part, side, ids = (batch.column(i).to_numpy() for i in range(4))
        start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])))
        links = []
        for s, e in zip(start.tolist(), [*start[1:].tolist(), len(key)]):
            sets = [np.frombuffer(x, "<u8") for x in batch.column(4).slice(s, e - s).to_pylist()]
            cross = int((side[s:e] == 0).sum())
            links += [(ids[s + i], ids[s + j]) for i, j in similar(sets, similarity, cross if cross < e - s else None)]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return _by_run(resolve)


def _verified(
    docs: DataFrame, classes: DataFrame, similarity: float, space: Workspace, id_column: str, text_column: str,
    set_rows: int = SET_ROWS,
) -> DataFrame:
    """Links (a, b) of Jaccard `similarity` or more among the documents of each class (node, root).

    Only these documents' sets of shingles are shuffled, once; large classes go in pairs of chunks.
    """

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), _digests(sets), pa.array(map(len, sets), pa.int64()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ],
                names=["key", "id", "digest", "n", "shingles"],
            )

    texts = _bytes(docs, id_column, text_column).join(classes, F.col("doc") == F.col("node"))
    sets = space.put("sets", texts.select(F.col("root").alias("key"), "doc", "bytes").mapInArrow(
        run, "key long, id long, digest binary, n long, shingles binary"
    ).dropDuplicates(["id", "digest"]))
    chunks = F.ceil(F.greatest(F.count("*") / set_rows, F.sum("n") / SET_SHINGLES)).cast("int")
    hot = space.put("sets-hot", sets.groupBy("key").agg(chunks.alias("chunks")).filter("chunks > 1"))
    return (
        _parts(sets.select("key", "id", "shingles"), hot)
        .repartition("key", "part").sortWithinPartitions("key", "part", "side")
        .mapInArrow(_similar(similarity), "a long, b long")
    )


def near_groups(
    docs: DataFrame, similarity: float = SIMILARITY, hot_rows: int = HOT_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc, component): documents that are near copies, or copies, of one with a smaller id.

    Documents that are in no group, or the smallest of theirs, have no row.
    """
    space = Workspace(docs.sparkSession, "near")
    prints = space.put("prints", wide_fingerprints(docs, id_column, text_column))
    distinct = space.put("distinct", prints.groupBy("digest").agg(F.min("doc").alias("id"), F.first("fp").alias("fp")))
    width, keys, distance = wide_plan(distinct.count(), similarity)
    draw = np.random.default_rng(SEED)
    drawn = [np.sort(draw.choice(WIDE_BITS, width, replace=False)) for _ in range(keys)]

    def keyed_rows(some):
        def run(batches):
            powers = np.left_shift(np.uint64(1), np.arange(width, dtype=np.uint64))
            for batch in batches:
                n = batch.num_rows
                raw = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(n, -1)
                bits = np.unpackbits(raw, axis=1, bitorder="little")
                for i in some:
                    key = (bits[:, drawn[i]].astype(np.uint64) * powers).sum(1, dtype=np.uint64)
                    key = (key + (np.uint64(i) << np.uint64(width))) * _MIXERS[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), *batch.columns], names=["key", "id", "label", "fp"]
                    )

        return run

    source = distinct.filter(F.col("id").isNotNull()).select("id", F.col("id").alias("label"), "fp")
    loose, first, step = None, 0, KEYS_AT_FIRST
    while first < keys:
        some = range(first, min(first + step, keys))
        keyed = source.mapInArrow(keyed_rows(some), "key long, id long, label long, fp binary")
        found = _links(keyed, distance, WIDE_BITS // 64, space, f"links-{first}", hot_rows)
        found = space.put(f"loose-{first}", found.distinct())
        loose = found if loose is None else loose.unionByName(found)
        first, step = first + step, min(2 * step, KEYS_AT_ONCE)
        if first < keys:
            lower = found.groupBy(F.col("b").alias("label")).agg(F.min("a").alias("least"))
            source = space.put(f"labelled-{first}", source.join(lower, "label", "left").select(
                "id", F.coalesce("least", "label").alias("label"), "fp"
            ))
        space.release()
    classes = space.put("classes", components(loose, space, "loose-stars"))
    links = _verified(docs, classes, similarity, space, id_column, text_column)
    roots = components(links, space)
    answer = space.put("answer", distinct.join(roots, distinct.id == roots.node, "left").select(
        "digest", F.coalesce("root", "id").alias("component")))
    return prints.join(answer, "digest").filter("doc <> component").select("doc", "component")
