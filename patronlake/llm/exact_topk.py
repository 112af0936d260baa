"""Exact top-k search by inner product: exhaustive, every query with every candidate.

Vectors are rows of whole-number weights, floor(scale * x) of each component. They are packed where they
lie into blocks, matrices of the fewest bytes that hold their weights. Blocks of queries make groups, blocks
of candidates make columns; a group and a column are one unit of work and one task, which holds the queries
with their best candidates so far and streams through the candidates. Of a tile of queries and a part of a
block all scores are made at once, dense: by a matrix product where floating point is exact for such
weights, else, or where few components have weights, from postings, a term after the other. Scores that
reach a query's worst kept one are selected and merged with what it keeps, and the columns' best are merged
by a ranked window.

A unit is dealt to its task by number, so nothing is joined or broadcast and the driver gets three counts.
The shuffle has each candidate block once for each group and each query block once for each column;
`GROUPS_AT_ONCE` groups are searched at a time, and their shuffle is released before the next.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part; a query does
not find its own row, but finds other rows with its id; ties go to the smaller id, NULL ids last; a
query with fewer candidates than k gets them all; vectors of unlike lengths meet in their common
components; repeated queries are answered each; an empty table gives an empty result; further columns
are ignored. Weights and scores beyond 64 bits count as the nearest 64-bit number of their sign: sums are exact
before that, and rank by what is reported.
"""

from __future__ import annotations

from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlake.llm.shared import Workspace, prepare, required

SCALE = 256
CANDIDATES_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 1024
BLOCK_CELLS = 1 << 20  # weights of a block, unless one vector has more
GROUP_CELLS = 1 << 23  # weights of the queries that a task holds
COLUMN_CELLS = 1 << 26  # weights of the candidates that a task streams through
GROUPS_AT_ONCE = 2  # the shuffle of a round may still be there while the next one is written
UNITS_PER_CORE = 3
TILE_QUERIES, TILE_ROWS = 256, 1024
RESULT_QUERIES = 8192  # to a batch of results
# Nanoseconds of a cell in a product, of a term's start and of a posting in a scatter; they choose the way, not the result.
_CELL_NS, _TERM_NS, _POSTING_NS = 0.03, 1500, 1.2
_MOST = (1 << 63) - 1
_NONE = -1 << 63  # below every score

_BLOCK = "place long, side int, n long, width long, kind string, row_numbers binary, ids binary, weights binary"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def weights(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _cuts(lengths: list[int], most_rows: int) -> list[int]:
    """Where blocks begin; the last one is open."""
    cuts, width = [0], 0
    for at, length in enumerate(lengths):
        width, n = max(width, length), at - cuts[-1]
        if n and (n >= most_rows or width * (n + 1) > BLOCK_CELLS):
            cuts.append(at)
            width = length
    return cuts


def _packed(side: int, most_rows: int):
    """Rows (row, id, weights) as blocks: row numbers, ids, and weights as bytes of a matrix with as many
    columns as the longest vector has components. Places count up from the partition's number."""

    def pack(place, part):
        lists = part.column(2)
        lengths = np.diff(lists.offsets.to_numpy())
        width = int(lengths.max())
        if (lengths == width).all():
            matrix = lists.flatten().to_numpy().reshape(-1, width) if width else np.zeros((part.num_rows, 0), np.int64)
        else:
            matrix = np.zeros((part.num_rows, width), np.int64)
            matrix[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
        most = largest(matrix)
        kind = next((kind for kind in ("int8", "int16", "int32") if most <= np.iinfo(kind).max), "int64")
        values = (
            place, side, part.num_rows, width, kind, part.column(0).to_numpy().tobytes(),
            part.column(1).to_numpy().tobytes(), matrix.astype(kind).tobytes(),
        )
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * 3)
        return pa.RecordBatch.from_arrays(
            [pa.array([x], kind) for x, kind in zip(values, kinds)],
            names=["place", "side", "n", "width", "kind", "row_numbers", "ids", "weights"],
        )

    def run(batches):
        held, place = None, TaskContext.get().partitionId()
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            cuts = _cuts(np.diff(held.column(2).offsets.to_numpy()).tolist(), most_rows)
            for a, b in zip(cuts, cuts[1:]):
                yield pack(place, held.slice(a, b - a))
                place += 1
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield pack(place, held)

    return run


def largest(matrix: np.ndarray) -> int:
    """The greatest size of a weight."""
    return max(abs(int(matrix.max(initial=0))), abs(int(matrix.min(initial=0))))


def postings(matrix: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By term: the positions with a weight, and the weights."""
    lists = []
    for term in matrix.T:
        at = np.flatnonzero(term)
        lists.append((at, term[at].astype(np.int64)))
    return lists


def _norms(matrix: np.ndarray) -> np.ndarray:
    """Lengths of the rows, rounded up: no sum of products of two rows' weights exceeds the product of their lengths."""
    numbers = matrix.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", numbers, numbers)) * (1 + 1e-9)


def _own_score(query: np.ndarray, norm: float) -> int:
    if norm * norm < _MOST:
        return int((query.astype(np.int64) ** 2).sum())
    return min(_MOST, sum(w * w for w in query.tolist()))


class Block:
    """Candidates in a part of a block."""

    def __init__(self, row: dict, part: slice):
        self.matrix = _matrix(row)[part]
        self.ids = np.frombuffer(row["ids"], np.int64)[part]
        self.no_id = np.frombuffer(row["row_numbers"], np.int64)[part] < 0
        self.least_id, self.names = int(self.ids.min()), not self.no_id.all()
        self.norm = float(_norms(self.matrix).max())
        self.counts = np.count_nonzero(self.matrix, axis=0)
        self.factors: dict[type, np.ndarray] = {}

    def factor(self, kind: type) -> np.ndarray:
        if kind not in self.factors:
            self.factors[kind] = np.ascontiguousarray(self.matrix.T, dtype=kind)
        return self.factors[kind]

    @cached_property
    def postings(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return postings(self.matrix)

    def product(self, queries: np.ndarray, kind: type) -> np.ndarray:
        terms = min(queries.shape[1], self.matrix.shape[1])
        return queries[:, :terms].astype(kind) @ self.factor(kind)[:terms]

    def scattered(self, queries: np.ndarray, fits: bool) -> np.ndarray:
        """A term at a time; unless sums fit 64 bits they are made of Python's numbers."""
        n, terms = len(self.ids), min(queries.shape[1], self.matrix.shape[1])
        out = np.zeros((len(queries), n), np.int64)
        for i, query in enumerate(queries):
            scores = out[i] if fits else np.zeros(n, object)
            for term in np.flatnonzero(query[:terms]).tolist():
                at, weight = self.postings[term]
                if not fits:
                    weight = weight.astype(object)
                if len(at) == n:
                    scores += int(query[term]) * weight
                else:
                    scores[at] += int(query[term]) * weight
            if not fits:
                out[i] = [max(-_MOST, min(_MOST, s)) for s in scores]
        return out

    def scores(self, queries: np.ndarray, norm: float) -> np.ndarray:
        """Scores of a tile of queries, whole numbers of a type that holds them; `norm`: of its longest query."""
        bound = norm * self.norm
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else None
        if kind and not self.sparse_for(queries):
            return self.product(queries, kind)
        return self.scattered(queries, bound < _MOST)

    def sparse_for(self, queries: np.ndarray) -> bool:
        """Whether postings cost less than a product, which takes all components."""
        if 8 * int(self.counts.sum()) > self.matrix.size:
            return False
        terms = min(queries.shape[1], len(self.counts))
        wanted = np.count_nonzero(queries[:, :terms], axis=0)
        product = _CELL_NS * len(queries) * len(self.ids) * terms
        return float(wanted @ (_TERM_NS + _POSTING_NS * self.counts[:terms])) < product


def _matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["weights"], row["kind"]).reshape(row["n"], row["width"])


class Group:
    """Queries of a unit, and of each the best `k` candidates so far, best first."""

    def __init__(self, rows: list[dict], k: int):
        self.k = k
        kind = np.result_type(*[row["kind"] for row in rows])
        self.matrix = np.zeros((sum(row["n"] for row in rows), max(row["width"] for row in rows)), kind)
        at = 0
        for row in rows:
            self.matrix[at : at + row["n"], : row["width"]] = _matrix(row)
            at += row["n"]
        self.ids = np.concatenate([np.frombuffer(row["ids"], np.int64) for row in rows])
        self.numbers = np.concatenate([np.frombuffer(row["row_numbers"], np.int64) for row in rows])
        self.norms = _norms(self.matrix)
        n = len(self.ids)
        self.score = np.full((n, k), _NONE, np.int64)
        self.found = np.full((n, k), _MOST, np.int64)
        self.no_id = np.ones((n, k), bool)

    def meet(self, block: Block) -> None:
        for first in range(0, len(self.ids), TILE_QUERIES):
            tile = slice(first, min(first + TILE_QUERIES, len(self.ids)))
            self.take(tile, block, block.scores(self.matrix[tile], float(self.norms[tile].max())))

    def take(self, tile: slice, block: Block, scores: np.ndarray) -> None:
        """Merges what reaches the worst kept candidate of each query."""
        k, top = self.k, scores.max(axis=1).astype(np.int64)
        least, last_id, last_no_id = self.score[tile, -1], self.found[tile, -1], self.no_id[tile, -1]
        # a level score is of use only with a smaller id
        sooner = (block.least_id < last_id) | ((block.least_id == last_id) & last_no_id & block.names)
        hit = np.flatnonzero((top > least) | ((top == least) & sooner))
        if not len(hit):
            return
        some, least, last_id, last_no_id = scores[hit], least[hit], last_id[hit], last_no_id[hit]
        enough, n = least, some.shape[1]
        if n > k and (least == _NONE).any():
            enough = np.maximum(least, np.partition(some, -k, axis=1)[:, -k].astype(np.int64))
        i, j = np.divmod(np.flatnonzero(some >= enough.astype(some.dtype)[:, None]), n)
        score, ids = some[i, j].astype(np.int64), block.ids[j]
        may = (score > least[i]) | (ids < last_id[i]) | ((ids == last_id[i]) & last_no_id[i] & ~block.no_id[j])
        i, j, score = i[may], j[may], score[may]
        rows = hit + tile.start
        of = np.concatenate([i, np.repeat(np.arange(len(hit)), k)])
        score = np.concatenate([score, self.score[rows].ravel()])
        found = np.concatenate([block.ids[j], self.found[rows].ravel()])
        no_id = np.concatenate([block.no_id[j], self.no_id[rows].ravel()])
        order = np.lexsort((no_id, found, ~score, of))
        best = order[np.searchsorted(of[order], np.arange(len(hit)))[:, None] + np.arange(k)]
        self.score[rows], self.found[rows], self.no_id[rows] = score[best], found[best], no_id[best]

    def results(self):
        names = ["query_row", "query_id", "vec_id", "score", "own_score", "no_id"]
        for first in range(0, len(self.ids), RESULT_QUERIES):
            part = slice(first, first + RESULT_QUERIES)
            own = [_own_score(query, norm) for query, norm in zip(self.matrix[part], self.norms[part].tolist())]
            there = self.score[part] != _NONE
            times = there.sum(axis=1)
            of_query = (np.repeat(np.asarray(x, np.int64), times) for x in (self.numbers[part], self.ids[part], own))
            number, own_id, own_score = of_query
            columns = (
                number, own_id, self.found[part][there], self.score[part][there], own_score,
                self.no_id[part][there].astype(np.int64),
            )
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)


def _search(k: int):
    """Blocks of units, queries before candidates: the best k candidates of each query."""

    def run(batches):
        unit, waiting, group = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["unit"] != unit:
                    if group:
                        yield from group.results()
                    unit, waiting, group = row["unit"], [], None
                if row["side"] == 0:
                    waiting.append(row)
                    continue
                if waiting:
                    group, waiting = Group(waiting, k), []
                if group:
                    for first in range(0, row["n"], TILE_ROWS):
                        group.meet(Block(row, slice(first, first + TILE_ROWS)))
        if group:
            yield from group.results()

    return run


def _up(n: int, by: int) -> int:
    return -(-n // by)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, id_column: str = "vec_id",
    vector_column: str = "embedding", candidates_per_block: int = CANDIDATES_PER_BLOCK,
    queries_per_group: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows of `vectors` for which `is_query` holds, on all rows."""
    spark = vectors.sparkSession
    prepare(spark)
    space = Workspace(spark, "topk")
    number = F.monotonically_increasing_id()  # below 0 for rows without an id, which go last among equal ids
    rows = required(vectors, id_column, vector_column).filter(usable(F.col(f"`{vector_column}`")))
    rows = space.put("rows", rows.select(
        F.when(F.col(f"`{id_column}`").cast("long").isNull(), -1 - number).otherwise(number).alias("row"),
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(_MOST)).alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        weights(F.col(f"`{vector_column}`"), scale).alias("w"),
    ))
    n, n_queries, width = rows.agg(F.count("*"), F.count_if("is_query"), F.max(F.size("w"))).first()
    width = max(1, width or 0)
    groups = max(1, _up(n_queries, queries_per_group or max(1, GROUP_CELLS // width)))
    at_once = min(groups, GROUPS_AT_ONCE)
    wanted = _up(UNITS_PER_CORE * spark.sparkContext.defaultParallelism, at_once)
    columns = max(1, _up(n * width, COLUMN_CELLS), min(wanted, _up(n, candidates_per_block)))

    def packed(name, part, side, most_rows):
        return space.put(name, part.select("row", "id", "w").mapInArrow(_packed(side, most_rows), _BLOCK))

    candidates = packed("candidates", rows, 1, min(candidates_per_block, max(1, n // (8 * columns * TILE_ROWS)) * TILE_ROWS))
    queries = packed("queries", rows.filter("is_query"), 0, QUERIES_PER_BLOCK)
    space.drop("rows")

    def each(count):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    def dealt(count):
        return F.pmod("place", F.lit(count))

    def searched(first, some):
        """Groups from the first on; unit = group * columns + column."""
        asked = queries.withColumn("group", dealt(groups) - first).filter(F.col("group").between(0, some - 1))
        met = asked.select("*", each(columns).alias("column")).unionByName(
            candidates.withColumn("column", dealt(columns)).select("*", each(some).alias("group"))
        )
        unit = (F.col("group") * columns + F.col("column")).cast("int").alias("unit")
        return (
            met.select(unit, *candidates.columns).repartitionById(some * columns, "unit").sortWithinPartitions("unit", "side")
            .mapInArrow(_search(k + 1), "query_row long, query_id long, vec_id long, score long, own_score long, no_id long")
        )

    found = []
    for first in range(0, groups, at_once):
        found.append(space.put(f"found-{first}", searched(first, min(at_once, groups - first))))
        space.release()
    found = reduce(DataFrame.unionByName, found)
    best = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "no_id")
    ranked = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    # one row with the query's id and its score with itself is the query
    same_id = (F.col("vec_id") == F.col("query_id")) & ((F.col("no_id") == 1) == (F.col("query_row") < 0))
    itself = same_id & (F.col("score") == F.col("own_score"))
    own_place = F.min(F.when(itself, F.col("place"))).over(W.partitionBy("query_row"))
    others = ranked.withColumn("own_place", F.coalesce(own_place, F.lit(k + 1)))
    rank = F.when(F.col("place") > F.col("own_place"), F.col("place") - 1).otherwise(F.col("place"))
    return others.filter(F.col("place") != F.col("own_place")).select(
        F.when(F.col("query_row") >= 0, F.col("query_id")).alias("query_id"), rank.cast("int").alias("rank"),
        F.when(F.col("no_id") == 0, F.col("vec_id")).alias("vec_id"), "score",
    ).filter(F.col("rank") <= k)
