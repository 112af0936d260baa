"""Nearest neighbours by inner product: a block matrix join of int8 tiles with error bounds.

Vectors become blocks: the vectors themselves in double precision, beside them whole numbers of 8 bits
(component / largest component * 127), the scale, the norm and the norm of what rounding lost. A task has
the blocks of a group of queries and streams through the blocks of a column of candidates. For each pair
of blocks one product of the int8 matrices gives all inner products up to an error of
|q'| |c - c'| + |q - q'| |c|, where q' and c' are the rounded vectors. A pair whose product plus error
lies below the query's k-th best lower bound cannot be among its nearest and goes; pairs that survive are
multiplied again in double precision, component after component, and pass through a heap of each query.
The heaps of all columns are merged by rank. Nothing is sampled and no index is fitted: recall is 1.

Equal vectors are folded first: one stands for all as a query, and as candidates only the rows with the
smallest ids of each vector can be answers, so a vector that is everywhere costs no more than others.
Each query row then leaves itself out of its vector's answers.

A query group is `QUERIES` vectors at most and a block `BLOCK_CELLS` components; columns are only
streamed, so their size is a matter of parallelism. The shuffle carries each query block once for each
column and each candidate block once for each query group.

Defined results: vectors that are NULL, empty or zero, or hold a NULL or non-finite component, take no
part; ties go to the smaller id, NULL ids last; a row without an id is no query; rows with equal ids
are different rows, and only a query's own row is left out; a query with fewer candidates gets them all;
of vectors of unlike lengths the shorter one counts as filled up with zeros; products beyond the range
of doubles are infinite, and undefined ones (infinity less infinity) count as minus infinity; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlake.llm.exact_topk import usable
from patronlake.llm.shared import Workspace, prepare, required

K = 20
QUERIES = 1 << 13
COLUMN = 1 << 16
LEAST_COLUMN = 1 << 11
BLOCK_ROWS, BLOCK_CELLS = 1 << 11, 1 << 20
AT_ONCE = 512  # queries to a tile
SURVIVOR_CELLS = 1 << 21  # components of survivors that are multiplied at a time
MAX_PARTS = 1 << 16
EXACT_SUM = 1 << 24  # whole numbers below are exact in single precision
NO_ID = 1 << 63  # after all ids
_SLACK = 1e-9  # for the rounding of the bounds themselves, relative to the norms

_BLOCK = "side int, n long, width long, numbers binary, ids binary, nameless binary, exact binary"


def _blocks(side: int):
    """Rows (number, id, vector) as blocks of at most `BLOCK_ROWS` rows and `BLOCK_CELLS` components."""

    def block(numbers, ids, lists):
        width = max(map(len, lists))
        exact = np.zeros((len(lists), width))
        for i, x in enumerate(lists):
            exact[i, : len(x)] = x
        nameless = np.array([x is None for x in ids])
        values = (
            side, len(ids), width, np.array(numbers, np.int64).tobytes(),
            np.array([x or 0 for x in ids], np.int64).tobytes(), nameless.tobytes(), exact.tobytes(),
        )
        kinds = (pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays(
            [pa.array([x], kind) for x, kind in zip(values, kinds)],
            names=["side", "n", "width", "numbers", "ids", "nameless", "exact"],
        )

    def run(batches):
        numbers, ids, lists, width = [], [], [], 0
        for batch in batches:
            vectors = batch.column(2)
            bounds, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
            for number, own, a, b in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()
            ):
                wider = max(width, b - a)
                if ids and (len(ids) >= BLOCK_ROWS or wider * (len(ids) + 1) > BLOCK_CELLS):
                    yield block(numbers, ids, lists)
                    numbers, ids, lists, wider = [], [], [], b - a
                numbers.append(number)
                ids.append(own)
                lists.append(values[a:b].copy())
                width = wider
        if ids:
            yield block(numbers, ids, lists)

    return run


class Block:
    """Vectors of a block with their 8-bit form and what bounds its errors."""

    def __init__(self, row: dict):
        self.numbers = np.frombuffer(row["numbers"], np.int64)
        nameless = np.frombuffer(row["nameless"], bool)
        self.order = [
            NO_ID if none else own for none, own in zip(nameless.tolist(), np.frombuffer(row["ids"], np.int64).tolist())
        ]
        self.exact = np.frombuffer(row["exact"], np.float64).reshape(row["n"], row["width"])
        self.scale = np.abs(self.exact).max(axis=1) / 127
        self.scale[self.scale == 0] = np.finfo(np.float64).tiny  # all but zero
        self.small = np.rint(self.exact / self.scale[:, None]).clip(-127, 127).astype(np.int8)
        rounded = self.small * self.scale[:, None]
        with np.errstate(over="ignore"):
            self.norm = np.linalg.norm(self.exact, axis=1)
            self.rounded_norm = np.linalg.norm(rounded, axis=1)
            self.lost = np.linalg.norm(self.exact - rounded, axis=1)

    def tile(self, other: Block, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of some rows with all of the other block, and how far off they may be."""
        width = min(self.small.shape[1], other.small.shape[1])
        kind = np.float32 if width * 127 * 127 < EXACT_SUM else np.float64
        whole = self.small[rows, :width].astype(kind) @ other.small[:, :width].astype(kind).T
        with np.errstate(over="ignore", invalid="ignore"):
            product = whole * self.scale[rows, None] * other.scale
            error = np.outer(self.rounded_norm[rows], other.lost) + np.outer(self.lost[rows], other.norm)
            error += _SLACK * np.outer(self.norm[rows], other.norm)
        return product, error

    def products(self, other: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Exact inner products of pairs, summed from the first component on."""
        width = min(self.exact.shape[1], other.exact.shape[1])
        out = np.zeros(len(i))
        step = max(1, SURVIVOR_CELLS // max(width, 1))
        with np.errstate(over="ignore", invalid="ignore"):
            for at in range(0, len(i), step):
                pairs = self.exact[i[at : at + step], :width] * other.exact[j[at : at + step], :width]
                out[at : at + step] = np.add.accumulate(pairs, axis=1)[:, -1]
        return out


class Heaps:
    """The best `k` candidates of each query of a block, the worst on top: (score, minus id, number)."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(n)]
        self.least = np.full(n, -np.inf)

    def push(self, i: int, score: float, order: int, number: int) -> None:
        heap, entry = self.heaps[i], (score if score == score else -np.inf, -order, number)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.least[i] = heap[0][0]


def meet(queries: Block, candidates: Block, heaps: Heaps) -> int:
    """Passes the pairs that survive the bounds to the heaps; returns their number."""
    k, n, survivors = heaps.k, len(candidates.order), 0
    numbers = candidates.numbers.tolist()
    for first in range(0, len(queries.order), AT_ONCE):
        rows = slice(first, min(first + AT_ONCE, len(queries.order)))
        product, error = queries.tile(candidates, rows)
        with np.errstate(invalid="ignore"):
            upper, lower = product + error, product - error
        unknown = ~(np.isfinite(upper) & np.isfinite(lower))
        upper[unknown], lower[unknown] = np.inf, -np.inf
        least = heaps.least[rows]
        if n >= k and np.isinf(least).any():
            least = np.maximum(least, np.partition(lower, n - k, axis=1)[:, n - k])
        i, j = np.nonzero(upper >= least[:, None])
        scores = queries.products(candidates, i + first, j)
        for a, b, score in zip((i + first).tolist(), j.tolist(), scores.tolist()):
            heaps.push(a, score, candidates.order[b], numbers[b])
        survivors += len(i)
    return survivors


def _join(k: int):
    """Rows of one (group, column), queries before candidates: the best k candidates of each query."""
    names = ["query", "candidate", "score"]

    def results(held):
        for queries, heaps in held:
            found = [
                (q, number, score) for q, heap in zip(queries.numbers.tolist(), heaps.heaps) for score, _, number in heap
            ]
            q, c, s = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.float64())], names=names
            )

    def run(batches):
        unit, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["group"], row["column"]) != unit:
                    yield from results(held)
                    unit, held = (row["group"], row["column"]), []
                block = Block(row)
                if row["side"] == 0:
                    held.append((block, Heaps(len(block.order), k)))
                    continue
                for queries, heaps in held:
                    meet(queries, block, heaps)
        yield from results(held)

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding",
    queries_per_group: int = QUERIES, candidates_per_column: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which `is_query` holds, among all other rows."""
    spark = vectors.sparkSession
    prepare(spark)
    space = Workspace(spark, "nearest")
    required(vectors, id_column, vector_column)
    typed = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("v"),
    )
    plain = F.transform("v", lambda x: x + F.lit(0.0))  # 0.0 and -0.0 are one
    rows = space.put(
        "rows",
        typed.filter(usable(F.col("v")) & F.exists("v", lambda x: x != 0)).withColumn("v", plain).select(
            F.monotonically_increasing_id().alias("row"), "id", (F.col("asks") & F.col("id").isNotNull()).alias("asks"),
            "v", F.sha2(F.array_join(F.col("v").cast("array<string>"), ","), 256).alias("digest"),
        ),
    )
    folded = space.put("folded", rows.groupBy("digest").agg(
        F.min("row").alias("number"), F.min("id").alias("id"), F.first("v").alias("v"), F.bool_or("asks").alias("asks")
    ))
    n, asking = folded.agg(F.count("*"), F.count_if("asks")).first()
    if not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    per_column = candidates_per_column or max(LEAST_COLUMN, min(COLUMN, -(-n // spark.sparkContext.defaultParallelism)))
    columns, groups = -(-n // per_column), -(-asking // queries_per_group)

    def dealt(part: DataFrame, side: int, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        blocks = space.put(f"blocks-{side}", part.select("number", "id", "v").mapInArrow(_blocks(side), _BLOCK))
        place = F.pmod(F.xxhash64("numbers"), F.lit(own_n)).alias(own)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_n - 1).cast("long"))).alias(other)
        return blocks.select("*", place, every).select("group", "column", *blocks.columns)

    met = dealt(folded.filter("asks"), 0, "group", groups, "column", columns).unionByName(
        dealt(folded, 1, "column", columns, "group", groups)
    )
    found = (
        met.repartition(min(2 * columns * groups, MAX_PARTS), "group", "column")
        .sortWithinPartitions("group", "column", "side")
        .mapInArrow(_join(k + 1), "query long, candidate long, score double")
    )
    return _ranked(space.put("found", found), rows, folded, k)


def _ranked(found: DataFrame, rows: DataFrame, folded: DataFrame, k: int) -> DataFrame:
    """Answers of query rows from the best candidate vectors of each query vector.

    Of a vector's rows the k + 1 with the smallest ids can be answers: so many are enough even where one
    of them is the query itself.
    """

    def first(partition: str, *order):
        return F.row_number().over(W.partitionBy(partition).orderBy(*order))

    by_id = F.asc_nulls_last("id"), F.asc("row")
    members = (
        rows.select("digest", "id", "row").withColumn("nth", first("digest", *by_id)).filter(F.col("nth") <= k + 1)
        .join(folded.select("digest", F.col("number").alias("candidate")), "digest").select("candidate", "id", "row")
    )
    best = found.join(members, "candidate").withColumn(
        "place", first("query", F.desc("score"), *by_id)
    ).filter(F.col("place") <= k + 1)
    answers = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "id", "row", "score"))).alias("found"))
    asking = rows.filter("asks").select("digest", F.col("id").alias("query_id"), F.col("row").alias("own")).join(
        folded.select("digest", F.col("number").alias("query")), "digest"
    )
    others = F.slice(F.filter("found", lambda x: x["row"] != F.col("own")), 1, k)
    return asking.join(answers, "query").select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )
