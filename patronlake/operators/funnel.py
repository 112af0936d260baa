"""Funnels that respect order: how many steps a session takes one after the other.

The steps are an automaton: state s waits for step s and moves on when it comes. A run of events is a function
from states to states, and functions of adjoining runs compose, so a session need not be in one task: events are
dealt into ranges of (session, time), each task gives one function for each session it holds a part of, and a
session's functions, at most one for each task, are composed in the order of the ranges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S


def moves(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: int) -> np.ndarray:
    """For runs [start, end) of step numbers (-1: none): the state that each state 0..steps ends in."""
    comes = [np.append(np.flatnonzero(codes == step), len(codes)) for step in range(steps)]
    result = np.empty((len(starts), steps + 1), np.int64)
    for first in range(steps + 1):
        at, state, going = starts.copy(), np.full(len(starts), first), np.ones(len(starts), bool)
        for step in range(first, steps):
            following = comes[step][np.searchsorted(comes[step], at)]
            going &= following < ends
            state += going
            at = np.where(going, following + 1, at)
        result[:, first] = state
    return result


def _runs(steps: int):
    """Sorted rows (session, part, code) as one row (session, part, moves) for each session of a task."""
    names = ["session", "part", "moves"]

    def emit(sessions, part, found):
        lists = pa.array(found.tolist(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(sessions, pa.string()), pa.array([part] * len(sessions), pa.int32()), lists], names=names)

    def run(batches):
        held = None  # of the last session so far: its id, the task's number, its moves
        for batch in batches:
            if not batch.num_rows:
                continue
            # sessions are told apart by number within the batch; NULL is a session of its own
            sessions = batch.column(0).dictionary_encode()
            numbers = sessions.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, batch.num_rows)
            found = moves(batch.column(2).to_numpy(), starts, ends, steps)
            known = sessions.dictionary.to_pylist()
            names_of = [None if n < 0 else known[n] for n in numbers[starts].tolist()]
            part = batch.column(1)[0].as_py()
            if held and held[0] == names_of[0]:
                found[0] = found[0][held[2]]
            elif held:
                yield emit([held[0]], part, held[2][None])
            if len(starts) > 1:
                yield emit(names_of[:-1], part, found[:-1])
            held = (names_of[-1], part, found[-1])
        if held:
            yield emit([held[0]], held[1], held[2][None])

    return run


def session_progress(
    events: DataFrame, steps: tuple[str, ...] = S.EVENT_TYPES, session: str = "session_id", step: str = "event_type",
    time: str = "timestamp", event: str = "event_id",
) -> DataFrame:
    """(session_id, reached): the number of steps taken in order, of every session.

    Events go by (time, id), NULLs last; other events between two steps do not matter. NULL is a session too.
    """
    code = F.coalesce(*[F.when(F.col(f"`{step}`") == name, F.lit(i)) for i, name in enumerate(steps)], F.lit(-1))
    order = [F.asc_nulls_first("session"), F.asc_nulls_last("time"), F.asc_nulls_last("event")]
    functions = (
        events.select(
            F.col(f"`{session}`").cast("string").alias("session"), F.col(f"`{time}`").alias("time"),
            F.col(f"`{event}`").alias("event"), code.alias("code"),
        )
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("session", F.spark_partition_id().alias("part"), "code")
        .mapInArrow(_runs(len(steps)), "session string, part int, moves array<long>")
    )
    composed = F.aggregate(
        F.array_sort(F.collect_list(F.struct("part", "moves"))), F.lit(0).cast("long"),
        lambda state, run: F.get(run["moves"], state.cast("int")),
    )
    return functions.groupBy("session").agg(composed.alias("reached")).withColumnRenamed("session", session)


def ordered_funnel(events: DataFrame) -> DataFrame:
    """As ``events.session_funnel``, but a cart counts only after a view, and an abandonment only after that cart."""
    reached = session_progress(events)
    counts = reached.agg(
        F.count("*").alias("sessions"),
        *[F.count_if(F.col("reached") >= n).alias(name) for n, name in enumerate(("viewed", "carted", "abandoned"), 1)],
    )
    return counts.withColumns({
        "view_to_cart": F.try_divide(F.col("carted").cast("double"), "viewed"),
        "cart_to_abandon": F.try_divide(F.col("abandoned").cast("double"), "carted"),
    })
