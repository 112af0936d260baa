"""How a raw table becomes a clean one.

A ``CleanPlan`` lists the output columns of one table, and which of them can lose a value on the
way: by parsing (bad stamps and numbers) or by remapping (unknown words). From the same list come
the clean rows, the rejected values and the drift counts, so the three cannot disagree.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CleanPlan:
    table: str
    key: str
    columns: Mapping[str, Column]
    parsed: Mapping[str, str] = field(default_factory=dict)
    remapped: Mapping[str, str] = field(default_factory=dict)
    keep: Column | None = None


def clean_rows(raw: DataFrame, plan: CleanPlan) -> DataFrame:
    kept = raw if plan.keep is None else raw.filter(plan.keep)
    return kept.select(*[expr.alias(name) for name, expr in plan.columns.items()])


def _lost(plan: CleanPlan, name: str, source: str) -> Column:
    return F.col(source).isNotNull() & plan.columns[name].isNull()


def rejected_values(raw: DataFrame, plan: CleanPlan) -> DataFrame:
    """Quarantine: one row per value that was present in the source and could not be read.

    The row itself stays in the clean table with NULL in that place.
    """
    kept = raw if plan.keep is None else raw.filter(plan.keep)
    faults = F.array(*[
        F.when(
            _lost(plan, name, source),
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(source).cast("string").alias("raw_value"),
            ),
        )
        for name, source in plan.parsed.items()
    ])
    return (
        kept.select(
            F.lit(plan.table).alias("table_name"),
            F.col(plan.key).cast("string").alias("row_key"),
            F.explode(F.array_compact(faults)).alias("fault"),
        )
        .select("table_name", "row_key", "fault.column_name", "fault.raw_value")
        .withColumn("reason", F.lit("unreadable value"))
    )


def drift_counts(raw: DataFrame, plan: CleanPlan) -> DataFrame:
    """Per remapped column, the present source values outside the vocabulary. One pass."""
    names = list(plan.remapped)
    counts = raw.agg(*[
        F.count_if(_lost(plan, name, source)).alias(name) for name, source in plan.remapped.items()
    ])
    return counts.unpivot([], names, "column_name", "unmapped").select(
        F.lit(plan.table).alias("table_name"), "column_name", "unmapped"
    )
