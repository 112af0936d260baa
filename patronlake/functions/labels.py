"""Display labels of the KPI cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fixed(value: Column, digits: int) -> Column:
    """Digits after the point, ties to even on the exact binary value, no grouping."""
    return F.regexp_replace(F.format_number(value, digits), ",", "")


def number_label(column: Column) -> Column:
    n = column.cast("double")
    return (
        F.when(n.isNull(), "0")
        .when(n >= 1_000_000, F.concat(_fixed(n / 1_000_000, 1), F.lit("M")))
        .when(n >= 1_000, F.concat(_fixed(n / 1_000, 1), F.lit("K")))
        .otherwise(F.format_number(n, 0))
    )


def currency_label(column: Column, symbol: str = "R$") -> Column:
    n = column.cast("double")
    amount = (
        F.when(n.isNull(), "0")
        .when(n >= 1_000_000, F.concat(_fixed(n / 1_000_000, 2), F.lit("M")))
        .when(n >= 1_000, F.concat(_fixed(n / 1_000, 1), F.lit("K")))
        .otherwise(F.format_number(n, 2))
    )
    return F.concat(F.lit(f"{symbol} "), amount)
