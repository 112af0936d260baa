"""Mapping of free vocabulary onto the standard words."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def remap(column: Column, aliases: Mapping[str, str], standard: Iterable[str]) -> Column:
    """Alias → standard word; a standard word passes; everything else, NULL included, is NULL.

    One lookup in one literal map, so a mapped word is never mapped again.
    """
    words = {word: word for word in standard}
    return literal_map({**words, **aliases})[column]


def remap_or(column: Column, aliases: Mapping[str, str], default: str) -> Column:
    return F.coalesce(literal_map(aliases)[column], F.lit(default))


def keep_if_in(column: Column, allowed: Iterable[str]) -> Column:
    return F.when(column.isin(*allowed), column)


def label_null(column: Column, label: str) -> Column:
    return F.coalesce(column, F.lit(label))
