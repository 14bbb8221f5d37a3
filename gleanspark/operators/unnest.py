"""Exploding an array that is costly to compute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column | str, item: str, keep: Sequence[str] = (), pos: str | None = None) -> DataFrame:
    """``(keep..., pos, item)`` for every element; null and empty arrays give nothing.

    A plain explode has the optimizer test the array in a filter of its own,
    which parses a JSON text several times over. The outer form computes the
    array once, and the rows of empty arrays are dropped by their position.
    """
    at = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(at, item)).where(F.col(at).isNotNull())
    return rows if pos else rows.drop(at)
