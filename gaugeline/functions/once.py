"""Expressions worth computing a single time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_column_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however many filters and columns use it.

    The optimizer copies a projected expression into the filters above it, where every copy runs
    again. It does not look through an exploded one-element array, which costs next to nothing.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
