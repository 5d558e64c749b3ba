"""Costly columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that a later filter reads instead of computing it again.

    The optimizer moves a filter below the projection it reads from and repeats
    the projected expression there; it does not do so below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
