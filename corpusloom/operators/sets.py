"""Unions and distinct."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows by column name; a column a source lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_sentences(df: DataFrame, column: str = "sentence") -> DataFrame:
    return df.select(column).distinct()
