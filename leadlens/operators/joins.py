"""Joins of a large relation to derived tables.

No broadcast hint: Spark's byte threshold and AQE decide from measured
sizes, and AQE splits skewed partitions of a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def join_lookup(left: DataFrame, right: DataFrame, on: str | list | Column, how: str) -> DataFrame:
    """``left`` joined to the derived table ``right``."""
    return left.join(right, on, how)
