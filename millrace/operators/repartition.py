"""The partitioners a job can ask for by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_key(df: DataFrame, *keys: str, parts: int | None = None) -> DataFrame:
    """All rows of a key in one partition."""
    return df.repartition(parts, *keys) if parts else df.repartition(*keys)


def at_random(df: DataFrame, parts: int, ident: str, seed: int = 0) -> DataFrame:
    """Spread rows at random.

    The target comes from a seeded hash of ``ident``, not ``rand()``: a task
    that is run again after a lost executor must send its rows to the same place.
    """
    return df.repartition(parts, F.xxhash64(F.lit(seed), F.col(ident)))


def round_robin(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts)


def rescale(df: DataFrame, parts: int) -> DataFrame:
    """Fewer partitions without a shuffle, more with one."""
    now = df.rdd.getNumPartitions()
    return df.coalesce(parts) if parts <= now else df.repartition(parts)
