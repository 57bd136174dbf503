"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """CRC-32 of the id's text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def first_by_hash(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Of each group the rows whose key hashes lowest, ``most`` of them (more only if a key repeats).

    Groups are counted first; only hashes in the lowest share of a group, twice
    what is wanted, are ranked, so ranking stays small however large the group
    is. One row per group goes back to the rows. Rows without group or key are
    left out. There must be few groups (classes, languages).
    """
    rows = rows.where(F.col(group).isNotNull() & F.col(key).isNotNull()).withColumn("_h", F.xxhash64(F.lit(11), key))
    names = rows.select(group, "_h")
    sizes = names.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    share = (F.col("_h") / float(1 << 64) + 0.5) * F.col("_n")
    low = names.join(F.broadcast(sizes), group).where(share <= 2 * most + 100)
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_h"))
    edges = low.select(group, "_h", rank.alias("_r")).where(F.col("_r") <= most).groupBy(group).agg(F.max("_h").alias("_edge"))
    return rows.join(F.broadcast(edges), group).where("_h <= _edge").drop("_h", "_edge")
