"""Largest values per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sequences import SLICE, Ordered

TOPS = ["top1", "top2", "top3"]


def top_n(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` largest rows per key with their rank; equal values all count.

    Spark prunes to ``n`` rows per key before the shuffle (WindowGroupLimit), so
    a large key stays cheap.
    """
    by_size = Window.partitionBy(*keys).orderBy(F.desc(value), *order)
    return df.withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= n)


def top3_running(df: DataFrame, keys, order, value: str, limits=None) -> DataFrame:
    """The three largest values of the key after each row, equal values kept."""
    seq = Ordered(df, keys, order, limits)
    if not seq.is_cut:
        return _cascade(df, keys, order, value)
    rows = seq.df
    here = _cascade(rows, [*keys, SLICE], order, value)
    # The same over the three largest of each slice gives, slice by slice, the
    # three largest of all earlier ones.
    best = top_n(rows, [*keys, SLICE], value, [], 3)
    so_far = _cascade(best.select(*keys, SLICE, "rank", value), keys, [SLICE, "rank"], value)
    # Places only grow along the way, so a slice ends with its largest ones.
    ends = so_far.groupBy(*keys, SLICE).agg(*[F.max(t).alias(t) for t in TOPS])
    next_slice = Window.partitionBy(*keys).orderBy(SLICE)
    carry = ends.select(*keys, SLICE, F.row_number().over(next_slice).alias("_nth"), *[F.lag(t).over(next_slice).alias(f"_carry_{t}") for t in TOPS])
    merged = F.array_compact(F.array(*TOPS, *[f"_carry_{t}" for t in TOPS]))
    all_six = seq._bring(here, carry.where("_nth > 1").drop("_nth")).withColumn("_all", F.sort_array(merged, asc=False))
    places = {t: F.get("_all", F.lit(i)) for i, t in enumerate(TOPS)}
    return all_six.withColumns(places).select(*df.columns, *TOPS)


def _cascade(df: DataFrame, keys, order, value: str) -> DataFrame:
    """The running second is the maximum of what the running first displaced or
    turned away, and the third the same for the second: running maxima over one
    shuffle and one sort, instead of a growing list per row."""
    by = Window.partitionBy(*keys).orderBy(*order)
    so_far, ahead = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(Window.unboundedPreceding, -1)
    rows, losing = df, F.col(value)
    for top in TOPS:
        rows = rows.withColumn("_losing", losing)
        rows = rows.withColumns({top: F.max("_losing").over(so_far), "_ahead": F.max("_losing").over(ahead)})
        # least() skips nulls, but a missing value or an empty place displaces nothing.
        both = F.col("_ahead").isNotNull() & F.col("_losing").isNotNull()
        rows = rows.withColumn("_pushed", F.when(both, F.least("_losing", "_ahead")))
        losing = F.col("_pushed")
    return rows.drop("_losing", "_ahead", "_pushed")
