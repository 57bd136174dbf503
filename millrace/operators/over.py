"""OVER windows: aggregates over rows near each row."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .sequences import Ordered, exact_time, floor_div, untag


def over_unbounded(df: DataFrame, keys, order, columns, limits=None) -> DataFrame:
    """From the key's start to the current row's time, equal times together."""
    return untag(Ordered(df, keys, order, limits).running(columns, ties=True))


def over_rows(df: DataFrame, keys, order, preceding: int,
              columns: dict[str, Column], limits=None) -> DataFrame:
    """The current row and ``preceding`` rows before it."""

    def framed(w: WindowSpec) -> dict[str, Column]:
        return {n: c.over(w.rowsBetween(-preceding, 0)) for n, c in columns.items()}

    return untag(Ordered(df, keys, order, limits).framed(framed, before=preceding))


def over_range(df: DataFrame, keys, order, preceding_us: int,
               columns: dict[str, tuple[str, str]], limits=None) -> DataFrame:
    """The rows at most ``preceding_us`` (in units of the order column) earlier.

    ``columns`` names aggregates as ``(kind, column)``: ``sum``, ``count``,
    ``min`` or ``max``. Rows without a time are each other's frame.

    A cut sequence is laid out by cells of time no wider than a frame. A frame
    then is the end of one cell, from its own begin on, and the beginning of a
    later cell, up to the row's time, with one whole cell between them at most;
    its parts are combined, nothing is subtracted, so a NaN or a large value
    stays within its frames. Sums of doubles may differ from an uncut sequence in
    their last digits. Cells are cut by rows in turn, so a burst inside one
    frame is no large task.
    """
    seq = Ordered(df, keys, order, limits)
    time = exact_time(df, order[0])
    plain = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    if not seq.is_cut:
        window = Window.partitionBy(*keys).orderBy("_time").rangeBetween(-preceding_us, 0)
        return df.withColumn("_time", time).withColumns({n: plain[k](c).over(window) for n, (k, c) in columns.items()}).drop("_time")

    def cell(at: Column) -> Column:
        if preceding_us <= 0:
            return at
        if _is_whole(df, order[0]):
            return floor_div(at, preceding_us)
        # Scaling by a power of two is exact.
        return F.floor(at / float(2 ** math.floor(math.log2(preceding_us)))).cast("double")

    where = [*keys, "_cell"]
    celled = untag(seq.df).withColumns({"_cell": cell(time), "_begin": time - preceding_us, "_begin_cell": cell(time - preceding_us)})
    inner = Ordered(celled, where, order, limits)
    upto = settle(untag(inner.running({f"_to_{n}": c for n, c in columns.items()}, ties=True)))
    if preceding_us > 0:
        # Where rounding puts a frame's begin into the row's own cell, it is the cell's edge.
        begin = F.when(F.col("_begin_cell") < F.col("_cell"), F.col("_begin"))
        both = Ordered.whole(upto, where, order).as_of(
            begin, {f"_from_{n}": c for n, c in columns.items()}, reverse=True, place={"_cell": F.col("_begin_cell")}, limits=seq.limits)
        own = F.when(F.col("_begin_cell") < F.col("_cell") - 1, F.col("_cell") - 1)
        totals = upto.where("_cell is not null").groupBy(*where).agg(*[plain[k](c).alias(f"_all_{n}") for n, (k, c) in columns.items()])
        totals = totals.withColumnsRenamed({c: f"_of_{c}" for c in where})
        on = [own == F.col("_of__cell"), *(F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys)]
        joined = both.join(totals, reduce(and_, on), "left")
    else:
        joined = upto.withColumns({f"_{p}_{n}": F.lit(None) for p in ("from", "all") for n in columns})

    def combined(name: str, kind: str) -> Column:
        parts = [F.col(f"_{p}_{name}") for p in ("from", "all", "to")]
        if kind in ("min", "max"):
            return (F.least if kind == "min" else F.greatest)(*parts)
        if kind == "count":
            return sum((F.coalesce(p, F.lit(0)) for p in parts[:2]), parts[2])
        add = lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
        return add(add(parts[0], parts[1]), parts[2])

    return joined.select(*df.columns, *[combined(n, k).alias(n) for n, (k, _) in columns.items()])


def _is_whole(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.FractionalType, T.DecimalType))
