"""Time, session and count windows.

The time windows take a bounded frame or a stream (with a watermark set by the
caller). Windows are half-open, aligned to the epoch. Aggregates are named
``(kind, column)`` pairs so that they can be computed in two steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import Limits, Ordered, Run, as_micros, untag

Aggregates = dict[str, tuple[str, str | Column]]


def _first_step(kind: str, c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[kind](c)


def _bounds(df: DataFrame, keys: Sequence[str], window: str, names) -> DataFrame:
    return df.select(
        *keys,
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
        *names,
    )


def with_processing_time(df: DataFrame, name: str = "pt") -> DataFrame:
    """The processing-time attribute: when the micro-batch or query ran."""
    return df.withColumn(name, F.current_timestamp())


def tumble(df: DataFrame, keys, time: str, size: str, aggregates: Aggregates) -> DataFrame:
    grouped = df.groupBy(*keys, F.window(time, size).alias("w"))
    result = grouped.agg(*[_first_step(k, c).alias(n) for n, (k, c) in aggregates.items()])
    return _bounds(result, keys, "w", aggregates)


def slide(df: DataFrame, keys, time: str, size: str, every: str, aggregates: Aggregates) -> DataFrame:
    """Windows of ``size``, one starting each ``every`` (the size comes first)."""
    grouped = df.groupBy(*keys, F.window(time, size, every).alias("w"))
    result = grouped.agg(*[_first_step(k, c).alias(n) for n, (k, c) in aggregates.items()])
    return _bounds(result, keys, "w", aggregates)


def session(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    gap_us: int | str | Column,
    aggregates: Aggregates,
    limits: Limits | None = None,
) -> DataFrame:
    """Session windows with one gap, or a gap per row, in microseconds.

    Rows exactly one gap apart share a session. Over a cut sequence a session
    begins where a row lies beyond the running maximum of all earlier ends;
    counting the beginnings numbers the sessions, which are then plain groups.
    So a large key is spread over tasks whatever its gaps.
    """
    fixed = isinstance(gap_us, int)
    gap = F.lit(gap_us) if fixed else (F.col(gap_us) if isinstance(gap_us, str) else gap_us)
    names = list(aggregates)

    def plain(rows: DataFrame, length: str | Column, steps: list[Column]) -> DataFrame:
        grouped = rows.groupBy(*keys, F.session_window(time, length).alias("w"))
        return _bounds(grouped.agg(*steps), keys, "w", names)

    once = [_first_step(k, c).alias(n) for n, (k, c) in aggregates.items()]
    length = f"{gap_us} microseconds" if fixed else _micros_text(gap)
    if df.isStreaming:
        return plain(df, length, once)
    valid = df.withColumn("_gap", gap.cast("bigint")).where(F.col("_gap") > 0)
    seq = Ordered(valid.where(F.col(time).isNotNull()), keys, [time], limits)
    if not seq.is_cut:
        return plain(df, length, once)
    span = "make_dt_interval(0, 0, 0, cast(cast(_gap AS decimal(18, 0)) / 1000000 AS decimal(18, 6)))"
    rows = seq.df.withColumn("_at", as_micros(seq.df, time)).withColumn("_end", F.expr(f"`{time}` + {span}"))
    rows = seq.settled(rows).running({"_reach": Run("max", F.col("_at") + F.col("_gap"), inclusive=False)})
    begins = F.col("_reach").isNull() | (F.col("_at") > F.col("_reach"))
    rows = seq.settled(rows.withColumn("_begins", F.when(begins, 1))).running({"_session": Run("count", "_begins")})
    grouped = rows.groupBy(*keys, "_session").agg(F.min(time).alias("window_start"), F.max("_end").alias("window_end"), *once)
    return grouped.select(*keys, "window_start", "window_end", *names)


def _micros_text(gap: Column) -> Column:
    return F.concat(gap.cast("bigint").cast("string"), F.lit(" microseconds"))


def count_tumble(
    df: DataFrame, keys, order, size: int, aggregates: Aggregates,
    carried: Sequence[str] = (), limits=None,
) -> DataFrame:
    """Windows of ``size`` rows per key; a window that never fills is not emitted.

    ``carried`` fields come from the window's first row.
    """
    placed = Ordered(df, keys, order, limits).positions("_nth")
    nth = F.floor((F.col("_nth") - 1) / size).cast("bigint")
    grouped = placed.groupBy(*keys, nth.alias("window_no")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.min_by(c, "_nth").alias(f"first_{c}") for c in carried],
        *[_first_step(k, c).alias(n) for n, (k, c) in aggregates.items()],
    )
    return grouped.where(F.col("_rows") == size).drop("_rows")


def count_slide(
    df: DataFrame, keys, order, size: int, every: int, aggregates: Aggregates, limits=None
) -> DataFrame:
    """Every ``every`` rows of a key, aggregates over its last ``size`` rows or fewer."""
    seq = Ordered(df, keys, order, limits)

    def frame(w):
        w = w.rowsBetween(1 - size, 0)
        return {n: _first_step(k, c).over(w) for n, (k, c) in aggregates.items()}

    framed = seq.over(seq.positions("nth")).framed(frame, before=size - 1, position="nth")
    return untag(framed.where(F.col("nth") % every == 0))
