"""Event time on bounded inputs: watermarks and late rows row by row.

A stream moves its watermark once per micro-batch. On a bounded input the
watermark can be followed exactly: before each row it is the largest event
time that arrived earlier, less the allowed disorder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequences import Ordered, as_micros, untag


def seconds_to_time(df: DataFrame, column: str, name: str = "t") -> DataFrame:
    """Event time from whole seconds."""
    return df.withColumn(name, F.timestamp_seconds(column))


def millis_to_time(df: DataFrame, column: str, name: str = "t") -> DataFrame:
    """Event time from milliseconds."""
    return df.withColumn(name, F.timestamp_millis(column))


def instant(df: DataFrame, name: str) -> DataFrame:
    """A time without zone as an instant, read as UTC (watermarks need instants)."""
    return df.withColumn(name, F.timestamp_micros(as_micros(df, name)))


def wall_time(df: DataFrame, *names: str) -> DataFrame:
    """Instants as times without zone, in UTC."""
    zoned = "convert_timezone(current_timezone(), 'UTC', CAST(`{}` AS timestamp_ntz))"
    return df.withColumns({n: F.expr(zoned.format(n)) for n in names})


def mark_lateness(
    df: DataFrame,
    arrival: Sequence[str],
    time: str,
    disorder_us: int,
    window_us: int,
    lateness_us: int,
    limits=None,
) -> DataFrame:
    """Say for each row whether its tumbling window was still open on arrival.

    Adds ``window_start_us`` and ``status``: ``on_time``, ``update`` (the window
    has fired, and fires again) or ``late`` (beyond the allowed lateness; such
    rows go to the side output). Arrival order is one sequence over the whole
    input; it is cut into slices, so no task reads it all.
    """
    rows = df.withColumn("_t", as_micros(df, time))
    seen = Ordered(rows, [], arrival, limits).running({"_newest": ("max", "_t")}, inclusive=False)
    start = (F.floor(F.col("_t") / window_us) * window_us).cast("bigint")
    end, mark = start + window_us, F.col("_newest") - disorder_us
    status = (
        F.when(F.col("_newest").isNull() | (end > mark), "on_time")
        .when(end + lateness_us > mark, "update")
        .otherwise("late")
    )
    marked = seen.withColumn("window_start_us", start).withColumn("status", status)
    return untag(marked.drop("_t", "_newest"))
