"""Grouped and running aggregates, alarms and changelogs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .sequences import Limits, Ordered, Run, as_micros, untag


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("n"))


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def running_total(df, keys, order, value: str, name: str = "total", limits=None):
    """The total of each key after each row."""
    return untag(Ordered(df, keys, order, limits).running({name: ("sum", value)}))


def running_average(df, keys, order, value: str, name: str = "average", limits=None):
    """The average of each key after each row, from its sum and count."""
    seen = Ordered(df, keys, order, limits).running(
        {"_sum": ("sum", F.col(value).cast("double")), "_n": ("count", value)}
    )
    average = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n"))
    return untag(seen.withColumn(name, average).drop("_sum", "_n"))


def rolling_max(df, keys, order, value: str, carried: Sequence[str], limits=None):
    """The running maximum, with the other fields of the key's first row."""
    first = F.struct(*carried)
    seen = Ordered(df, keys, order, limits).running(
        {f"max_{value}": ("max", value), "_first": ("first", first)}
    )
    return untag(seen.withColumns({f"first_{c}": F.col(f"_first.{c}") for c in carried}).drop("_first"))


def max_row(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
            columns: Sequence[str], last: bool = False) -> DataFrame:
    """The whole row of the maximum; on ties the first row, or the last.

    A rank on the columns themselves, of any orderable type. Spark keeps one row
    per key and task ahead of the shuffle (WindowGroupLimit), so a very large key
    stays cheap.
    """
    ties = [F.desc(c) if last else F.asc(c) for c in order]
    best = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(value), *ties)
    top = df.withColumn("_nth", F.row_number().over(best)).where("_nth = 1")
    return top.select(*keys, *[c for c in columns if c not in keys])


def reduce_running(df, keys, order, value: str, carried: Sequence[str], limits=None):
    """A running reduce that sums ``value`` and keeps the first row's fields."""
    seen = Ordered(df, keys, order, limits).running(
        {f"sum_{value}": ("sum", value), "_first": ("first", F.struct(*carried))}
    )
    return untag(seen.withColumns({f"first_{c}": F.col(f"_first.{c}") for c in carried}).drop("_first"))


def distinct_running(df, member: str, order: Sequence[str], name: str = "uv", limits=None):
    """How many different ``member`` values the whole input held after each row.

    A marker goes in just ahead of each member's first row, and markers are
    counted along the whole input. The first rows come from a plain aggregate,
    so a member that repeats very often needs no care.
    """
    rows = df.withColumn("_side", F.lit(1)).withColumn("_marker", F.lit(None).cast("int"))
    first = df.where(F.col(member).isNotNull()).groupBy(member).agg(F.min(F.struct(*order)).alias("_first"))
    markers = first.select("_first.*", F.lit(0).alias("_side"), F.lit(1).alias("_marker"))
    marked = rows.unionByName(markers, allowMissingColumns=True)
    counted = Ordered(marked, [], [*order, "_side"], limits).running({name: Run("count", "_marker")})
    return untag(counted.where(F.col("_side") == 1).drop("_side", "_marker"))


def retract_changelog(df, keys, order, value: str, limits=None) -> DataFrame:
    """Each change of the per-key sum: the old result taken back, the new added."""
    amount = F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType))
    # What is taken back is the total as it was sent, not one reckoned backwards.
    seen = Ordered(df, keys, order, limits).running(
        {"_new": Run("sum", amount), "_old": Run("sum", amount, inclusive=False), "_nth": Run("count", F.lit(1))}
    )
    added = F.struct(F.lit("+").alias("op"), F.col("_new").alias("total"))
    retracted = F.struct(F.lit("-").alias("op"), F.col("_old").alias("total"))
    changes = F.when(F.col("_nth") == 1, F.array(added)).otherwise(F.array(retracted, added))
    return seen.withColumn("_change", F.explode(changes)).select(*df.columns, "_change.*")


def first_seen(df, keys, value: str, order, carried: Sequence[str], limits=None) -> DataFrame:
    """For every row, the first row of its key that had the same value."""
    seen = Ordered(df, [*keys, value], order, limits).running(
        {"_first": ("first", F.struct(*carried))}
    )
    return untag(seen.withColumns({f"first_{c}": F.col(f"_first.{c}") for c in carried}).drop("_first"))


def drop_repeats(df, keys, value: str, order, columns: Sequence[str]) -> DataFrame:
    """One row per key and value: the first that arrived."""
    first = df.groupBy(*keys, value).agg(
        F.min_by(F.struct(*columns), F.struct(*order)).alias("_row")
    )
    return first.select(*keys, value, "_row.*")


def jump_alarm(df, keys, order, value: str, over: float, limits=None) -> DataFrame:
    """Rows that differ from the key's previous row by more than ``over``."""
    with_last = Ordered(df, keys, order, limits).framed(
        lambda w: {"previous": F.lag(value).over(w)}, before=1
    )
    return untag(with_last.where(F.abs(F.col(value) - F.col("previous")) > over))


def rising_alarm(df, keys, order, value: str, hold_us: int, limits=None) -> DataFrame:
    """Alarms for values that keep rising for ``hold_us`` microseconds (above 0).

    A rising row starts a timer if none runs; a row that does not rise, at or
    before the deadline, cancels it. After an alarm the next rising row starts
    a new one. The first row of a key counts as rising. Returns the keys, the
    run's number and ``alarm_at`` in microseconds.
    """
    seq = Ordered(df, keys, order, limits)
    rows = seq.framed(lambda w: {"_last": F.lag(value).over(w)}, before=1)
    time = as_micros(df, order[0])
    rows = rows.withColumn("_t", time).withColumn(
        "_falls", F.when(F.col("_last").isNotNull() & ~(F.col(value) > F.col("_last")), F.col("_t"))
    )
    rows = seq.settled(rows).running(
        {"run": Run("count", "_falls"), "_ends": Run("latest", "_falls", reverse=True)}
    )
    rising = rows.where(F.col("_falls").isNull())
    # A timer that the run's end would cancel never fires, and neither does a
    # later one of that run, so those rows can go before the shuffle.
    fires = rising.where(F.col("_ends").isNull() | (F.col("_t") + hold_us < F.col("_ends")))
    if seq.is_cut:
        return _alarms_by_doubling(untag(fires.select(*keys, "run", "_t")).distinct(), [*keys, "run"], hold_us, seq.limits)
    # A run is scanned batch by batch in constant memory.
    laid_out = (
        fires.select(*keys, "run", "_t")
        .repartition(*keys, "run")
        .sortWithinPartitions(*keys, "run", "_t")
    )
    group = [*keys, "run"]
    fields = [laid_out.schema[c] for c in group]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_run, deadline = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n, names = batch.num_rows, batch.select(group)
            # Neighbours are compared in their own types: keys of any size stay exact.
            change = np.zeros(n, bool)
            change[0] = True
            for column in names.columns:
                a, b = column.slice(1), column.slice(0, n - 1)
                differ = pc.fill_null(pc.not_equal(a, b), False)
                nulls = pc.xor(pc.is_null(a), pc.is_null(b))
                change[1:] |= np.asarray(pc.or_(differ, nulls))
            starts = np.flatnonzero(change)
            times, firing = np.asarray(batch.column("_t")), []
            first = names.slice(0, 1).to_pylist()[0]
            for lo, hi in zip(starts, [*starts[1:], n]):
                at = lo
                if lo == 0 and first == open_run:
                    at += int(np.searchsorted(times[lo:hi], deadline, side="right"))
                while at < hi:
                    firing.append(at)
                    deadline = int(times[at]) + hold_us
                    at += int(np.searchsorted(times[at:hi], deadline, side="right"))
            open_run = names.slice(n - 1, 1).to_pylist()[0]
            fired = pa.array(firing, pa.int64())
            yield names.take(fired).append_column("alarm_at", pa.array(times[firing] + hold_us, pa.int64()))

    return laid_out.mapInArrow(scan, f"{schema}, alarm_at bigint")


def _alarms_by_doubling(times: DataFrame, group: list[str], hold_us: int, limits: Limits) -> DataFrame:
    """The alarms of runs of any length, spread over the cluster.

    Each row leads to the first row after its deadline; the rows that fire are
    those on the path from a run's first row. In each round the rows known to
    be on it show the row as many steps ahead as rounds have doubled, and the
    steps are joined with themselves, so a path of n alarms takes log2(n) rounds.
    """
    seq = Ordered(times, group, ["_t"], limits)
    ahead = settle(seq.as_of(F.col("_t") + hold_us, {"_next": ("min", F.col("_t"))}, inclusive=False, reverse=True))
    fired = settle(times.groupBy(*group).agg(F.min("_t").alias("_t")))
    step = ahead.where("_next is not null")

    def follow(rows: DataFrame, time: str) -> DataFrame:
        """Rows with ``_far``, where their ``time`` leads to; the others go."""
        to = step.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col("_t").alias("_of_t"), F.col("_next").alias("_far"))
        on = [F.col(time) == F.col("_of_t"), *(F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group)]
        return rows.join(to, reduce(and_, on)).drop("_of_t", *[f"_of_{c}" for c in group])

    while True:
        more = settle(follow(fired, "_t").select(*group, F.col("_far").alias("_t")))
        if more.isEmpty():
            return fired.select(*group, (F.col("_t") + hold_us).alias("alarm_at"))
        fired = fired.unionByName(more)
        step = settle(follow(step, "_next").select(*group, "_t", F.col("_far").alias("_next")))


def event_timers(df, keys, time: str, delay: str) -> DataFrame:
    """The timers set by every row at its own time plus ``delay``.

    Two rows of a key with one time share a timer, and on a bounded input every
    timer fires.
    """
    return df.select(*keys, (F.col(time) + F.expr(f"INTERVAL {delay}")).alias("fired_at")).distinct()
