"""Ordered sequences per key that stay parallel when one key is very large.

``Window.partitionBy(key)`` sends all rows of a key to one task. That is the
right plan for keys of ordinary size, and it is what runs when no key is large.
When a key is too large for a task (or there is no key at all) the rows are laid
out once by ranges of key and order, in files whose part is kept as the *slice*
of a row. A slice is a stretch of the sequence of one or more keys, of about
``rows_per_task`` rows at most, whatever the types of the order columns and
however many rows share an instant. All later steps read that layout:

* running aggregates run inside a slice and get the totals of the key's earlier
  slices. Only one key can reach into a slice from before, so that is at most
  one row per slice;
* frames of a bounded number of rows get copies of the few rows just outside
  blocks of a fixed number of rows;
* "as of" look-ups at another time are rows of their own in the sequence, so
  they too are running aggregates.

Nothing is collected but the number of rows in all and in the largest key, and
no join is forced: the small sides are DataFrames for Spark to plan. Make one
``Ordered`` and go on with ``over`` for derived frames, which keep the slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle

SLICE, BLOCK, AT, HOME, POS = "_slice", "_block", "_at", "_home", "_pos"


@dataclass(frozen=True)
class Limits:
    """How much of one key a single task may hold."""

    rows_per_task: int = 4_000_000

    @staticmethod
    def of(df: DataFrame) -> "Limits":
        conf = df.sparkSession.conf
        rows = conf.get("spark.millrace.rowsPerTask", None)
        return Limits(rows_per_task=int(rows)) if rows else Limits()


@dataclass(frozen=True)
class Run:
    """A running aggregate.

    Kinds are ``sum``, ``count``, ``max``, ``min``, ``first`` and ``latest`` (the
    last value that is not null). ``reverse`` runs from the end; without
    ``inclusive`` the current row is left out.
    """

    kind: str
    column: Column | str
    reverse: bool = False
    inclusive: bool = True

    @property
    def value(self) -> Column:
        return F.col(self.column) if isinstance(self.column, str) else self.column

    def local(self) -> Column:
        """Within one key, or one slice of it."""
        if self.kind == "latest":
            return F.last(self.value, ignorenulls=True)
        plain = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "first": F.first}
        return plain[self.kind](self.value)

    def total(self, order: Sequence[str]) -> Column:
        """A whole slice in one value."""
        place = F.struct(*order)
        head, tail = (F.max_by, F.min_by) if self.reverse else (F.min_by, F.max_by)
        if self.kind == "first":
            return head(F.struct(self.value.alias("v")), place)
        if self.kind == "latest":
            return tail(F.struct(self.value.alias("v")), F.when(self.value.isNotNull(), place))
        return self.local()

    def carried(self, name: str) -> Column:
        """The totals of the slices on the way to this one."""
        if self.kind in ("sum", "count"):
            return F.sum(name)
        if self.kind in ("max", "min"):
            return F.max(name) if self.kind == "max" else F.min(name)
        return (F.first if self.kind == "first" else F.last)(name, ignorenulls=True)

    def combine(self, name: str) -> Column:
        here, carry = F.col(name), F.col(f"_carry_{name}")
        if self.kind == "count":
            return here + F.coalesce(carry, F.lit(0))
        if self.kind == "sum":
            return F.when(carry.isNull(), here).when(here.isNull(), carry).otherwise(here + carry)
        if self.kind in ("max", "min"):
            return F.greatest(here, carry) if self.kind == "max" else F.least(here, carry)
        if self.kind == "first":
            return F.when(carry.isNotNull(), carry["v"]).otherwise(here)
        return F.coalesce(here, carry["v"])


def as_micros(df: DataFrame, name: str) -> Column:
    """A time as a whole number: microseconds, days for dates, or the number itself."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(
            f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', `{name}`)"
        )
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint")
    return F.col(name).cast("bigint")


def exact_time(df: DataFrame, name: str) -> Column:
    """A time as a number to reckon with: microseconds or days, or the number itself, fractions kept."""
    kind = df.schema[name].dataType
    return F.col(name) if isinstance(kind, T.NumericType) else as_micros(df, name)


def floor_div(number: Column, by: Column | int) -> Column:
    """Whole-number division rounding down, without the rounding of doubles."""
    by = F.lit(by) if isinstance(by, int) else by
    return ((number - F.pmod(number, by)) / by).cast("bigint")


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


class Ordered:
    """The rows of ``df`` per ``keys``, in the order of the ``order`` columns.

    ``order`` names ascending columns of any orderable type; the first is a time
    or a number, the rest break ties. Empty ``keys`` means one sequence over the
    whole table. Rows that are equal in key, order and all other columns cannot
    be told apart and stay in one slice.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], limits: Limits | None = None):
        self.df, self.keys, self.order = df, list(keys), list(order)
        self.limits = limits or Limits.of(df)
        parts = self._parts()
        self.is_cut = parts > 0
        if self.is_cut:
            self.df = self._laid_out(parts)

    def over(self, df: DataFrame) -> "Ordered":
        """The same key and order over a derived frame, without a new count."""
        seq = Ordered.whole(df, self.keys, self.order)
        seq.limits, seq.is_cut = self.limits, self.is_cut
        return seq

    @classmethod
    def whole(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> "Ordered":
        """Sequences whose keys are known to be of ordinary size: no count, no cuts."""
        seq = cls.__new__(cls)
        seq.df, seq.keys, seq.order = df, list(keys), list(order)
        seq.limits, seq.is_cut = Limits(), False
        return seq

    # -- the layout ----------------------------------------------------------

    def _parts(self) -> int:
        """How many slices the rows need: none if no key is large."""
        most = self.limits.rows_per_task
        sizes = self.df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
        largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
        if not total or (self.keys and largest <= most):
            return 0
        least = 2 if self.keys else self.df.sparkSession.sparkContext.defaultParallelism
        # Ranges come from a sample, so they are asked for half as large.
        return max(least, -(-2 * total // most))

    def _laid_out(self, parts: int) -> DataFrame:
        """The rows by ranges of key and order, with their slice, written down."""
        plain = [f.name for f in self.df.schema if not _holds_map(f.dataType)]
        tie = F.xxhash64(*plain)  # splits rows of equal order; the same if a task runs again
        ranged = self.df.repartitionByRange(parts, *self.keys, *self.order, tie)
        return settle(ranged.withColumn(SLICE, F.spark_partition_id()))

    def _asc(self, names: Sequence[str], reverse: bool) -> list[Column]:
        return [F.desc(n) if reverse else F.asc(n) for n in names]

    # -- running aggregates -------------------------------------------------

    def running(
        self,
        columns: dict[str, Run | tuple[str, Column | str]],
        reverse: bool = False,
        inclusive: bool = True,
        ties: bool = False,
    ) -> DataFrame:
        """Add aggregates over all rows of the key up to the current one.

        ``columns`` maps a new name to a ``Run``, or to ``(kind, column)`` for
        one that takes ``reverse`` and ``inclusive`` from here. Ask for columns
        that do not need each other in one call: a cut sequence reads its input
        twice per call. ``ties`` counts rows of equal time together. Sums of
        doubles depend on how a sequence is cut, in their last digits; sums of
        whole numbers and decimals do not.
        """
        runs = {
            name: r if isinstance(r, Run) else Run(r[0], r[1], reverse, inclusive)
            for name, r in columns.items()
        }
        if not self.is_cut:
            return self.df.withColumns(self._local(runs, self.keys, ties))
        rows = self.df
        for back in (False, True):
            some = {n: r for n, r in runs.items() if r.reverse == back}
            if some:
                rows = self._bring(rows, self._carries(some, back))
        rows = rows.withColumns(self._local(runs, [SLICE, *self.keys], ties))
        rows = rows.withColumns({n: r.combine(n) for n, r in runs.items()}).select(*self.df.columns, *runs)
        return self._level(rows, list(runs), reverse) if ties else rows

    def _local(self, runs: dict[str, Run], by: Sequence[str], ties: bool) -> dict[str, Column]:
        return {
            n: r.local().over(self._window(by, r.reverse, r.inclusive, ties)) for n, r in runs.items()
        }

    def _window(self, by, reverse, inclusive, ties) -> WindowSpec:
        order = self.order[:1] if ties else self.order
        window = Window.partitionBy(*by).orderBy(*self._asc(order, reverse))
        if ties:
            return window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return window.rowsBetween(
            Window.unboundedPreceding, Window.currentRow if inclusive else -1
        )

    def _slices(self, reverse: bool = False) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self._asc([SLICE], reverse))

    def _carries(self, runs: dict[str, Run], reverse: bool) -> DataFrame:
        """What reaches into a slice from the key's slices on the way to it."""
        totals = self.df.groupBy(*self.keys, SLICE).agg(*[r.total(self.order).alias(n) for n, r in runs.items()])
        others = self._slices(reverse).rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(
            *self.keys, SLICE, F.row_number().over(self._slices(reverse)).alias("_nth"),
            *[r.carried(n).over(others).alias(f"_carry_{n}") for n, r in runs.items()],
        )
        return carry.where("_nth > 1").drop("_nth")

    def _bring(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        """Join per-slice values of at most one key per slice back to its rows."""
        renamed = carry.withColumnsRenamed({c: f"_of_{c}" for c in [*self.keys, SLICE]})
        on = [F.col(SLICE) == F.col(f"_of_{SLICE}")]
        on += [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in self.keys]
        return rows.join(renamed, _all(on), "left").drop(*[f"_of_{c}" for c in [*self.keys, SLICE]])

    def _level(self, rows: DataFrame, names: list[str], reverse: bool) -> DataFrame:
        """Give rows of equal time the value of the last of them, where a cut parts them."""
        time = self.order[0]
        # Rows without a time come first, so a slice that has one begins with it.
        begin = F.when(F.count(time) == F.count(F.lit(1)), F.min(time))
        ends = self.df.groupBy(*self.keys, SLICE).agg(begin.alias("_from"), F.max(time).alias("_to"))
        ends = ends.select(*self.keys, F.col("_to").alias(time), F.lead("_from").over(self._slices()).alias("_next"),
                           F.lead(F.lit(1)).over(self._slices()).alias("_more"))
        parted = ends.where(F.col("_more").isNotNull() & F.col(time).eqNullSafe(F.col("_next"))).select(*self.keys, time).distinct()
        named = [*self.keys, time]
        parted = parted.withColumnsRenamed({c: f"_of_{c}" for c in named})
        on = _all([F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in named])
        pick = F.min_by if reverse else F.max_by
        last = rows.join(parted, on, "left_semi").groupBy(*named).agg(pick(F.struct(*names), SLICE).alias("_all"))
        last = last.withColumnsRenamed({c: f"_of_{c}" for c in named})
        joined = rows.join(last, on, "left")
        return joined.select(*self.df.columns, *[F.when(F.col("_all").isNotNull(), F.col("_all")[n]).otherwise(F.col(n)).alias(n) for n in names])

    def positions(self, name: str = POS) -> DataFrame:
        """Add the 1-based place of each row within its key."""
        return self.running({name: Run("count", F.lit(1))})

    def settled(self, df: DataFrame) -> "Ordered":
        """The sequence over a derived frame that is worth writing down first.

        Each step over a cut sequence reads its input twice, so steps that
        build on each other would read it four times, eight times and so on.
        """
        return self.over(settle(df) if self.is_cut else df)

    # -- other times ----------------------------------------------------------

    def as_of(self, time: Column, columns: dict[str, tuple[str, Column | str]], inclusive: bool = True, reverse: bool = False,
              place: dict[str, Column] | None = None, limits: Limits | None = None) -> DataFrame:
        """Add running aggregates of the key as they stood at another ``time``.

        ``time`` is in the units of the order column (``exact_time``);
        ``inclusive`` counts rows of just that time. ``reverse`` runs from the
        key's end down to that time. ``place`` asks under other values of some
        key columns. Every row enters the sequence twice, as itself and as a
        question at that time, so neither bursts nor long distances gather rows
        in a task. Where ``time`` is null the aggregates are null (counts 0).
        The result is not cut.
        """
        plain = self.df.drop(SLICE)
        own = exact_time(plain, self.order[0])
        kept = {f"_own{k}": c for k, c in enumerate(place or {})}
        side = 1 if inclusive != reverse else -1
        ask = plain.withColumns({"_when": time, "_side": F.lit(side), **{n: F.col(c) for n, c in kept.items()}}).withColumns(place or {})
        both = plain.withColumns({"_when": own, "_side": F.lit(0), **{n: F.col(c) for n, c in kept.items()}}).unionByName(ask)
        seq = Ordered(both, self.keys, ["_when", "_side", *self.order], limits or self.limits)
        # A question without a time comes before all rows that have one.
        event = (F.col("_side") == 0) & F.col("_when").isNotNull() if reverse else F.col("_side") == 0
        runs = {n: (k, F.when(event, F.col(c) if isinstance(c, str) else c)) for n, (k, c) in columns.items()}
        asked = untag(seq.running(runs, reverse=reverse).where(F.col("_side") != 0))
        if reverse:
            known = F.col("_when").isNotNull()
            asked = asked.withColumns({n: F.when(known, F.col(n)).otherwise(F.lit(0) if k == "count" else F.lit(None)) for n, (k, _) in columns.items()})
        return asked.withColumns({c: F.col(n) for n, c in kept.items()}).drop("_when", "_side", *kept)

    # -- bounded frames -----------------------------------------------------

    def framed(
        self,
        columns: Callable[[WindowSpec], dict[str, Column]],
        before: int = 0,
        after: int = 0,
        position: str | None = None,
    ) -> DataFrame:
        """Add window columns that look at most ``before``/``after`` rows away.

        ``position`` names a column that already numbers the key's rows.
        """
        if not self.is_cut:
            return self.df.withColumns(columns(Window.partitionBy(*self.keys).orderBy(*self.order)))
        size = max(self.limits.rows_per_task, before + after, 1)
        rows = self.df if position else self.positions()
        place = F.col(position or POS)

        def block(pos: Column) -> Column:
            return floor_div(pos, size)

        blocks = F.array_distinct(F.array(block(place), block(place + before), block(place - after)))
        copies = rows.withColumn(HOME, block(place)).withColumn(BLOCK, F.explode(blocks))
        added = columns(Window.partitionBy(*self.keys, BLOCK).orderBy(*self.order))
        return copies.withColumns(added).where(F.col(HOME) == F.col(BLOCK)).select(*self.df.columns, *added)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType)) or (isinstance(kind, T.ArrayType) and _holds_map(kind.elementType))


def untag(df: DataFrame) -> DataFrame:
    """Drop the helper columns of ``Ordered``."""
    return df.drop(SLICE, BLOCK, AT, HOME, POS)
