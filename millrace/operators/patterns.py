"""Pattern matching over the ordered events of a key.

Each operator takes an ``Ordered`` sequence and conditions as columns and
returns one row per match. Stages follow each other

* strictly (``next_to``, ``consecutive=True``): no row in between;
* relaxed (``followed_by``, the default inside loops): the next fitting row;
* freely (``followed_by_any``, ``combinations``): any later fitting row.

All matches are kept. Where the number of matches grows with the square of the
rows (open-ended loops, free contiguity) the result is exact but written
compactly: one row per first event with the first and the last event that can
close a match and how many there are. Every row in between that fits closes one
match, so nothing is lost and no pairs are produced.

``within`` is in units of the order column (microseconds for timestamps); the
last event must come less than that after the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequences import Ordered, Run, as_micros

R, T_, EV = "_rank", "_time", "_event"
Condition = Column | str


def _holds(condition: Condition | None) -> Column:
    """A condition as a column that is never null; SQL text is allowed."""
    if condition is None:
        return F.lit(False)
    column = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(column, F.lit(False))


def _event(seq: Ordered, fields: Sequence[str]) -> Column:
    return F.struct(*[F.col(f) for f in fields])


def _unfold(df: DataFrame, column: str, prefix: str, fields: Sequence[str]) -> list[Column]:
    return [F.col(f"{column}.{f}").alias(f"{prefix}_{f}") for f in fields]


def single(seq: Ordered, where: Condition) -> DataFrame:
    """A pattern of one event."""
    return seq.df.where(_holds(where))


def _with_next(seq: Ordered, fields: Sequence[str], then: Condition, position: str | None = None) -> DataFrame:
    """Attach the following row of the key: its fields, time, and whether it fits."""
    rows = seq.df.withColumn(T_, as_micros(seq.df, seq.order[0])).withColumn(
        EV, F.struct(F.col(T_).alias("at"), _holds(then).alias("fits"),
                     _event(seq, fields).alias("row"))
    )
    return seq.over(rows).framed(
        lambda w: {"_next": F.lead(EV).over(w)}, after=1, position=position
    ).drop(EV)


def _in_time(last: Column, first: Column, within: int | None) -> Column:
    return F.lit(True) if within is None else (last - first) < within


def next_to(seq: Ordered, first: Condition, then: Condition, fields: Sequence[str],
            within: int | None = None) -> DataFrame:
    """``first`` and, strictly next, ``then``."""
    rows = _with_next(seq, fields, then).where(_holds(first) & F.col("_next.fits"))
    rows = rows.where(_in_time(F.col("_next.at"), F.col(T_), within))
    return rows.select(
        *seq.keys, *[F.col(f).alias(f"first_{f}") for f in fields],
        *_unfold(rows, "_next.row", "last", fields),
    )


def not_next(seq: Ordered, first: Condition, then: Condition, fields: Sequence[str],
             at_end: bool = True) -> DataFrame:
    """``first`` whose next row is not ``then``.

    At the end of a bounded input nothing follows, which counts as "not next"
    unless ``at_end`` is false.
    """
    rows = _with_next(seq, fields, then).where(_holds(first))
    nothing = F.col("_next").isNull()
    rows = rows.where((nothing & F.lit(at_end)) | ~F.col("_next.fits"))
    return rows.select(*seq.keys, *[F.col(f).alias(f"first_{f}") for f in fields])


def next_or_timeout(seq: Ordered, first: Condition, then: Condition, fields: Sequence[str],
                    within: int) -> DataFrame:
    """``next_to`` with its unfinished matches: ``tag`` is ``match`` or ``timeout``.

    A started match times out once time has moved ``within`` past its start,
    and at the end of the input. A different row strictly next ends it quietly.
    """
    rows = _with_next(seq, fields, then).where(_holds(first))
    open_ended = F.col("_next").isNull() | ~_in_time(F.col("_next.at"), F.col(T_), within)
    tag = F.when(open_ended, "timeout").when(F.col("_next.fits"), "match")
    rows = rows.withColumn("tag", tag).where(F.col("tag").isNotNull())
    matched = F.col("tag") == "match"
    return rows.select(
        *seq.keys, "tag", *[F.col(f).alias(f"first_{f}") for f in fields],
        *[F.when(matched, F.col(f"_next.row.{f}")).alias(f"last_{f}") for f in fields],
    )


def followed_by(seq: Ordered, first: Condition, then: Condition, fields: Sequence[str],
                within: int | None = None) -> DataFrame:
    """``first`` and the next row after it, however far, that is ``then``."""
    rows = seq.df.withColumn(T_, as_micros(seq.df, seq.order[0])).withColumn(
        EV, F.when(_holds(then), F.struct(F.col(T_).alias("at"), _event(seq, fields).alias("row")))
    )
    found = seq.over(rows).running({"_then": ("latest", EV)}, reverse=True, inclusive=False)
    found = found.where(_holds(first) & F.col("_then").isNotNull())
    found = found.where(_in_time(F.col("_then.at"), F.col(T_), within))
    return found.select(
        *seq.keys, *[F.col(f).alias(f"first_{f}") for f in fields],
        *_unfold(found, "_then.row", "last", fields),
    )


def _reached(seq: Ordered, rows: DataFrame, name: str, within: int) -> DataFrame:
    """The last event (its rank leads the struct) less than ``within`` after each row."""
    if not seq.is_cut:
        ahead = Window.partitionBy(*seq.keys).orderBy(T_).rangeBetween(0, within - 1)
        return rows.withColumn(name, F.max(EV).over(ahead))
    return seq.over(rows).as_of(F.col(T_) + (within - 1), {name: ("latest", EV)})


def _closers(seq: Ordered, closes: Condition, fields: Sequence[str], within: int | None) -> DataFrame:
    """For each row the next closing row after it, the last one in reach, and
    how many there are from one to the other."""
    rows = seq.df.withColumn(T_, as_micros(seq.df, seq.order[0]))
    place = F.struct(*[as_micros(seq.df, c) for c in seq.order]) if within is None else F.col(T_)
    event = F.struct(F.col(T_).alias("at"), _event(seq, fields).alias("row"))
    rows = rows.withColumn(EV, F.when(_holds(closes), event)).withColumn("_at_order", place)
    after = {"reverse": True, "inclusive": False}
    wanted = {R: Run("count", EV), "_head": Run("latest", EV, **after)}
    if within is None:
        # Later rows come first in reverse, so the first event is the last one.
        last = F.when(F.col(EV).isNotNull(), F.struct("_at_order", F.col(EV).alias("e")))
        wanted |= {"_tail": Run("max", last, **after), "n_matches": Run("count", EV, **after)}
        rows = seq.over(rows).running(wanted)
        return rows.withColumn("_tail", F.col("_tail.e"))
    rows = seq.over(rows).running(wanted)
    ranked = F.when(F.col(EV).isNotNull(), F.struct(F.col(R).alias("rank"), F.col(EV).alias("e")))
    rows = _reached(seq, rows.withColumn(EV, ranked), "_reach", within)
    return rows.withColumns({"_tail": F.col("_reach.e"), "n_matches": F.col("_reach.rank") - F.col(R)})


def followed_by_any(seq: Ordered, first: Condition, then: Condition, fields: Sequence[str],
                    within: int | None = None) -> DataFrame:
    """``first`` and any later ``then``, compactly: one row per first event.

    ``last_*`` is the nearest closing event, ``final_*`` the farthest, and
    ``n_matches`` counts the closing events from one to the other.
    """
    rows = _closers(seq, then, fields, within).where(_holds(first) & F.col("_head").isNotNull())
    rows = rows.where(_in_time(F.col("_head.at"), F.col(T_), within))
    return rows.select(
        *seq.keys, *[F.col(f).alias(f"first_{f}") for f in fields],
        *_unfold(rows, "_head.row", "last", fields),
        *_unfold(rows, "_tail.row", "final", fields),
        "n_matches",
    )


def combinations(seq: Ordered, where: Condition, fields: Sequence[str],
                 within: int | None = None) -> DataFrame:
    """Two fitting events in any combination (``times(2).allowCombinations()``)."""
    return followed_by_any(seq, where, where, fields, within)


def one_or_more(
    seq: Ordered, where: Condition, fields: Sequence[str], at_least: int = 1,
    until: Condition | None = None, consecutive: bool = False, within: int | None = None,
) -> DataFrame:
    """Loops of ``at_least`` or more fitting events, compactly: a row per start.

    ``last_*`` closes the shortest loop and ``final_*`` the longest; each
    fitting event from one to the other closes one match, ``n_matches`` in all.
    A stop row (``until``) ends the loop and takes no part; with
    ``consecutive`` any row that does not fit ends it.
    """
    stop = _holds(until)
    fits = _holds(where) & ~stop
    rows = seq.df.withColumn(T_, as_micros(seq.df, seq.order[0])).withColumn("_fits", fits)
    rows = rows.withColumn("_breaks", ~F.col("_fits") if consecutive else stop)
    event = F.struct(F.col(T_).alias("at"), _event(seq, fields).alias("row"))
    rows = rows.withColumn(EV, F.when(F.col("_fits"), event))

    # Without a break the loop runs to the key's last fitting row. In reverse,
    # that row is the earliest, and counting on from here gives its rank.
    last = F.struct(*[as_micros(seq.df, c).alias(f"_o{i}") for i, c in enumerate(seq.order)], F.col(EV).alias("e"))
    ends = {
        R: Run("count", EV),
        "_rest": Run("count", EV, reverse=True, inclusive=False),
        "_whole": Run("max", F.when(F.col("_fits"), last), reverse=True),
        "_before": Run("latest", EV),
    }
    rows = seq.over(rows).running(ends)
    whole = F.struct((F.col(R) + F.col("_rest")).alias("rank"), F.col("_whole.e").alias("e"))
    rows = rows.withColumn("_run", whole)
    if until is not None or consecutive:
        # A breaking row knows the rank and the event of the last fitting row
        # before it; the rows ahead of it look it up.
        mark = F.struct(F.col(R).alias("rank"), F.col("_before").alias("e"))
        rows = rows.withColumn("_mark", F.when(F.col("_breaks"), mark))
        rows = seq.settled(rows.drop("_whole", "_before", "_rest")).running(
            {"_end": Run("latest", "_mark", reverse=True)}
        )
        rows = rows.withColumn("_run", F.coalesce("_end", "_run"))
    here = F.struct(F.col(R).alias("rank"), F.col(EV).alias("e"))
    rows = rows.where(F.col("_fits")).withColumn(EV, here)
    rows = rows.select(*seq.df.columns, T_, R, EV, "_run")
    if within is not None:
        rows = _reached(seq, rows, "_near", within)
        near = F.col("_near.rank") < F.col("_run.rank")
        rows = rows.withColumn("_run", F.when(near, F.col("_near")).otherwise(F.col("_run")))
    ahead = at_least - 1
    rows = rows.withColumn("n_matches", F.col("_run.rank") - F.col(R) + 1 - ahead)
    rows = seq.over(rows).framed(
        lambda w: {"_short": F.lead(EV, ahead).over(w)}, after=ahead, position=R
    ) if ahead else rows.withColumn("_short", F.col(EV))
    rows = rows.where(F.col("n_matches") > 0)
    return rows.select(
        *seq.keys, *[F.col(f).alias(f"first_{f}") for f in fields],
        *_unfold(rows, "_short.e.row", "last", fields),
        *_unfold(rows, "_run.e.row", "final", fields),
        "n_matches",
    )


def times(seq: Ordered, where: Condition, ident: str, least: int, most: int | None = None,
          until: Condition | None = None, consecutive: bool = False,
          within: int | None = None) -> DataFrame:
    """Exactly ``least`` to ``most`` fitting events: a row per match.

    ``events`` lists ``ident`` of the matched rows, of which there are at most
    ``most`` per start.
    """
    most = most or least
    loops = _loops(seq, where, ident, most, until, consecutive)
    sizes = F.sequence(F.lit(least), F.lit(most))
    lists = F.transform(
        F.filter(sizes, lambda n: n <= F.size("_loop")), lambda n: F.slice("_loop", 1, n)
    )
    matches = loops.withColumn("_match", F.explode(lists))
    last = F.element_at("_match", -1)
    matches = matches.where(_in_time(last["at"], F.col("_match")[0]["at"], within))
    return matches.select(*seq.keys, F.col("_match.id").alias("events"))


def _loops(seq, where, ident, most, until=None, consecutive=False, then=None) -> DataFrame:
    """From each fitting row, it and up to ``most - 1`` fitting rows after it.

    With ``then``, each of them also says whether the row strictly next to it
    fits that, and names it.
    """
    stop = _holds(until)
    fits = _holds(where) & ~stop
    rows = seq.df.withColumn(T_, as_micros(seq.df, seq.order[0])).withColumn("_fits", fits)
    counted = {R: Run("count", F.when(F.col("_fits"), 1))}
    if until is not None or consecutive:
        breaks = ~F.col("_fits") if consecutive else stop
        counted["_segment"] = Run("count", F.when(breaks, 1))
    if then is not None:
        counted["_place"] = Run("count", F.lit(1))
    rows = seq.over(rows).running(counted)
    item = [F.col(ident).alias("id"), F.col(T_).alias("at"),
            (F.col("_segment") if "_segment" in counted else F.lit(0)).alias("segment")]
    if then is not None:
        rows = rows.withColumn("_closes", F.struct(_holds(then).alias("fits"), F.col(ident).alias("id")))
        rows = seq.over(rows).framed(
            lambda w: {"_next": F.lead("_closes").over(w)}, after=1, position="_place"
        )
        item += [F.col("_next.fits").alias("fits"), F.col("_next.id").alias("next")]
    rows = rows.where(F.col("_fits")).withColumn(EV, F.struct(*item))
    ahead = seq.over(rows).framed(
        lambda w: {"_ahead": F.collect_list(EV).over(w.rowsBetween(0, most - 1))},
        after=most - 1, position=R,
    )
    return ahead.withColumn(
        "_loop", F.filter("_ahead", lambda e: e["segment"] == F.col(f"{EV}.segment"))
    ).drop("_ahead")


def loop_then_next(
    seq: Ordered, loop: Condition, least: int, most: int, then: Condition, ident: str,
    greedy: bool = False, optional: bool = False,
) -> DataFrame:
    """A loop of ``least`` to ``most`` events and, strictly after its last, ``then``.

    ``greedy`` keeps only the longest loop from each start that completes;
    ``optional`` also matches ``then`` with no loop before it. ``events`` lists
    the loop, ``then_id`` the closing row.
    """
    loops = _loops(seq, loop, ident, most, then=then)
    sizes = F.filter(
        F.sequence(F.lit(least), F.lit(most)),
        lambda n: (n <= F.size("_loop")) & F.coalesce(F.get("_loop", n - 1)["fits"], F.lit(False)),
    )
    if greedy:
        sizes = F.slice(F.reverse(sizes), 1, 1)
    matches = loops.withColumn("_n", F.explode(sizes))
    matched = F.slice("_loop", 1, F.col("_n"))
    result = matches.select(
        *seq.keys, F.transform(matched, lambda e: e["id"]).alias("events"),
        F.element_at(matched, -1)["next"].alias("then_id"),
    )
    if optional:
        kind = result.schema["events"].dataType.simpleString()
        alone = seq.df.where(_holds(then)).select(
            *seq.keys, F.array().cast(kind).alias("events"), F.col(ident).alias("then_id")
        )
        result = result.unionByName(alone)
    return result


def group_times(seq: Ordered, first: Condition, then: Condition, ident: str, count: int) -> DataFrame:
    """The pair ``first`` strictly next ``then``, ``count`` times in relaxed order.

    ``starts`` and ``nexts`` list the rows of the pairs; pairs do not overlap.
    """
    placed = seq.over(seq.positions("_place"))
    pairs = _with_next(placed, [ident], then, "_place").where(_holds(first) & F.col("_next.fits"))
    pairs = pairs.withColumn(
        EV, F.struct(F.col("_place").alias("at"), F.col(ident).alias("start"),
                     F.col(f"_next.row.{ident}").alias("next"))
    )
    reach = 2 * (count - 1)  # an overlapping pair can stand before each usable one
    ahead = seq.settled(pairs).framed(
        lambda w: {"_ahead": F.collect_list(EV).over(w.rowsBetween(0, reach))}, after=reach
    )
    kind = ahead.schema["_ahead"].dataType.simpleString()
    chain = F.aggregate(
        "_ahead", F.array().cast(kind),
        lambda got, e: F.when(
            (F.size(got) == 0)
            | ((F.size(got) < count) & (e["at"] > F.element_at(got, -1)["at"] + 1)),
            F.concat(got, F.array(e)),
        ).otherwise(got),
    )
    full = ahead.withColumn("_chain", chain).where(F.size("_chain") == count)
    return full.select(
        *seq.keys, F.col("_chain.start").alias("starts"), F.col("_chain.next").alias("nexts")
    )
