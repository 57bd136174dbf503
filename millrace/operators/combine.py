"""Operators over two or more inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import Limits, Ordered, untag


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of inputs of one type, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def connect(
    left: DataFrame,
    right: DataFrame,
    map_left: dict[str, Column],
    map_right: dict[str, Column],
) -> DataFrame:
    """Two types, one function per side, one output type."""
    return left.select(*[c.alias(n) for n, c in map_left.items()]).unionByName(
        right.select(*[c.alias(n) for n, c in map_right.items()])
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_order: Sequence[str],
    right_order: Sequence[str],
    limits: Limits | None = None,
) -> DataFrame:
    """Pair the n-th row of a key on one side with its n-th row on the other.

    A match uses up both rows, so a key repeated on either side never
    multiplies. Rows without a key cannot match. Joining on (key, place) also
    spreads a key that repeats very often.
    """
    l_rows = left.where(F.col(key).isNotNull())
    r_rows = right.where(F.col(key).isNotNull())
    l_at = Ordered(l_rows, [key], left_order, limits).positions("_nth")
    r_at = Ordered(r_rows, [key], right_order, limits).positions("_nth")
    return untag(l_at).join(untag(r_at), [key, "_nth"], "inner").drop("_nth")


def apply_rules(
    df: DataFrame, rules: DataFrame, on: str | Sequence[str], default: dict[str, object]
) -> DataFrame:
    """Look up a rule for each row; rows without one get the defaults."""
    joined = df.join(rules, on, "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in default.items()}
    )


def control_as_of(
    data: DataFrame,
    control: DataFrame,
    time: str,
    ident: str,
    value: str,
    limits: Limits | None = None,
) -> DataFrame:
    """Give each data row the newest control value at or before its time.

    ``control`` has the columns ``time``, ``ident`` and ``value``; its rows come
    before data rows of the same time. One sequence over both inputs, cut into
    time slices, so no single task reads it all.
    """
    side, place = "_side", "_control"
    rows = data.withColumn(place, F.lit(None).cast(control.schema[value].dataType))
    rows = rows.withColumn(side, F.lit(1)).unionByName(
        control.select(time, ident, F.col(value).alias(place)).withColumn(side, F.lit(0)),
        allowMissingColumns=True,
    )
    seen = Ordered(rows, [], [time, side, ident], limits).running(
        {value: ("latest", place)}
    )
    return untag(seen.where(F.col(side) == 1).drop(side, place))
