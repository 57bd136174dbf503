"""Mix sources to target sizes along a curriculum, with DataFrame functions only.

Each source has a share of the words to train on and a schedule, the relative
rate at which it is wanted from the start (time 0) to the end (time 1) of the
training. The integral of its schedule is its cumulative demand; a document that
begins after ``c`` words of its source's order is wanted at the time at which
the demand reaches ``c``. Sorting all documents by that time gives the order of
training in which each source follows its schedule.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .text import WORD

# Relative rates at evenly spaced times, straight lines between: falling, rising, level.
RATES = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (1.0, 1.0))


def words_in(text: Column | str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(totals: DataFrame, weights: Sequence[float] = (3, 1, 2), factor: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words to take of each source, from one row (source, source_size) per source.

    All sources together get ``factor`` times all words, by weight (dealt in
    turn to the sources in code point order, null last), none over ``most``
    times its own; what is over is shared again by weight until nothing is.
    That level is the highest of those reached by filling the sources in order
    of how soon they are full.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = totals.select("source", "source_size", place.alias("place"), weight.alias("weight"))
    rows = rows.withColumn("full", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("full") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(factor)) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / open_weight)
    level = F.max("level").over(everything)
    return rows.select("source", "source_size", "place", F.least("full", F.col("weight") * level).alias("target"))


def when_wanted(share: Column, kind: Column, rates: Sequence[Sequence[float]] = RATES) -> Column:
    """The time at which a source of this kind has given ``share`` (0 to 1) of its words."""
    out = F.lit(None).cast("double")
    for number, knots in enumerate(rates):
        step = 1 / (len(knots) - 1)
        reached = [0.0]
        for a, b in zip(knots, knots[1:]):
            reached.append(reached[-1] + (a + b) / 2 * step)
        wanted = share * reached[-1]
        time = F.lit(1.0)
        for k in reversed(range(len(knots) - 1)):
            over, a, b = wanted - reached[k], knots[k], knots[k + 1]
            # Area under the line from a towards b, solved for the time.
            root = F.sqrt(F.greatest(F.lit(a * a) + over * (2 * (b - a) / step), F.lit(0.0)))
            time = F.when(wanted < reached[k + 1], k * step + 2 * over / (a + root)).otherwise(time)
        out = F.when(kind % len(rates) == number, time).otherwise(out)
    return out


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, digits: int = 3,
        weights: Sequence[float] = (3, 1, 2), factor: float = 1.5, most: float = 2.0, carry: Sequence[str] = ()) -> DataFrame:
    """What the mix takes of each document, and when.

    A source's documents stand in the order of a hash of their id and seed, as
    often after one another as the target needs; a document is taken each time
    its middle word lies before the target, so a source misses its target by
    half a document at most. Returns doc_id, size, source, source_size, target,
    taken, positions (times of training, ascending; empty if not taken) and the
    columns ``carry`` (of other names than these).

    A null or empty text has size 0 and is never taken; a null source is a
    source; a null id is an id of its own; repeated rows are taken one by one;
    other columns are not read; an empty table gives an empty result.
    """
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    own = [F.col(c).alias(f"_carried_{k}") for k, c in enumerate(carry)]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), words_in(text).alias("size"),
                       key.alias("_key"), *own)
    # A source may be a third of everything: it is cut into slices of the hash.
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).withColumn("_slice", F.substring("_key", 1, digits))
    narrow = settle(rows.select("doc_id", "source", "size", "_key", "_source", "_slice"))
    rows = rows if carry else narrow
    slices = narrow.groupBy("_source", "_slice").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    totals = slices.groupBy("_source").agg(F.sum("n").alias("source_size"))
    totals = totals.withColumn("source", F.when(F.col("_source") != "", F.expr("substring(_source, 2)")))
    aims = targets(totals, weights, factor, most).withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    begins = slices.join(aims.drop("source"), "_source").drop("n")
    found = rows.join(begins, ["_source", "_slice"])
    inside = Window.partitionBy("_source", "_slice").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2
    found = found.withColumn("_middle", middle)
    passes = [F.col("_middle") + F.col("source_size") * k for k in range(math.ceil(most))]
    times = F.array(*[F.when((F.col("size") > 0) & (p < F.col("target")), when_wanted(p / F.col("target"), F.col("place"))) for p in passes])
    found = found.withColumn("positions", F.array_compact(times))
    carried = [F.col(f"_carried_{k}").alias(c) for k, c in enumerate(carry) if c not in ("doc_id", "source")]
    return found.select("doc_id", "size", "source", "source_size", "target", (F.col("size") * F.size("positions")).alias("taken"),
                        "positions", *carried)


def by_position(mixed: DataFrame) -> DataFrame:
    """The mix sorted by when a document is first wanted; what is not taken comes last."""
    rest = F.lit(2.0) + F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)  # spread, as it may be most rows
    return mixed.withColumn("_at", F.coalesce(F.try_element_at("positions", F.lit(1)), rest)).repartitionByRange("_at").sortWithinPartitions("_at").drop("_at")


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row for each time a document is taken, sorted by ``position``."""
    taken = mixed.select("*", F.explode("positions").alias("position")).drop("positions")
    return taken.repartitionByRange("position").sortWithinPartitions("position")
