"""Recurring line templates across documents, by a log-template tree.

Lines are parsed to a fixed depth: the number of tokens, then the leading
tokens, variable fields (tokens with a digit) standing for any. In a leaf, a
token is constant at its place if enough distinct texts have it there; all other
places are variable fields. Lines of one template agree in their constants.
Templates that come up in enough distinct texts that are no near copies of each
other, and are constant for the most part, are boilerplate: their lines are
dropped.

Both steps are counts per leaf and place, so no leaf is held by one task, and
no result depends on the order of the lines. Only lines in leaves of enough
texts are looked at token by token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from . import alike
from .text import buffer_of, mix, pieces, words_of

_TEXT = ["c1", "c2"]
_TEMPLATE = ["leaf", "t1", "t2"]


class _Lines:
    """Tokens and lines of a batch: leaf, number of tokens and number in its text of each line with tokens."""

    def __init__(self, column: pa.Array, depth: int):
        raw, at = buffer_of(column)
        self.words = words_of(raw, at, lower=False)
        starts = self.words.starts
        tokens = self.words.hashes.copy()
        digits = np.flatnonzero((raw - np.uint8(48)) < 10)
        tokens[np.searchsorted(starts, digits, "right") - 1] = 0  # variable fields
        self.tokens = tokens
        # A line begins at the first word of a text or after a line feed.
        feeds = np.flatnonzero(raw == 10)
        first = np.unique(np.concatenate([self.words.first[:-1], np.searchsorted(starts, feeds)]))
        self.first = first[first < len(starts)]
        self.size = np.diff(np.append(self.first, len(starts)))
        self.row = np.searchsorted(at, starts[self.first], "right") - 1
        self.number = np.searchsorted(feeds, starts[self.first]) - np.searchsorted(feeds, at[self.row])
        leaf = mix(self.size.astype(np.uint64))
        for k in range(depth):
            here = np.minimum(self.first + k, max(len(tokens) - 1, 0))
            leaf = np.where(k < self.size, mix(leaf * np.uint64(0x100000001B3) + (tokens[here] if len(tokens) else 0)), leaf)
        self.leaf = leaf.view(np.int64)

    def new(self, kept: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether a token of the lines ``kept`` (``places``: where their tokens are) is the first of its text at its leaf and place."""
        out = np.ones(len(places), bool)
        key = mix(self.leaf[kept].view(np.uint64) + mix(self.row[kept].astype(np.uint64)))
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        again = np.flatnonzero(np.repeat(times[which] > 1, self.size[kept]))
        if len(again):
            line = np.repeat(np.arange(len(kept)), self.size[kept])[again]
            at = (places[again] - self.first[kept][line]).astype(np.uint64)
            spot = mix(mix(key[line] + at) + self.tokens[places[again]])
            out[again] = False
            out[again[np.unique(spot, return_index=True)[1]]] = True
        return out


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """Per text the leaves of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            lines = _Lines(batch.column("text"), depth)
            ends = np.searchsorted(lines.row, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("c1"), batch.column("c2"), _lists(lines.leaf, ends)], ["c1", "c2", "leaves"])

    return docs.mapInArrow(run, "c1 bigint, c2 bigint, leaves array<bigint>")


def _tokens(docs: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """Lines (c1, c2, number, leaf, tokens) that may lie in one of the leaves.

    ``new`` says of each token whether it is the first of its text at its leaf and place.

    A bitmap of bounded size of the leaves' hashes passes over other lines; what
    it lets through in excess is to be joined away.
    """
    shared = docs.sparkSession.sparkContext.broadcast(alike.bitmap(leaves, "leaf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            lines = _Lines(batch.column("text"), depth)
            kept = np.flatnonzero(alike.in_bitmap(shared.value, lines.leaf))
            ends = np.concatenate([[0], np.cumsum(lines.size[kept])])
            places = np.repeat(lines.first[kept] - ends[:-1], lines.size[kept]) + np.arange(ends[-1])
            row = pa.array(lines.row[kept])
            new = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(lines.new(kept, places)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("c1").take(row), batch.column("c2").take(row), pa.array(lines.number[kept].astype(np.int32)),
                 pa.array(lines.leaf[kept]), _lists(lines.tokens.view(np.int64)[places], ends), new],
                ["c1", "c2", "number", "leaf", "tokens", "new"])

    return docs.mapInArrow(run, "c1 bigint, c2 bigint, number int, leaf bigint, tokens array<bigint>, new array<boolean>")


def recurring(texts: DataFrame, depth: int = 3, min_texts: int = 10, least_tokens: int = 5, constant: float = 0.7,
              short_texts: int = 20) -> DataFrame:
    """Lines (c1, c2, number) with their templates (leaf, t1, t2) that recur in enough distinct texts, and how many are enough (least): ``min_texts``.

    ``texts`` has c1, c2 (two hashes of the text) and text. Lines of which less
    than ``constant`` is constant are no templates. Lines of fewer than
    ``least_tokens`` tokens agree by chance more easily: all their tokens
    without a digit have to be constant, and the texts ``short_texts``.
    """
    leaves = settle(_lines(texts, depth))
    held = leaves.select(*_TEXT, F.explode(F.array_distinct("leaves")).alias("leaf")).distinct()
    wide = settle(held.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_texts).select("leaf"))
    lines = _tokens(texts, wide, depth).join(wide, "leaf", "left_semi").distinct()
    lines = settle(lines.withColumn("line", F.monotonically_increasing_id()))
    each = lines.select("line", "leaf", F.posexplode(F.arrays_zip("tokens", "new")).alias("place", "at"))
    each = each.select("line", "leaf", "place", F.col("at.tokens").alias("token"), F.col("at.new").alias("new")).where("token <> 0")
    spot = ["leaf", "place", "token"]
    texts_of = each.where("new").groupBy(*spot).agg(F.count(F.lit(1)).alias("n"))
    constants = settle(texts_of.where(F.col("n") >= min_texts).select(*spot))
    # A template's name: the sum of its constants' hashes (wrapped to 62 bits), whatever their order.
    sign = F.sum(F.xxhash64("place", "token").bitwiseAND(F.lit((1 << 40) - 1)))
    sign2 = F.sum(F.xxhash64(F.lit(1), "place", "token").bitwiseAND(F.lit((1 << 40) - 1)))
    named = each.join(constants, spot).groupBy("line").agg(sign.alias("t1"), sign2.alias("t2"), F.count(F.lit(1)).alias("constants"))
    named = lines.select("line", "leaf", "number", *_TEXT, F.size("tokens").alias("n"), F.size(F.array_remove("tokens", F.lit(0).cast("bigint"))).alias("plain")).join(named, "line")
    short = F.col("n") < least_tokens
    enough = F.when(short, F.col("constants") == F.col("plain")).otherwise(F.col("constants") >= F.col("n") * F.lit(constant))
    named = named.withColumn("least", F.when(short, F.greatest(F.lit(short_texts), F.lit(min_texts))).otherwise(F.lit(min_texts)))
    named = settle(named.where(enough))
    counted = named.select(*_TEMPLATE, *_TEXT).distinct().groupBy(*_TEMPLATE).agg(F.count(F.lit(1)).alias("texts"))
    counted = settle(counted.where(F.col("texts") >= min_texts))
    return named.join(counted, _TEMPLATE).where(F.col("texts") >= F.col("least")).select(*_TEXT, "number", *_TEMPLATE, "least")


def _apart(found: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The lines of ``found`` whose template recurs in enough texts that are no near copies of each other."""
    groups = settle(alike.groups(rows, size, percent, found.select("c1")))
    held = found.select(*_TEMPLATE, "least", "c1").distinct().join(groups, "c1", "left")
    held = held.select(*_TEMPLATE, "least", F.coalesce("copies", "c1").alias("copies")).distinct()
    counted = held.groupBy(*_TEMPLATE, "least").agg(F.count(F.lit(1)).alias("groups"))
    return found.join(counted.where(F.col("groups") >= F.col("least")), [*_TEMPLATE, "least"], "left_semi")


def drop_lines(docs: DataFrame, text: str = "text", depth: int = 3, min_texts: int = 10, least_tokens: int = 5, constant: float = 0.7,
               size: int = 5, percent: int = 80, short_texts: int = 20) -> DataFrame:
    """``docs`` without the lines of recurring templates, and n_lines and n_dropped_lines.

    Texts linked by near copies (``size`` words a shingle, similarity
    ``percent`` / 100, as ``alike`` estimates it) count as one text for a
    template, so what only copies share is left for the search for copies; all
    other recurring lines go, whatever their share of the text. Texts with the same content are one text
    in all counts and are treated alike. Lines end at a line feed; a text without
    dropped lines is unchanged, to the byte. A null text stays null, with no
    lines. Columns already called n_lines or n_dropped_lines are replaced; an
    empty table gives an empty result.
    """
    others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped_lines")]
    # The table's own columns travel in one struct, so that their names cannot clash.
    rows = docs.select(F.struct(*others).alias("own"), F.col(text).cast("string").alias("text"),
                       F.xxhash64(text).alias("c1"), F.xxhash64(F.lit(1), text).alias("c2"))
    found = settle(recurring(rows.select("c1", "c2", "text"), depth, min_texts, least_tokens, constant, short_texts))
    found = _apart(found, rows.select("c1", "c2", "text"), size, percent)
    drops = settle(found.groupBy(*_TEXT).agg(F.sort_array(F.collect_set("number")).alias("drop")))
    rows = rows.join(drops, _TEXT, "left").withColumn("lines", F.split("text", "\n"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop"), lambda k: F.get("lines", k))
    clean = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[clean.alias(c) if c == text else F.col("own")[c].alias(c) for c in others],
                       F.when(F.col("text").isNotNull(), F.size("lines")).otherwise(0).alias("n_lines"),
                       F.when(F.col("drop").isNotNull(), F.size("drop")).otherwise(0).alias("n_dropped_lines"))
