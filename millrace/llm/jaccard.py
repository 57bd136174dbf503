"""Exact Jaccard join of documents over word shingles: a grouped prefix join.

Shingles are 64-bit hashes, ordered by value. By the prefix principle, two sets
that are similar enough share one of the first ``p = n - ceil(t * n) + 1``
shingles of each, in any order that is the same for all. So

* documents of the same set are one *class*, classes whose size and prefix are
  the same are one *group*;
* a shingle in the prefixes of more than ``common`` documents is put last in the
  order, for all documents alike; so lists of groups by shingle are short, and
  joining them with themselves costs at most ``common / 2`` per entry;
* a sketch of 256 parities bounds the difference of two sets from below, and the
  number of shared prefix shingles their overlap from above, which leaves few
  pairs of groups; their classes are joined with their whole sets and verified;
* sets made almost wholly of common shingles are met through those, star by
  star with another centre for each list, and only across components that are
  not linked yet; a pair is made on the first list it shares, as far as a short
  look back on both lists tells, and a wide sketch leaves few that do not link.

Only connectedness is asked for, so no list of all pairs is made of documents
that are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .graph import components
from .text import buffer_of, grams, mix, pieces, words_of

_MARK_BITS = 22

# Longs of the wide sketch of sets on lists of any length, and how many lists a pair is looked for before.
_WIDE = 16
_BACK = 4

# Rounds of stars before lists are tried pair by pair.
_ROUNDS = 3


def _prefix(n: int, percent: int) -> int:
    """Shingles of a set of n of which two similar sets share one at least."""
    return n - -(-percent * n // 100) + 1


def _window(n: int, percent: int) -> int:
    """Shingles looked at first: the prefix and room for common ones."""
    p = _prefix(n, percent)
    return min(n, p + p // 4 + 4)


def _sums(values: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums that tell sets apart."""
    values = values.view(np.uint64)
    one, two = mix(values + np.uint64(0xA5A5A5A5)).sum(), mix(values ^ np.uint64(0x5BF03635)).sum()
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    raw, at = buffer_of(column)
    words = words_of(raw, at)
    for row in range(len(at) - 1):
        yield np.unique(grams(words.of(row), size).view(np.int64))


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


_SET = ["n", "s1", "s2"]
_SKETCH = ["k0", "k1", "k2", "k3"]


def _parities(values: np.ndarray) -> list[int]:
    """For each of 256 cells of hash values, whether the set has an odd number in it."""
    odd = np.bincount(values.view(np.uint64) >> np.uint64(56), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _wide(values: np.ndarray) -> np.ndarray:
    """As ``_parities``, of as many cells as fill ``_WIDE`` longs."""
    cells = values.view(np.uint64) >> np.uint64(64 - (64 * _WIDE - 1).bit_length())
    return np.packbits((np.bincount(cells, minlength=64 * _WIDE) & 1).astype(np.uint8)).view(np.int64)


def _needed(n: Column, percent: int) -> Column:
    """``_prefix`` of a column."""
    return n - F.floor((n * percent + 99) / 100) + 1


def _seen(n: Column, percent: int) -> Column:
    """``_window`` of a column."""
    p = _needed(n, percent)
    return F.least(n, p + F.floor(p / 4) + 4)


def _may_link(a: str, b: str, percent: int, sketch: list[str] = _SKETCH) -> Column:
    """False only if sizes or sketches show that two sets are too different; true where there is no sketch."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.{k}").bitwiseXOR(F.col(f"{b}.{k}"))) for k in sketch), F.lit(0))
    alike = F.coalesce(apart * (100 + percent) <= (n + m) * (100 - percent), F.lit(True))
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & alike


def shingled(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document the size of its set, its signatures (s1, s2), its first shingles (``head``) and their hash with the size (``group``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            signs: list[tuple[int, ...]] = []
            heads = []
            for found in _sets(batch.column("text"), size):
                head = found[: _window(len(found), percent)] if len(found) else found
                heads.append(head.copy())
                signs.append((len(found), _sums(head + len(found))[0], *_sums(found), *_parities(found)))
            columns = [pa.array(c, pa.int64()) for c in zip(*signs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, _lists(heads)], ["doc_id", "n", "group", "s1", "s2", *_SKETCH, "head"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, group bigint, s1 bigint, s2 bigint, k0 bigint, k1 bigint, k2 bigint, k3 bigint, head array<bigint>")


def whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The whole sets (n, s1, s2, shingles) of some documents, from their texts.

    ``wanted`` has doc_id. A bitmap of bounded size, of hashes of the ids,
    passes over other texts before they are looked at; what it lets through in
    excess has no effect.
    """
    mask = (1 << _MARK_BITS) - 1
    place = F.xxhash64("doc_id").bitwiseAND(F.lit(mask))
    marks = wanted.select(place.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    bits = np.zeros((mask + 1) // 64, np.uint64)
    for row in marks.collect():  # at most 2**16 rows
        bits[row["word"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy()
            hit = (shared.value[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1)
            for part in pieces(iter([batch.filter(pa.array(hit.astype(bool)))]), "text"):
                found = list(_sets(part.column("text"), size))
                signs = [(len(x), *_sums(x)) for x in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*signs)), _lists(found)],
                                                 ["doc_id", "n", "s1", "s2", "shingles"])

    rows = docs.select("doc_id", "text", place.alias("h"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, shingles array<bigint>")


def near_copies(docs: DataFrame, size: int = 4, percent: int = 85, common: int = 64, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Documents linked, directly or not, by sets whose Jaccard similarity is at least ``percent`` / 100.

    Words are split at ASCII white space and lower-cased (A-Z); a set holds the
    distinct runs of ``size`` words, of a shorter text the one run of all. A null
    or empty text has no set and links with nothing, itself apart.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable) and
    class_id (smallest doc_id of the same set), one row per row of ``docs``;
    repeated rows are copies. A row with a null id belongs to the class of its
    set; a set that only such rows have links with no other. Other columns are
    not read; an empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = settle(shingled(docs, size, percent).withColumn("row", F.monotonically_increasing_id()))
    full = rows.where("n > 0")
    classes = settle(full.groupBy("group", *_SET).agg(F.min("row").alias("class"), F.min("doc_id").alias("class_id"), *[F.min(k).alias(k) for k in _SKETCH]))
    roots = _linked(docs, full, classes, size, percent, common)
    known = classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    smallest = known.groupBy("root").agg(F.min("class_id").alias("component_id"))
    known = settle(known.join(smallest, "root").select(*_SET, "class_id", "component_id"))
    out = rows.select("doc_id", *_SET).join(known, _SET, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def _linked(docs: DataFrame, full: DataFrame, classes: DataFrame, size: int, percent: int, common: int) -> DataFrame:
    """Rows (class, root) of all classes that have a verified link to another."""
    p, w = _needed(F.col("n"), percent), _seen(F.col("n"), percent)
    groups = settle(full.groupBy("group").agg(F.min("n").alias("n"), F.min(F.element_at("head", -1)).alias("last"), F.min("row").alias("first")))
    entries = full.select("group", F.explode("head").alias("t"))
    counts = settle(entries.groupBy("t").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    named = classes.where("class_id is not null").select("group", "class", F.col("class_id").alias("doc_id"), *_SET)

    # Groups whose first shingles are too often common ones are looked at whole, every class of
    # them: they share size and head only. Their further shingles count as well, which may make
    # more shingles common: until none is added.
    beyond, whole = None, None
    while True:
        total = counts if beyond is None else counts.union(beyond.groupBy("t").agg(F.count(F.lit(1)).alias("c"))).groupBy("t").agg(F.sum("c").alias("c"))
        heavy = settle(total.where(F.col("c") > common).select("t"))
        used = settle(entries.join(heavy, "t").distinct().groupBy("group").agg(F.count(F.lit(1)).alias("heavy")))
        short = groups.join(used, "group").where(w - F.col("heavy") < p).select("group")
        short = short if whole is None else short.join(whole.select("group").distinct(), "group", "left_anti")
        short = settle(named.join(short, "group"))
        if short.isEmpty():
            break
        more = whole_sets(docs, short, size).join(short, ["doc_id", *_SET]).dropDuplicates(["class"])
        more = more.select("group", "class", "n", w.alias("w"), F.posexplode("shingles").alias("place", "t"))
        whole = settle(more if whole is None else more.union(whole))
        beyond = whole.where("place >= w").select("class", "t")

    # What is put on lists: every class of a group looked at whole, else the group, named by its first class.
    members = classes.select("group", "class", *_SKETCH).join(groups.select("group", "first"), "group")
    if whole is None:
        members = members.withColumn("unit", F.col("first"))
    else:
        seen = whole.select("group").distinct().withColumn("seen", F.lit(1))
        members = members.join(seen, "group", "left").withColumn("unit", F.when(F.col("seen") == 1, F.col("class")).otherwise(F.col("first")))
    members = settle(members.select("group", "class", "unit", *_SKETCH))
    light = counts.select("t").join(heavy, "t", "left_anti")
    lists = entries.join(light, "t").select("t", "group").distinct()
    if whole is not None:
        # A further shingle may lie among the first of others, even where those have it once.
        reached = beyond.join(heavy, "t", "left_anti")
        single = entries.join(reached.select("t").distinct().join(counts, "t", "left_anti"), "t")
        lists = lists.unionByName(single.select("t", "group"))
    facts = groups.join(used, "group", "left").select(
        "group", "first", "n", F.coalesce("heavy", F.lit(0)).alias("heavy"), F.when(w < F.col("n"), F.col("last")).otherwise((1 << 63) - 1).alias("last"))
    # A group of several classes has no one sketch.
    one = F.count(F.lit(1)) == 1
    units = members.groupBy("group", "unit").agg(*[F.when(one, F.min(k)).alias(k) for k in _SKETCH])
    facts = settle(facts.join(units, "group"))
    # Written before facts make the rows long, so that the shuffle of all first shingles is gone by
    # then; what can be told from the rest is not carried: ``first`` is a group's shorter name.
    lists = settle(lists).join(facts, "group").drop("group")
    if whole is not None:
        # These lie beyond the first shingles, so no row comes twice.
        lists = lists.unionByName(reached.select("t", F.col("class").alias("unit")).join(facts, "unit").drop("group"))
    a, b = lists.alias("a"), lists.alias("b")
    apart = (F.col("a.unit") < F.col("b.unit")) & (F.col("a.first") != F.col("b.first"))
    pairs = a.join(b, (F.col("a.t") == F.col("b.t")) & apart & _may_link("a", "b", percent))
    # All shared shingles up to the earlier end of the two heads are counted or common;
    # beyond it the set that ends earlier has the rest of its shingles left.
    rest = {x: F.col(f"{x}.n") - _seen(F.col(f"{x}.n"), percent) for x in "ab"}
    most = F.least("a.heavy", "b.heavy") + F.when(F.col("a.last") <= F.col("b.last"), rest["a"]).otherwise(rest["b"])
    pairs = pairs.groupBy(F.col("a.unit").alias("ua"), F.col("b.unit").alias("ub")).agg(
        F.count(F.lit(1)).alias("shared"), F.min(most).alias("most"), F.min((F.col("a.n") + F.col("b.n")) * percent).alias("need"))
    pairs = pairs.where((F.col("shared") + F.col("most")) * (100 + percent) >= F.col("need")).select("ua", "ub")

    # Expand pairs of units to pairs of classes.
    of_unit = members.select("unit", "class")
    pairs = pairs.join(of_unit.toDF("ua", "a"), "ua").join(of_unit.toDF("ub", "b"), "ub").select("a", "b")
    links = settle(_verified(docs, classes, pairs, size, percent))

    # Groups of several classes, and sets made of common shingles: lists of any length.
    many = classes.groupBy("group").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("group")
    lists = named.join(many, "group").select(F.concat(F.lit("g"), F.col("group").cast("string")).alias("list"), "class", F.array().cast("array<bigint>").alias("back"))
    if whole is not None:
        marked = whole.join(heavy.withColumn("common", F.lit(1)), "t", "left")
        plain = marked.groupBy("class").agg(F.max("n").alias("n"), F.count(F.when(F.col("common").isNull(), 1)).alias("plain"))
        poor = plain.where(F.col("plain") < p).select("class", (p - F.col("plain")).alias("need"))
        # Of the common shingles, which come last in the order, as many as the prefix still needs.
        order = Window.partitionBy("class").orderBy("t")
        rare = marked.where("common is not null").select("class", "t").join(poor, "class")
        rare = rare.withColumn("at", F.row_number().over(order)).withColumn("back", F.collect_list("t").over(order.rowsBetween(-_BACK, -1)))
        lists = lists.union(rare.where("at <= need").select(F.concat(F.lit("t"), F.col("t").cast("string")), "class", "back"))
    return _across(docs, classes, settle(lists), links, size, percent)


def _across(docs: DataFrame, classes: DataFrame, lists: DataFrame, links: DataFrame, size: int, percent: int) -> DataFrame:
    """Components (class, root) of the links and of those between classes of the same list.

    ``lists`` has list, class and ``back``, the lists of the class just before
    this one in an order that is the same for all. A list's classes are first
    tried against one of them, of each list another; what then still lies in
    different components is tried pair by pair.
    """
    roots = settle(components(links).toDF("class", "root"))
    sets, wide = None, [f"w{k}" for k in range(_WIDE)]
    for turn in range(_ROUNDS + 1):
        lists = lists.drop("root").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
        lists = settle(lists.join(lists.groupBy("list").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("list"), "list"))
        if lists.isEmpty():
            return roots
        if sets is None:
            sets = _sets_of(docs, classes, lists.select("class").distinct(), size)
            sketches = _widely(sets)
        b = lists.join(sketches, "class").alias("b")
        if turn < _ROUNDS:
            hub = F.min_by("class", F.xxhash64(F.lit(turn), "list", "class")).alias("class")
            a = lists.groupBy("list").agg(hub).join(lists.join(sketches, "class"), ["list", "class"]).alias("a")
            apart = F.col("a.root") != F.col("b.root")
        else:
            a = lists.join(sketches, "class").alias("a")
            apart = (F.col("a.root") < F.col("b.root")) & ~F.arrays_overlap("a.back", "b.back")
        pairs = a.join(b, (F.col("a.list") == F.col("b.list")) & apart & _may_link("a", "b", percent, wide))
        links = settle(_alike(_distinct(pairs.select(F.col("a.class").alias("a"), F.col("b.class").alias("b"))), sets, percent))
        roots = settle(_merged(roots, links))
    return roots


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (class, root) when links (a, b) between classes are added."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(roots.toDF(end, "r"), end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
    step = settle(components(ends).toDF("root", "further"))
    old = roots.join(step, "root", "left").select("class", F.coalesce("further", "root").alias("root"))
    # Classes that had no link before are roots of their own, which no row of ``roots`` names.
    return old.union(step.join(roots.select("root").distinct(), "root", "left_anti").toDF("class", "root"))


def _distinct(pairs: DataFrame) -> DataFrame:
    return settle(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are similar enough."""
    pairs = _distinct(pairs)
    return _alike(pairs, _sets_of(docs, classes, pairs.select("a").union(pairs.select("b")).distinct().toDF("class"), size), percent)


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The whole sets (class, n, shingles) of some classes; those without a named document have none."""
    involved = settle(wanted.join(classes, "class").select("class", F.col("class_id").alias("doc_id"), *_SET))
    found = whole_sets(docs, involved.select("doc_id"), size)
    # A class has one doc_id and one set: with them in the key, the shuffle of the join serves.
    met = found.join(involved, ["doc_id", *_SET]).dropDuplicates(["class", "doc_id", *_SET])
    return settle(met.select("class", "n", "shingles"))


def _widely(sets: DataFrame) -> DataFrame:
    """Per class the size and the wide sketch of its set."""
    names = [f"w{k}" for k in range(_WIDE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = batch.column("shingles")
            at, values = np.asarray(shingles.offsets), np.asarray(shingles.values)
            sketch = np.array([_wide(values[x:y]) for x, y in zip(at[:-1], at[1:])], np.int64).reshape(-1, _WIDE)
            columns = [batch.column("class"), batch.column("n"), *(pa.array(c) for c in sketch.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, ["class", "n", *names])

    return settle(sets.mapInArrow(run, "class bigint, n bigint, " + ", ".join(f"{w} bigint" for w in names)))


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    both = pairs.join(sets.toDF("a", "na", "sa"), "a").join(sets.toDF("b", "nb", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    return both.where(shared * 100 >= (F.col("na") + F.col("nb") - shared) * percent).select("a", "b")
