"""Spelling variants of a corpus' words, by the sorted rotations of the marked words.

A word is written with a marker at its end and rotated to every place. With the
character to be edited turned to the end, all that is left of the word is a
prefix: words that differ by a replacement there are exactly the rotations that
prolong this prefix by one character, and the word without the character is the
rotation that equals the prefix. So rotations are sorted by prefix, and each
run of one prefix is scanned once. A run holds one rotation for each character
of the alphabet, at most, and its neighbours are emitted as a count and the best
of them, not as pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

# Fixed values of the contract: what a run of letters is, and the letters lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MARK = "$"


def without(word: Column, place: Column) -> Column:
    """``word`` without the code point at ``place`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word)))


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 7, least: int = 2, one_in: int = 31) -> DataFrame:
    """Rows (word, n): words of at least ``least_length`` code points that occur ``least`` times in all texts.

    Runs of letters, A-Z lower-cased. Where ``one_in`` divides the CRC-32 of
    ``<doc_id>:<run>`` the run loses the code point at that CRC modulo its
    length. A null text has no runs, a null id counts as an empty string, and
    repeated rows count as often as they occur.
    """
    source = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.translate(F.col(text).cast("string"), UPPER, LOWER).alias("text"))
    # A run only gets shorter, so shorter ones are left out at once.
    runs = source.select("id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= max(least_length, 1))
    crc = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    place = (crc % F.char_length("run")).cast("int")
    words = runs.select(F.when(crc % one_in == 0, without(F.col("run"), place)).otherwise(F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """Rows (prefix, last, first_of_run, n) of all rotations of the words of (word, n).

    ``last`` is the character a rotation has beyond its prefix, null where the
    rotation is the prefix itself. ``first_of_run`` tells whether it is unlike
    the character before it in the word: leaving out any of several equal
    characters in a row gives one and the same word, found at the first alone.
    """
    word, size = F.col("word"), F.char_length("word")

    def turned(i: Column) -> Column:
        last = F.substring(word, i + 1, F.lit(1))
        before = F.when(i > 0, F.substring(word, i, F.lit(1)))
        rest = F.concat(F.substring(word, i + 2, size), F.lit(MARK), F.substring(word, F.lit(1), i))
        return F.struct(rest.alias("prefix"), last.alias("last"), F.coalesce(before != last, F.lit(True)).alias("first_of_run"))

    def whole(i: Column) -> Column:
        full = F.concat(F.substring(word, i + 1, size), F.lit(MARK), F.substring(word, F.lit(1), i))
        return F.struct(full.alias("prefix"), F.lit(None).cast("string").alias("last"), F.lit(False).alias("first_of_run"))

    all_of = F.concat(F.transform(F.sequence(F.lit(0), size - 1), turned), F.transform(F.sequence(F.lit(0), size), whole))
    return words.where(size > 0).select("n", F.explode(all_of).alias("r")).select("r.*", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """Rows (word, n_near, best) for the words of (word, n) that have near words.

    Near: one code point inserted, deleted or replaced. ``best`` is the near
    word of largest n, of equal ones the first by code points, as a struct
    (minus, word) with minus n first. Words are distinct, not null and hold no
    marker. No words give no rows.
    """
    # Within a prefix the words differ in `last` alone, so its order is theirs.
    run = Window.partitionBy("prefix")
    scan = run.orderBy(F.col("last").isNull(), F.col("n").desc(), "last")
    every = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("minus"), F.col("last").alias("last"))
    longer = F.when(F.col("last").isNotNull(), me)
    shown = rotations(words).select(
        "*",
        F.count("last").over(run).alias("n_longer"),
        F.count(F.when(F.col("first_of_run"), 1)).over(run).alias("n_inserted"),
        F.max(F.when(F.col("last").isNull(), F.col("n"))).over(run).alias("whole_n"),
        F.row_number().over(scan).alias("place"),
        F.first(longer).over(every).alias("top"),
        F.lead(longer).over(scan).alias("second"),
        F.min(F.when(F.col("first_of_run"), me)).over(run).alias("inserted"),
    )
    is_whole = F.col("last").isNull()
    shorter = F.col("first_of_run") & F.col("whole_n").isNotNull()
    met = F.when(is_whole, F.col("n_inserted")).otherwise(F.col("n_longer") - 1 + shorter.cast("bigint"))
    shown = shown.withColumn("met", met).where("met > 0")

    mark = F.locate(MARK, F.col("prefix"))
    after, before = F.substring(F.col("prefix"), F.lit(1), mark - 1), F.substring(F.col("prefix"), mark + 1, F.char_length("prefix"))

    def named(minus: Column, last: Column) -> Column:
        return F.struct(minus.alias("minus"), F.concat(before, last, after).alias("word"))

    beside = F.when(is_whole, F.col("inserted")).when(F.col("place") == 1, F.col("second")).otherwise(F.col("top"))
    best_longer = F.when(beside.isNotNull(), named(beside["minus"], beside["last"]))
    best_shorter = F.when(~is_whole & shorter, named(-F.col("whole_n"), F.lit("")))
    found = shown.select(
        F.concat(before, F.coalesce("last", F.lit("")), after).alias("word"), "met", F.least(best_longer, best_shorter).alias("best")
    )
    return found.groupBy("word").agg(F.sum("met").alias("n_near"), F.min("best").alias("best"))


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for all words of (word, n).

    ``form`` is the best near word if its n is at least ``times`` the word's
    (``times`` above 1), else null; ``root`` is where forms lead to. Each form
    has ``times`` the n of its word, so a path has at most log(n) steps; it is
    shortened by half in each round.
    """
    words = settle(words)
    near = neighbours(words)
    enough = -F.col("best.minus") >= times * F.col("n")
    known = settle(
        words.join(near, "word", "left").select(
            "word", F.when(enough, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        )
    )
    step = settle(known.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        further = step.toDF("root", "further")
        if step.join(further, "root", "left_semi").isEmpty():
            break
        step = settle(step.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return known.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
