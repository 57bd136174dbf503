"""Quality rules on whole texts and on lines across documents, with DataFrame functions only.

A line counts by the distinct texts of its host that hold it. Lines in more of
them than the limit are taken out; a document of which too little is left is
rejected. Exact copies are one text, so they do not make their own lines common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .mixing import words_in
from .text import SPACE, WORD

SYMBOLS = "#*$%&|<>"
CLEAN = "_clean"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def normalised(line: Column) -> Column:
    """A line without outer white space and case (A-Z), each number as 0."""
    line = F.regexp_replace(line, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")
    return F.regexp_replace(F.translate(line, _UPPER, _UPPER.lower()), "[0-9]+", "0")


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside a run of three that the text holds twice or more.

    The runs' hashes are sorted with their places, equal neighbours give the
    places, and the gaps between places how many words they cover. The sort is
    only made for texts in which a run comes again.
    """
    n = F.size("_w") - 2
    runs = F.when(n > 0, F.arrays_zip(F.slice("_w", 1, n).alias("a"), F.slice("_w", 2, n).alias("b"), F.slice("_w", 3, n).alias("c")))
    rows = rows.withColumn("_runs", F.transform(runs, lambda r: F.xxhash64(r["a"], r["b"], r["c"])))
    again = F.size(F.array_distinct("_runs")) < F.size("_runs")
    rows = rows.withColumn("_placed", F.when(again, F.sort_array(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    m = F.size("_placed")
    zipped = F.arrays_zip(
        F.col("_placed").alias("x"), F.slice("_placed", 2, m).alias("next"),
        F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice("_placed", 1, m - 1)).alias("last"))
    equal = F.filter(zipped, lambda z: (z["x"]["h"] == z["next"]["h"]) | (z["x"]["h"] == z["last"]["h"]))
    rows = rows.withColumn("_at", F.sort_array(F.transform(equal, lambda z: z["x"]["i"])))
    gaps = F.zip_with("_at", F.slice("_at", 2, F.size("_at")), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, g: s + g)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))


def check(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_docs: int = 10, least_left: float = 0.5,
          least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """Counts of each whole text, whether it is kept, and the text without lines above the limit.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed (fewer than ``least_words`` words, or more than
    ``most_repeated`` per cent in repeated runs), kept, n_left_words, and
    clean_text: the text without lines held by more than ``max_docs`` distinct
    texts of the host, of which n_left_words are the words. A document is
    depleted if that is less than ``least_left`` of its words.

    A null or empty text has counts of 0 and fails; null hosts are one host; a
    null id is kept as it is; repeated rows are judged one by one, and count as
    one text for line frequency; other columns are not read; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_own"), F.col(host).alias("_of"))
    rows = _cleaned(rows, "_own", "_of", max_docs).withColumn("_t", F.coalesce("_own", F.lit("")))
    rows = rows.withColumns({"_w": _words(F.col("_t")), "_l": F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))})
    n_words = F.size("_w").cast("bigint")
    out = _with_repeats(rows).select(
        "doc_id", n_words.alias("n_words"),
        F.length(F.regexp_replace("_t", f"[{SPACE}]+", "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words", F.when(F.col(CLEAN).isNull(), n_words).otherwise(words_in(CLEAN)).alias("n_left_words"),
        F.coalesce(CLEAN, "_own").alias("clean_text"))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeated)
    kept = ~F.col("base_failed") & (F.col("n_left_words") >= F.col("n_words") * F.lit(least_left))
    out = out.withColumn("base_failed", failed).withColumn("kept", kept)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left_words", "clean_text")


def _cleaned(rows: DataFrame, text: str, host: str, max_docs: int) -> DataFrame:
    """Adds the text without lines held by more than ``max_docs`` distinct texts of the host, null where it has none.

    Each distinct text (two hashes) of a host has the hashes of its lines, null
    for lines without a word; those that recur give the places that go.
    """
    named = {"_host": F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")),
             "_c1": F.xxhash64(text), "_c2": F.xxhash64(F.lit(1), text)}
    rows = rows.withColumns(named)
    hashed = F.transform(F.split(text, "\n"), lambda x: F.when(x.rlike(f"[^{SPACE}]"), F.xxhash64(normalised(x))))
    texts = settle(rows.select(*named, hashed.alias("_h")).dropDuplicates([*named]))
    frequent = texts.select("_host", F.explode(F.array_distinct("_h")).alias("h")).where("h is not null")
    frequent = frequent.groupBy("_host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_docs).select("_host", "h")
    places = texts.select(*named, F.posexplode("_h").alias("place", "h")).join(frequent, ["_host", "h"])
    gone = settle(places.groupBy(*named).agg(F.collect_list("place").alias("_gone")))
    lines, last = F.split(text, "\n"), F.size(F.split(text, "\n")) - 1
    stay = F.array_except(F.sequence(F.lit(0), last), "_gone")
    clean = F.when(F.col("_gone").isNotNull(), F.array_join(F.transform(stay, lambda k: F.get(lines, k)), "\n"))
    return rows.join(gone, [*named], "left").withColumn(CLEAN, clean).drop(*named, "_gone")


def remove_frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", max_docs: int = 10) -> DataFrame:
    """The rows of ``docs`` with texts rid of lines held by more than ``max_docs`` distinct texts of the host.

    Lines are compared as by ``check``, whose clean_text are these texts. Lines
    without a word stay, as do texts without such lines, nulls and all other
    columns; repeated rows stay repeated; null hosts are one host; an empty
    table gives an empty result.
    """
    rows = docs.select(F.struct("*").alias("own"), F.col(text).cast("string").alias("t"), F.col(host).alias("of"))
    out = _cleaned(rows, "t", "of", max_docs)
    return out.select(*[F.coalesce(CLEAN, F.col("own")[c]).alias(c) if c == text else F.col("own")[c].alias(c) for c in docs.columns])
