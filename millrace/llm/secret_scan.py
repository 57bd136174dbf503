"""Secrets in whole texts: candidates by pattern, false positives removed by a random forest.

DataFrame functions and Spark's own forest only. A candidate is a long run of
key characters with a digit, parts joined by dots included, of which a word may
hold many, or a value of any form given to a credential's name. Words are cut
into segments where a further name with a value begins (JSON, query strings,
connection strings), so that each match is seen with its own name. The forest
judges a candidate by its length, how
its characters change class and follow one another, how much of it is words of
the corpus, whether it looks like a path or an address, and the words beside it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .sampling import first_by_hash
from .text import SPACE, WORD

# What counts as a candidate, and the words that name a credential.
_KEY = r"[A-Za-z0-9+/_=\-]"
CANDIDATE = rf"(?<!{_KEY})(?=[A-Za-z+/_=\-]*+(?:\.[A-Za-z+/_=\-]*+){{0,4}}[0-9]){_KEY}{{12,}}(?:\.{_KEY}{{12,}}){{0,4}}"
NAMES = r"(?i)token|secret|passw|pwd|credential|bearer|auth|api[_-]?key|access[_-]?key|private[_-]?key"
# A credential's name to its end (an author is none), the value given to it in the same word, and where the next name begins.
NAME = rf"(?:{NAMES})(?:ord|d)?s?(?-i:(?![a-z]))[\w.\-]*[\"'`\\\\]*"
GIVEN = rf"{NAME}(?::=|=>|[=:])+(.*)"
NEXT_NAME = r"[,;&?{}\[\]()|]+(?=[\"'`\\]*[A-Za-z_][\w.\-]*[\"'`\\]*[=:])"

FEATURES = ["length", "changes", "classes", "distinct", "digits", "hex", "likelihood", "coverage", "slashes", "dots", "address",
            "quoted", "assigned", "named", "named_before", "next_is_word"]


def _value(given: Column) -> Column:
    """What a name is given: the inside of its quotes, or all up to closing signs."""
    quoted = F.regexp_extract(given, r"\A\\?([\"'`])(.+?)\\?\1", 2)
    return F.when(quoted != "", quoted).otherwise(F.regexp_replace(given, r"\A[\"'`\\]+|[\"'`\\,;.)\]}]+\z", ""))


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per candidate: doc_id, hashes of the text, word number ``n``, segment number ``part`` in the text, match number ``m`` in it (all from 0), segment (word), core, neighbours."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("t"))
    # One pass over each text finds those with a candidate; only they are split.
    rows = rows.where(F.col("t").rlike(CANDIDATE) | F.col("t").rlike(rf"{NAME}[{SPACE}]*[=:]"))
    parts = F.transform(F.regexp_extract_all("t", F.lit(WORD), F.lit(0)), lambda x, i: F.transform(
        F.filter(F.split(x, NEXT_NAME), lambda y: y != ""), lambda y: F.struct(i.cast("bigint").alias("n"), y.alias("s"))))
    rows = rows.select("doc_id", F.xxhash64("t").alias("c1"), F.xxhash64(F.lit(1), "t").alias("c2"), F.flatten(parts).alias("p"))
    rows = rows.withColumn("w", F.col("p.s"))
    none = F.lit("")
    beside = F.arrays_zip(
        F.col("p.n").alias("n"), F.col("w").alias("word"), F.concat(F.array(none), F.slice("w", 1, F.size("w") - 1)).alias("before"),
        F.slice(F.concat(F.array(none, none), "w"), 1, F.size("w")).alias("before2"),
        F.concat(F.slice("w", 2, F.size("w")), F.array(none)).alias("after"))
    placed = F.transform(beside, lambda z, i: F.struct(z["n"].alias("n"), i.cast("bigint").alias("part"), z["word"].alias("word"), z["before"].alias("before"),
                                                       z["before2"].alias("before2"), z["after"].alias("after")))

    def told(z: Column) -> Column:
        """Whether the words before give this one to a credential's name."""
        return z["before"].rlike(rf"{NAME}(?::=|=>|[=:])+[\"'`]*\z") | (z["before"].rlike(r"\A(?::=|=>|[=:])+\z") & z["before2"].rlike(rf"{NAME}\z"))

    wanted = F.filter(placed, lambda z: z["word"].rlike(CANDIDATE) | z["word"].rlike(rf"{GIVEN}\z") | (z["before"].rlike(r"[=:>][\"'`]*\z") & told(z)))
    found = rows.withColumn("f", F.explode(wanted)).select("doc_id", "c1", "c2", "f.*")
    given = F.when(F.col("word").rlike(rf"{GIVEN}\z"), _value(F.regexp_extract("word", rf"{GIVEN}\z", 1))).when(told({c: F.col(c) for c in ("before", "before2")}), _value(F.col("word")))
    cores = F.when(F.length(given) > 0, F.array(given)).otherwise(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0)))
    return found.select("*", F.posexplode(cores).alias("m", "core"))


def dictionary(docs: DataFrame, size: int = 20_000, text: str = "text") -> DataFrame:
    """The ``size`` most frequent words (a-z, three letters or more) of all texts, with their counts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))).alias("entry"))
    return words.groupBy("entry").agg(F.count(F.lit(1)).alias("uses")).orderBy(F.desc("uses"), "entry").limit(size)


def _follow(words: DataFrame) -> DataFrame:
    """Log-probability of each pair of characters next to each other in the dictionary's words (at most 26 * 26 rows)."""
    letters = F.transform(F.sequence(F.lit(1), F.length("entry") - 1), lambda i: F.substring(F.col("entry"), i, 2))
    pairs = words.select("uses", F.explode(letters).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.sum("uses").alias("n"))
    first = counts.groupBy(F.substring("pair", 1, 1).alias("x")).agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(first), F.substring("pair", 1, 1) == F.col("x")).select(
        "pair", F.log((F.col("n") + 1) / (F.col("total") + 26)).alias("log_p"))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the columns of FEATURES to candidates; ``words`` is a dictionary of bounded size."""
    core, lower = F.col("core"), F.lower("core")
    found = settle(found.withColumn("id", F.monotonically_increasing_id()))
    runs = found.select("id", F.explode(F.regexp_extract_all(F.lower("core"), F.lit("[a-z]{3,}"), F.lit(0))).alias("entry"))
    covered = runs.join(F.broadcast(words.select("entry")), "entry").groupBy("id").agg(F.sum(F.length("entry")).alias("covered"))
    pairs = found.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.length("core") - 1), lambda i: F.substring(F.lower("core"), i, 2))).alias("pair"))
    likely = pairs.join(F.broadcast(_follow(words)), "pair", "left").groupBy("id").agg(F.avg(F.coalesce("log_p", F.lit(-8.0))).alias("likelihood"))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(core, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", "-")
    collapsed = F.regexp_replace(classes, r"(.)\1+", "$1")
    length = F.length("core")
    count = lambda pattern, of: F.regexp_count(of, F.lit(pattern))
    out = found.join(covered, "id", "left").join(likely, "id", "left")
    values = {
        "length": length, "changes": (F.length(collapsed) - 1) / length, "classes": F.size(F.array_distinct(F.split(collapsed, ""))),
        "distinct": F.size(F.array_distinct(F.split(core, ""))) / length, "digits": count("[0-9]", core) / length,
        "hex": lower.rlike(r"\A[0-9a-f]+\z").cast("int"), "likelihood": F.coalesce("likelihood", F.lit(0.0)),
        "coverage": F.coalesce("covered", F.lit(0)) / length, "slashes": count(r"[/\\]", F.col("word")), "dots": count(r"\.", F.col("word")),
        "address": F.col("word").rlike(r"@|://|^www\.").cast("int"), "quoted": F.col("word").rlike("[\"'`]").cast("int"),
        "assigned": (F.col("before").rlike(r"[=:]['\"]?\z") | F.col("word").rlike(r"\A[{\[(\"'`\\]*[\w.\-]+[\"'`\\]*[=:]")).cast("int"),
        "named": (F.col("before").rlike(NAMES) | F.col("word").rlike(rf"\A[^=:]*({NAMES})")).cast("int"),
        "named_before": F.col("before2").rlike(NAMES).cast("int"), "next_is_word": F.col("after").rlike(r"\A\p{L}+[.,;]?\z").cast("int"),
    }
    return out.withColumns({name: value.cast("double") for name, value in values.items()})


def weak_label() -> Column:
    """Label of findings that their surroundings settle: 1 a key given to a credential's name, 0 an address, a number or a word in prose, else null."""
    named = (F.col("named") + F.col("named_before") > 0) & (F.col("assigned") > 0) & (F.col("address") == 0) & F.col("core").rlike(CANDIDATE)
    prose = (F.col("coverage") >= 1) & (F.col("quoted") == 0) & (F.col("next_is_word") > 0)
    plain = (F.col("address") > 0) | (F.col("digits") >= 0.99) | prose
    return F.when(plain, 0).when(named, 1)


def train(findings: DataFrame, label: str = "label", per_label: int = 5000, trees: int = 40, depth: int = 6, seed: int = 3) -> PipelineModel | float:
    """A forest from labelled findings: at most ``per_label`` of each label (lowest hashes of the finding).

    With findings of one label only, or none, the share of label 1 instead
    (smoothed), which then is every candidate's score.
    """
    keyed = findings.withColumn("_key", F.concat_ws("#", *[c for c in ("c1", "c2", "n", "part", "m") if c in findings.columns]))
    sample = first_by_hash(keyed.select("_key", label, *FEATURES), label, "_key", per_label)
    sample = settle(sample)
    sizes = {int(r[label]): r["n"] for r in sample.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    # Bounded, and in one order whatever the cluster: the forest comes out the same.
    rows = sample.select(F.col(label).cast("double").alias("label"), "_key", *FEATURES).coalesce(1).sortWithinPartitions("_key", "label")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="_features", numTrees=trees, maxDepth=depth, seed=seed)
    return PipelineModel([assembler, forest.fit(assembler.transform(rows))])


def judge(findings: DataFrame, model: PipelineModel | float) -> DataFrame:
    """Adds ``score``, the forest's share of votes for a secret."""
    if isinstance(model, float):
        return findings.withColumn("score", F.lit(model))
    scored = model.transform(findings)
    return scored.withColumn("score", F.element_at(vector_to_array("probability"), 2)).drop("_features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, least: float = 0.5, size: int = 20_000, text: str = "text", doc_id: str = "doc_id", labelled: DataFrame | None = None) -> DataFrame:
    """All candidates of all texts with their score and whether they are secrets.

    The forest is trained on ``labelled`` (findings with FEATURES and a column
    label), or, where there are none, on the findings that weak_label() settles.
    Returns doc_id, c1, c2 (hashes of the text), n (word number), part and m
    (segment of the text and match in it), core, score, is_secret. Null and empty texts have no candidates; repeated rows give
    repeated findings; a null id is kept; other columns are not read; an empty
    table gives an empty result.
    """
    words = settle(dictionary(docs, size, text))
    found = settle(features(candidates(docs, text, doc_id), words))
    if labelled is None:
        labelled = found.withColumn("label", weak_label()).where("label is not null")
    out = judge(found, train(labelled))
    return out.select("doc_id", "c1", "c2", "n", "part", "m", "core", "score", (F.col("score") >= least).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every secret found in a text replaced by ``mark``; other texts and columns unchanged.

    Keys are replaced wherever the text holds them, values of other forms (which
    may be plain words) in the word they were found in only.
    """
    key = F.col("core").rlike(CANDIDATE)
    secrets = findings.where("is_secret").groupBy("c1", "c2").agg(
        F.sort_array(F.collect_set(F.when(key, F.col("core"))), asc=False).alias("cores"),
        F.collect_set(F.when(~key, F.struct("n", "core"))).alias("values"))
    # The table's own columns travel in one struct, so that their names cannot clash.
    rows = docs.select(F.struct("*").alias("own"), F.col(text).alias("text"), F.xxhash64(text).alias("c1"), F.xxhash64(F.lit(1), text).alias("c2"))
    rows = rows.join(secrets, ["c1", "c2"], "left")
    literal = mark.replace("\\", "\\\\").replace("$", "\\$")

    def exact(core: Column) -> Column:
        quoted = F.concat(F.lit(r"\Q"), F.replace(core, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        return F.concat(F.lit("(?<![A-Za-z0-9])"), quoted, F.lit("(?![A-Za-z0-9])"))

    words = F.transform(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda w, i: F.aggregate(
        F.filter("values", lambda v: v["n"] == i), w, lambda x, v: F.regexp_replace(x, exact(v["core"]), F.lit(literal))))
    gaps = F.split("text", WORD)
    joined = F.array_join(F.transform(F.arrays_zip(gaps.alias("gap"), words.alias("word")), lambda z: F.concat(z["gap"], F.coalesce(z["word"], F.lit("")))), "")
    base = F.when(F.size("values") > 0, joined).otherwise(F.col("text"))
    clean = F.aggregate("cores", base, lambda t, c: F.replace(t, c, F.lit(mark)))
    clean = F.when(F.col("cores").isNull(), F.col("text")).otherwise(clean)
    return rows.select(*[clean.alias(c) if c == text else F.col("own")[c].alias(c) for c in docs.columns])
