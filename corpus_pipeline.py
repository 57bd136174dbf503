"""From raw documents to packed training sequences, in stages that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import jaccard, langid, mixing, packing, templates
from millrace.llm.sampling import remainder
from millrace.llm.tokens import tokenizer_path
from millrace.session import bounded_batches, settle


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column has."""
    while name in map(str.lower, docs.columns):
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter, and those no language suits, go."""
    bounded_batches(spark)
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.train(docs.where(~held_out), "text", "lang", "doc_id")
    name, score = _free(docs, "language"), _free(docs, "score")
    found = langid.predict(docs, model, names=(name, score))
    return found.where((F.col(name) != langid.UNKNOWN) & (F.col(score) >= 0.5)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of templates that recur across texts; n_chars follows the text."""
    shown = {c: _free(docs, f"own_{c}") for c in ("n_lines", "n_dropped_lines")}
    found = templates.drop_lines(docs.withColumnsRenamed(shown))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_dropped_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(shown.get(c, c)).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by similar texts the one with the smallest id.

    Five words to a shingle, similarity 0.8. Rows without an id cannot be named
    in a link and stay; of rows equal in id and text one stays.
    """
    found = jaccard.near_copies(docs, size=5, percent=80)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    stay = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    one, two = _free(docs, "h1"), _free(docs, "h2")
    marked = stay.withColumns({one: F.xxhash64("text"), two: F.xxhash64(F.lit(1), "text")})
    return marked.dropDuplicates(["doc_id", one, two]).select(docs.columns).unionByName(docs.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, as often as it takes them, in the order of training."""
    own = _free(docs, "own")
    mixed = mixing.mix(docs.withColumn(own, F.struct(docs.columns)), carry=[own])
    return mixing.in_training_order(mixed).select(*[F.col(own)[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of every document, with its place in a sequence of 1024 tokens.

    Small batches, as the stages before leave less memory to the workers.
    """
    bounded_batches(spark)
    return packing.pack(docs, tokenizer_path(), capacity=1024, end_id=2, batch_bytes=2 << 20)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("jaccard_near_copies", near_copies),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

# Language, packing and similarity are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else settle(docs), sf_dir)
    return docs
