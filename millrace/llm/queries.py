"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import align, jaccard, langid, mixing, nbsvm, nra, packing, rabitq, rules, secret_scan, spelling, templates, token_files
from .sampling import remainder
from .tokens import PIECE_BPE, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.train(docs.where(~held_out), "text", "lang", "doc_id")
    found = langid.predict(docs, model, "text", keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.by_position(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


sql("op2_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':7') AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS most FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER earlier, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM weighed
  WINDOW earlier AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + size / 2.0::DOUBLE AS middle
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       CAST(size * ((middle < target)::INT + (middle + source_size < target)::INT) AS BIGINT) AS taken
FROM placed
""")


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents"), size=4, percent=85)


@query
def op4_embedding_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_copies(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.check(table(spark, sf_dir, "documents")).drop("clean_text")


sql("op5_quality_rules", r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t),
runs AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY r ORDER BY i))
  WHERE c IS NOT NULL),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM runs CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
lines AS (
  SELECT r, source, text, line, regexp_replace(translate(regexp_replace(line, '\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z', '', 'g'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS plain,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
frequent AS (SELECT source, plain FROM lines GROUP BY source, plain HAVING count(DISTINCT text) > 10),
per_text AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines,
         coalesce(sum(n) FILTER (WHERE EXISTS (SELECT 1 FROM frequent f WHERE f.source IS NOT DISTINCT FROM l.source AND f.plain = l.plain)), 0) AS lost
  FROM lines l GROUP BY r),
counts AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, len(w) - CAST(coalesce(lost, 0) AS BIGINT) AS n_left_words
  FROM t LEFT JOIN repeats USING (r) LEFT JOIN per_text USING (r))
SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
       NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND n_left_words >= n_words * 0.5 AS kept
FROM counts
""")


@query
def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped_lines")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).select("doc_id", "n", "core", "score", "is_secret")


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=0)
    return token_files.digest(token_files.read(spark, path))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = nbsvm.train(docs, labels.where(~held_out))
    found = nbsvm.score(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=2)


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECE_BPE))


@query
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


sql("op12_exact_top_k", r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.r <> v.r WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id ASC NULLS LAST) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
""")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


sql("op13_spelling_variants", r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
coded AS (
  SELECT run, flatten(list_transform(string_split(head || run, ''),
           lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS bytes
  FROM runs WHERE length(run) >= 7),
hashed AS (
  SELECT run, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM coded, crc),
typed AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
places AS (SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words),
cut AS (SELECT word, n, word[1:i] AS head, word[i + 2:] AS tail FROM places WHERE i < length(word)),
split AS (SELECT word, n, word[1:i] AS head, word[i + 1:] AS tail FROM places),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b USING (head, tail) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN split b USING (head, tail)
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN split b USING (head, tail)),
ranked AS (
  SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place FROM pairs),
known AS (
  SELECT w.word, CASE WHEN r.n >= 10 * w.n THEN r.near END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
steps AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT s.word, k.form FROM steps s JOIN known k ON s.root = k.word WHERE k.form IS NOT NULL)
SELECT known.*, root FROM known JOIN steps USING (word)
WHERE root NOT IN (SELECT word FROM known WHERE form IS NOT NULL)
""")
