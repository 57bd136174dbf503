import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, nbsvm, secret_scan, text
from millrace.llm.queries import QUERIES
from millrace.llm.sampling import first_by_hash, remainder

from .cases import MORE, edges, empty, prose


def test_language_on_held_out_documents(spark):
    found = QUERIES["op1_language_id"](spark, MORE)
    lang = spark.read.parquet(f"{MORE}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").collect()
    assert len(rows) == lang.count()
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert 0.2 < len(held) / len(rows) < 0.3 and np.mean(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    docs = edges(spark)
    model = langid.train(docs, "text", "lang", "doc_id")
    rows = langid.predict(docs, model).collect()
    assert len(rows) == docs.count() and rows[0].asDict().keys() == set(docs.columns)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all((by_id[k].lang_pred, by_id[k].score) == ("und", 0.0) for k in (1, 2, 3, 13))
    assert by_id[14].lang_pred == "ja" and by_id[12].lang_pred == "fr"


def test_language_without_labels(spark):
    unknown = edges(spark).withColumn("lang", F.lit(None).cast("string"))
    rows = langid.predict(unknown, langid.train(unknown, "text", "lang", "doc_id"), keep=["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    model = langid.train(empty(spark), "text", "lang", "doc_id")
    assert langid.predict(empty(spark), model).collect() == []


def test_language_takes_little_memory(spark):
    docs = edges(spark)
    model = langid.train(docs, "text", "lang", "doc_id")
    sent = langid.predict(docs, model)._jdf.queryExecution().analyzed().children().head().output()
    assert sent.size() == len([c for c in docs.columns if c not in ("lang_pred", "score")])
    parts = [len(rows) for rows, _ in langid.ngrams([prose(150, 5)] * 2000, 1 << 16)]
    assert len(parts) > 2 and max(parts) < 1_000_000
    # A text of another type, or one that is not kept, is read all the same.
    plain = langid.predict(docs, model, keep=["doc_id"]).collect()
    as_bytes = langid.predict(docs.withColumn("text", F.col("text").cast("binary")), model).select("doc_id", "lang_pred", "score").collect()
    assert sorted(map(str, plain)) == sorted(map(str, as_bytes))


def test_workers_let_memory_go_after_the_last_batch(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    monkeypatch.setattr(text.pa, "default_memory_pool", Pool)
    found = list(text.pieces(iter([pa.record_batch({"text": ["ab", None, "c" * 9]})]), "text", 4))
    assert [b.num_rows for b in found] == [2, 1] and calls == [1]


def test_ngrams_stay_within_texts_and_cuts_do_no_harm():
    together = {r: sorted(g.tolist()) for r, g in _by_row(["Ab c", None, "é1f", "x"])}
    for row, text in enumerate(["Ab c", None, "é1f", "x"]):
        alone = dict(_by_row([text]))
        assert together.get(row) == (sorted(alone[0].tolist()) if alone else None)
    long = "word and another " * 200_000
    assert sum(len(g) for _, g in langid.ngrams([long], 1 << 16)) == 200_000 * sum(len(g) for _, g in langid.ngrams(["word and another"], 1 << 16))


def _by_row(texts):
    rows, grams = zip(*langid.ngrams(texts, 1 << 30))
    rows, grams = np.concatenate(rows), np.concatenate(grams)
    return [(r, grams[rows == r]) for r in np.unique(rows)]


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(5000).selectExpr("id as key", "if(id % 10 = 0, 'small', 'large') as kind").union(spark.sql("select null, 'large'"))
    taken = first_by_hash(rows, "kind", "key", 100)
    assert {r.kind: r["count"] for r in taken.groupBy("kind").count().collect()} == {"small": 100, "large": 100}
    again = first_by_hash(rows.repartition(7), "kind", "key", 100)
    assert taken.exceptAll(again).count() == 0


def test_remainder_matches_crc32(spark):
    import zlib

    rows = spark.range(50).select("id", remainder(F.col("id"), 4).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 4 for r in rows)


def test_quality_on_held_out_documents(spark):
    found = QUERIES["op9_quality_classifier"](spark, MORE)
    rows = found.join(spark.read.parquet(f"{MORE}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{MORE}/documents.parquet").count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    good, bad = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    assert np.mean([[g > b for g in good] for b in bad]) > 0.95
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9


def test_quality_edges(spark):
    docs = edges(spark)
    labels = spark.createDataFrame([(6, 1), (7, 1), (10, 1), (16, 0), (13, 0), (13, None), (None, 1), (99, 0)], "doc_id bigint, quality int")
    model = nbsvm.train(docs, labels)
    rows = nbsvm.score(docs, model).collect()
    by_id = {r.doc_id: r.score for r in rows if r.doc_id is not None}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert by_id[1] == by_id[2] == by_id[3] and by_id[6] == by_id[7]
    assert nbsvm.score(empty(spark), model).collect() == []


@pytest.mark.parametrize("wanted", ["quality = 1", "quality = 0", "false"])
def test_quality_with_one_class_or_none(spark, wanted):
    labels = spark.createDataFrame([(6, 1), (7, 1), (16, 0)], "doc_id bigint, quality int").where(wanted)
    scores = {r.score for r in nbsvm.score(edges(spark), nbsvm.train(edges(spark), labels), keep=["doc_id"]).collect()}
    share = {"quality = 1": 3 / 4, "quality = 0": 1 / 3, "false": 1 / 2}[wanted]
    assert len(scores) == 1 and scores.pop() == pytest.approx(share)


def test_margin_learns_a_rare_mark():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 500, 60)).astype(np.uint32) for _ in range(200)]
    labels = np.array([k % 4 != 0 for k in range(200)], int)
    rows = [np.append(r, [600]).astype(np.uint32) if not y else r for r, y in zip(rows, labels)]
    model = nbsvm.fit(rows, labels, 1024)
    low = nbsvm.margin(model.weights, np.array([3, 7, 600], np.uint32))
    assert low < nbsvm.margin(model.weights, np.array([3, 7], np.uint32)) and model.slope > 0


KEY = "dafbac99949115180e7593de87b4492bcef9890b"


def scanned(spark):
    rows = [(k, f"{prose(30, k)} token = \"{KEY[k:] + KEY[:k]}\" and {prose(20, 100 + k)}") for k in range(30)]
    rows += [(100 + k, f"{prose(30, k)} call 48451681144073{k:02d} or mail user{k}longname1@mail6.example.com {prose(20, k)}") for k in range(30)]
    rows += [(200, None), (201, ""), (202, "none here"), (None, f'secret = "{KEY}"'), (5, rows[5][1]), (300, "0123456789ab" * 9000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n": F.lit(1), "score": F.lit(2), "id": F.lit(3), "label": F.lit(1)})


def test_secrets_are_found_and_numbers_are_not(spark):
    docs = scanned(spark)
    found = secret_scan.scan(docs, size=500)
    rows = found.collect()
    secrets = [r for r in rows if r.is_secret]
    assert {r.doc_id for r in secrets} == {*range(30), None} and len([r for r in secrets if r.doc_id == 5]) == 2
    assert all(sorted(r.core) == sorted(KEY) for r in secrets)
    assert {r.doc_id for r in rows if not r.is_secret} >= {100 + k for k in range(30)}
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs, found).collect()}
    assert '"<secret>"' in clean[0] and KEY not in clean[0] and "48451681144073" in clean[100] and clean[200] is None


def test_every_match_of_a_word_is_a_candidate_with_its_own_name(spark):
    one, two, three = KEY[:20], KEY[20:] + "x1", "Zk" + KEY[5:25]
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkw.dozjgNryP4J3jVmNHl0w5N"
    rows = [(1, f'{{"id":"{one}","secret":"{two}","x":[1,2],"note":"{three}"}}'), (2, f"https://h.example/p?id={one}&token={two}&q=1"), (3, f"{one},{two},{three}"),
            (4, f"Server=db;User=me;Password=let&me{{in;Pooling=yes and more"), (5, 'password: "open sesame', ), (6, "the pwd = hunter and no more"), (7, jwt),
            (8, "Author: Smith wrote secretary: notes"), (9, '{"password":"p,a;s&s","n":1}'), (10, "db.password=a A a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = secret_scan.candidates(docs)
    cores = {}
    for r in found.orderBy("part", "m").collect():
        cores.setdefault(r.doc_id, []).append(r.core)
    assert cores == {1: [one, two, three], 2: [f"id={one}", two], 3: [one, two, three], 4: ["let&me{in"], 5: ["open"], 6: ["hunter"], 7: [jwt], 9: ["p,a;s&s"], 10: ["a"]}
    judged = {(r.doc_id, r.core): (r.named, r.assigned, r.address) for r in secret_scan.features(found, secret_scan.dictionary(docs)).collect()}
    assert judged[1, two] == (1, 1, 0) and judged[1, one][0] == judged[1, three][0] == 0
    assert judged[2, two] == (1, 1, 0) and judged[2, f"id={one}"][0] == 0
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs, found.withColumn("is_secret", F.lit(True))).collect()}
    assert clean[1] == '{"id":"<secret>","secret":"<secret>","x":[1,2],"note":"<secret>"}' and clean[9] == '{"password":"<secret>","n":1}'
    assert clean[10] == "db.password=<secret> A a" and clean[6] == "the pwd = <secret> and no more" and clean[8] == rows[7][1]


def test_secrets_of_tables_without_any(spark):
    docs = scanned(spark)
    assert secret_scan.scan(docs.where("false")).collect() == []
    assert secret_scan.scan(docs.where("doc_id in (200, 201, 202)")).collect() == []
    one_label = secret_scan.scan(docs.where("doc_id between 100 and 120")).collect()
    assert one_label and not any(r.is_secret for r in one_label)
