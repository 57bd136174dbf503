import pytest

import corpus_pipeline
from __spark_entry__ import queries
from millrace.llm import jaccard, templates
from millrace.session import settle

from .cases import SF, Union, edges, empty, shingles, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


def test_every_operator_and_the_pipeline_are_registered():
    names = set(queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert list(STAGES) == ["language_id", "line_dedup", "jaccard_near_copies", "mixing", "best_fit_packing"]


@pytest.mark.parametrize("table", ["edges", "empty"])
def test_stages_on_edges(spark, table):
    docs = settle((edges if table == "edges" else empty)(spark))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != "best_fit_packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        before, docs = docs, settle(out)
        if table == "edges":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            assert kept <= {r.doc_id for r in before.select("doc_id").collect()}
            if name == "language_id":
                assert kept == {4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 15, 16, 17, None}
            if name == "jaccard_near_copies":
                assert kept == {4, 5, 6, 12, 14, 15, 16, 17, None} and docs.where("doc_id = 6").count() == 1
    assert (docs.count() > 0) == (table == "edges")


def test_near_copy_stage_keeps_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {r.doc_id: shingles(r.text, 5) for r in docs.collect()}
    union, items = Union(sets), list(sets.items())
    for k, (a, x) in enumerate(items):
        for b, y in items[:k]:
            both = len(x & y)
            if both and both * 100 >= 80 * (len(x) + len(y) - both):
                union.link(a, b)
    kept = [r.doc_id for r in STAGES["jaccard_near_copies"](spark, docs, SF).collect()]
    assert sorted(kept) == sorted({union.find(d) for d in sets})


def test_run_packs_what_the_stages_keep(spark):
    packed = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF))
    want = {}
    for r in docs.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + 1
    got = {}
    for r in packed:
        if r.piece == 0:
            got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want and all(len(words(r.text)) for r in docs.collect())
    assert packed and max(r.offset + r.length for r in packed) <= 1024


def test_operators_do_not_meet_in_other_modules():
    assert jaccard.near_copies.__module__ == "millrace.llm.jaccard" and templates.drop_lines.__module__ == "millrace.llm.templates"
