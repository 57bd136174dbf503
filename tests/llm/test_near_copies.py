import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import graph, jaccard, rabitq

from .cases import SF, Union, edges, empty, prose, shingles


def brute(texts, size, percent):
    sets = {d: shingles(t, size) for d, t in texts}
    union, items = Union(sets), list(sets.items())
    for k, (a, x) in enumerate(items):
        for b, y in items[:k]:
            both = len(x & y)
            if x and y and both * 100 >= percent * (len(x) + len(y) - both):
                union.link(a, b)
    return {d: (len(s), union.find(d)) for d, s in sets.items()}


def found(df, **how):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_copies(df, **how).collect()}


def family(seed, members, base_words=60):
    """Copies of one text with a few words changed, some of them a little too many."""
    pick, base = random.Random(seed), prose(base_words, seed).split()
    out = []
    for k in range(members):
        w = list(base)
        for _ in range(pick.choice([0, 1, 1, 2, 3])):
            w[pick.randrange(len(w))] = f"x{seed}y{k}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("size", "percent", "common"), [(4, 85, 64), (4, 85, 2), (5, 80, 1), (1, 50, 3)])
def test_same_as_brute_force(spark, size, percent, common):
    shared = prose(55, 99).replace("\n", " ")
    texts = [t for s in range(4) for t in family(s, 14)] + [prose(40, 50 + k) + "\n" + shared + "\n" + prose(30, 80 + k) for k in range(12)]
    texts += ["a b c d", "A  B\nC\tD", "a b", "a b", "", None, shared, shared + " end"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df, size=size, percent=percent, common=common) == brute(rows, size, percent)


def test_classes_with_the_same_first_shingles_each_have_their_links(spark):
    def h(word):
        return int(next(jaccard._sets(pa.array([word]), 1))[0])

    base = sorted((f"b{k}" for k in range(40)), key=h)
    head, tail = base[:12], base[12:]  # the first 12 of 40 are looked at; all are common
    own = iter(w for w in (f"own{k}" for k in range(10_000)) if h(w) > h(head[-1]))
    texts = [" ".join(head + [next(own) for _ in tail])]  # smallest id of its group, and unlike the others
    for k in range(150):
        pick = random.Random(k)
        x = head + pick.sample(tail, 24) + [next(own) for _ in range(4)]
        y = list(x)
        y[pick.randrange(12)] = next(own)
        texts += [" ".join(x), " ".join(y)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df, size=1, percent=85, common=64) == brute(rows, 1, 85)


def test_long_lists_make_few_pairs(spark, monkeypatch):
    """Variants of one passage, made of common shingles, are not all tried against each other, list by list."""
    pick, base, texts = random.Random(5), prose(240, 5).split(), []
    for k in range(160):
        w = list(base)
        for _ in range(pick.choice([4, 5, 6])):
            w[pick.randrange(len(w))] = f"own{k}"
        texts.append(" ".join(w))
    rows, made, distinct = list(enumerate(texts)), [], jaccard._distinct

    def counted(pairs):
        made.append(pairs.count())
        return distinct(pairs)

    monkeypatch.setattr(jaccard, "_distinct", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df, size=4, percent=85, common=16) == brute(rows, 4, 85)
    on_lists = made[1:]  # the first ones share uncommon shingles
    assert on_lists and sum(on_lists) < 160 * 159 // 2 and on_lists[-1] < 800


def test_steps_leave_long_shuffles_behind(spark, monkeypatch):
    texts = [prose(60, k // 3) + " end" * (k % 3) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    pairs, sets, written = [], [], jaccard.settle

    def watched(df):
        plan = df._jdf.queryExecution()
        if "bit_count" in plan.optimizedPlan().toString():
            pairs.append(plan.optimizedPlan().toString())
        if df.columns == ["class", "n", "shingles"]:
            sets.append(plan.executedPlan().toString())
        return written(df)

    monkeypatch.setattr(jaccard, "settle", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jaccard.near_copies(docs).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # All first shingles are not shuffled in the step that shuffles lists with their facts, whole sets only once.
    assert pairs and not any("explode(head" in plan for plan in pairs)
    assert sets and not any("hashpartitioning(class#" in plan for plan in sets)


def test_documents_same_as_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert found(df) == brute(rows, 4, 85)


def test_edges(spark):
    rows = jaccard.near_copies(edges(spark)).collect()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == edges(spark).count()
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert [by_id[k].component_id for k in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert {by_id[k].component_id for k in (6, 7, 8, 9, 10, 11)} == {6}
    assert {by_id[k].class_id for k in (6, 7, 8, 9)} == {6} and by_id[11].class_id == 10
    assert by_id[12].n_shingles > 59_000
    assert [r.component_id for r in rows if r.doc_id is None] == [None, None]
    assert jaccard.near_copies(empty(spark)).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(7, 7), (5000, 4999)]
    random.Random(1).shuffle(chain)
    roots = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert len({roots[k] for k in range(301)}) == 1 and len({roots[1000 + k] for k in range(200)}) == 1
    assert len(set(roots.values())) == 3 and len(roots) == 503
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_rounds_over_few_edges_need_no_shuffles(spark, monkeypatch):
    chain = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 20)]
    edges = spark.createDataFrame(chain, "a bigint, b bigint").repartition(3)
    plans, written = [], graph.settle

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df)

    monkeypatch.setattr(graph, "settle", watched)
    few = {tuple(r) for r in graph.components(edges).collect()}
    assert len(plans) > 2 and not any("hashpartitioning" in plan for plan in plans[1:])
    plans.clear()
    monkeypatch.setattr(graph, "_FEW", 0)
    assert few == {tuple(r) for r in graph.components(edges).collect()} and "hashpartitioning" in plans[1]
    assert len({root for _, root in few}) == 2 and len(few) == 81


def vectors():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 24))
    near = np.repeat(base, 8, axis=0) + rng.standard_normal((320, 24)) * 0.12
    dense = rng.standard_normal(24) + rng.standard_normal((120, 24)) * 0.05
    x = np.concatenate([base, near, dense, dense[:5]]).astype(np.float32)
    return [(k, [float(c) for c in v], k % 2 if k % 7 else 0) for k, v in enumerate(x)]


def brute_vectors(rows, threshold):
    union, links = Union([r[0] for r in rows]), {r[0]: 0 for r in rows}
    for k, (a, x, la) in enumerate(rows):
        for b, y, lb in rows[:k]:
            if la == lb and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                union.link(a, b)
                links[a] += 1
                links[b] += 1
    return {d: (n, union.find(d), union.find(d) == d) for d, n in links.items()}


@pytest.mark.parametrize("block", [512, 16])
def test_vectors_same_as_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rabitq.near_copies(df, block=block, recall=0.9999).collect()}
    assert got == brute_vectors(rows, 0.98)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = 0.9 * x + 0.2 * rng.standard_normal((300, 64)) / 8
    errors, outside = [], 0
    for seed in range(20):
        turn = rabitq.rotation(64, seed)
        rx, ry = x @ turn, y @ turn
        code = np.where(rx > 0, 1, -1) / 8
        factor = (code * rx).sum(axis=1)
        error = (code * ry).sum(axis=1) / factor - (x * y).sum(axis=1)
        errors.append(error)
        outside += (np.abs(error) > 4 * np.sqrt((1 - factor**2) / factor**2 / 63)).sum()
    assert abs(np.mean(errors)) < 0.005 and outside == 0


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 1.0], None),
            (8, [1.0, 1.0], None), (9, [2.0, 2.0], 1), (10, [1.0, 1.0], 1), (10, [1.0, 1.0], 1), (11, [1.0, 1.0], 2), (12, [1.0, 1.0, 0.0], 1), (None, [3.0, 3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("n", "class", "keys", "v", "root")})
    out = rabitq.near_copies(df).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    assert len(out) == len(rows)
    assert all(got[k] == (0, k, True) for k in (1, 2, 3, 4, 5, 6, 7, 8, 11, 12))
    assert got[9] == (3, 9, True) and got[10] == (3, 9, False) and got[None][:2] == (3, 9)
    assert rabitq.near_copies(df.where("false")).collect() == []
