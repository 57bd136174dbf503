"""Groups by min-hashes against Jaccard similarities worked out pair by pair."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import alike


def words(seed, n):
    drawn = random.Random(seed)
    return ["".join(drawn.choices("abcdefghij", k=6)) for _ in range(n)]


def edited(base, seed, edits):
    drawn, out = random.Random(seed), list(base)
    for k in drawn.sample(range(len(out)), edits):
        out[k] = f"new{seed}x{k}"
    return out


def shingles(text, size=5):
    w = text.lower().split()
    return {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()


def jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def grouped(spark, texts, **kwargs):
    rows = spark.createDataFrame(list(enumerate(texts)), "c1 bigint, text string")
    return {r.c1: r.copies for r in alike.groups(rows, **kwargs).collect()}


def test_copies_meet_and_texts_around_one_passage_do_not(spark):
    copies = [" ".join(edited(words(f"base {g}", 200), 1000 * g + k, 2)) for g in range(20) for k in range(6)]
    passage = words("passage", 100)
    shared = [" ".join(passage + words(f"own {k}", 100)) for k in range(300)]  # similarity 1/3 to each other
    got = grouped(spark, copies + shared)
    for g in range(20):
        members = range(6 * g, 6 * g + 6)
        assert min(jaccard(copies[a], copies[b]) for a in members for b in members) >= 0.8
        assert len({got[k] for k in members}) == 1
    assert len({got[6 * g] for g in range(20)}) == 20
    assert not set(range(120, 420)) & set(got)


def test_links_follow_similarity(spark):
    """At the similarity asked for nearly all pairs meet; at half of it none do."""
    at, below = [], []
    for k in range(200):
        base = words(k, 100)
        at += [" ".join(base), " ".join(edited(base, k, 2))]
        below += [" ".join(base[:70] + words(f"{k} left", 30)), " ".join(base[:70] + words(f"{k} right", 30))]
    assert all(jaccard(*at[2 * k : 2 * k + 2]) >= 0.8 for k in range(200))
    assert all(jaccard(*below[2 * k : 2 * k + 2]) < 0.55 for k in range(200))
    got = grouped(spark, at)
    assert sum(got.get(2 * k, -1) == got.get(2 * k + 1, -2) for k in range(200)) >= 198
    assert len(set(got.values())) * 2 == len(got)
    assert grouped(spark, below) == {}


def test_minima_estimate_similarity():
    a, b = " ".join(words(1, 400)), " ".join(words(1, 300) + words(2, 100))
    low = alike._minima(*alike._shingles(pa.array([a, None, b, "", "one two"]), 5))
    assert low.shape == (3, 256)
    assert abs(np.mean(low[0] == low[1]) - jaccard(a, b)) < 0.1
    assert np.mean(low[0] == low[2]) == 0


def test_odd_texts(spark):
    long = " ".join(words("long", 200_000))
    got = grouped(spark, [None, "", " \t\n", "Two words", "two  WORDS", "other words", long, long + " end"])
    assert set(got) == {3, 4, 6, 7} and got[3] == got[4] and got[6] == got[7]
    assert grouped(spark, []) == {}
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, "a b c")], "c1 bigint, text string").withColumn("b", F.lit(1))
    wanted = spark.createDataFrame([(1,), (2,), (2,)], "c1 bigint")
    assert {r.c1 for r in alike.groups(twice, wanted=wanted).collect()} == {1, 2}


@pytest.mark.parametrize("size", [1, 5])
def test_shingles_are_those_of_each_text(size):
    texts = ["a b c d e f g", None, "a b", "A B C D E F G", "", "b c d e f"]
    values, counts = alike._shingles(pa.array(texts), size)
    at = np.concatenate([[0], np.cumsum(counts)])
    sets = [set(values[at[k] : at[k + 1]].tolist()) for k in range(len(texts))]
    assert [len(s) for s in sets] == [len(shingles(t or "", size)) for t in texts]
    assert sets[0] == sets[3] and len(sets[0] & sets[5]) == len(shingles(texts[0], size) & shingles(texts[5], size))
