import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import spelling

from .cases import edge_rows, edges, empty


def vocabulary(rows, least_length=7, one_in=31):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= least_length
    return {w: k for w, k in n.items() if k >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    rows, form = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
        rows[w] = (n[w], len(others))
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        yield (w, form[w], root, *rows[w], n[form[w]] if form[w] else None)


def compare(spark, n):
    words = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(3)
    got = spelling.variants(words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(n))


def test_small_alphabet(spark):
    """Many near words, runs of equal letters, ties, and forms of forms."""
    pick = random.Random(2)
    n = {"".join(pick.choice("abé") for _ in range(pick.randint(1, 6))): 10 ** pick.randint(0, 4) * pick.randint(1, 2) for _ in range(400)}
    compare(spark, n)


def test_paths(spark):
    chain = {"a" * k + "b": 10**k for k in range(1, 12)}  # each the form of the one before
    compare(spark, chain | {"zzzzzzz": 5, "ÿ×÷àààà": 3, "ÿ×÷ààà": 30, "x": 1})


def test_vocabulary(spark):
    rows = [(r[0], r[1]) for r in edge_rows()] + [(1, "Straße STRASSE straße ÀÉÎÕÜ àéîõü Émaillées émaillées"), (2, "longword1longword LONGWORDs longword's longword")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("word", "n", "run", "id", "prefix")})
    for options in ({}, {"one_in": 2}, {"least_length": 1, "one_in": 3}):
        got = spelling.vocabulary(docs, **options)
        assert {r["word"]: r["n"] for r in got.collect()} == vocabulary(rows, options.get("least_length", 7), options.get("one_in", 31))


def test_edges(spark):
    found = {tuple(r) for r in spelling.variants(spelling.vocabulary(edges(spark))).collect()}
    assert found == set(brute(vocabulary([(r[0], r[1]) for r in edge_rows()])))
    assert spelling.variants(spelling.vocabulary(empty(spark))).collect() == []
