"""Pattern operators against the written-out rows and a brute-force matcher."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import patterns as P
from millrace.operators.sequences import Limits, Ordered

CUT, WHOLE = Limits(rows_per_task=10), Limits()

# Sensor readings (id, second, value).
SENSOR = [("s1", 1, 10), ("s1", 2, 20), ("s2", 3, 30), ("s1", 4, 40), ("s2", 5, 50), ("s1", 6, 60)]
SENSOR2 = [("s1", 1, 10), ("s1", 2, 20), ("s1", 3, 30), ("s2", 4, 30), ("s1", 4, 40), ("s2", 5, 50), ("s2", 6, 60)]
SENSOR3 = [("s1", 1, 10), ("s2", 4, 30), ("s1", 4, 40), ("s2", 5, 50)]


def readings(spark, rows):
    data = [(i + 1, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "n bigint, id string, t bigint, vc int")
    return Ordered(df, [], ["t", "n"])


def values(df, *columns):
    return sorted(tuple(list(v) if isinstance(v, list) else v for v in r) for r in df.select(*columns).collect())


S1, S2 = "id = 's1'", "id = 's2'"


def test_single(spark):
    assert values(P.single(readings(spark, SENSOR), S1), "t") == [(1,), (2,), (4,), (6,)]


def test_one_or_more_until(spark):
    got = P.one_or_more(readings(spark, SENSOR), S1, ["t"], until=F.col("vc") >= 40)
    assert values(got, "first_t", "last_t", "final_t", "n_matches") == [(1, 1, 2, 2), (2, 2, 2, 1)]


def test_next(spark):
    assert values(P.next_to(readings(spark, SENSOR), S1, S2, ["t"]), "first_t", "last_t") == [(2, 3), (4, 5)]


def test_greedy(spark):
    vc30 = F.col("vc") == 30
    got = P.loop_then_next(readings(spark, SENSOR2), S1, 2, 3, vc30, "n", greedy=True)
    assert values(got, "events", "then_id") == [([1, 2, 3], 4), ([2, 3], 4)]
    got = P.loop_then_next(readings(spark, SENSOR2), S1, 2, 3, vc30, "n")
    assert values(got, "events", "then_id") == [([1, 2], 3), ([1, 2, 3], 4), ([2, 3], 4)]


def test_optional(spark):
    got = P.loop_then_next(readings(spark, SENSOR), S1, 2, 2, S2, "n", optional=True)
    assert values(got, "events", "then_id") == [([], 3), ([], 5), ([1, 2], 3), ([2, 4], 5)]


def test_group(spark):
    got = P.group_times(readings(spark, SENSOR), S1, S2, "n", 2)
    assert values(got, "starts", "nexts") == [([2, 4], [3, 5])]


def test_within(spark):
    got = P.next_to(readings(spark, SENSOR3), S1, S2, ["t"], within=2)
    assert values(got, "first_t", "last_t") == [(4, 5)]


def test_login_failures(spark):
    data = [(i, 1035, kind, t) for i, (kind, t) in enumerate(
        [("success", 840), ("fail", 842), ("fail", 843), ("fail", 844)])]
    df = spark.createDataFrame(data, "n bigint, user_id bigint, kind string, t bigint")
    got = P.one_or_more(Ordered(df, ["user_id"], ["t", "n"]), F.col("kind") == "fail", ["t"],
                        at_least=2, consecutive=True, within=2)
    assert values(got, "first_t", "last_t", "final_t", "n_matches") == [(842, 843, 843, 1), (843, 844, 844, 1)]


def test_order_timeout(spark):
    data = [(1, 1, "create", 0), (2, 1, "pay", 100), (3, 2, "create", 0), (4, 2, "pay", 900),
            (5, 3, "create", 5), (6, 4, "pay", 7), (7, 5, "create", 0), (8, 5, "cancel", 3)]
    df = spark.createDataFrame(data, "n bigint, o bigint, kind string, t bigint")
    got = P.next_or_timeout(Ordered(df, ["o"], ["t", "n"]), F.col("kind") == "create",
                            F.col("kind") == "pay", ["t"], 900)
    rows = {(r["o"], r["tag"], r["last_t"]) for r in got.collect()}
    assert rows == {(1, "match", 100), (2, "timeout", None), (3, "timeout", None)}


# -- brute force -----------------------------------------------------------------


def make_rows(seed, keys):
    rng = random.Random(seed)
    t, rows = 0, []
    for i in range(160):
        t += rng.choice([0, 1, 1, 3])
        rows.append((i, rng.choice(keys), rng.choice("aaabbcx"), t))
    return rows


def per_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[3], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups.values()


def loops(group, fits, stop, consecutive, relaxed_any=False):
    """Every list of row places a loop can take, by start."""
    for s, row in enumerate(group):
        if not fits(row) or stop(row):
            continue
        taken = [s]
        yield list(taken)
        for j in range(s + 1, len(group)):
            if stop(group[j]) or (consecutive and not fits(group[j])):
                break
            if fits(group[j]):
                taken.append(j)
                yield list(taken)


A, B, C = (lambda r: r[2] == "a"), (lambda r: r[2] == "b"), (lambda r: r[2] == "c")
never = lambda r: False
COL = {k: f"kind = '{k}'" for k in "abcx"}


@pytest.fixture(scope="module", params=[(1, ["k"], CUT), (2, ["k", "l", "m"], WHOLE), (3, ["k"] * 8 + ["l"], CUT)])
def case(request, spark):
    seed, keys, limits = request.param
    rows = make_rows(seed, keys)
    df = spark.createDataFrame(rows, "n bigint, k string, kind string, t bigint").repartition(3)
    return rows, Ordered(df, ["k"], ["t", "n"], limits)


@pytest.mark.parametrize("until,consecutive,within,least", [
    (False, False, None, 1), (True, False, None, 2), (False, True, None, 2), (True, False, 6, 1), (False, True, 3, 2)])
def test_open_loops(case, until, consecutive, within, least):
    rows, seq = case
    want = {}
    for group in per_key(rows):
        for m in loops(group, A, C if until else never, consecutive):
            first, last = group[m[0]], group[m[-1]]
            if len(m) >= least and (within is None or last[3] - first[3] < within):
                want.setdefault(first[0], []).append(last[0])
    got = P.one_or_more(seq, COL["a"], ["n"], least, COL["c"] if until else None, consecutive, within)
    got = {r["first_n"]: (r["last_n"], r["final_n"], r["n_matches"]) for r in got.collect()}
    assert got == {s: (e[0], e[-1], len(e)) for s, e in want.items()}


@pytest.mark.parametrize("least,most,until,consecutive,within", [
    (2, 2, False, False, None), (2, 4, False, False, 9), (2, 3, True, False, None), (1, 3, False, True, None)])
def test_times(case, least, most, until, consecutive, within):
    rows, seq = case
    want = []
    for group in per_key(rows):
        for m in loops(group, A, C if until else never, consecutive):
            if least <= len(m) <= most and (within is None or group[m[-1]][3] - group[m[0]][3] < within):
                want.append([group[i][0] for i in m])
    got = P.times(seq, COL["a"], "n", least, most, COL["c"] if until else None, consecutive, within)
    assert sorted(r["events"] for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("within", [None, 4])
def test_contiguity(case, within):
    rows, seq = case
    strict, relaxed, free, combos, nots = [], [], {}, {}, []
    near = lambda a, b: within is None or b[3] - a[3] < within
    for g in per_key(rows):
        for i, r in enumerate(g):
            if not A(r):
                continue
            if i + 1 < len(g) and B(g[i + 1]):
                if near(r, g[i + 1]):
                    strict.append((r[0], g[i + 1][0]))
            else:
                nots.append((r[0],))
            later = [x for x in g[i + 1:] if B(x)]
            if later and near(r, later[0]):
                relaxed.append((r[0], later[0][0]))
            ends = [x[0] for x in later if near(r, x)]
            if ends:
                free[r[0]] = (ends[0], ends[-1], len(ends))
            ends = [x[0] for x in g[i + 1:] if A(x) and near(r, x)]
            if ends:
                combos[r[0]] = (ends[0], ends[-1], len(ends))
    a, b = COL["a"], COL["b"]
    assert values(P.next_to(seq, a, b, ["n"], within), "first_n", "last_n") == sorted(strict)
    assert values(P.followed_by(seq, a, b, ["n"], within), "first_n", "last_n") == sorted(relaxed)
    assert values(P.not_next(seq, a, b, ["n"]), "first_n") == sorted(nots)
    for got, want in ((P.followed_by_any(seq, a, b, ["n"], within), free),
                      (P.combinations(seq, a, ["n"], within), combos)):
        assert {r["first_n"]: (r["last_n"], r["final_n"], r["n_matches"]) for r in got.collect()} == want


def test_loop_then_next(case):
    rows, seq = case
    every = []
    for g in per_key(rows):
        for m in loops(g, A, never, False):
            end = m[-1] + 1
            if 2 <= len(m) <= 3 and end < len(g) and B(g[end]):
                every.append(([g[i][0] for i in m], g[end][0]))
    got = P.loop_then_next(seq, COL["a"], 2, 3, COL["b"], "n")
    assert values(got, "events", "then_id") == sorted(every)
    longest = [max(ms, key=lambda m: len(m[0])) for _, ms in itertools.groupby(sorted(every), key=lambda m: m[0][0])]
    got = P.loop_then_next(seq, COL["a"], 2, 3, COL["b"], "n", greedy=True)
    assert values(got, "events", "then_id") == sorted(longest)


@pytest.mark.parametrize("first,then", ["ab", "aa"])
def test_groups(case, first, then):
    rows, seq = case
    want = []
    for g in per_key(rows):
        pairs = [i for i in range(len(g) - 1) if g[i][2] == first and g[i + 1][2] == then]
        for at in pairs:
            chain = [at]
            for i in pairs:
                if i > chain[-1] + 1 and len(chain) < 3:
                    chain.append(i)
            if len(chain) == 3:
                want.append(([g[i][0] for i in chain], [g[i + 1][0] for i in chain]))
    got = P.group_times(seq, COL[first], COL[then], "n", 3)
    assert values(got, "starts", "nexts") == sorted(want)
