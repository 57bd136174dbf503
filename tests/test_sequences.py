"""The cut form of every sequence primitive equals the plain window."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, over, topk, windows
from millrace.operators.sequences import Limits, Ordered

CUT, WHOLE = Limits(rows_per_task=10), Limits()
SCHEMA = "k string, t bigint, id bigint, v bigint"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(600):
        k = rng.choice(["hot"] * 6 + ["warm", "warm", None, f"cold{i % 40}"])
        v = None if rng.random() < 0.1 else rng.randrange(50)
        data.append((k, rng.randrange(150), i, v))
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def bursts(spark):
    """A key with most rows in one instant, some without a time."""
    rng = random.Random(3)
    times = [None] * 60 + [5] * 300 + [rng.randrange(10**9) for _ in range(60)] + [10**12]
    return spark.createDataFrame(
        [("hot" if i % 5 else "warm", t, i, rng.randrange(9)) for i, t in enumerate(times)], SCHEMA)


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    key = lambda r: tuple(str(x) for x in r)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("mode", ["rows", "before", "ties"])
def test_running(rows, keys, reverse, mode):
    kinds = {k: (k, "v") for k in ("sum", "count", "max", "min", "latest")}
    if mode == "rows":
        kinds["first"] = ("first", F.struct("id", "v"))
    how = {"reverse": reverse, "inclusive": mode != "before", "ties": mode == "ties"}
    if mode == "ties":
        del kinds["latest"]  # not defined among equal times
    want = Ordered.whole(rows, keys, ["t", "id"])
    got = Ordered(rows, keys, ["t", "id"], CUT)
    assert got.is_cut and not want.is_cut
    same(got.running(kinds, **how).drop("_slice"), want.running(kinds, **how))


@pytest.mark.parametrize("keys", [["k"], []])
def test_frames(rows, keys):
    def columns(w):
        return {
            "a": F.sum("v").over(w.rowsBetween(-3, 0)),
            "b": F.lag("v", 2).over(w),
            "c": F.lead("id").over(w),
        }

    want = Ordered.whole(rows, keys, ["t", "id"])
    got = Ordered(rows, keys, ["t", "id"], CUT)
    same(got.framed(columns, before=3, after=1).drop("_slice"), want.framed(columns, before=3, after=1))

    for inclusive in (True, False):
        asked = {"a": ("sum", "v"), "n": ("count", "v"), "l": ("latest", "id")}
        time = F.col("t") - 7
        same(got.as_of(time, asked, inclusive), want.as_of(time, asked, inclusive))


@pytest.mark.parametrize(
    "make",
    [
        lambda d, l: topk.top3_running(d, ["k"], ["t", "id"], "v", l),
        lambda d, l: aggregates.retract_changelog(d, ["k"], ["t", "id"], "v", l),
        lambda d, l: aggregates.distinct_running(d.where("v is not null"), "v", ["t", "id"], limits=l),
        lambda d, l: aggregates.rising_alarm(d, ["k"], ["t", "id"], "v", 3, l),
        lambda d, l: aggregates.running_average(d, ["k"], ["t", "id"], "v", limits=l),
        lambda d, l: over.over_range(d, ["k"], ["t", "id"], 5, {"s": ("sum", "v"), "n": ("count", "v")}, l),
        lambda d, l: over.over_unbounded(d, ["k"], ["t", "id"], {"s": ("sum", "v")}, l),
        lambda d, l: windows.count_tumble(d, ["k"], ["t", "id"], 5, {"s": ("sum", "v")}, ["id"], l),
        lambda d, l: windows.count_slide(d, ["k"], ["t", "id"], 5, 2, {"s": ("sum", "v")}, l),
    ],
)
def test_operators_agree(rows, make):
    same(make(rows, CUT), make(rows, WHOLE))


@pytest.mark.parametrize("gap", [2_000_000, "gap"])
def test_session_agrees(rows, gap):
    timed = rows.where("k is not null").select(
        "k", F.timestamp_seconds(F.col("t") * 3).alias("ts"), "v",
        ((F.col("id") % 4 + 1) * 1_000_000).alias("gap"),
    )
    aggs = {"n": ("count", F.lit(1)), "s": ("sum", "v")}
    same(
        windows.session(timed, ["k"], "ts", gap, aggs, CUT),
        windows.session(timed, ["k"], "ts", gap, aggs, WHOLE),
    )


def largest_slice(seq):
    return seq.df.groupBy(*seq.keys, "_slice").count().agg(F.max("count")).first()[0]


def test_bursts_are_cut(spark):
    rows = bursts(spark)
    got = Ordered(rows, ["k"], ["t", "id"], CUT)
    assert largest_slice(got) <= 20
    kinds = {"s": ("sum", "v"), "f": ("first", "id"), "l": ("latest", "v")}
    for reverse in (False, True):
        want = Ordered.whole(rows, ["k"], ["t", "id"]).running(kinds, reverse=reverse)
        same(got.running(kinds, reverse=reverse).drop("_slice"), want)
    lead = lambda w: {"n": F.lead("id", 2).over(w)}
    same(got.framed(lead, after=2).drop("_slice"), Ordered.whole(rows, ["k"], ["t", "id"]).framed(lead, after=2))
    ranged = {"s": ("sum", "v"), "n": ("count", "v")}
    same(over.over_range(rows, ["k"], ["t", "id"], 10, ranged, CUT), over.over_range(rows, ["k"], ["t", "id"], 10, ranged, WHOLE))
    totals = {"s": ("sum", "v")}
    same(over.over_unbounded(rows, ["k"], ["t", "id"], totals, CUT), over.over_unbounded(rows, ["k"], ["t", "id"], totals, WHOLE))


def test_one_instant_with_text_ties_is_cut(spark):
    rows = spark.createDataFrame([("one", 5, f"{i % 7}-{i}", i) for i in range(2000)], "k string, t bigint, tie string, v bigint")
    got = Ordered(rows, ["k"], ["t", "tie"], Limits(rows_per_task=50))
    assert largest_slice(got) <= 100
    same(got.running({"s": ("sum", "v")}).drop("_slice"), Ordered.whole(rows, ["k"], ["t", "tie"]).running({"s": ("sum", "v")}))


def test_every_large_key_is_cut(spark):
    rows = spark.range(12_000).selectExpr("id % 30 AS k", "id AS t", "id AS id")
    got = Ordered(rows, ["k"], ["t", "id"], Limits(rows_per_task=50))
    assert largest_slice(got) <= 100
    assert got.df.select("k", "_slice").distinct().groupBy("k").count().where("count < 4").count() == 0


def test_a_burst_inside_a_frame_is_no_large_task(spark):
    rows = spark.createDataFrame([("a", 100 + i % 3, i, 1) for i in range(1900)] + [("a", 1, 5000, 1)], SCHEMA)
    limits = Limits(rows_per_task=50)
    seq = Ordered(rows, ["k"], ["t", "id"], limits)
    assert largest_slice(seq) <= 100
    same(over.over_range(rows, ["k"], ["t", "id"], 50, {"s": ("sum", "v")}, limits),
         over.over_range(rows, ["k"], ["t", "id"], 50, {"s": ("sum", "v")}, WHOLE))


def test_session_of_a_large_key_with_one_tiny_gap(spark, capsys):
    rows = spark.range(2000).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 3).alias("ts"),
                                    F.when(F.col("id") == 7, 1000).otherwise(5_000_000).cast("bigint").alias("gap"), F.lit(1).alias("v"))
    aggs = {"n": ("count", F.lit(1))}
    cut = windows.session(rows, ["k"], "ts", "gap", aggs, Limits(rows_per_task=50))
    same(cut, windows.session(rows, ["k"], "ts", "gap", aggs, WHOLE))
    cut.explain("formatted")
    assert "session_window" not in capsys.readouterr().out


@pytest.mark.parametrize("limits", [CUT, WHOLE])
def test_top3_by_hand(spark, rows, limits):
    best, want = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r["t"], r["id"])):
        kept = best.setdefault(r["k"], [])
        if r["v"] is not None:
            best[r["k"]] = kept = sorted([*kept, r["v"]], reverse=True)[:3]
        want[r["id"]] = tuple([*kept, None, None, None][:3])
    got = topk.top3_running(rows, ["k"], ["t", "id"], "v", limits)
    assert {r["id"]: (r["top1"], r["top2"], r["top3"]) for r in got.collect()} == want


def alike(a, b):
    """Equal with NaN equal to itself, doubles to nine digits."""
    plain = lambda df: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())
    assert plain(a) == plain(b)


@pytest.mark.parametrize("kind, values", [
    ("double", [float("nan"), 0.1, 0.5, 2.1, 9.3, 2.1, float("inf"), 1.0, 0.25, None, 3.0]),
    ("bigint", [2**62, 2**61, -(2**62), 2**62 - 1, 5, 2**62, 1, None, 2, 3, 2**62]),
])
@pytest.mark.parametrize("step, preceding", [(1, 0), (4, 5), (3, 3), (1, 4)])
def test_range_frames_do_not_subtract(spark, kind, values, step, preceding):
    """A NaN or a value near the limit of its type stays within its frames, cut or not."""
    rows = [("k", None if k == 8 else k // 2 * step, k, v) for k, v in enumerate(values * 4)]
    df = spark.createDataFrame(rows, f"k string, t bigint, id int, v {kind}")
    if kind == "bigint" and preceding >= step:
        df = df.withColumn("v", (F.col("v") / 16).cast("bigint"))  # several large values in a frame
    wanted = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v")}
    if kind == "bigint" and preceding == 0:
        wanted.pop("s")
    alike(over.over_range(df, ["k"], ["t", "id"], preceding, wanted, Limits(rows_per_task=6)),
          over.over_range(df, ["k"], ["t", "id"], preceding, wanted, WHOLE))


@pytest.mark.parametrize("kind, preceding", [("double", 3), ("double", 1), ("decimal(9,2)", 3), ("timestamp", 2_500_000), ("int", 7)])
def test_range_frames_over_any_time(spark, kind, preceding):
    pick = random.Random(preceding)
    rows = [(pick.choice("ab"), None if k % 17 == 0 else pick.randint(-400, 400) / 10, k, k % 7) for k in range(300)]
    df = spark.createDataFrame(rows, "k string, t double, id int, v int").withColumn("t", F.col("t").cast(kind))
    wanted = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "id"), "hi": ("max", "id")}
    alike(over.over_range(df, ["k"], ["t", "id"], preceding, wanted, Limits(rows_per_task=20)),
          over.over_range(df, ["k"], ["t", "id"], preceding, wanted, WHOLE))


def test_one_long_run_of_alarms(spark):
    """A key that only rises: many alarms on one path, found in log rounds."""
    rows = spark.range(700).select(F.lit("k").alias("k"), (F.col("id") * 3 + F.col("id") % 2).alias("t"), "id", F.col("id").alias("v"))
    rows = rows.unionByName(rows.limit(3).withColumn("k", F.lit(None)))
    for hold in (7, 400):
        cut = aggregates.rising_alarm(rows, ["k"], ["t", "id"], "v", hold, Limits(rows_per_task=40))
        same(cut, aggregates.rising_alarm(rows, ["k"], ["t", "id"], "v", hold, WHOLE))
