"""Window, running and stateful operators against rows worked out by hand."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import aggregates, combine, event_time, over, reshape, topk, windows

# Readings (id, second, value), and the same shape in milliseconds.
SENSOR = [("s1", 1, 10), ("s1", 2, 20), ("s2", 3, 30), ("s1", 4, 40), ("s2", 5, 50), ("s1", 6, 60)]
S = 1_000_000


def readings(spark, rows=SENSOR):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n bigint, " + schemas.WATER_SENSOR)
    return event_time.seconds_to_time(df, "ts")


def seconds(df, *more):
    start, end = F.unix_seconds("window_start"), F.unix_seconds("window_end")
    return sorted(tuple(r) for r in df.select("id", start.alias("a"), end.alias("b"), *more).collect())


COUNT, SUM = {"n": ("count", "vc")}, {"s": ("sum", "vc")}


def test_tumble(spark):
    got = windows.tumble(readings(spark), ["id"], "t", "5 seconds", COUNT)
    assert seconds(got, "n") == [("s1", 0, 5, 3), ("s1", 5, 10, 1), ("s2", 0, 5, 1), ("s2", 5, 10, 1)]


def test_slide(spark):
    got = windows.slide(readings(spark), ["id"], "t", "6 seconds", "3 seconds", COUNT)
    assert seconds(got, "n") == [("s1", -3, 3, 2), ("s1", 0, 6, 3), ("s1", 3, 9, 2), ("s1", 6, 12, 1),
                                 ("s2", 0, 6, 2), ("s2", 3, 9, 2)]


def test_sessions(spark):
    got = windows.session(readings(spark), ["id"], "t", 3 * S, COUNT)
    assert seconds(got, "n") == [("s1", 1, 9, 4), ("s2", 3, 8, 2)]
    got = windows.session(readings(spark), ["id"], "t", 2 * S, SUM)  # one gap apart: merged
    assert seconds(got, "s") == [("s1", 1, 8, 130), ("s2", 3, 7, 80)]


def test_count_windows(spark):
    rows = readings(spark)
    got = windows.count_tumble(rows, ["id"], ["t", "n"], 2, SUM, ["vc"])
    assert sorted((r["id"], r["first_vc"], r["s"]) for r in got.collect()) == [("s1", 10, 30), ("s1", 40, 100), ("s2", 30, 80)]
    got = windows.count_tumble(rows, ["id"], ["t", "n"], 5, SUM)
    assert got.count() == 0  # never full
    got = windows.count_slide(rows, ["id"], ["t", "n"], 5, 2, SUM)
    assert sorted((r["id"], r["nth"], r["s"]) for r in got.collect()) == [("s1", 2, 30), ("s1", 4, 130), ("s2", 2, 80)]


def test_running(spark):
    rows = readings(spark)
    got = aggregates.reduce_running(rows, ["id"], ["t", "n"], "vc", ["ts"])
    assert [tuple(r) for r in got.orderBy("n").select("id", "first_ts", "sum_vc").collect()] == [
        ("s1", 1, 10), ("s1", 1, 30), ("s2", 3, 30), ("s1", 1, 70), ("s2", 3, 80), ("s1", 1, 130)]
    got = aggregates.rolling_max(rows, ["id"], ["t", "n"], "vc", ["ts"])
    assert [(r["max_vc"], r["first_ts"]) for r in got.orderBy("n").collect()] == [
        (10, 1), (20, 1), (30, 3), (40, 1), (50, 3), (60, 1)]
    alarms = aggregates.jump_alarm(rows, ["id"], ["t", "n"], "vc", 10)
    assert sorted((r["id"], r["ts"]) for r in alarms.collect()) == [("s1", 4), ("s1", 6), ("s2", 5)]


def test_over(spark):
    rows = readings(spark)
    got = over.over_rows(rows, ["id"], ["t", "n"], 2, {"s": F.sum("vc")})
    assert [r["s"] for r in got.orderBy("n").collect()] == [10, 30, 30, 70, 80, 120]
    got = over.over_range(rows, ["id"], ["t", "n"], 2 * S, {"s": ("sum", "vc")})
    assert [r["s"] for r in got.orderBy("n").collect()] == [10, 30, 30, 60, 80, 100]


def test_max_rows_on_ties(spark):
    rows = readings(spark, [("s1", 1, 10), ("s1", 2, 30), ("s1", 3, 30), ("s1", 4, 20)])
    first = aggregates.max_row(rows, ["id"], "vc", ["ts", "n"], ["ts", "vc"])
    last = aggregates.max_row(rows, ["id"], "vc", ["ts", "n"], ["ts", "vc"], last=True)
    assert [tuple(r) for r in first.collect()] == [("s1", 2, 30)]
    assert [tuple(r) for r in last.collect()] == [("s1", 3, 30)]


def test_max_rows_by_fractions_and_text(spark):
    rows = spark.createDataFrame([("a", 1.7, "x", 9), ("a", 1.2, "y", 9), ("a", 0.5, "z", 3)], "k string, t double, name string, v int")
    assert aggregates.max_row(rows, ["k"], "v", ["t"], ["t"]).collect()[0]["t"] == 1.2
    assert aggregates.max_row(rows, ["k"], "v", ["name"], ["name"]).collect()[0]["name"] == "x"
    assert aggregates.max_row(rows, ["k"], "v", ["name"], ["name"], last=True).collect()[0]["name"] == "y"


def test_range_over_fractions(spark):
    rows = spark.createDataFrame([("a", 1.2, 5), ("a", 1.7, 5), ("a", 1.9, 4)], "k string, t double, v bigint")
    got = over.over_range(rows, ["k"], ["t"], 0, {"s": ("sum", "v")}).orderBy("t")
    assert [r["s"] for r in got.collect()] == [5, 5, 4]


def test_changelog_takes_back_what_it_sent(spark):
    rows = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.2), ("a", 3, 0.3)], "k string, t bigint, v double")
    got = [(r["op"], r["total"]) for r in aggregates.retract_changelog(rows, ["k"], ["t"], "v").orderBy("t", F.desc("op")).collect()]
    sent = [v for op, v in got if op == "+"]
    assert [v for op, v in got if op == "-"] == sent[:-1]


def test_rising_alarm_tells_large_ids_apart(spark):
    for ids in ((2**62, 2**62 + 1), (10, 11), (None, 2**62 + 1)):
        rows = spark.createDataFrame([(i, t, t) for i in ids for t in (1, 9)], "id bigint, t bigint, v bigint")
        got = aggregates.rising_alarm(rows, ["id"], ["t"], "v", 5)
        assert sorted((r["id"] or 0, r["alarm_at"]) for r in got.collect()) == sorted((i or 0, t + 5) for i in ids for t in (1, 9))


def test_top(spark):
    rows = readings(spark, [("s1", i, v) for i, v in enumerate([5, 9, 9, 1, 9, 12])])
    got = topk.top3_running(rows, ["id"], ["t", "n"], "vc").orderBy("n").collect()
    assert [(r["top1"], r["top2"], r["top3"]) for r in got] == [
        (5, None, None), (9, 5, None), (9, 9, 5), (9, 9, 5), (9, 9, 9), (12, 9, 9)]
    two = topk.top_n(rows, ["id"], "vc", ["n"], 2).orderBy("rank")
    assert [(r["vc"], r["rank"]) for r in two.collect()] == [(12, 1), (9, 2)]


def test_dedup_keeps_the_first(spark):
    """The aim of the map-state job is to drop repeats; its literal form is ``first_seen``."""
    rows = readings(spark, [("s1", 1, 10), ("s1", 2, 10), ("s1", 3, 20), ("s2", 4, 10)])
    kept = aggregates.drop_repeats(rows, ["id"], "vc", ["ts", "n"], ["ts"])
    assert sorted(tuple(r) for r in kept.collect()) == [("s1", 10, 1), ("s1", 20, 3), ("s2", 10, 4)]
    seen = aggregates.first_seen(rows, ["id"], "vc", ["ts", "n"], ["ts"]).orderBy("n")
    assert [r["first_ts"] for r in seen.collect()] == [1, 1, 3, 4]


def rising(spark, values):
    rows = readings(spark, [("s1", t, v) for t, v in values])
    got = aggregates.rising_alarm(rows, ["id"], ["t", "n"], "vc", 5 * S)
    return sorted(r["alarm_at"] // S for r in got.collect())


def test_rising_alarm(spark):
    assert rising(spark, [(1, 1), (3, 2), (7, 3)]) == [6, 12]  # at the end all timers fire
    assert rising(spark, [(1, 1), (3, 2), (4, 2), (20, 3)]) == [25]  # cancelled by the equal value
    assert rising(spark, [(1, 1), (6, 0)]) == []  # a fall at the deadline still cancels
    assert rising(spark, [(1, 1), (6, 2), (7, 3), (8, 1)]) == [6]


def test_reconcile_uses_each_row_once(spark):
    pay = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "tx string, pay int")
    receipt = spark.createDataFrame([("a", 7), ("c", 8), (None, 9), ("a", 10), ("a", 11)], "tx string, got int")
    both = combine.reconcile(pay, receipt, "tx", ["pay"], ["got"])
    assert sorted(tuple(r) for r in both.select("tx", "pay", "got").collect()) == [("a", 1, 7), ("a", 2, 10)]


def test_control_comes_before_rows_of_its_time(spark):
    data = spark.createDataFrame([(1, 1), (5, 2), (9, 3)], "t bigint, id bigint")
    control = spark.createDataFrame([(5, 1, "1"), (7, 2, "2")], "t bigint, id bigint, switch string")
    got = combine.control_as_of(data, control, "t", "id", "switch")
    assert sorted((r["id"], r["switch"]) for r in got.collect()) == [(1, None), (2, "1"), (3, "2")]


def test_side_outputs(spark):
    tagged = reshape.tag_rows(readings(spark), {"high": F.col("vc") > 45, "low": F.col("vc") < 15})
    sizes = {name: reshape.side_output(tagged, name).count() for name in ("high", "low", "main")}
    assert sizes == {"high": 2, "low": 1, "main": 3}


def test_lateness(spark):
    # (arrival, event second): windows of 5 s, 3 s disorder, 3 s lateness.
    rows = [(1, 1), (2, 8), (3, 4), (4, 9), (5, 2), (6, 11), (7, 3), (8, 12), (9, 6)]
    df = spark.createDataFrame(rows, "a bigint, s bigint").withColumn("t", F.timestamp_seconds("s"))
    got = event_time.mark_lateness(df, ["a"], "t", 3 * S, 5 * S, 3 * S)
    assert [r["status"] for r in got.orderBy("a").collect()] == [
        "on_time", "on_time", "update", "on_time", "update", "on_time", "late", "on_time", "on_time"]
