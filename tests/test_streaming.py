"""Streams: late rows, updates, restarts, processing time, timers."""

import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import windows
from millrace.streaming import control, late, processors, run

S = 1_000_000
SCHEMA = "id string, ts timestamp, vc int"


def put(spark, path, rows):
    """One file with (id, second, value) rows."""
    df = spark.createDataFrame(rows, "id string, s bigint, vc int")
    df.select("id", F.timestamp_seconds("s").alias("ts"), "vc").coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("in", "out", "checkpoint")]


def drain(query, until, seconds=60):
    """Wait until ``until()`` holds, then stop the query."""
    end = time.time() + seconds
    try:
        while time.time() < end and not until():
            time.sleep(0.3)
    finally:
        query.stop()


def test_window_updates_then_drops_late_rows(spark, folders):
    inbox, out, checkpoint = folders

    def step(rows):
        put(spark, inbox, rows)
        stream = source(spark, inbox).withWatermark("ts", "6 seconds")  # 3 s disorder and 3 s lateness
        counted = windows.tumble(stream, ["id"], "ts", "5 seconds", {"n": ("count", "vc")})
        run.write_batches(counted, out, checkpoint, "update").awaitTermination()

    step([("s1", 1, 1), ("s1", 7, 1)])
    step([("s1", 2, 1)])  # disordered, in time
    step([("s1", 30, 1)])
    step([("s1", 31, 1)])
    step([("s1", 3, 1)])  # far behind the watermark
    written = run.read_batches(spark, out, "id string, window_start timestamp, window_end timestamp, n bigint")
    final = run.latest(written, ["id", "window_start", "window_end"])
    got = sorted((int(r["window_start"].timestamp()), r["n"]) for r in final.collect())
    assert got == [(0, 2), (5, 1), (30, 2)]


def test_late_rows_are_kept_apart(spark, folders):
    inbox, out, checkpoint = folders
    for rows in ([("s1", 1, 1), ("s1", 12, 2)], [("s1", 4, 3), ("s1", 8, 4), ("s1", 14, 5)], [("s1", 7, 6)]):
        put(spark, inbox, rows)
        stream = source(spark, inbox)
        late.split_late(stream, out, checkpoint, "ts", 3 * S, 5 * S, 3 * S).awaitTermination()
    got = {r["vc"]: r["status"] for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {1: "on_time", 2: "on_time", 3: "late", 4: "on_time", 5: "on_time", 6: "update"}


def test_batch_written_again_is_not_doubled(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "a int")
    for _ in range(2):
        rows.write.mode("overwrite").parquet(str(tmp_path / "batch_id=0"))
    assert run.read_batches(spark, str(tmp_path), "a int").count() == 1


@pytest.mark.parametrize("window", ["tumble", "slide", "session"])
def test_processing_time_windows(spark, folders, window):
    inbox, out, checkpoint = folders
    put(spark, inbox, [("s1", 1, 1), ("s1", 2, 2), ("s2", 3, 3)])
    stream = windows.with_processing_time(source(spark, inbox)).withWatermark("pt", "0 seconds")
    aggs = {"n": ("count", "vc")}
    if window == "tumble":
        result = windows.tumble(stream, ["id"], "pt", "5 seconds", aggs)
    elif window == "slide":
        result = windows.slide(stream, ["id"], "pt", "6 seconds", "3 seconds", aggs)
    else:
        result = windows.session(stream, ["id"], "pt", 5 * S, aggs)
    mode = "complete" if window == "session" else "update"
    run.write_batches(result, out, checkpoint, mode).awaitTermination()
    got = run.read_batches(spark, out, result.schema)
    per_row = 2 if window == "slide" else 1
    assert {r["id"]: r["n"] for r in got.groupBy("id").agg(F.sum("n").alias("n")).collect()} == {
        "s1": 2 * per_row, "s2": per_row}


def test_processing_timer_fires_after_its_delay(spark, folders):
    inbox, out, checkpoint = folders
    put(spark, inbox, [("s1", 1, 1), ("s1", 2, 2)])
    with run.stream_settings(spark):
        fired = processors.apply(source(spark, inbox), processors.ProcessingTimers("id", 2000), "id string, rows bigint")
        query = run.write_batches(fired, out, checkpoint, trigger={"processingTime": "1 second"})

    def rows():
        try:
            return run.read_batches(spark, out, "id string, rows bigint").collect()
        except Exception:  # noqa: BLE001  nothing written yet
            return []

    drain(query, rows, 90)
    assert [(r["id"], r["rows"]) for r in rows()] == [("s1", 2)]


KEYED = "k string, t double, n bigint, v double, kind string"


def in_order(spark, folders, steps, processor, schema, delay="5 seconds"):
    """All a processor writes for rows (key, second, id, value, kind) that come in several micro-batches; a last row ends it."""
    inbox, out, checkpoint = folders
    for k, rows in enumerate([*steps, [("end", 1e9, 0, 0.0, "")]]):
        df = spark.createDataFrame(rows, KEYED).withColumn("ts", (F.col("t") * S).cast("bigint"))
        df.withColumn("ts", F.timestamp_micros("ts")).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(KEYED + ", ts timestamp").parquet(inbox).withWatermark("ts", delay)
        run.write_batches(processors.apply(stream, processor, schema, "ts"), out, checkpoint).awaitTermination()
    got = run.read_batches(spark, out, schema).drop("batch_id")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_average_in_event_order(spark, folders):
    steps = [[("s1", 1.0, 1, 10.0, ""), ("s1", 3.0, 3, 60.0, "")], [("s1", 2.0, 2, 20.0, ""), ("s2", 1.0, 9, 7.0, ""), ("s2", 2.0, 10, None, "")]]
    got = in_order(spark, folders, steps, processors.RunningAverage("k", "n", "v"), "k string, event_id bigint, average double")
    assert got == [("s1", 1, 10.0), ("s1", 2, 15.0), ("s1", 3, 30.0), ("s2", 10, 7.0), ("s2", 9, 7.0)]


def test_second_event_of_a_match_comes_first(spark, folders):
    """The closing event comes a micro-batch before the event that opens the match; null ids and kinds stay null."""
    big = 2**60 + 1
    steps = [[("o1", 8.0, big, 0.0, "pay"), ("o2", 1.0, 5, 0.0, "create"), ("o3", 2.0, None, 0.0, "create")],
             [("o1", 4.0, 1, 0.0, "create"), ("o3", 3.5, 7, 0.0, None), ("o4", 6.0, None, 0.0, "create")], [("o2", 30.0, 6, 0.0, "pay")]]
    match = processors.NextOrTimeout("k", "n", "kind", "create", "pay", 10 * S)
    got = in_order(spark, folders, steps, match, "k string, tag string, first_id bigint, last_id bigint")
    assert got == [("o1", "match", 1, big), ("o2", "timeout", 5, None), ("o4", "timeout", None, None)]


def test_rows_behind_the_watermark_go(spark, folders):
    steps = [[("s", 100.0, 1, 1.0, "")], [("s", 90.0, 2, 50.0, ""), ("s", 101.0, 3, 2.0, "")], [("s", 97.0, 4, 90.0, "")]]
    alarm = processors.JumpAlarm("k", "n", "v", 10.0)
    got = in_order(spark, folders, steps, alarm, "k string, event_id bigint, previous double, value double")
    assert got == [("s", 1, 90.0, 1.0)]  # the row at 90 is late, the one at 97 is not


def brute_reconcile(rows, within):
    out, waiting = [], []
    for t, side, n in sorted((round(t * S), kind, n) for _, t, n, _, kind in rows):
        while waiting and t - waiting[0][0] >= within:
            _, s, i = waiting.pop(0)
            out.append(("k", f"{s}_only", i if s == "a" else None, i if s == "b" else None))
        if waiting and waiting[0][1] != side:
            i = waiting.pop(0)[2]
            out.append(("k", "match", *((i, n) if side == "b" else (n, i))))
        else:
            waiting.append((t, side, n))
    return out + [("k", f"{s}_only", i if s == "a" else None, i if s == "b" else None) for _, s, i in waiting]


def test_reconcile_uses_each_row_once(spark, folders):
    pick = random.Random(3)
    rows = [("k", pick.randint(0, 160) / 4, n, 0.0, pick.choice("ab")) for n in range(60)]
    rows.sort(key=lambda r: r[1] + pick.random() * 4.9)
    steps = [rows[:20], rows[20:45], rows[45:]]
    match = processors.Reconcile("k", "n", "kind", "a", "b", 6 * S)
    got = in_order(spark, folders, steps, match, "k string, tag string, left_id bigint, right_id bigint")
    assert got == sorted(brute_reconcile(rows, 6 * S), key=str)
    assert len({r[1] for r in got}) > 1


def test_state_goes_by_groups_of_keys(spark, folders):
    """Keys share held rows, a timer and a stored value, so calls to the state store do not grow with them."""
    inbox, out, checkpoint = folders
    rows = spark.range(8000).select(F.when(F.col("id") % 4000 != 0, F.col("id") % 4000).alias("k"), "id", F.timestamp_seconds(F.col("id") + 1).alias("ts"), F.col("id").alias("v"))
    stored = []
    for part in (rows, rows.limit(1).select("k", "id", F.timestamp_seconds(F.lit(10**9)).alias("ts"), "v")):
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox).withWatermark("ts", "5 seconds")
        alarm = processors.Changelog("k", "id", "v")
        query = run.write_batches(processors.apply(stream, alarm, "k bigint, event_id bigint, op string, total bigint", "ts"), out, checkpoint)
        query.awaitTermination()
        stored += [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert 0 < max(stored) < 3000  # by keys: 4,000 lists of rows and as many timers
    got = run.read_batches(spark, out, "k bigint, event_id bigint, op string, total bigint")
    assert got.count() == 3 * 4000 and got.select("k").distinct().count() == 4000
    assert got.where("k is null").count() == 3 and got.where("op = '+' and total = 2 * event_id - 4000 and event_id >= 4000").count() == 4000


def test_waiting_rows_go_to_pages_and_come_back_in_order(spark, folders):
    rows = [("k", n + 1.0, n, 0.0, "a" if n < 23 else "b") for n in range(40)]
    match = processors.Reconcile("k", "n", "kind", "a", "b", 30 * S)
    match.page = 3
    got = in_order(spark, folders, [[*rows[:15], ("j", 1.0, 1, 0.0, "a")], rows[15:]], match, "k string, tag string, left_id bigint, right_id bigint")
    want = [*brute_reconcile(rows, 30 * S), ("j", "a_only", 1, None)]
    assert got == sorted(want, key=str) and {r[1] for r in got} == {"match", "a_only"}


def test_timers_of_one_instant_fire_once(spark, folders):
    steps = [[("s", 1.0, 1000, 0.0, ""), ("s", 1.0, 1000, 0.0, ""), ("s", 1.0, 2**41, 0.0, "")], [("s", 1.0, 1000, 0.0, ""), ("t", 2.0, None, 0.0, "")]]
    got = in_order(spark, folders, steps, processors.EventTimers("k", "n", 500), "k string, fired_ms bigint")
    assert [r for r in got if r[0] != "end"] == [("s", 1500)]  # the last one is beyond the closing row


def test_rules_change_between_and_inside_micro_batches(spark, folders):
    inbox, out, checkpoint = folders
    steps = [[("d", 1, None), ("c", 2, 1), ("d", 3, None), ("c", 4, 2), ("d", 5, None)], [("d", 6, None), ("c", 8, 3), ("d", 9, None), ("d", 8, None)],
             [("d", 7, None)], [("d", 20, None), ("c", 21, None), ("d", 22, None)]]
    for rows in steps:
        put(spark, inbox, rows)
        stream = source(spark, inbox).withColumn("n", F.unix_seconds("ts"))
        control.apply_as_of(stream, out, checkpoint, F.col("id") == "c", "ts", "n", "vc", ["n"], delay_us=5 * S).awaitTermination()
    got = run.read_batches(spark, f"{out}/rows", "n bigint, vc int")
    assert {r["n"]: r["vc"] for r in got.collect()} == {1: None, 3: 1, 5: 2, 6: 2, 8: 3, 9: 3, 7: 2, 20: 3, 22: 3}


def test_replay_reads_files_in_order_and_survives_a_restart(spark):
    rows = spark.range(500).select("id", F.timestamp_seconds(F.col("id") % 100).alias("ts"))  # each instant five times
    written = run.replay(spark, rows, "ts", lambda s: s.select("id", F.unix_seconds("ts").alias("s")), steps=4, restart=True)
    bounds = [(r["lo"], r["hi"]) for r in written.groupBy("batch_id").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("batch_id").collect()]
    assert len(bounds) >= 4 and all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    assert written.count() == 500 and written.select("id").distinct().count() == 500
    empty = run.replay(spark, rows.where("false"), "ts", lambda s: s.select("id"))
    assert empty.count() == 0
