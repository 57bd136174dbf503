"""The same questions asked of streams: each replays a whole table in time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, event_time, windows
from ..operators.sequences import Limits
from ..session import scratch_path
from ..sources import files
from ..streaming import control, late, processors, run
from .registry import DAY, HOUR, ORACLE, events, query
from .running import C_EVENTS, _cents
from .tables import EVENT_TEXT, SUMS_SQL, _event_files, _sums
from .windows import AGG, session_sql, slide_sql, tumble_sql

END = "TIMESTAMP '2199-01-01 00:00:00Z'"


def _rows(spark, sf, *more):
    rows = _cents(events(spark, sf)).select("event_id", "ts", "user_id", "cents", *more)
    return event_time.instant(rows, "ts")


def _closing(rows):
    """One far-future row of a user that does not exist, to end all windows."""
    values = {"ts": F.expr(END), "user_id": F.lit(-1)}
    return rows.sparkSession.range(1).select(*[
        values.get(f.name, F.lit("0")).cast(f.dataType).alias(f.name) for f in rows.schema])


def _replay(spark, rows, build, mode="append", close=False, **options):
    written = run.replay(spark, rows, "ts", build, mode, rows_per_step=Limits.of(rows).rows_per_task,
                         closing=_closing(rows) if close else None, partitions=spark.sparkContext.defaultParallelism, **options)
    if not close:
        return written
    written = written.where("user_id >= 0").drop("batch_id")
    bounds = [c for c in ("window_start", "window_end") if c in written.columns]
    return event_time.wall_time(written, *bounds) if bounds else written


@query("stream_file_scan", SUMS_SQL)
def stream_file_scan(spark, sf):
    source = files.read_delimited(spark, _event_files(spark, sf), EVENT_TEXT, stream=True)
    out = scratch_path(spark, "scan")
    run.write_batches(source, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return _sums(run.read_batches(spark, f"{out}/rows", source.schema))


@query("checkpoint_resume", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def checkpoint_resume(spark, sf):
    rows = _rows(spark, sf)
    updates = _replay(spark, rows, lambda s: aggregates.count_by(s, "user_id"), "update", restart=True)
    return run.latest(updates, ["user_id"])


@query("stream_tumble", tumble_sql(24))
def stream_tumble(spark, sf):
    def build(stream):
        return windows.tumble(stream.withWatermark("ts", "3 hours"), ["user_id"], "ts", "1 day", AGG)

    return _replay(spark, _rows(spark, sf), build, close=True)


@query("stream_slide", slide_sql(12, 6))
def stream_slide(spark, sf):
    def build(stream):
        return windows.slide(stream.withWatermark("ts", "3 hours"), ["user_id"], "ts", "12 hours", "6 hours", AGG)

    return _replay(spark, _rows(spark, sf), build, close=True)


@query("stream_session", session_sql(str(8 * HOUR)))
def stream_session(spark, sf):
    def build(stream):
        return windows.session(stream.withWatermark("ts", "1 hour"), ["user_id"], "ts", 8 * HOUR, AGG)

    return _replay(spark, _rows(spark, sf), build, close=True)


# A tenth of the rows come after all the others; windows that have ended by then take none of them.
LATE_SQL = f"""
WITH t AS (SELECT *, epoch_us(ts) AS us, event_id % 10 = 3 AS held, epoch_us(ts) // {DAY} * {DAY} AS starts FROM events),
m AS (SELECT max(us) // 1000 * 1000 AS newest FROM t WHERE NOT held)"""


def _held_back(spark, rows, build):
    """What a stream writes when it gets a tenth of the rows after all others, then a last row that ends all windows."""
    base, held = scratch_path(spark, "held"), F.col("event_id") % 10 == 3
    dated = 0
    for k, part in enumerate((rows.where(~held), rows.where(held), _closing(rows))):
        dated = run.lay_out(part, f"{base}/in/rows-{k}", ["ts"], 8, dated)
        result = build(spark.readStream.schema(rows.schema).parquet(f"{base}/in/*"))
        run.write_batches(result, f"{base}/out", f"{base}/checkpoint", partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return run.read_batches(spark, f"{base}/out", result.schema).where("user_id >= 0")


@query("sql_event_time", LATE_SQL + f"""
SELECT user_id, make_timestamp(starts) AS window_start, count(*) AS n, max(us // 1000) AS newest_ms
FROM t, m WHERE NOT held OR starts + {DAY} > (newest // 1000000 - 5) * 1000000 GROUP BY ALL""")
def sql_event_time(spark, sf):
    def build(stream):
        # Time from milliseconds, a watermark, and a window, in SQL over the stream.
        stream.withColumn("ms", F.unix_millis("ts")).drop("ts").createOrReplaceTempView("ms_events")
        timed = spark.sql("SELECT *, to_timestamp(from_unixtime(ms / 1000, 'yyyy-MM-dd HH:mm:ss')) AS t FROM ms_events")
        timed.withWatermark("t", "5 seconds").createOrReplaceTempView("timed_events")
        return spark.sql("""
            SELECT user_id, window(t, '1 day').start AS window_start, count(*) AS n, max(ms) AS newest_ms
            FROM timed_events GROUP BY user_id, window(t, '1 day')""")

    return event_time.wall_time(_held_back(spark, _rows(spark, sf), build).drop("batch_id"), "window_start")


@query("table_event_time", LATE_SQL + f"""
SELECT user_id, CAST(make_timestamp(starts) AS DATE) AS day, count(*) AS n, max(ts) AS newest
FROM t, m WHERE NOT held OR starts + {DAY} > newest - 3000000 GROUP BY ALL""")
def table_event_time(spark, sf):
    def build(stream):
        rows = stream.select("user_id", F.col("ts").alias("et")).withWatermark("et", "3 seconds")
        return rows.groupBy("user_id", F.window("et", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max("et").alias("newest"))

    found = _held_back(spark, _rows(spark, sf), build)
    return event_time.wall_time(found.select("user_id", F.to_date("w.start").alias("day"), "n", "newest"), "newest")


# -- processing time -----------------------------------------------------------

# Which window a row falls into is the clock's; over all windows a user's rows are
# counted once (twice by sliding windows), and several triggers make several windows.
PROC_SQL = f"""
SELECT user_id, {{times}} * count(*) AS n, {{times}} * CAST(sum(cents) AS BIGINT) AS total, true AS several FROM {C_EVENTS} GROUP BY user_id"""


def _by_the_clock(spark, sf, build, mode):
    def timed(stream):
        return build(windows.with_processing_time(stream).withWatermark("pt", "0 seconds"))

    found = run.latest(_replay(spark, _rows(spark, sf), timed, mode), ["user_id", "window_start", "window_end"])
    several = found.agg((F.min("window_start") < F.max("window_start")).alias("several"))
    totals = found.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return totals.crossJoin(F.broadcast(several))


@query("proc_tumble", PROC_SQL.format(times=1))
def proc_tumble(spark, sf):
    return _by_the_clock(spark, sf, lambda s: windows.tumble(s, ["user_id"], "pt", "10 milliseconds", AGG), "update")


@query("proc_slide", PROC_SQL.format(times=2))
def proc_slide(spark, sf):
    return _by_the_clock(spark, sf, lambda s: windows.slide(s, ["user_id"], "pt", "20 milliseconds", "10 milliseconds", AGG), "update")


@query("proc_session", PROC_SQL.format(times=1))
def proc_session(spark, sf):
    return _by_the_clock(spark, sf, lambda s: windows.session(s, ["user_id"], "pt", 5_000, AGG), "complete")


@query("stream_uv", "SELECT count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view'")
def stream_uv(spark, sf):
    views = _rows(spark, sf, "event_type").where(F.col("event_type") == "view")

    def build(stream):
        return stream.dropDuplicates(["user_id"]).select("user_id")

    fresh = _replay(spark, views, build)
    return fresh.agg(F.count(F.lit(1)).alias("uv"))


@query("stream_reconcile", """
WITH side AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth
              FROM events WHERE event_type IN ('signup', 'purchase')),
     pay AS (SELECT * FROM side WHERE event_type = 'signup'), receipt AS (SELECT * FROM side WHERE event_type = 'purchase')
SELECT user_id, CASE WHEN r.event_id IS NULL THEN 'signup_only' WHEN p.event_id IS NULL THEN 'purchase_only' ELSE 'match' END AS tag,
       p.event_id AS left_id, r.event_id AS right_id
FROM pay p FULL JOIN receipt r USING (user_id, nth)""")
def stream_reconcile(spark, sf):
    # The n-th payment of a user goes with the n-th receipt; what is left waits for years and leaves alone.
    rows = _rows(spark, sf, "event_type").where("event_type IN ('signup', 'purchase')")
    match = processors.Reconcile("user_id", "event_id", "event_type", "signup", "purchase", 10 * 365 * DAY)
    return _in_order(spark, rows, match, "user_id bigint, tag string, left_id bigint, right_id bigint")


@query("stream_rules", ORACLE["control_asof"])
def stream_rules(spark, sf):
    rows = _rows(spark, sf, "event_type").withColumn("switch", F.col("user_id") % 3)
    base = scratch_path(spark, "rules")
    run.lay_out(rows, f"{base}/in", ["ts", "event_id"], 3 * spark.sparkContext.defaultParallelism)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism).parquet(f"{base}/in")
    control.apply_as_of(stream, f"{base}/out", f"{base}/checkpoint", F.col("event_type") == "signup", "ts", "event_id", "switch",
                        ["event_id"]).awaitTermination()
    seen = run.read_batches(spark, f"{base}/out/rows", "event_id bigint, switch bigint")
    logic = F.when(F.col("switch") == 1, "logic-1").when(F.col("switch") == 2, "logic-2").otherwise("other")
    return seen.select("event_id", logic.alias("logic"))


@query("stream_late_rows", f"""
WITH t AS (SELECT event_id, epoch_us(ts) AS t, event_id % 10 = 3 AS held, (epoch_us(ts) // {6 * HOUR} + 1) * {6 * HOUR} AS ends FROM events),
m AS (SELECT max(t) - {HOUR} AS mark FROM t WHERE NOT held)
SELECT CASE WHEN NOT held OR ends > mark THEN 'on_time' WHEN ends + {3 * HOUR} > mark THEN 'update' ELSE 'late' END AS status,
       count(*) AS n, count(DISTINCT event_id) AS ids FROM t, m GROUP BY 1""")
def stream_late_rows(spark, sf):
    rows = _rows(spark, sf)
    base = scratch_path(spark, "late")
    # A tenth of the rows come only after all the others.
    held = F.col("event_id") % 10 == 3
    for part in (rows.where(~held), rows.where(held)):
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        late.split_late(stream, f"{base}/out", f"{base}/checkpoint", "ts", HOUR, 6 * HOUR, 3 * HOUR).awaitTermination()
    split = spark.read.parquet(f"{base}/out/rows")
    return split.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"))


# -- keyed state ---------------------------------------------------------------


DELAY = 2 * HOUR


def _groups(spark, rows):
    """Over how many groups the keys of a table are dealt: some 32,768 rows to a group, and enough of them for all cores."""
    return max(16 * spark.sparkContext.defaultParallelism, rows.count() // 32_768)


def _in_order(spark, rows, processor, schema):
    """Run a processor over rows that come up to two hours late, within and across micro-batches."""
    arrival, groups = F.unix_micros("ts") + F.pmod(F.xxhash64("event_id"), F.lit(DELAY)), _groups(spark, rows)

    def build(stream):
        return processors.apply(stream.withWatermark("ts", "2 hours"), processor, schema, "ts", groups)

    return _replay(spark, rows, build, close=True, order=[arrival])


@query("stream_jump_alarm", ORACLE["jump_alarm"])
def stream_jump_alarm(spark, sf):
    alarm = processors.JumpAlarm("user_id", "event_id", "value", 10.0)
    return _in_order(spark, _rows(spark, sf, "value"), alarm, "user_id bigint, event_id bigint, previous double, value double")


@query("stream_changelog", ORACLE["retract_changelog"])
def stream_changelog(spark, sf):
    log = processors.Changelog("user_id", "event_id", "cents")
    return _in_order(spark, _rows(spark, sf), log, "user_id bigint, event_id bigint, op string, total bigint")


@query("stream_top3", ORACLE["top3_running"])
def stream_top3(spark, sf):
    top = processors.RunningTop3("user_id", "event_id", "value")
    return _in_order(spark, _rows(spark, sf, "value"), top, "user_id bigint, event_id bigint, top1 double, top2 double, top3 double")


@query("stream_event_timer", "SELECT DISTINCT user_id, epoch_us(ts) // 1000 + 5000 AS fired_ms FROM events")
def stream_event_timer(spark, sf):
    rows = _rows(spark, sf)
    groups = _groups(spark, rows)

    def build(stream):
        timers = processors.EventTimers("user_id", "ms", 5000)
        stream = stream.withWatermark("ts", "0 seconds").withColumn("ms", F.unix_millis("ts"))
        return processors.apply(stream, timers, "user_id bigint, fired_ms bigint", "ts", groups)

    return _replay(spark, rows, build, close=True)


@query("stream_rising_alarm", f"SELECT user_id, alarm_at FROM ({ORACLE['rising_alarm']})")
def stream_rising_alarm(spark, sf):
    alarm = processors.RisingAlarm("user_id", "event_id", "value", DAY)
    return _in_order(spark, _rows(spark, sf, "value"), alarm, "user_id bigint, alarm_at bigint")


@query("stream_order_timeout", ORACLE["cep_order_timeout"].replace("first_event_id", "first_id").replace("last_event_id", "last_id"))
def stream_order_timeout(spark, sf):
    match = processors.NextOrTimeout("user_id", "event_id", "event_type", "signup", "purchase", 12 * HOUR)
    return _in_order(spark, _rows(spark, sf, "event_type"), match, "user_id bigint, tag string, first_id bigint, last_id bigint")


@query("stream_login_fail", f"""
WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                   - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events),
m AS (SELECT user_id, event_id, count(*) OVER f - 1 AS n_matches, min(event_id) OVER f AS first_id FROM s
  WHERE event_type = 'error'
  WINDOW f AS (PARTITION BY user_id, island ORDER BY ts RANGE BETWEEN INTERVAL '86399.999999 seconds' PRECEDING AND CURRENT ROW))
SELECT user_id, first_id, event_id AS last_id, n_matches FROM m WHERE n_matches > 0""")
def stream_login_fail(spark, sf):
    repeated = processors.Repeated("user_id", "event_id", "event_type", "error", DAY)
    return _in_order(spark, _rows(spark, sf, "event_type"), repeated, "user_id bigint, first_id bigint, last_id bigint, n_matches bigint")
