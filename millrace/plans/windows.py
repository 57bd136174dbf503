"""Time, session and count windows, and late rows, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import event_time, windows
from .registry import DAY, HOUR, events, query
from .running import C_EVENTS, _cents

KEYS, ORDER = ["user_id"], ["ts", "event_id"]
AGG = {"n": ("count", "cents"), "total": ("sum", "cents")}
AGG_SQL = "count(*) AS n, CAST(sum(cents) AS BIGINT) AS total"


def _rows(spark, sf, *more):
    return _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents", *more)


def tumble_sql(hours: int, keys: str = "user_id") -> str:
    size = hours * HOUR
    return f"""
SELECT {keys}, make_timestamp(epoch_us(ts) // {size} * {size}) AS window_start,
       make_timestamp(epoch_us(ts) // {size} * {size} + {size}) AS window_end, {AGG_SQL}
FROM {C_EVENTS} GROUP BY ALL"""


def slide_sql(size: int, every: int) -> str:
    size, every = size * HOUR, every * HOUR
    return f"""
WITH placed AS (SELECT user_id, cents, epoch_us(ts) AS t,
  unnest(range(epoch_us(ts) // {every} * {every}, epoch_us(ts) - {size}, -{every})) AS s FROM {C_EVENTS})
SELECT user_id, make_timestamp(s) AS window_start, make_timestamp(s + {size}) AS window_end, {AGG_SQL}
FROM placed WHERE t < s + {size} GROUP BY user_id, s"""


def session_sql(gap: str) -> str:
    return f"""
WITH spans AS (SELECT user_id, event_id, cents, epoch_us(ts) AS t, epoch_us(ts) + {gap} AS e FROM {C_EVENTS}),
flags AS (SELECT *, CASE WHEN t > max(e) OVER (PARTITION BY user_id ORDER BY t, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM spans),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM flags)
SELECT user_id, make_timestamp(min(t)) AS window_start, make_timestamp(max(e)) AS window_end, {AGG_SQL}
FROM runs GROUP BY user_id, run"""


def count_sql(size: int) -> str:
    return f"""
WITH placed AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // {size} AS window_no FROM {C_EVENTS})
SELECT user_id, window_no, arg_min(event_id, event_id) AS first_event_id, CAST(sum(cents) AS BIGINT) AS total
FROM placed GROUP BY user_id, window_no HAVING count(*) = {size}"""


# -- time windows --------------------------------------------------------------


@query("event_tumble", tumble_sql(24))
def event_tumble(spark, sf):
    return windows.tumble(_rows(spark, sf), KEYS, "ts", "1 day", AGG)


@query("tumble_reduce", f"""
SELECT user_id, make_timestamp(epoch_us(ts) // {6 * HOUR} * {6 * HOUR}) AS window_start, CAST(sum(cents) AS BIGINT) AS total
FROM {C_EVENTS} GROUP BY ALL""")
def tumble_reduce(spark, sf):
    out = windows.tumble(_rows(spark, sf), KEYS, "ts", "6 hours", {"total": ("sum", "cents")})
    return out.drop("window_end")


@query("tumble_agg", tumble_sql(6, "event_type"))
def tumble_agg(spark, sf):
    return windows.tumble(_rows(spark, sf, "event_type"), ["event_type"], "ts", "6 hours", AGG)


@query("tumble_process", f"""
SELECT user_id, strftime(make_timestamp(epoch_us(ts) // {DAY} * {DAY}), '%Y-%m-%d') AS day,
       count(*) AS n, min(cents) AS least, max(cents) AS most FROM {C_EVENTS} GROUP BY ALL""")
def tumble_process(spark, sf):
    out = windows.tumble(_rows(spark, sf), KEYS, "ts", "1 day", {
        "n": ("count", "cents"), "least": ("min", "cents"), "most": ("max", "cents")})
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n", "least", "most")


@query("event_slide", slide_sql(6, 3))
def event_slide(spark, sf):
    return windows.slide(_rows(spark, sf), KEYS, "ts", "6 hours", "3 hours", AGG)


@query("event_session", session_sql(str(8 * HOUR)))
def event_session(spark, sf):
    return windows.session(_rows(spark, sf), KEYS, "ts", 8 * HOUR, AGG)


@query("session_dynamic_gap", session_sql(f"(event_id % 5 + 1) * {3 * HOUR}"))
def session_dynamic_gap(spark, sf):
    gap = (F.col("event_id") % 5 + 1) * (3 * HOUR)
    return windows.session(_rows(spark, sf), KEYS, "ts", gap, AGG)


@query("table_tumble", tumble_sql(3))
def table_tumble(spark, sf):
    return windows.tumble(_rows(spark, sf), KEYS, "ts", "3 hours", AGG)


@query("table_slide", slide_sql(3, 2))
def table_slide(spark, sf):
    return windows.slide(_rows(spark, sf), KEYS, "ts", "3 hours", "2 hours", AGG)


@query("table_session", session_sql(str(2 * HOUR)))
def table_session(spark, sf):
    return windows.session(_rows(spark, sf), KEYS, "ts", 2 * HOUR, AGG)


def _sql_window(spark, sf, window):
    _rows(spark, sf).createOrReplaceTempView("cent_events")
    return spark.sql(f"""
        SELECT user_id, {window}.start AS window_start, {window}.end AS window_end,
               count(*) AS n, sum(cents) AS total FROM cent_events GROUP BY user_id, {window}""")


@query("sql_tumble", tumble_sql(2))
def sql_tumble(spark, sf):
    return _sql_window(spark, sf, "window(ts, '2 hours')")


@query("sql_hop", slide_sql(3, 2))
def sql_hop(spark, sf):
    return _sql_window(spark, sf, "window(ts, '3 hours', '2 hours')")


@query("sql_session", session_sql(str(12 * HOUR)))
def sql_session(spark, sf):
    return _sql_window(spark, sf, "session_window(ts, '12 hours')")


# -- count windows -------------------------------------------------------------


@query("count_tumble", count_sql(5))
def count_tumble(spark, sf):
    return windows.count_tumble(_rows(spark, sf), KEYS, ORDER, 5, {"total": ("sum", "cents")}, ["event_id"])


@query("table_count_tumble", count_sql(2))
def table_count_tumble(spark, sf):
    return windows.count_tumble(_rows(spark, sf), KEYS, ORDER, 2, {"total": ("sum", "cents")}, ["event_id"])


@query("count_slide", f"""
SELECT user_id, event_id, nth, total FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth,
    CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING) AS BIGINT) AS total FROM {C_EVENTS})
WHERE nth % 2 = 0""")
def count_slide(spark, sf):
    out = windows.count_slide(_rows(spark, sf), KEYS, ORDER, 5, 2, {"total": ("sum", "cents")})
    return out.select("user_id", "event_id", "nth", "total")


# -- event time and late rows --------------------------------------------------


ARRIVAL_SQL = f"""
WITH arrived AS (SELECT event_id, user_id, cents, epoch_us(ts) AS t,
       epoch_us(ts) + (event_id % 13) * {HOUR} AS arrival FROM {C_EVENTS}),
seen AS (SELECT *, max(t) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {HOUR} AS mark,
       t // {6 * HOUR} * {6 * HOUR} AS window_start_us FROM arrived),
marked AS (SELECT *, CASE WHEN mark IS NULL OR window_start_us + {6 * HOUR} > mark THEN 'on_time'
       WHEN window_start_us + {9 * HOUR} > mark THEN 'update' ELSE 'late' END AS status FROM seen)"""


def _marked(spark, sf):
    """The events as they would arrive with up to twelve hours of delay."""
    time = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts)")
    rows = _rows(spark, sf).withColumn("arrival", time + (F.col("event_id") % 13) * HOUR)
    return event_time.mark_lateness(rows, ["arrival", "event_id"], "ts", HOUR, 6 * HOUR, 3 * HOUR)


@query("allowed_lateness", ARRIVAL_SQL + f"""
SELECT user_id, window_start_us, {AGG_SQL}, CAST(count(CASE WHEN status = 'update' THEN 1 END) AS BIGINT) AS updates
FROM marked WHERE status <> 'late' GROUP BY user_id, window_start_us""")
def allowed_lateness(spark, sf):
    kept = _marked(spark, sf).where(F.col("status") != "late")
    return kept.groupBy("user_id", "window_start_us").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total"),
        F.count(F.when(F.col("status") == "update", 1)).alias("updates"))


@query("late_side_output", ARRIVAL_SQL + """
SELECT event_id, user_id, window_start_us FROM marked WHERE status = 'late'""")
def late_side_output(spark, sf):
    return _marked(spark, sf).where(F.col("status") == "late").select("event_id", "user_id", "window_start_us")


# -- processing time -----------------------------------------------------------


@query("proc_time_column")
def proc_time_column(spark, sf):
    return windows.with_processing_time(events(spark, sf).select("event_id", "user_id"))
