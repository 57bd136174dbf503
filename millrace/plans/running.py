"""Running aggregates, OVER windows and keyed state, per row of the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, over, topk
from .registry import DAY, events, query

KEYS, ORDER = ["user_id"], ["ts", "event_id"]
W = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _cents(df):
    """The value in whole cents, so that sums are exact in any order."""
    return df.withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


CENTS = "CAST(round(value * 100) AS BIGINT)"
C_EVENTS = f"(SELECT *, {CENTS} AS cents FROM events)"


@query("running_sum", f"SELECT event_id, user_id, CAST(sum(cents) OVER {W} AS BIGINT) AS total FROM {C_EVENTS}")
def running_sum(spark, sf):
    rows = _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents")
    return aggregates.running_total(rows, KEYS, ORDER, "cents").select("event_id", "user_id", "total")


@query("running_avg", f"SELECT event_id, user_id, round(avg(cents) OVER {W}, 4) AS average FROM {C_EVENTS}")
def running_avg(spark, sf):
    rows = _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents")
    out = aggregates.running_average(rows, KEYS, ORDER, "cents")
    return out.select("event_id", "user_id", F.round("average", 4).alias("average"))


@query("rolling_max", f"""
SELECT event_id, user_id, max(value) OVER {W} AS max_value, first_value(event_id) OVER {W} AS first_event_id,
       first_value(event_type) OVER {W} AS first_event_type FROM events""")
def rolling_max(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    out = aggregates.rolling_max(rows, KEYS, ORDER, "value", ["event_id", "event_type"])
    return out.select("event_id", "user_id", "max_value", "first_event_id", "first_event_type")


@query("reduce_running", f"""
SELECT event_id, user_id, CAST(sum(cents) OVER {W} AS BIGINT) AS sum_cents, first_value(ts) OVER {W} AS first_ts
FROM {C_EVENTS}""")
def reduce_running(spark, sf):
    rows = _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents")
    out = aggregates.reduce_running(rows, KEYS, ORDER, "cents", ["ts"])
    return out.select("event_id", "user_id", "sum_cents", "first_ts")


@query("uv_running", """
SELECT event_id, sum(fresh) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS uv
FROM (SELECT event_id, ts, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS fresh
      FROM events WHERE event_type = 'view')""")
def uv_running(spark, sf):
    views = events(spark, sf).where(F.col("event_type") == "view").select("event_id", "ts", "user_id")
    return aggregates.distinct_running(views, "user_id", ORDER).select("event_id", "uv")


@query("retract_changelog", f"""
WITH r AS (SELECT event_id, user_id, cents, CAST(sum(cents) OVER {W} AS BIGINT) AS total,
                  row_number() OVER {W} AS nth FROM {C_EVENTS})
SELECT event_id, user_id, '+' AS op, total FROM r
UNION ALL SELECT event_id, user_id, '-', total - cents FROM r WHERE nth > 1""")
def retract_changelog(spark, sf):
    rows = _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents")
    return aggregates.retract_changelog(rows, KEYS, ORDER, "cents").select("event_id", "user_id", "op", "total")


@query("first_seen_per_value", """
SELECT event_id, user_id, event_type,
       first_value(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS first_event_id
FROM events""")
def first_seen_per_value(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    out = aggregates.first_seen(rows, KEYS, "event_type", ORDER, ["event_id"])
    return out.select("event_id", "user_id", "event_type", "first_event_id")


@query("jump_alarm", """
SELECT event_id, user_id, previous, value FROM (
  SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
WHERE abs(value - previous) > 10""")
def jump_alarm(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", "value")
    return aggregates.jump_alarm(rows, KEYS, ORDER, "value", 10.0).select("event_id", "user_id", "previous", "value")


@query("rising_alarm", f"""
WITH RECURSIVE marked AS (
  SELECT user_id, epoch_us(ts) AS t, event_id,
         lag(value) OVER w AS last, value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
falls AS (SELECT *, CASE WHEN last IS NOT NULL AND NOT value > last THEN t END AS fall FROM marked),
runs AS (SELECT *, count(fall) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run,
         min(fall) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ends FROM falls),
rising AS (SELECT user_id, run, t, ends FROM runs WHERE fall IS NULL),
heads AS (SELECT user_id, run, min(t) AS t, any_value(ends) AS ends FROM rising GROUP BY user_id, run),
alarms AS (
  SELECT user_id, run, t + {DAY} AS alarm_at, ends FROM heads WHERE ends IS NULL OR t + {DAY} < ends
  UNION ALL
  SELECT user_id, run, t + {DAY}, ends FROM (
    SELECT a.user_id, a.run, a.ends, min(r.t) AS t FROM alarms a JOIN rising r
      ON r.user_id = a.user_id AND r.run = a.run AND r.t > a.alarm_at GROUP BY a.user_id, a.run, a.ends, a.alarm_at)
  WHERE ends IS NULL OR t + {DAY} < ends)
SELECT user_id, run, alarm_at FROM alarms""")
def rising_alarm(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", "value")
    return aggregates.rising_alarm(rows, KEYS, ORDER, "value", DAY)


@query("top3_running", """
SELECT e.event_id, e.user_id, list_sort(list(p.value), 'DESC')[1] AS top1,
       list_sort(list(p.value), 'DESC')[2] AS top2, list_sort(list(p.value), 'DESC')[3] AS top3
FROM events e JOIN events p ON p.user_id = e.user_id AND (p.ts, p.event_id) <= (e.ts, e.event_id)
GROUP BY e.event_id, e.user_id""")
def top3_running(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", "value")
    return topk.top3_running(rows, KEYS, ORDER, "value").select("event_id", "user_id", "top1", "top2", "top3")


@query("over_unbounded", f"SELECT event_id, user_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS total FROM {C_EVENTS}")
def over_unbounded(spark, sf):
    rows = _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents")
    return over.over_unbounded(rows, KEYS, ORDER, {"total": ("sum", "cents")}).select("event_id", "user_id", "total")


@query("over_range", f"""
SELECT event_id, user_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM {C_EVENTS}""")
def over_range(spark, sf):
    rows = _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents")
    out = over.over_range(rows, KEYS, ORDER, DAY, {"total": ("sum", "cents")})
    return out.select("event_id", "user_id", "total")


@query("over_rows", f"""
SELECT event_id, user_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING) AS BIGINT) AS total
FROM {C_EVENTS}""")
def over_rows(spark, sf):
    rows = _cents(events(spark, sf)).select("event_id", "user_id", "ts", "cents")
    out = over.over_rows(rows, KEYS, ORDER, 2, {"total": F.sum("cents")})
    return out.select("event_id", "user_id", "total")


@query("sql_named_window", f"""
SELECT event_id, user_id, count(cents) OVER w AS n, CAST(sum(cents) OVER w AS BIGINT) AS total FROM {C_EVENTS}
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 1 PRECEDING)""")
def sql_named_window(spark, sf):
    _cents(events(spark, sf)).createOrReplaceTempView("event_cents")
    return spark.sql("""
        SELECT event_id, user_id, count(cents) OVER w AS n, sum(cents) OVER w AS total FROM event_cents
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 1 PRECEDING)""")
