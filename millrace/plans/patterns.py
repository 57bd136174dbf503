"""Patterns over each user's events in time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import patterns as P
from ..operators.sequences import Ordered
from .registry import DAY, HOUR, events, query

ID = ["event_id"]
CLICK, VIEW, BUY, ERROR, JOIN = (f"event_type = '{t}'" for t in ("click", "view", "purchase", "error", "signup"))
STOP = "value > 60"

NEXT_SQL = "WITH s AS (SELECT *, lead(event_id) OVER w AS nid, lead(event_type) OVER w AS ntype, lead(ts) OVER w AS nts " \
           "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"


def _seq(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    return Ordered(rows, ["user_id"], ["ts", "event_id"])


def _text(df, *lists):
    """Lists of ids as text, which both engines compare alike."""
    return df.withColumns({c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c in lists})


@query("cep_single", "SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def cep_single(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "event_type", "value")
    return rows.where(ERROR).select("event_id", "user_id", "value")


@query("cep_or_condition", "SELECT event_id, user_id FROM events WHERE value > 30 OR event_type = 'signup'")
def cep_or_condition(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "event_type", "value")
    return rows.where((F.col("value") > 30) | F.expr(JOIN)).select("event_id", "user_id")


@query("cep_times", """
SELECT user_id, event_id || ',' || e2 AS events FROM (
  SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS e2
  FROM events WHERE event_type = 'error') WHERE e2 IS NOT NULL""")
def cep_times(spark, sf):
    return _text(P.times(_seq(spark, sf), ERROR, "event_id", 2), "events")


@query("cep_times_range", """
WITH m AS (SELECT user_id, event_id e1, lead(event_id, 1) OVER w e2, lead(event_id, 2) OVER w e3, lead(event_id, 3) OVER w e4
  FROM events WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, concat_ws(',', e1, e2) AS events FROM m WHERE e2 IS NOT NULL
UNION ALL SELECT user_id, concat_ws(',', e1, e2, e3) FROM m WHERE e3 IS NOT NULL
UNION ALL SELECT user_id, concat_ws(',', e1, e2, e3, e4) FROM m WHERE e4 IS NOT NULL""")
def cep_times_range(spark, sf):
    return _text(P.times(_seq(spark, sf), ERROR, "event_id", 2, 4), "events")


OPEN_SQL = """
WITH s AS (SELECT *, count(CASE WHEN {stop} THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS segment
  FROM events),
m AS (SELECT * FROM s WHERE event_type = 'click' AND NOT ({stop}))
SELECT user_id, event_id AS first_event_id, event_id AS last_event_id,
  max(event_id) OVER w AS final_event_id, count(*) OVER w AS n_matches FROM m
WINDOW w AS (PARTITION BY user_id, segment ORDER BY {order} {frame})"""


@query("cep_one_or_more", OPEN_SQL.format(
    stop="false", order="ts", frame="RANGE BETWEEN CURRENT ROW AND INTERVAL '86399.999999 seconds' FOLLOWING"))
def cep_one_or_more(spark, sf):
    return P.one_or_more(_seq(spark, sf), CLICK, ID, within=DAY)


@query("cep_until", OPEN_SQL.format(
    stop=STOP, order="ts, event_id", frame="ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"))
def cep_until(spark, sf):
    return P.one_or_more(_seq(spark, sf), CLICK, ID, until=STOP)


@query("cep_next", NEXT_SQL + """
SELECT user_id, event_id AS first_event_id, nid AS last_event_id FROM s WHERE event_type = 'click' AND ntype = 'purchase'""")
def cep_next(spark, sf):
    return P.next_to(_seq(spark, sf), CLICK, BUY, ID)


@query("cep_not_next", NEXT_SQL + """
SELECT user_id, event_id AS first_event_id FROM s WHERE event_type = 'click' AND (ntype IS NULL OR ntype <> 'view')""")
def cep_not_next(spark, sf):
    return P.not_next(_seq(spark, sf), CLICK, VIEW, ID)


@query("cep_followed_by", """
SELECT user_id, event_id AS first_event_id, nid AS last_event_id FROM (
  SELECT *, min(CASE WHEN event_type = 'purchase' THEN event_id END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nid FROM events)
WHERE event_type = 'click' AND nid IS NOT NULL""")
def cep_followed_by(spark, sf):
    return P.followed_by(_seq(spark, sf), CLICK, BUY, ID)


FREE_SQL = """
SELECT user_id, event_id AS first_event_id, lo AS last_event_id, hi AS final_event_id, n_matches FROM (
  SELECT *, min(CASE WHEN {then} THEN event_id END) OVER w AS lo, max(CASE WHEN {then} THEN event_id END) OVER w AS hi,
    count(CASE WHEN {then} THEN 1 END) OVER w AS n_matches FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '0.000001 seconds' FOLLOWING
               AND INTERVAL '{reach} seconds' FOLLOWING))
WHERE {first} AND n_matches > 0"""


@query("cep_followed_by_any", FREE_SQL.format(first=CLICK, then=BUY, reach="172799.999999"))
def cep_followed_by_any(spark, sf):
    return P.followed_by_any(_seq(spark, sf), CLICK, BUY, ID, within=2 * DAY)


@query("cep_combinations", FREE_SQL.format(first=ERROR, then=ERROR, reach="259199.999999"))
def cep_combinations(spark, sf):
    return P.combinations(_seq(spark, sf), ERROR, ID, within=3 * DAY)


LOOP_SQL = """
WITH s AS (SELECT *, lead(event_id) OVER w AS nid, lead(event_type) OVER w AS ntype
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT user_id, event_id e1, lead(event_id, 1) OVER w e2, lead(event_id, 2) OVER w e3,
  lead(nid, 1) OVER w n2, lead(nid, 2) OVER w n3, lead(ntype, 1) OVER w t2, lead(ntype, 2) OVER w t3
  FROM s WHERE event_type = 'click' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


@query("cep_greedy", LOOP_SQL + """
SELECT user_id, concat_ws(',', e1, e2, e3) AS events, n3 AS then_id FROM m WHERE t3 = 'purchase'
UNION ALL SELECT user_id, concat_ws(',', e1, e2), n2 FROM m WHERE t2 = 'purchase' AND t3 IS DISTINCT FROM 'purchase'""")
def cep_greedy(spark, sf):
    return _text(P.loop_then_next(_seq(spark, sf), CLICK, 2, 3, BUY, "event_id", greedy=True), "events")


@query("cep_optional", LOOP_SQL + """
SELECT user_id, concat_ws(',', e1, e2) AS events, n2 AS then_id FROM m WHERE t2 = 'purchase'
UNION ALL SELECT user_id, '', event_id FROM events WHERE event_type = 'purchase'""")
def cep_optional(spark, sf):
    return _text(P.loop_then_next(_seq(spark, sf), CLICK, 2, 2, BUY, "event_id", optional=True), "events")


@query("cep_group", NEXT_SQL + """
, pairs AS (SELECT user_id, ts, event_id, nid FROM s WHERE event_type = 'click' AND ntype = 'view'),
two AS (SELECT *, lead(event_id) OVER w AS e2, lead(nid) OVER w AS n2 FROM pairs
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, concat_ws(',', event_id, e2) AS starts, concat_ws(',', nid, n2) AS nexts FROM two WHERE e2 IS NOT NULL""")
def cep_group(spark, sf):
    return _text(P.group_times(_seq(spark, sf), CLICK, VIEW, "event_id", 2), "starts", "nexts")


@query("cep_within", NEXT_SQL + f"""
SELECT user_id, event_id AS first_event_id, nid AS last_event_id FROM s
WHERE event_type = 'click' AND ntype = 'view' AND epoch_us(nts) - epoch_us(ts) < {6 * HOUR}""")
def cep_within(spark, sf):
    return P.next_to(_seq(spark, sf), CLICK, VIEW, ID, within=6 * HOUR)


@query("cep_login_fail", f"""
WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                   - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events),
m AS (SELECT *, lead(event_id) OVER w AS e2, count(*) OVER f - 1 AS n_matches, max(event_id) OVER f AS final FROM s
  WHERE event_type = 'error'
  WINDOW w AS (PARTITION BY user_id, island ORDER BY ts, event_id),
         f AS (PARTITION BY user_id, island ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL '86399.999999 seconds' FOLLOWING))
SELECT user_id, event_id AS first_event_id, e2 AS last_event_id, final AS final_event_id, n_matches FROM m WHERE n_matches > 0""")
def cep_login_fail(spark, sf):
    return P.one_or_more(_seq(spark, sf), ERROR, ID, at_least=2, consecutive=True, within=DAY)


@query("cep_order_timeout", NEXT_SQL + f"""
, t AS (SELECT *, CASE WHEN nid IS NULL OR epoch_us(nts) - epoch_us(ts) >= {12 * HOUR} THEN 'timeout'
                     WHEN ntype = 'purchase' THEN 'match' END AS tag FROM s WHERE event_type = 'signup')
SELECT user_id, tag, event_id AS first_event_id, CASE WHEN tag = 'match' THEN nid END AS last_event_id FROM t WHERE tag IS NOT NULL""")
def cep_order_timeout(spark, sf):
    return P.next_or_timeout(_seq(spark, sf), JOIN, BUY, ID, within=12 * HOUR)


@query("cep_next_unkeyed", """
SELECT first_event_id, last_event_id FROM (
  SELECT event_id AS first_event_id, event_type, lead(event_id) OVER w AS last_event_id, lead(event_type) OVER w AS next_type
  FROM events WINDOW w AS (ORDER BY ts, event_id))
WHERE event_type = 'view' AND next_type = 'click'""")
def cep_next_unkeyed(spark, sf):
    rows = events(spark, sf).select("event_id", "ts", "event_type")
    return P.next_to(Ordered(rows, [], ["ts", "event_id"]), VIEW, CLICK, ID)
