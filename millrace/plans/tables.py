"""Sources, sinks, row-wise operators, unions and grouped aggregates."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..functions import scalar, udfs
from ..operators import aggregates, combine, repartition, reshape, topk
from ..session import scratch_path
from ..sinks import files as file_sinks
from ..sinks import keyed
from ..sources import catalog, files, generated, kafka
from .registry import events, query, table

EVENT_TEXT = "event_id bigint, user_id bigint, event_type string, value double"


def _event_files(spark, sf_dir, sep=","):
    """The events as delimited files in the shared folder."""
    path = scratch_path(spark, "events-text")
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    file_sinks.write_delimited(rows, path, sep)
    return path


def _sums(df):
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"), F.round(F.sum("value"), 2).alias("total")
    )


SUMS_SQL = """
SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, round(sum(value), 2) AS total
FROM events GROUP BY event_type"""


# -- sources -------------------------------------------------------------------


@query("wordcount_batch", """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(line, ' ')) AS word
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word""")
def wordcount_batch(spark, sf):
    path = scratch_path(spark, "texts")
    table(spark, sf, "documents").select("text").where("text IS NOT NULL").write.text(path, lineSep="\n")
    lines = spark.read.text(path, lineSep="\n")
    return aggregates.word_count(reshape.split_words(lines, "value"))


@query("csv_typed_scan", SUMS_SQL)
def csv_typed_scan(spark, sf):
    return _sums(files.read_delimited(spark, _event_files(spark, sf), EVENT_TEXT))


@query("table_file_source", SUMS_SQL)
def table_file_source(spark, sf):
    path = _event_files(spark, sf, "|")
    files.read_delimited(spark, path, EVENT_TEXT, "|", "\n").createOrReplaceTempView("event_files")
    return _sums(spark.table("event_files"))


@query("sql_file_source", SUMS_SQL)
def sql_file_source(spark, sf):
    files.declare_file_table(spark, "event_csv", EVENT_TEXT, _event_files(spark, sf))
    return spark.sql("""
        SELECT event_type, count(*) AS n, sum(user_id) AS users, round(sum(value), 2) AS total
        FROM event_csv GROUP BY event_type""")


@query("from_elements", """
SELECT v.label, count(*) AS n FROM events e
JOIN (VALUES ('click', 'touch'), ('view', 'look'), ('signup', 'join'), ('purchase', 'buy')) v(event_type, label)
USING (event_type) GROUP BY v.label""")
def from_elements(spark, sf):
    labels = [("click", "touch"), ("view", "look"), ("signup", "join"), ("purchase", "buy")]
    elements = spark.createDataFrame(labels, "event_type string, label string")
    joined = events(spark, sf).join(elements, "event_type")
    return aggregates.count_by(joined, "label")


@query("from_collection", """
SELECT e.user_id, CAST(sum(w.weight) AS BIGINT) AS score FROM events e
JOIN (VALUES ('click', 1), ('view', 2), ('purchase', 30)) w(event_type, weight)
USING (event_type) GROUP BY e.user_id""")
def from_collection(spark, sf):
    weights = {"click": 1, "view": 2, "purchase": 30}
    collection = spark.createDataFrame(list(weights.items()), "event_type string, weight bigint")
    joined = events(spark, sf).join(collection, "event_type")
    return joined.groupBy("user_id").agg(F.sum("weight").alias("score"))


@query("kafka_options", """
SELECT CAST(user_id AS VARCHAR) AS key,
       '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def kafka_options(spark, sf):
    return kafka.as_records(events(spark, sf), "user_id", ["event_id", "event_type"])


@query("json_value_scan", """
SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_value_scan(spark, sf):
    records = events(spark, sf).select(F.col("props").alias("value"))
    return aggregates.count_by(kafka.json_rows(records, "k int"), "k")


@query("csv_value_scan", """
SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY event_type""")
def csv_value_scan(spark, sf):
    line = F.concat_ws(",", "event_id", "user_id", "event_type").alias("value")
    rows = kafka.csv_rows(events(spark, sf).select(line), "event_id bigint, user_id bigint, event_type string")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


@query("marketing_events", """
SELECT (['huawwei', 'xiaomi', 'apple', 'baidu', 'qq', 'oppo', 'vivo'])[1 + (event_id * 31) % 7] AS channel,
       (['download', 'install', 'update', 'uninstall'])[1 + (event_id * 17) % 4] AS behavior,
       count(*) AS n, CAST(max(epoch_us(ts) // 1000) AS BIGINT) AS newest
FROM events GROUP BY 1, 2""")
def marketing_events(spark, sf):
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', ts)")
    made = generated.marketing_events(events(spark, sf), "event_id", millis)
    return made.groupBy("channel", "behavior").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"))


@query("custom_source", """
SELECT event_type, 'sensor' || (mixed % 100) AS id, count(*) AS n, CAST(sum((mixed >> 8) % 1000) AS BIGINT) AS total
FROM (SELECT event_type, (event_id * 2654435761) & 4294967295 AS mixed FROM events) GROUP BY ALL""")
def custom_source(spark, sf):
    """Readings of the custom data source, one for each event, met by their number."""
    e = events(spark, sf)
    spark.dataSource.register(generated.SensorSource)
    n = (e.agg(F.max("event_id")).first()[0] or 0) + 1
    parts = spark.sparkContext.defaultParallelism
    readings = spark.read.format("sensor_rows").option("rows", n).option("parts", parts).load()
    met = e.join(readings, F.col("event_id") * 1000 == readings["ts"])
    return met.groupBy("event_type", "id").agg(F.count(F.lit(1)).alias("n"), F.sum("vc").alias("total"))


@query("computed_column", """
SELECT event_id, date_trunc('second', ts) AS t, CAST(length(event_type) AS INTEGER) AS width FROM events""")
def computed_column(spark, sf):
    events(spark, sf).createOrReplaceTempView("plain_events")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY VIEW timed_events AS
        SELECT event_id, event_type, date_trunc('SECOND', ts) AS t FROM plain_events""")
    return spark.sql("SELECT event_id, CAST(t AS TIMESTAMP_NTZ) AS t, length(event_type) AS width FROM timed_events")


@query("catalog_table", """
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment""")
def catalog_table(spark, sf):
    before = spark.catalog.currentDatabase()
    path = scratch_path(spark, "catalog")
    name = "db_" + path.rsplit("-", 1)[1]
    try:
        catalog.use_database(spark, name, path)
        catalog.save_table(table(spark, sf, "customer"), "customers")
    finally:
        spark.sql(f"USE `{before}`")
    return spark.table(f"{name}.customers").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


# -- sinks ---------------------------------------------------------------------


@query("to_json", """
SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def to_json(spark, sf):
    return events(spark, sf).select("event_id", scalar.json_of("user_id", "event_type").alias("value"))


@query("upsert_last_by_key", """
SELECT user_id, '{"event_id":' || arg_max(event_id, event_id) || ',"event_type":"'
       || arg_max(event_type, event_id) || '"}' AS value FROM events GROUP BY user_id""")
def upsert_last_by_key(spark, sf):
    return keyed.last_by_key(events(spark, sf), "user_id", ["ts", "event_id"], ["event_id", "event_type"])


@query("csv_pipe_sink", SUMS_SQL)
def csv_pipe_sink(spark, sf):
    path = _event_files(spark, sf, "|")
    return _sums(spark.read.schema(EVENT_TEXT).option("sep", "|").csv(path))


@query("insert_select", """
SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'""")
def insert_select(spark, sf):
    events(spark, sf).createOrReplaceTempView("insert_source")
    path = scratch_path(spark, "insert")
    target = "purchases_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {target} (event_id BIGINT, user_id BIGINT, value DOUBLE) USING parquet LOCATION '{path}'")
    file_sinks.insert_select(spark, target, "SELECT event_id, user_id, value FROM insert_source WHERE event_type = 'purchase'")
    return spark.table(target)


# -- row-wise operators --------------------------------------------------------


@query("map_project", "SELECT event_id, user_id AS id, epoch_us(ts) // 1000000 AS sec, CAST(floor(value) AS INTEGER) AS vc FROM events")
def map_project(spark, sf):
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', ts)")
    return events(spark, sf).select(
        "event_id", F.col("user_id").alias("id"), seconds.alias("sec"), F.floor("value").cast("int").alias("vc"))


@query("map_partition", "SELECT event_id, upper(event_type) AS label FROM events")
def map_partition(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type")

    def label(upper, batch):
        return batch.assign(label=upper(pa.array(batch["event_type"], pa.string())).to_pandas())[["event_id", "label"]]

    return reshape.map_with_resource(rows, "event_id bigint, label string", lambda: pc.utf8_upper, label)


@query("flatmap_words", "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents")
def flatmap_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))


@query("filter_even", "SELECT event_id, user_id, event_type FROM events WHERE event_id % 2 = 0")
def filter_even(spark, sf):
    return events(spark, sf).where(F.col("event_id") % 2 == 0).select("event_id", "user_id", "event_type")


@query("table_where_select", "SELECT event_id, ts, value FROM events WHERE event_type = 'click'")
def table_where_select(spark, sf):
    return events(spark, sf).where(F.col("event_type") == "click").select("event_id", "ts", "value")


@query("sql_where", "SELECT event_id, user_id, value FROM events WHERE event_type = 'view'")
def sql_where(spark, sf):
    events(spark, sf).createOrReplaceTempView("event_view")
    return spark.sql("SELECT event_id, user_id, value FROM event_view WHERE event_type = 'view'")


@query("side_output_split", """
SELECT event_id, CASE WHEN value > 50 THEN 'high' ELSE 'main' END AS tag, value FROM events""")
def side_output_split(spark, sf):
    tag = F.when(F.col("value") > 50, "high").otherwise("main")
    return events(spark, sf).select("event_id", tag.alias("tag"), "value")


@query("scalar_functions", """
SELECT event_id, split_part(event_type, 'c', 1) AS head, CAST(length(event_type) AS INTEGER) AS len, user_id % 7 AS m,
       abs(event_id - user_id) AS gap, event_id // 10 AS tens, event_type || '-' || user_id AS pair,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k, date_trunc('second', ts) AS sec,
       ts - INTERVAL 5 SECOND AS before, CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS parsed FROM events""")
def scalar_functions(spark, sf):
    c = F.col
    return events(spark, sf).select(
        "event_id",
        F.split("event_type", "c")[0].alias("head"),
        F.length("event_type").alias("len"),
        (c("user_id") % 7).alias("m"),
        F.abs(c("event_id") - c("user_id")).alias("gap"),
        F.expr("event_id div 10").alias("tens"),
        reshape.composite_key("event_type", "user_id").alias("pair"),
        scalar.parse_json(c("props"), "k int")["k"].alias("k"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("sec"),
        (c("ts") - F.expr("INTERVAL 5 SECONDS")).alias("before"),
        c("user_id").cast("string").cast("bigint").alias("parsed"),
    )


# -- partitioners --------------------------------------------------------------

SAME_ROWS_SQL = "SELECT event_id, user_id, event_type FROM events"


def _narrow(spark, sf):
    return events(spark, sf).select("event_id", "user_id", "event_type")


@query("repartition_key", SAME_ROWS_SQL)
def repartition_key(spark, sf):
    return repartition.by_key(_narrow(spark, sf), "user_id")


@query("repartition_random", SAME_ROWS_SQL)
def repartition_random(spark, sf):
    return repartition.at_random(_narrow(spark, sf), spark.sparkContext.defaultParallelism, "event_id", seed=42)


@query("repartition_roundrobin", SAME_ROWS_SQL)
def repartition_roundrobin(spark, sf):
    return repartition.round_robin(_narrow(spark, sf), spark.sparkContext.defaultParallelism)


@query("coalesce", SAME_ROWS_SQL)
def coalesce(spark, sf):
    rows = _narrow(spark, sf)
    return repartition.rescale(rows, max(1, rows.rdd.getNumPartitions() // 2))


# -- several inputs ------------------------------------------------------------


@query("union_all", """
SELECT event_id, value FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, value FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, value FROM events WHERE value > 100""")
def union_all(spark, sf):
    e = events(spark, sf).select("event_id", "event_type", "value")
    parts = [e.where("event_type = 'click'"), e.where("event_type = 'view'"), e.where("value > 100")]
    return combine.union_all(*[p.select("event_id", "value") for p in parts])


@query("connect_comap", """
SELECT 'order' AS side, o_orderkey AS id, o_orderstatus AS label FROM orders
UNION ALL SELECT 'event', event_id, event_type FROM events""")
def connect_comap(spark, sf):
    return combine.connect(
        table(spark, sf, "orders"), events(spark, sf),
        {"side": F.lit("order"), "id": F.col("o_orderkey"), "label": F.col("o_orderstatus")},
        {"side": F.lit("event"), "id": F.col("event_id"), "label": F.col("event_type")})


@query("reconcile_join", """
WITH pay AS (SELECT user_id, event_id AS pay_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events WHERE event_type = 'signup'),
     receipt AS (SELECT user_id, event_id AS receipt_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events WHERE event_type = 'purchase')
SELECT user_id, pay_id, receipt_id FROM pay JOIN receipt USING (user_id, nth)""")
def reconcile_join(spark, sf):
    e = events(spark, sf)
    pay = e.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("pay_id"))
    receipt = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("receipt_id"))
    both = combine.reconcile(pay, receipt, "user_id", ["ts", "pay_id"], ["at", "receipt_id"])
    return both.select("user_id", "pay_id", "receipt_id")


@query("broadcast_rules", """
SELECT coalesce(r.logic, 'other') AS logic, count(*) AS n, round(sum(value), 2) AS total FROM events e
LEFT JOIN (VALUES ('click', 'logic-1'), ('purchase', 'logic-2')) r(event_type, logic) USING (event_type) GROUP BY 1""")
def broadcast_rules(spark, sf):
    rules = spark.createDataFrame([("click", "logic-1"), ("purchase", "logic-2")], "event_type string, logic string")
    applied = combine.apply_rules(events(spark, sf), rules, "event_type", {"logic": "other"})
    return applied.groupBy("logic").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("control_asof", """
SELECT event_id, CASE switch WHEN 1 THEN 'logic-1' WHEN 2 THEN 'logic-2' ELSE 'other' END AS logic FROM (
  SELECT event_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN user_id % 3 END IGNORE NULLS)
    OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS switch FROM events)
WHERE event_type <> 'signup'""")
def control_asof(spark, sf):
    e = events(spark, sf)
    control = e.where("event_type = 'signup'").select("ts", "event_id", (F.col("user_id") % 3).alias("switch"))
    data = e.where("event_type <> 'signup'").select("ts", "event_id")
    seen = combine.control_as_of(data, control, "ts", "event_id", "switch")
    logic = F.when(F.col("switch") == 1, "logic-1").when(F.col("switch") == 2, "logic-2").otherwise("other")
    return seen.select("event_id", logic.alias("logic"))


@query("udtf_split", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(o_orderpriority, '-')) AS word FROM orders) GROUP BY word""")
def udtf_split(spark, sf):
    udfs.register(spark)
    table(spark, sf, "orders").select("o_orderpriority").createOrReplaceTempView("order_texts")
    return spark.sql("""
        SELECT word, count(*) AS n
        FROM split_words(TABLE(SELECT o_orderpriority AS text, '-' AS sep FROM order_texts)) GROUP BY word""")


# -- grouped aggregates --------------------------------------------------------


@query("pv_count", "SELECT 'pv' AS name, count(*) AS n FROM events WHERE event_type = 'view'")
def pv_count(spark, sf):
    views = events(spark, sf).where(F.col("event_type") == "view")
    return views.agg(F.count(F.lit(1)).alias("n")).select(F.lit("pv").alias("name"), "n")


@query("uv_count", "SELECT 'uv' AS name, count(DISTINCT user_id) AS n FROM events WHERE event_type = 'view'")
def uv_count(spark, sf):
    users = events(spark, sf).where(F.col("event_type") == "view").select("user_id")
    return users.agg(F.countDistinct("user_id").alias("n")).select(F.lit("uv").alias("name"), "n")


@query("table_group_sum", "SELECT user_id, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def table_group_sum(spark, sf):
    return events(spark, sf).groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("total"))


@query("count_by_two_keys", """
SELECT event_type || '-' || user_id AS name, count(*) AS n FROM events GROUP BY event_type, user_id""")
def count_by_two_keys(spark, sf):
    counted = aggregates.count_by(events(spark, sf), "event_type", "user_id")
    return counted.select(reshape.composite_key("event_type", "user_id").alias("name"), "n")


@query("count_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_by_key(spark, sf):
    return aggregates.count_by(events(spark, sf), "event_type")


@query("ad_click_by_province", """
SELECT c_mktsegment || '-' || c_nationkey AS province_ad, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def ad_click_by_province(spark, sf):
    clicks = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    joined = clicks.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    key = reshape.composite_key("c_mktsegment", "c_nationkey").alias("province_ad")
    return joined.groupBy(key).agg(F.sum("n").alias("n"))


ROW = ["event_id", "ts", "event_type"]


@query("max_by_first", """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY floor(value / 10) DESC, ts, event_id) = 1""")
def max_by_first(spark, sf):
    rows = events(spark, sf).withColumn("vc", F.floor(F.col("value") / 10))
    return aggregates.max_row(rows, ["user_id"], "vc", ["ts", "event_id"], ROW)


@query("max_by_last", """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY floor(value / 10) DESC, ts DESC, event_id DESC) = 1""")
def max_by_last(spark, sf):
    rows = events(spark, sf).withColumn("vc", F.floor(F.col("value") / 10))
    return aggregates.max_row(rows, ["user_id"], "vc", ["ts", "event_id"], ROW, last=True)


@query("top3_per_key", """
SELECT user_id, event_id, value, row_number() OVER w AS rank FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, ts, event_id) QUALIFY rank <= 3""")
def top3_per_key(spark, sf):
    top = topk.top_n(events(spark, sf), ["user_id"], "value", ["ts", "event_id"], 3)
    return top.select("user_id", "event_id", "value", F.col("rank").cast("bigint").alias("rank"))


@query("top2_rank", """
SELECT user_id, value AS vc, CAST(rank AS VARCHAR) AS rank FROM (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rank FROM events)
WHERE rank <= 2""")
def top2_rank(spark, sf):
    top = topk.top_n(events(spark, sf).select("user_id", "value"), ["user_id"], "value", [], 2)
    return top.select("user_id", F.col("value").alias("vc"), F.col("rank").cast("string").alias("rank"))


@query("top2_udtf", """
SELECT user_id, value AS vc, CAST(rank AS VARCHAR) AS rank FROM (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rank FROM events)
WHERE rank <= 2""")
def top2_udtf(spark, sf):
    udfs.register(spark)
    events(spark, sf).createOrReplaceTempView("top_events")
    return spark.sql("""
        SELECT * FROM top2(
          TABLE(SELECT * FROM top2_parts(TABLE(SELECT user_id, value AS vc FROM top_events))) PARTITION BY user_id)""")


@query("udf_scalar", "SELECT doc_id, CAST(length(text) AS INTEGER) AS len FROM documents")
def udf_scalar(spark, sf):
    udfs.register(spark)
    table(spark, sf, "documents").select("doc_id", "text").createOrReplaceTempView("texts")
    return spark.sql("SELECT doc_id, str_len(text) AS len FROM texts")


@query("udaf_avg", "SELECT user_id, round(avg(value), 4) AS average FROM events GROUP BY user_id")
def udaf_avg(spark, sf):
    averaged = udfs.user_aggregate(events(spark, sf), ["user_id"], udfs.Average("value"), "average", ["value"])
    return averaged.withColumn("average", F.round("average", 4))


@query("udaf_avg_sql", "SELECT event_type, round(avg(value), 4) AS average FROM events GROUP BY event_type")
def udaf_avg_sql(spark, sf):
    udfs.register(spark)
    events(spark, sf).createOrReplaceTempView("avg_events")
    return spark.sql("""
        SELECT key AS event_type, round(average, 4) AS average FROM avg_of_parts(
          TABLE(SELECT * FROM avg_parts(TABLE(SELECT event_type AS key, value FROM avg_events))) PARTITION BY key)""")


@query("dedup_per_key", """
SELECT user_id, event_type, min(event_id) AS event_id, min(ts) AS ts FROM events GROUP BY user_id, event_type""")
def dedup_per_key(spark, sf):
    return aggregates.drop_repeats(events(spark, sf), ["user_id"], "event_type", ["ts", "event_id"], ["event_id", "ts"])


@query("event_timer", """
SELECT DISTINCT user_id, ts + INTERVAL 5 SECOND AS fired_at FROM events""")
def event_timer(spark, sf):
    return aggregates.event_timers(events(spark, sf), ["user_id"], "ts", "5 SECONDS")
