"""Sources, sinks, partitioners and user functions."""

import glob
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import scalar, udfs
from millrace.operators import repartition, reshape
from millrace.sinks import files as file_sinks
from millrace.sinks import keyed
from millrace.sources import files, generated, kafka

READINGS = [("s1", 1000, 10), ("s1", 2000, 20), ("s2", 3000, 30), ("s1", 4000, 40), ("s1", 5000, 50), ("s2", 6000, 60)]


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(READINGS, schemas.WATER_SENSOR)


def test_pipe_file_holds_exactly_the_filtered_rows(spark, readings, tmp_path):
    file_sinks.write_delimited(readings.coalesce(1).where("id = 's1'"), str(tmp_path / "out"))
    lines = "".join(open(f).read() for f in glob.glob(str(tmp_path / "out" / "part-*")))
    assert lines == "s1|1000|10\ns1|2000|20\ns1|4000|40\ns1|5000|50\n"


def test_malformed_line_fails(spark, tmp_path):
    (tmp_path / "in.csv").write_text("s1,1,10\ns1,x,20\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_delimited(spark, str(tmp_path / "in.csv"), schemas.WATER_SENSOR).collect()


def test_empty_field_is_null(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1,create,,5\n1,pay,ab,6\n")
    rows = files.read_delimited(spark, str(tmp_path / "in.csv"), schemas.ORDER_EVENT).collect()
    assert [r["tx_id"] for r in rows] == [None, "ab"]


def test_word_files_as_stream_and_table(spark, tmp_path):
    (tmp_path / "words").mkdir()
    (tmp_path / "words" / "w.txt").write_text("hello you\nhello stream\n")
    path = str(tmp_path / "words")
    words = reshape.split_words(files.read_lines(spark, path))
    assert sorted(r["word"] for r in words.collect()) == ["hello", "hello", "stream", "you"]
    assert files.read_lines(spark, path, stream=True).isStreaming


def test_kafka_records(spark, readings):
    options = kafka.source_options("h1:9092,h2:9092", "sensor", "g")
    assert options == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "sensor",
                       "startingOffsets": "latest", "kafka.group.id": "g"}
    records = kafka.as_records(readings, "id")
    assert json.loads(records.first()["value"]) == {"id": "s1", "ts": 1000, "vc": 10}
    binary = records.select(F.col("value").cast("binary").alias("value"))
    assert sorted(map(tuple, kafka.json_rows(binary, schemas.WATER_SENSOR).collect())) == sorted(READINGS)
    lines = readings.select(F.concat_ws(",", "id", "ts", "vc").alias("value"))
    assert sorted(map(tuple, kafka.csv_rows(lines, schemas.WATER_SENSOR).collect())) == sorted(READINGS)


class FolderStore:
    """Writes each batch of rows to its own file; stands in for an outside store."""

    def __init__(self, folder):
        self.folder = folder

    def upsert(self, rows):
        import uuid
        with open(f"{self.folder}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump(rows, f)

    def close(self):
        open(f"{self.folder}/closed", "a").write("x")


def stored(folder):
    return [r for f in glob.glob(f"{folder}/*.json") for r in json.load(open(f))]


def test_last_value_per_key_goes_to_the_store(spark, readings, tmp_path):
    folder = str(tmp_path)
    last = keyed.last_by_key(readings, "id", ["ts"], ["ts", "vc"])
    keyed.write_partitions(last, lambda: FolderStore(folder), batch_size=1)
    got = {k: json.loads(v) for k, v in stored(folder)}
    assert got == {"s1": {"ts": 5000, "vc": 50}, "s2": {"ts": 6000, "vc": 60}}


def test_upsert_stream(spark, readings, tmp_path):
    for name in ("in", "store"):
        (tmp_path / name).mkdir()
    folder = str(tmp_path / "store")
    readings.write.mode("append").parquet(str(tmp_path / "in"))
    stream = files.read_table(spark, str(tmp_path / "in"), schemas.WATER_SENSOR, stream=True)
    started = keyed.upsert_stream(stream, "id", ["ts"], ["vc"], lambda: FolderStore(folder), str(tmp_path / "c"))
    started.trigger(availableNow=True).start().awaitTermination()
    assert {k: json.loads(v)["vc"] for k, v in stored(folder)} == {"s1": 50, "s2": 60}


class FakeConnection:
    def __init__(self):
        self.log = []

    def cursor(self):
        return self

    def executemany(self, statement, rows):
        self.log.append((statement, list(rows)))

    def commit(self):
        self.log.append("commit")

    def close(self):
        self.log.append("close")


def test_sql_store_batches_a_prepared_statement():
    connection = FakeConnection()
    store = keyed.SqlStore(connection, "INSERT INTO sensor VALUES (?, ?, ?)")
    store.upsert(READINGS[:2])
    store.close()
    assert connection.log == [("INSERT INTO sensor VALUES (?, ?, ?)", READINGS[:2]), "commit", "close"]
    options = keyed.jdbc_options("jdbc:x", "sensor", "d.Driver", "u", "p", batch_size=1)
    assert options == {"url": "jdbc:x", "dbtable": "sensor", "driver": "d.Driver", "batchsize": "1", "user": "u", "password": "p"}


def test_generated_source(spark, tmp_path):
    spark.dataSource.register(generated.SensorSource)
    rows = spark.read.format("sensor_rows").option("rows", 500).option("parts", 3).load()
    assert rows.count() == 500 and rows.rdd.getNumPartitions() == 3
    low, high = rows.agg(F.min("vc"), F.max("vc")).first()
    assert 0 <= low < high < 1000
    again = spark.read.format("sensor_rows").option("rows", 500).option("parts", 7).load()
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, again.collect()))


def test_generated_stream(spark, tmp_path):
    spark.dataSource.register(generated.SensorSource)
    stream = spark.readStream.format("sensor_rows").option("rows", 250).option("perBatch", 100).load()
    query = (stream.groupBy().count().writeStream.outputMode("complete").format("memory").queryName("made")
             .option("checkpointLocation", str(tmp_path)).start())
    try:
        query.processAllAvailable()
        assert spark.table("made").first()[0] == 250
    finally:
        query.stop()


def test_partitioners(spark):
    rows = spark.range(1000)
    assert repartition.round_robin(rows, 5).rdd.getNumPartitions() == 5
    sizes = repartition.at_random(rows, 4, "id", seed=1).rdd.glom().map(len).collect()
    assert sum(sizes) == 1000 and min(sizes) > 150
    assert repartition.rescale(rows.repartition(6), 2).rdd.getNumPartitions() == 2
    assert repartition.rescale(rows.repartition(2), 6).rdd.getNumPartitions() == 6
    by = repartition.by_key(rows.withColumn("k", F.col("id") % 3), "k", parts=4)
    assert by.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("n")).agg(F.max("n")).first()[0] == 1


def test_user_functions(spark, readings):
    udfs.register(spark)
    readings.createOrReplaceTempView("readings")
    lengths = spark.sql("SELECT DISTINCT str_len(id) AS n FROM readings").collect()
    assert [r["n"] for r in lengths] == [2]
    spark.sql("SELECT * FROM VALUES ('a_b_c', '_'), (NULL, '_'), ('x-y', '-'), ('', '-'), ('q', NULL) AS t(text, sep)").createOrReplaceTempView("to_split")
    words = spark.sql("SELECT text, word FROM split_words(TABLE(to_split))").collect()
    assert sorted(map(tuple, words)) == [("", ""), ("a_b_c", "a"), ("a_b_c", "b"), ("a_b_c", "c"), ("x-y", "x"), ("x-y", "y")]


def test_aggregates_as_table_functions(spark):
    udfs.register(spark)
    rows = [(k % 3 if k % 10 else None, None if k % 7 == 0 else float("nan") if k == 50 else k / 4) for k in range(100)] + [(9, None)]
    spark.createDataFrame(rows, "user_id bigint, vc double").repartition(7).createOrReplaceTempView("udtf_rows")
    top = spark.sql("SELECT * FROM top2(TABLE(SELECT * FROM top2_parts(TABLE(udtf_rows))) PARTITION BY user_id)").collect()
    want = set()
    for user in (None, 0, 1, 2):
        best = sorted((v for u, v in rows if u == user and v is not None), key=lambda v: (v != v, v), reverse=True)[:2]
        want |= {str((user, v, str(n))) for n, v in enumerate(best, 1)}
    assert {str(tuple(r)) for r in top} == want
    fine = "SELECT CAST(user_id AS STRING) AS key, vc AS value FROM udtf_rows WHERE vc IS NULL OR NOT isnan(vc)"
    means = spark.sql(f"SELECT * FROM avg_of_parts(TABLE(SELECT * FROM avg_parts(TABLE({fine}))) PARTITION BY key)").collect()
    for key, mean in means:
        values = [v for u, v in rows if v == v and v is not None and (None if u is None else str(u)) == key]
        assert mean == (pytest.approx(sum(values) / len(values)) if values else None)
    assert {r["key"] for r in means} == {None, "0", "1", "2", "9"}


def test_user_aggregate(spark, readings):
    rows = readings.unionByName(spark.createDataFrame([("s3", 1, None)], schemas.WATER_SENSOR))
    got = udfs.user_aggregate(rows.repartition(4), ["id"], udfs.Average("vc"), "average", ["vc"], held_keys=1)
    assert {r["id"]: r["average"] for r in got.collect()} == {"s1": 30.0, "s2": 45.0, "s3": None}


def test_resource_is_closed(spark, readings, tmp_path):
    mark = str(tmp_path / "closed")

    def close(_):
        open(mark, "a").write("x")

    def double(factor, batch):
        return pd.DataFrame({"vc": batch["vc"] * factor})

    got = reshape.map_with_resource(readings.coalesce(1), "vc int", lambda: 2, double, close)
    assert sorted(r["vc"] for r in got.collect()) == [20, 40, 60, 80, 100, 120]
    assert open(mark).read() == "x"


def test_time_without_milliseconds(spark):
    row = spark.createDataFrame([(1_234_567,)], "ms bigint").select(scalar.truncated_to_seconds("ms").alias("t")).first()
    assert row["t"].microsecond == 0 and int(row["t"].timestamp()) == 1234
