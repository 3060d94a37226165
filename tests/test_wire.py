"""Byte forms of keys and values."""

from pyspark.sql import functions as F

from helpers import clock, rows_of
from streamrank.functions.wire import bytes_to_long, bytes_to_windowed_key, long_to_bytes
from streamrank.sinks.topics import keyed_longs, keyed_text, windowed_text
from streamrank.sources.topics import subscribed, typed

LONGS = [0, 1, -1, 255, -256, 2**63 - 1, -(2**63)]


def test_longs_are_eight_big_endian_bytes(spark):
    rows = spark.createDataFrame([(n,) for n in LONGS], "n long").select("n", long_to_bytes(F.col("n")).alias("b"))
    for row in rows.withColumn("back", bytes_to_long(F.col("b"))).collect():
        assert bytes(row.b) == row.n.to_bytes(8, "big", signed=True)
        assert row.back == row.n


def test_windowed_keys(spark):
    rows = spark.createDataFrame(
        [("家电类", clock("12:00:00"), "a\nb\n"), ("", clock("13:00:00"), "")], "k string, start timestamp, v string"
    ).withColumn("window", F.struct("start"))
    sent = windowed_text(rows, F.col("k"), F.col("v"))
    for row in sent.collect():
        ms = int.from_bytes(bytes(row.key)[-8:], "big")
        assert ms in (int(clock("12:00:00").timestamp() * 1000), int(clock("13:00:00").timestamp() * 1000))
    key, start = bytes_to_windowed_key(F.col("key"))
    assert {row.k for row in sent.select(key.alias("k"), start.alias("s")).collect()} == {"家电类", ""}


def test_typed_round_trip(spark):
    rows = spark.createDataFrame([("a", 5), ("b", -5)], "k string, n long")
    sent = keyed_longs(rows, F.col("k"), F.col("n"))
    assert dict(sent.dtypes) == {"key": "binary", "value": "binary"}
    assert rows_of(typed(sent, "string", "long")) == [("a", 5), ("b", -5)]
    assert rows_of(typed(keyed_text(rows, F.col("k"), F.col("n").cast("string")))) == [("a", "5"), ("b", "-5")]
    assert dict(typed(sent, "bytes", "bytes").dtypes) == {"key": "binary", "value": "binary"}


def test_subscription_reads_only_its_topics(spark, tmp_path):
    rows = spark.createDataFrame([("t1", "a"), ("t2", "b"), ("t3", "c")], "topic string, value string")
    rows.write.partitionBy("topic").parquet(str(tmp_path / "topics"))
    scan = subscribed(spark.read.parquet(str(tmp_path / "topics")), ["t1", "t3"])
    assert sorted(row.value for row in scan.collect()) == ["a", "c"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "topic" in plan.split("PartitionFilters: [")[1].split("]")[0]
