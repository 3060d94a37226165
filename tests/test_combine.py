"""Counting a task's own rows before the shuffle."""

from pyspark.sql import functions as F

from helpers import at, rows_of
from streamrank.operators import combine
from streamrank.operators.windows import tumbling_count

ROWS = [("a", at(1_000)), ("a", at(1_999)), ("a", at(2_000)), ("b", at(-1)), (None, at(0)), ("a", None), ("é", at(10**12))]


def test_slots_add_up_to_windows(spark):
    rows = spark.createDataFrame(ROWS * 40, "key string, timestamp timestamp").repartition(5)
    slots = combine.slot_counts(rows, ["key"], "1 second")
    counts = slots.groupBy("key", "slot").agg(F.sum("n").alias("count"),
        F.unix_micros(F.min("first")).alias("f"), F.unix_micros(F.max("last")).alias("l"))
    windows = tumbling_count(rows, ["key"], "1 second").select("key", F.unix_micros("window.start").alias("slot"), "count")
    assert rows_of(counts.select("key", "slot", "count")) == rows_of(windows)
    assert slots.count() <= 5 * windows.count()
    spans = {(r.key, r.slot): (r.f, r.l) for r in counts.collect()}
    assert spans["a", 1_000_000] == (1_000_000, 1_999_000) and spans["b", -1_000_000] == (-1_000, -1_000)


def test_many_keys_pass_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(combine, "HELD", 100)
    rows = spark.range(5_000, numPartitions=2).select(
        (F.col("id") % 700).cast("string").alias("key"), F.timestamp_millis(F.col("id")).alias("timestamp"))
    slots = combine.slot_counts(rows, ["key"], "1 hour")
    assert slots.agg(F.sum("n")).first()[0] == 5_000 and slots.select("key").distinct().count() == 700
    assert combine.slot_counts(rows.limit(0), ["key"], "1 hour").count() == 0
