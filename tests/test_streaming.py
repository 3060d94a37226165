"""The jobs as streams: lateness, restarts, replays, and agreement with batch."""

import os
import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from helpers import SF_DIR, Feed, at, clock, rows_of
from streamrank.operators.windows import running_count, session_count, tumbling_count
from streamrank.plans.labelled_counts import play_sessions
from streamrank.plans.rank_events import rank_counts, store_rank_counts
from streamrank.plans.top_pages import page_counts, store_top_pages, top_pages
from streamrank.plans.word_count import word_count
from streamrank.registry import QUERIES
from streamrank.session import stream_session
from streamrank.sinks.batches import read_batches, write_batch
from streamrank.sinks.rank_table import read_rank_table
from streamrank.streaming.latest import latest
from streamrank.streaming.run import fresh_checkpoint, run, to_batches, watermarked, table_stream
from streamrank.functions.labels import window_label
from streamrank.streaming.keyed import (
    Heartbeat, current_sessions, heartbeat, live_hopping_count, live_lists, live_session_changes, live_top,
)
from streamrank.streaming.snapshot import PeriodicSnapshot, periodic_snapshot
from test_windows import PLAYS, SESSIONS


@pytest.fixture(scope="module")
def session(spark):
    sibling = stream_session(spark)
    sibling.conf.set("spark.sql.shuffle.partitions", "2")
    return sibling


def play(result, handler, checkpoint, final_only=True):
    query = run(result, handler, name="test", checkpoint=str(checkpoint), final_only=final_only, every=None)
    query.awaitTermination()


def hourly(rows):
    return tumbling_count(watermarked(rows, "10 minutes"), ["key"], "1 hour")


def counts_by_hour(df):
    return {(r.key, r.h): r["count"] for r in df.select("key", F.date_format("window.start", "HH").alias("h"), "count").collect()}


@pytest.mark.parametrize("every", ["0 seconds", "1 second"])
def test_running_on(spark, session, tmp_path, every):
    feed = Feed(tmp_path / "in")
    feed.send(("a", at(0)))
    path = str(tmp_path / "out")
    query = run(
        running_count(feed.stream(session), ["key"]), to_batches(path), name="running-on",
        checkpoint=str(tmp_path / "cp"), final_only=False, every=every,
    )
    try:
        query.processAllAvailable()
        feed.send(("a", at(1)))
        query.processAllAvailable()
        assert query.name == "running-on" and query.isActive
    finally:
        query.stop()
    assert rows_of(read_batches(spark, path).select("batch_id", "count")) == [(0, 1), (1, 2)]


def test_late_and_too_late_rows(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(("a", clock("12:30:00")), ("a", clock("13:05:00")))   # watermark 12:55
    feed.send(("a", clock("12:20:00")))                             # late, window still open
    feed.send(("a", clock("13:30:00")))                             # watermark 13:20
    feed.send(("a", clock("13:31:00")))                             # this batch closes 12h
    feed.send(("a", clock("12:40:00")), ("a", clock("13:10:00")))   # too late; late but in time
    feed.send(("end", clock("23:00:00")))
    path = str(tmp_path / "out")
    play(hourly(feed.stream(session)), to_batches(path), tmp_path / "cp")
    assert counts_by_hour(read_batches(spark, path)) == {("a", "12"): 2, ("a", "13"): 4}


def test_open_windows_wait(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(("a", clock("12:30:00")), ("a", clock("13:30:00")))
    path = str(tmp_path / "out")
    play(hourly(feed.stream(session)), to_batches(path), tmp_path / "cp")
    assert counts_by_hour(read_batches(spark, path)) == {("a", "12"): 1}


def test_updates_then_restart_from_checkpoint(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    path, checkpoint = str(tmp_path / "out"), tmp_path / "cp"
    feed.send(("a", at(0)), ("b", at(0)))
    feed.send(("a", at(1000)))
    for more in ((), (("a", at(2000)), ("c", at(0)))):
        if more:
            feed.send(*more)
        play(running_count(feed.stream(session), ["key"]), to_batches(path), checkpoint, final_only=False)
    changes = read_batches(spark, path)
    assert rows_of(changes.select("batch_id", "key", "count")) == [
        (0, "a", 1), (0, "b", 1), (1, "a", 2), (2, "a", 3), (2, "c", 1),
    ]
    assert rows_of(latest(changes, ["key"])) == [("a", 3), ("b", 1), ("c", 1)]


def test_fresh_checkpoint_starts_over(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(("a", at(0)))
    for attempt in range(2):
        path = str(tmp_path / f"out{attempt}")
        play(running_count(feed.stream(session), ["key"]), to_batches(path), fresh_checkpoint(spark, "t"), final_only=False)
        assert rows_of(read_batches(spark, path).select("key", "count")) == [("a", 1)]


def test_replayed_batch_counts_once(spark, session, tmp_path):
    """The handler fails after storing its batch, so the batch comes again."""
    feed = Feed(tmp_path / "in", "value string, timestamp timestamp")
    message = '{"data":{"event":"viewProduct","project":"p","properties":{"product_id":"1"}}}'
    feed.send((message, clock("12:00:00")), (message, clock("12:00:30")))
    feed.send((message, clock("12:05:00")))
    feed.send((message, clock("23:00:00")))
    path, checkpoint = str(tmp_path / "out"), tmp_path / "cp"
    store, seen = store_rank_counts(path, F.lit(1)), []

    def flaky(rows, batch_id):
        store(rows, batch_id)
        seen.append((batch_id, rows.count()))
        if seen[-1][1] and len([s for s in seen if s[1]]) == 1:
            raise RuntimeError("lost")

    def start():
        rows = watermarked(feed.stream(session), "1 minute")
        play(rank_counts(rows), flaky, checkpoint)

    with pytest.raises(Exception, match="lost"):
        start()
    start()
    stored = [batch_id for batch_id, count in seen if count]
    assert len(stored) > len(set(stored))
    assert [row.rank_value for row in read_rank_table(spark, path).collect()] == [3]


def test_input_is_consumed_only_after_the_handler(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(("a", at(0)))
    path, checkpoint = str(tmp_path / "out"), tmp_path / "cp"

    def refuse(rows, batch_id):
        raise RuntimeError("not now")

    with pytest.raises(Exception, match="not now"):
        play(feed.stream(session), refuse, checkpoint)
    play(feed.stream(session), to_batches(path), checkpoint)
    assert read_batches(spark, path).count() == 1


def test_top_pages_of_a_window_come_in_one_batch(spark, session, tmp_path):
    ddl = "user string, page string, industry string, flags string, timestamp timestamp"
    feed = Feed(tmp_path / "in", ddl)
    rows = [
        [("u", f"p{i % (7 + hour)}", f"i{i % 3}", "ARTICLE", clock(f"{hour:02}:{i % 60:02}:00")) for i in range(200)]
        for hour in range(4)
    ]
    for chunk in rows:
        feed.send(*chunk)
    feed.send(("u", "end", "end", "ARTICLE", clock("23:00:00")))
    path = str(tmp_path / "out")
    play(page_counts(watermarked(feed.stream(session), "10 minutes")), store_top_pages(path, 3), tmp_path / "cp")
    stored = read_batches(spark, path)
    assert stored.count() == 12
    assert stored.select("batch_id").distinct().count() > 1
    batch = spark.createDataFrame([row for chunk in rows for row in chunk], ddl)
    assert rows_of(stored.drop("batch_id")) == rows_of(top_pages(page_counts(batch), 3).select(stored.drop("batch_id").columns))


def test_golden_sessions_arriving_one_by_one(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    for key, ms in PLAYS:
        feed.send((key, at(ms)))
    feed.send(("end", at(PLAYS[0][1] + 10**9)))
    path = str(tmp_path / "out")
    play(play_sessions(watermarked(feed.stream(session))), to_batches(path), tmp_path / "cp")
    assert dict(rows_of(read_batches(spark, path).drop("batch_id"))) == SESSIONS


def test_sessions_refuse_update_mode(session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(("a", at(0)))
    sessions = session_count(watermarked(feed.stream(session)), ["key"], "30 minutes")
    with pytest.raises(Exception, match="(?i)session window"):
        play(sessions, lambda rows, batch_id: None, tmp_path / "cp", final_only=False)


def test_word_count_updates(spark, session, tmp_path):
    feed = Feed(tmp_path / "in", "value string")
    for line in ("hello kafka streams", "all streams lead to kafka", "join kafka summit"):
        feed.send((line,))
    path = str(tmp_path / "out")
    play(word_count(feed.stream(session)), to_batches(path), tmp_path / "cp", final_only=False)
    changes = read_batches(spark, path)
    assert [row["count"] for row in changes.filter("word = 'kafka'").orderBy("batch_id").collect()] == [1, 2, 3]
    assert changes.filter("word = 'hello'").count() == 1
    assert dict(rows_of(latest(changes, ["word"])))["streams"] == 2


def test_snapshots_report_running_totals(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(("a", at(10_100)), ("a", at(10_900)), ("b", at(10_500)))
    feed.send(("a", at(12_000)))
    feed.send(("end", at(60_000)))
    feed.send(("end", at(90_000)))
    path = str(tmp_path / "out")
    result = periodic_snapshot(watermarked(feed.stream(session), "0 seconds"), "key")
    play(result, to_batches(path), tmp_path / "cp")
    reports = read_batches(spark, path).filter("key <> 'end'").select("key", "tick_ms", "value")
    assert rows_of(reports) == [("a", 11_000, "2"), ("a", 13_000, "3"), ("b", 11_000, "1")]


def test_snapshots_of_many_seconds_in_one_batch(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(*(("a", at(1000 * second + i)) for second in range(20) for i in range(3)))
    feed.send(("end", at(60_000)))
    path = str(tmp_path / "out")
    play(periodic_snapshot(watermarked(feed.stream(session), "0 seconds"), "key"), to_batches(path), tmp_path / "cp")
    reports = read_batches(spark, path).filter("key = 'a'").select("tick_ms", "value")
    assert sorted(map(tuple, reports.collect())) == [(1000 * s + 1000, str(3 * s + 3)) for s in range(20)]


def test_live_sessions_change_by_change(spark, session, tmp_path):
    """The nine updates of the golden plays, and the session that another has replaced."""
    feed = Feed(tmp_path / "in")
    for key, ms in PLAYS:
        feed.send((key, at(ms)))
    path = str(tmp_path / "out")
    play(live_session_changes(feed.stream(session)), to_batches(path), tmp_path / "cp")
    changes = read_batches(spark, path)
    label = window_label(F.col("key"), F.col("window.start"), F.col("window.end"))
    found = {}
    for row in changes.select("batch_id", label.alias("label"), "count", "replaced").collect():
        found.setdefault(row.batch_id, []).append((row.label, row["count"], row.replaced))
    assert [(label, count) for i in range(9) for label, count, gone in found[i] if not gone] == [
        ("jo@1484823406597->1484823406597", 1), ("bill@1484823466597->1484823466597", 1),
        ("sarah@1484823526597->1484823526597", 1), ("jo@1484825207597->1484825207597", 1),
        ("bill@1484823466597->1484825206597", 2), ("sarah@1484827006597->1484827006597", 1),
        ("jo@1484823406597->1484825207597", 3), ("bill@1484828806597->1484828806597", 1),
        ("sarah@1484827006597->1484827186597", 2),
    ]
    assert sorted(label for label, _, gone in found[6] if gone) == [
        "jo@1484823406597->1484823406597", "jo@1484825207597->1484825207597"]
    standing = current_sessions(changes, ["key"])
    assert dict(rows_of(standing.select(label, "count"))) == SESSIONS


def test_lists_under_signed_changes(spark, session, tmp_path):
    """Items that shrink or leave make room for others; a group may lose all of them."""
    feed = Feed(tmp_path / "in", "grp string, slot long, item string, delta long")
    feed.send(*(("g", 0, f"i{i}", 10 + i) for i in range(40)), ("h", 0, "only", 1))
    feed.send(("g", 0, "i39", -45), ("g", 0, "i38", -48), ("h", 0, "only", -1))
    feed.send(("g", 0, "i0", 90), ("g", 0, "i37", 3), ("g", 0, "i1", 0))
    path = str(tmp_path / "out")
    play(live_lists(feed.stream(session), 3), to_batches(path), tmp_path / "cp")
    found = {(r.batch_id, r.grp): list(zip(r["items"], r.amounts)) for r in read_batches(spark, path).collect()}
    assert found == {
        (0, "g"): [("i39", 49), ("i38", 48), ("i37", 47)], (0, "h"): [("only", 1)],
        (1, "g"): [("i37", 47), ("i36", 46), ("i35", 45)], (1, "h"): [],
        (2, "g"): [("i0", 100), ("i37", 50), ("i36", 46)],
    }


def test_closed_windows_leave_the_state(spark, session, tmp_path):
    """A row for a window that the watermark has passed finds no state, and is dropped as late."""
    feed = Feed(tmp_path / "in", "page string, industry string, timestamp timestamp")
    feed.send(("p", "i", clock("10:10:00")), ("q", "i", clock("10:20:00")), (None, "i", clock("10:20:00")))
    feed.send(("p", "i", clock("10:30:00")), ("p", "i", clock("11:10:00")))
    feed.send(("r", "i", clock("14:00:00")))
    feed.send(("q", "i", clock("10:40:00")), ("s", "i", clock("14:10:00")), ("s", "i", clock("14:11:00")))
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    play(live_top(feed.stream(session), "industry", "page", 2, "1 hour", "10 minutes"), to_batches(path), checkpoint)
    lists = read_batches(spark, path).select("batch_id", F.date_format("window.start", "HH").alias("h"), "items", "amounts")
    assert sorted((r.batch_id, r.h, r["items"], r.amounts) for r in lists.collect()) == [
        (0, "10", ["p", "q"], [1, 1]), (1, "10", ["p", "q"], [2, 1]), (1, "11", ["p"], [1]),
        (2, "14", ["r"], [1]), (3, "14", ["s", "r"], [2, 1])]
    state = spark.read.format("statestore").option("stateVarName", "amounts").option("operatorId", 1)
    kept = state.option("path", checkpoint).load()
    assert {r.key.slot for r in kept.select("key").distinct().collect()} == {clock("14:00:00").timestamp() * 1_000_000}


def test_hot_keys_reach_the_state_as_slots(spark, session, tmp_path):
    """State handlers get a row per key, slot and task, not one per event."""
    feed = Feed(tmp_path / "in")
    feed.send(*(("a", at(i)) for i in range(5_000)))
    path = str(tmp_path / "out")
    query = run(live_hopping_count(feed.stream(session), "key", "5 minutes", "1 minute"), to_batches(path),
                name="hot", checkpoint=str(tmp_path / "cp"), final_only=True, every=None)
    query.awaitTermination()
    assert {r["count"] for r in read_batches(spark, path).collect()} == {5_000}
    assert read_batches(spark, path).count() == 5
    seen = query.recentProgress[0]["stateOperators"][0]
    assert seen["numRowsUpdated"] < 20
    with pytest.raises(ValueError, match="divide"):
        live_hopping_count(feed.stream(session), "key", "5 minutes", "2 minutes")


def test_live_keys_report_at_every_tick_until_they_expire(spark, session, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(("a", at(10_100)), ("a", at(10_900)), ("b", at(14_500)))
    feed.send(("a", at(11_900)), ("b", at(16_000)))
    feed.send(("b", at(20_000)), ("a", at(19_200)))
    feed.send(("end", at(60_000)))
    path = str(tmp_path / "out")
    play(heartbeat(feed.stream(session), "key", "1 second", "3 seconds", "5 seconds"), to_batches(path), tmp_path / "cp")
    reports = read_batches(spark, path).where("key <> 'end'").select("key", "tick_ms", "value")
    assert rows_of(reports) == sorted(
        [("a", t, v) for t, v in ((11_000, "2"), (12_000, "3"), (13_000, "3"), (14_000, "3"), (15_000, "3"))]
        + [("a", t, "1") for t in (20_000, 21_000, 22_000, 23_000)]
        + [("b", t, v) for t, v in ((15_000, "1"), (16_000, "1"), (17_000, "2"), (18_000, "2"), (19_000, "2"), (20_000, "2"))]
        + [("b", t, "1") for t in (21_000, 22_000, 23_000, 24_000)])
    with pytest.raises(ValueError, match="divide"):
        heartbeat(feed.stream(session), "key", "2 seconds", "3 seconds")


def test_keys_that_report_share_the_state_of_a_bucket(spark, session, tmp_path):
    """State is read and written per bucket, not per key, and every key has its own reports."""
    feed, pick = Feed(tmp_path / "in"), random.Random(5)
    rows = [(f"k{pick.randrange(200)}", pick.randrange(90_000)) for _ in range(1_500)]
    for part in range(3):
        feed.send(*((k, at(ms)) for k, ms in rows if ms // 30_000 == part))
    feed.send(("end", at(200_000)))
    path = str(tmp_path / "out")
    query = run(heartbeat(feed.stream(session), "key", "1 second", "4 seconds", "10 seconds", buckets=8), to_batches(path),
                name="buckets", checkpoint=str(tmp_path / "cp"), final_only=True, every=None)
    query.awaitTermination()
    expected = []
    for key in {k for k, _ in rows}:
        ticks = sorted(ms // 1000 * 1000 + 1000 for k, ms in rows if k == key)
        total, last = 0, None
        for tick in range(ticks[0], ticks[-1] + 4001, 1000):
            total, last = (total + ticks.count(tick), tick) if tick in ticks else (total, last)
            if last is not None:
                expected.append((key, tick, str(total)))
                total, last = (0, None) if tick == last + 4000 else (total, last)
    assert rows_of(read_batches(spark, path).where("key <> 'end'").select("key", "tick_ms", "value")) == sorted(expected, key=repr)
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress) <= 3 * 8


def test_live_state_does_not_read_what_was_stored(spark, session, tmp_path):
    """A micro-batch reads its own input files and no results of the batches before it."""
    feed = Feed(tmp_path / "in")
    for i in range(6):
        feed.send(*((f"k{j}", at(60_000 * i + j)) for j in range(50)))
    path = str(tmp_path / "out")
    query = run(live_session_changes(feed.stream(session), "key", "10 seconds"), to_batches(path),
                name="cost", checkpoint=str(tmp_path / "cp"), final_only=True, every=None)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [50] * 6
    assert sorted(os.listdir(tmp_path)) == ["cp", "in", "out"]


def test_streams_of_folders_with_odd_names(spark, tmp_path):
    for name in ("plain", "odd[1]{x}*"):
        path = f"{tmp_path}/{name}"
        spark.range(3).write.parquet(f"{tmp_path}/made-{len(name)}")
        os.rename(f"{tmp_path}/made-{len(name)}", path)
        for written in (path, path + "/"):
            assert table_stream(spark, written, "id long").schema.simpleString() == "struct<id:bigint>"


def test_tables_of_many_files(spark, tmp_path):
    """A table may be a folder of files, for batches and for streams."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("tumbling_count_1h", "top_pages_per_industry_hour"):
        expected = rows_of(QUERIES[name](spark, SF_DIR))
        assert rows_of(QUERIES[name](spark, str(tmp_path))) == expected
        streamed = QUERIES[f"stream_{name}"](spark, str(tmp_path))
        assert rows_of(streamed.select(QUERIES[name](spark, SF_DIR).columns)) == expected


@pytest.mark.parametrize("handler", [PeriodicSnapshot(), Heartbeat(1, 1)])
def test_state_handler_needs_no_package_on_executors(handler, tmp_path):
    load = "import pickle, sys; print(type(pickle.load(sys.stdin.buffer)).__name__, 'streamrank' in sys.modules)"
    found = subprocess.run(
        [sys.executable, "-c", load], input=cloudpickle.dumps(handler), cwd=tmp_path,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, check=True,
    )
    assert found.stdout.split() == [type(handler).__name__.encode(), b"False"]


def test_batches_read_back_in_another_session(spark, tmp_path):
    write_batch(spark.range(3), 7, str(tmp_path / "x"))
    assert read_batches(spark.newSession(), str(tmp_path / "x")).count() == 3
