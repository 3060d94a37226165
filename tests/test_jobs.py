"""Jobs from encoded topic records to encoded topic records."""

import dataclasses

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import Feed, at, clock, rows_of
from streamrank.functions.wire import bytes_to_long, bytes_to_windowed_key
from streamrank.jobs import JOBS, jobs, main, start_job, start_landing, start_rank_table, to_console
from streamrank.operators.projections import header
from streamrank.schemas import PAGE_VIEW
from streamrank.session import stream_session
from streamrank.sinks.batches import read_batches
from streamrank.sinks.landing import read_landed
from streamrank.sinks.rank_table import read_rank_table
from streamrank.streaming.run import to_batches
from test_json_events import FULL
from test_windows import PLAYS, SESSIONS

TOPIC_DDL = "key binary, value binary, timestamp timestamp"


@pytest.fixture(scope="module")
def session(spark):
    sibling = stream_session(spark)
    sibling.conf.set("spark.sql.shuffle.partitions", "2")
    return sibling


def outcome(spark, session, tmp_path, job, *batches):
    feed = Feed(tmp_path / "in", TOPIC_DDL)
    for batch in batches:
        feed.send(*batch)
    path = str(tmp_path / "out")
    start_job(
        job, feed.stream(session), to_batches(path), name="job",
        checkpoint=str(tmp_path / "cp"), every=None,
    ).awaitTermination()
    return read_batches(spark, path)


def windowed(records):
    key, start = bytes_to_windowed_key(F.col("key"))
    return records.select("batch_id", key.alias("key"), start.alias("start"), F.decode("value", "UTF-8").alias("value"))


def keyed(records):
    return records.select("batch_id", F.decode("key", "UTF-8").alias("key"), bytes_to_long(F.col("value")).alias("value"))


def big_endian(n):
    return n.to_bytes(8, "big", signed=True)


def test_play_sessions(spark, session, tmp_path):
    rows = [(key.encode(), b"play", at(ms)) for key, ms in PLAYS]
    silent = [(None, b"play", at(PLAYS[0][1])), (b"jo", None, at(PLAYS[0][1] + 1))]
    end = [(b"end", b"play", at(PLAYS[0][1] + 10**9))]
    found = keyed(outcome(spark, session, tmp_path, JOBS["play-sessions"], rows + silent, end))
    assert dict(rows_of(found.select("key", "value"))) == SESSIONS


def test_hot_words_report_every_change(spark, session, tmp_path):
    rows = [(b"w", big_endian(1), at(600_000))]
    found = keyed(outcome(spark, session, tmp_path, JOBS["hot-words"], rows, rows))
    assert found.filter("key = 'w@600000->900000'").select("batch_id", "value").orderBy("batch_id").collect() == [(0, 1), (1, 2)]
    assert found.count() == 10


def test_rank_events(spark, session, tmp_path):
    message = (None, FULL.encode(), clock("12:00:30"))
    found = windowed(outcome(spark, session, tmp_path, JOBS["rank-events"], [message, (None, b"junk", clock("12:00:00"))], [message]))
    record = '"rank_type":"searchProduct","rank_id":"hello","user_project":"mall","rank_channel":"H5"'
    noon = int(clock("12:00:00").timestamp() * 1000)
    assert rows_of(found) == [
        (0, f"{{{record}}}", noon, f'{{{record},"rank_value":1}}'),
        (1, f"{{{record}}}", noon, f'{{{record},"rank_value":2}}'),
    ]


def test_search_words(spark, session, tmp_path):
    message = (None, FULL.encode(), clock("12:00:31"))
    found = windowed(outcome(spark, session, tmp_path, JOBS["search-words"], [message, message]))
    start = int(clock("12:00:30").timestamp() * 1000)
    assert rows_of(found) == [
        (0, '{"project":"mall","search_word":"hello"}', start, '{"project":"mall","search_word":"hello","count":2}'),
    ]


def test_word_count(spark, session, tmp_path):
    batches = [[(None, line.encode(), at(0))] for line in ("hello kafka", "kafka")] + [[(None, None, at(0))]]
    found = keyed(outcome(spark, session, tmp_path, JOBS["word-count"], *batches))
    assert rows_of(found) == [(0, "hello", 1), (0, "kafka", 1), (1, "kafka", 2)]


def test_top_pages(spark, session, tmp_path):
    """Page views come as JSON here, since Avro needs a package."""
    job = dataclasses.replace(JOBS["top-pages"], decode=lambda records: records.select(
        F.from_json(F.col("value").cast("string"), PAGE_VIEW).alias("view"), "timestamp"
    ).select("view.*", "timestamp"))
    view = '{"user":"u","page":"%s","industry":"吃类","flags":"%s"}'
    rows = [(None, (view % pair).encode(), clock("12:10:00")) for pair in (
        ("news.html", "ARTICLE"), ("index.html", "ARTICLE"), ("news.html", "ARTICLE"), ("about.html", "AD"),
    )]
    end = [(None, (view % ("end", "ARTICLE")).encode(), clock("23:00:00", "2024-01-09"))]
    found = windowed(outcome(spark, session, tmp_path, job, rows, end))
    assert rows_of(found.select("key", "start", "value")) == [
        ("吃类", int(clock("12:00:00").timestamp() * 1000), "news.html\nindex.html\n"),
    ]


def test_snapshots(spark, session, tmp_path):
    rows = [(b"a", b"x", at(10_100)), (b"a", b"y", at(10_200))]
    end = [(b"end", b"x", at(10**9))]
    found = outcome(spark, session, tmp_path, JOBS["snapshots"], rows, end)
    assert rows_of(found.select(F.decode("key", "UTF-8"), F.decode("value", "UTF-8"))) == [("a", "2")]


def test_console(spark, capfd):
    to_console(2)(spark.createDataFrame([("k", "v")], "key string, value string"), 3)
    printed = capfd.readouterr().out
    assert "batch 3" in printed and "|k  |v    |" in printed and "not shown" not in printed
    to_console(50)(spark.range(60).select(F.format_string("row %d.", "id").alias("key")), 4)
    printed = capfd.readouterr().out
    assert printed.count("row ") == 50 and "10 more rows are not shown" in printed


def test_results_go_somewhere(tmp_path):
    with pytest.raises(SystemExit):
        main(["word-count", "--source", "a", "--checkpoint", str(tmp_path)])


def many_messages(n):
    return [("events", None, FULL.encode(), clock("12:00:30")) for _ in range(n)]


def test_landing_and_rank_table_take_all_there_is(spark, session, tmp_path):
    """More records than one trigger once was allowed to take, in one trigger."""
    feed = Feed(tmp_path / "in", "topic string, key binary, value binary, timestamp timestamp")
    feed.send(*many_messages(6_000))
    start_landing(feed.stream(session), str(tmp_path / "land"), str(tmp_path / "cp"), uuid=True, roll=None).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "land"))
    assert landed.count() == landed.select(header("uuid")).distinct().count() == 6_000
    start_landing(feed.stream(session), str(tmp_path / "text"), str(tmp_path / "cp2"), roll=None).awaitTermination()
    assert read_landed(spark, str(tmp_path / "text")).count() == 6_000

    feed.send(("events", None, FULL.encode(), clock("23:00:00", "2024-01-09")))
    start_rank_table(feed.stream(session), str(tmp_path / "ranks"), str(tmp_path / "cp3"), every=None).awaitTermination()
    assert read_rank_table(spark, str(tmp_path / "ranks")).first().rank_value == 6_000


def test_parameters_reach_the_jobs(spark, session, tmp_path):
    """A shorter lateness and width close a window that the defaults keep open."""
    rows = [(b"jo", b"play", clock(t)) for t in ("12:00:00", "12:00:20", "12:10:00")]
    end = [(b"end", b"play", clock("13:00:00"))]
    job = jobs(late="1 minute", gap="1 minute 30 seconds")["play-sessions"]
    found = keyed(outcome(spark, session, tmp_path, job, rows, end))
    assert sorted(v for k, v in rows_of(found.select("key", "value")) if k.startswith("jo")) == [1, 2]


def test_live_sessions_as_records(spark, session, tmp_path):
    batches = [[(key.encode(), b"play", at(ms))] for key, ms in PLAYS]
    found = keyed(outcome(spark, session, tmp_path, JOBS["play-sessions-live"], *batches))
    table = {}
    for row in found.orderBy("batch_id").collect():
        table[row.key] = row.value
    assert {k: v for k, v in table.items() if v is not None} == SESSIONS


def test_live_top_pages_as_records(spark, session, tmp_path):
    """An overtaken page leaves the list while its hour is open."""
    live = jobs(n=1)["top-pages-live"]
    job = dataclasses.replace(live, decode=lambda records: records.select(
        F.from_json(F.col("value").cast("string"), PAGE_VIEW).alias("view"), "timestamp"
    ).select("view.*", "timestamp"))
    view = '{"user":"u","page":"%s","industry":"x","flags":"ARTICLE"}'
    sent = [[(None, (view % page).encode(), clock("12:10:00")) for page in pages] for pages in ("a", "bb", "c")]
    found = windowed(outcome(spark, session, tmp_path, job, *sent))
    assert [r.value for r in found.orderBy("batch_id").collect()] == ["a\n", "b\n", "b\n"]


@pytest.mark.parametrize("job", ["word-count", "landing", "rank-table"])
def test_command_line_reaches_the_connector(spark, job, tmp_path):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        main([job, "--source", "a,b", "--target", "t", "--checkpoint", str(tmp_path)])
