"""Connector options and record shapes."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from streamrank import schemas
from streamrank.session import shared_dir, stream_session
from streamrank.sinks.topics import sink_options, write_topic
from streamrank.sources.avro import avro_values, by_schema_id, header_id
from streamrank.sources.topics import earliest, source_options, topic_stream


def test_source_options():
    assert source_options("h:1") == {"kafka.bootstrap.servers": "h:1"}
    assert source_options("h:1", group_id="") == {"kafka.bootstrap.servers": "h:1"}
    assert source_options("h:1", group_id="g", session_timeout_ms=9, min_offsets_per_trigger=200) == {
        "kafka.bootstrap.servers": "h:1", "kafka.group.id": "g",
        "kafka.session.timeout.ms": "9", "minOffsetsPerTrigger": "200",
    }
    assert earliest("h:1")["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in earliest("h:1", max_offsets_per_trigger=None)
    assert earliest("h:1", max_offsets_per_trigger=7)["maxOffsetsPerTrigger"] == "7"


def test_given_options_replace_all():
    given = {"kafka.bootstrap.servers": "other:1"}
    assert source_options("h:1", group_id="g", override=given) == given
    assert sink_options("h:1", override=given) == given
    assert source_options("h:1", override={}) == {"kafka.bootstrap.servers": "h:1"}
    assert sink_options("h:1", override={})["kafka.bootstrap.servers"] == "h:1"


def test_sink_options():
    assert sink_options("h:1") == {
        "kafka.bootstrap.servers": "h:1", "kafka.acks": "all",
        "kafka.batch.size": "16384", "kafka.linger.ms": "1", "kafka.buffer.memory": "33554432",
    }
    assert sink_options("h:1", acks="1", retries=3)["kafka.retries"] == "3"


def test_connectors_need_their_packages(spark):
    """Without the packages the calls reach Spark and fail there, by name."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topic_stream(spark, ["a", "b"], earliest("h:1"))
    rows = spark.createDataFrame([("a", "b")], "key string, value string")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        write_topic(rows, "t", sink_options("h:1"))
    records = rows.select(F.current_timestamp().alias("timestamp"), F.encode("value", "UTF-8").alias("value"))
    with pytest.raises(AnalysisException, match="(?i)avro"):
        avro_values(records, "PageView", schemas.PAGE_VIEW)


def test_records_of_several_writer_schemas(spark):
    """Each record goes to the decoder of its schema id; text stands for the record's bytes here."""
    framed = lambda n, text: b"\x00" + n.to_bytes(4, "big") + text.encode()
    rows = spark.createDataFrame(
        [(1, framed(7, "a,1")), (2, framed(258, "b")), (3, framed(7, "c,2")), (4, None)], "id int, value binary")

    def decoder(read):
        return lambda body: F.when(body.isNotNull(), F.struct(*(c.alias(n) for c, n in zip(read(body.cast("string")), "xy"))))

    decoders = {
        7: decoder(lambda t: (F.split_part(t, F.lit(","), F.lit(1)), F.split_part(t, F.lit(","), F.lit(2)))),
        258: decoder(lambda t: (t, F.lit(None).cast("string"))),
    }
    found = rows.select("id", by_schema_id(F.col("value"), decoders).alias("r")).orderBy("id").collect()
    assert [r.r and tuple(r.r) for r in found] == [("a", "1"), ("b", None), ("c", "2"), None]
    for odd in (framed(9, "d"), b"x", b"\x01\x00\x00\x00\x07z"):
        more = rows.union(spark.createDataFrame([(5, odd)], "id int, value binary"))
        with pytest.raises(Exception, match="unexpected schema id"):
            more.select(by_schema_id(F.col("value"), decoders).alias("r")).collect()
    with pytest.raises(AnalysisException, match="(?i)avro"):
        avro_values(rows.withColumn("timestamp", F.current_timestamp()), "PageView", schemas.PAGE_VIEW,
                    writers={7: schemas.PAGE_VIEW, 258: schemas.PAGE_VIEW_STATS})


def test_page_view_schema_text():
    text = schemas.to_avsc("PageView", schemas.PAGE_VIEW)
    assert json.loads(text) == {
        "type": "record", "name": "PageView", "fields": [
            {"name": "user", "type": "string"}, {"name": "page", "type": "string"},
            {"name": "industry", "type": "string"},
            {"name": "flags", "type": ["null", "string"], "default": None},
        ],
    }
    assert schemas.read_avsc(text) == {"PageView": schemas.PAGE_VIEW}


@pytest.mark.parametrize("record", [schemas.PAGE_VIEW_STATS, schemas.PLAY_EVENT, schemas.COMMON_RANK])
def test_schema_text_round_trip(record):
    assert schemas.read_avsc(schemas.to_avsc("Thing", record))["Thing"] == record


def test_schema_lists_enums_and_names():
    text = json.dumps([
        {"namespace": "n.s", "type": "enum", "name": "State", "symbols": ["ON", "OFF"]},
        {"namespace": "n.s", "type": "record", "name": "Inner", "fields": [{"name": "n", "type": "int"}]},
        {"namespace": "n.s", "type": "record", "name": "Outer", "fields": [
            {"name": "state", "type": "State"}, {"name": "inner", "type": "n.s.Inner"},
            {"name": "note", "type": ["string", "null"]},
        ]},
    ])
    outer = schemas.read_avsc(text)["Outer"]
    assert outer.simpleString() == "struct<state:string,inner:struct<n:int>,note:string>"
    assert [f.nullable for f in outer] == [False, False, True]
    with pytest.raises(ValueError):
        schemas.read_avsc('{"type":"record","name":"R","fields":[{"name":"x","type":"Missing"}]}')
    with pytest.raises(ValueError):
        schemas.read_avsc('{"type":"record","name":"R","fields":[{"name":"x","type":["int","string"]}]}')


def test_shared_dir_is_the_named_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(root + "/x-") and first != second


def test_stream_session_settings(spark):
    session = stream_session(spark)
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert session.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"


def test_schema_ids_in_headers(spark):
    rows = spark.createDataFrame([(b"\x00\x00\x00\x01\x02body",), (b"\x01\x00\x00\x00\x02",), (b"\x00",), (None,)], "value binary")
    assert [r[0] for r in rows.select(header_id(F.col("value"))).collect()] == [258, None, None, None]
