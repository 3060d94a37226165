"""Counts over tumbling, hopping and session windows."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import at, rows_of
from streamrank.operators.windows import (
    hopping_count, micros, running_count, session_count, tumbling_count,
)
from streamrank.plans.labelled_counts import hot_words, play_sessions, printed

# Arrival order of the session example; the seventh event joins two sessions.
PLAYS = [
    ("jo", 1484823406597), ("bill", 1484823466597), ("sarah", 1484823526597),
    ("jo", 1484825207597), ("bill", 1484825206597), ("sarah", 1484827006597),
    ("jo", 1484825206597), ("bill", 1484828806597), ("sarah", 1484827186597),
]
SESSIONS = {
    "jo@1484823406597->1484825207597": 3,
    "bill@1484823466597->1484825206597": 2,
    "bill@1484828806597->1484828806597": 1,
    "sarah@1484823526597->1484823526597": 1,
    "sarah@1484827006597->1484827186597": 2,
}


def timed(spark, rows):
    return spark.createDataFrame([(k, at(ms)) for k, ms in rows], "key string, timestamp timestamp")


def windowed(df):
    return {
        (row.key, row.s, row.e): row["count"]
        for row in df.select(
            "key", "count", F.unix_millis("window.start").alias("s"), F.unix_millis("window.end").alias("e")
        ).collect()
    }


def test_golden_sessions(spark):
    assert dict(rows_of(play_sessions(timed(spark, PLAYS)))) == SESSIONS


def test_gap_is_inclusive(spark):
    rows = [("on", 0), ("on", 1_800_000), ("over", 0), ("over", 1_800_001)]
    assert windowed(session_count(timed(spark, rows), ["key"], "30 minutes")) == {
        ("on", 0, 1_800_000): 2, ("over", 0, 0): 1, ("over", 1_800_001, 1_800_001): 1,
    }


def sessions_by_hand(rows, gap):
    times = defaultdict(list)
    for key, ms in sorted(rows):
        times[key].append(ms)
    found = {}
    for key, ordered in times.items():
        session = [ordered[0]]
        for ms in ordered[1:] + [None]:
            if ms is None or ms - session[-1] > gap:
                found[(key, session[0], session[-1])] = len(session)
                session = []
            session.append(ms)
    return found


@pytest.mark.parametrize("span", [50_000, 5_000_000])
def test_sessions_match_brute_force(spark, span):
    """A third of the rows share one key; times fall on slot borders, too, and before 1970."""
    rng = random.Random(span)
    rows = [
        (("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"), rng.randrange(-span, span, 500))
        for _ in range(4000)
    ]
    rows = list(dict.fromkeys(rows))
    expected = sessions_by_hand(rows, 1000)
    assert windowed(session_count(timed(spark, rows), ["key"], "1 second")) == expected


@pytest.mark.parametrize("width, advance", [("5 minutes", "1 minute"), ("5 minutes", "2 minutes")])
def test_hopping_matches_brute_force(spark, width, advance):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.randrange(-400_000, 4_000_000)) for _ in range(2000)]
    size, step = micros(width) // 1000, micros(advance) // 1000
    expected = Counter()
    for key, ms in rows:
        start = ms - ms % step
        while start > ms - size:
            expected[(key, start, start + size)] += 1
            start -= step
    assert windowed(hopping_count(timed(spark, rows), ["key"], width, advance)) == dict(expected)


def test_windows_start_at_the_epoch(spark):
    rows = [("a", 0), ("a", 59_999), ("a", 60_000)]
    assert windowed(tumbling_count(timed(spark, rows), ["key"], "1 minute")) == {
        ("a", 0, 60_000): 2, ("a", 60_000, 120_000): 1,
    }


def test_null_keys_do_not_count(spark):
    rows = timed(spark, [(None, 0), ("a", 0)])
    assert rows_of(running_count(rows, ["key"])) == [("a", 1)]
    for counted in (
        tumbling_count(rows, ["key"], "1 hour"),
        hopping_count(rows, ["key"], "2 hours", "1 hour"),
        session_count(rows, ["key"], "1 hour"),
    ):
        assert {row.key for row in counted.collect()} == {"a"}
    kept = tumbling_count(rows, ["key"], "1 hour", null_parts=True)
    assert {row.key for row in kept.collect()} == {None, "a"}


def test_labels(spark):
    rows = timed(spark, [("w", 0)])
    assert rows_of(hot_words(rows, width="2 minutes", advance="1 minute")) == [
        ("w@-60000->60000", 1), ("w@0->120000", 1),
    ]
    assert rows_of(printed(tumbling_count(rows, ["key"], "1 hour"), "key")) == [("w>0=1",)]


def test_interval_lengths():
    assert micros("1 week") == 7 * micros("1 day") and micros("1 hour 30 minutes") == 90 * micros("1 minute")
    for odd in ("1 month", "soon", "", "5"):
        with pytest.raises(ValueError, match="fixed length"):
            micros(odd)
