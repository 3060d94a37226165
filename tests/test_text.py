"""Words, lines and blank text."""

import random

import regex
from pyspark.sql import functions as F

from helpers import rows_of
from streamrank.functions.labels import lines_of
from streamrank.functions.text import is_blank
from streamrank.operators.projections import lines, words
from streamrank.plans.word_count import word_count

SEPARATORS = regex.compile(r"[^\p{Alphabetic}\p{M}\p{Nd}\p{Pc}‌‍]+")


def split_by_hand(line: str) -> list[str]:
    pieces = SEPARATORS.split(line.lower())
    if len(pieces) == 1:
        return pieces
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


def words_of(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    return [row.word for row in words(rows).collect()]


def test_word_edges(spark):
    assert words_of(spark, ["Hello, Wörld!"]) == ["hello", "wörld"]
    assert words_of(spark, ["!!lead trail.."]) == ["", "lead", "trail"]
    assert words_of(spark, ["你好 a_b-c"]) == ["你好", "a_b", "c"]
    assert words_of(spark, [""]) == [""]
    assert words_of(spark, ["!!"]) == []
    assert words_of(spark, [None]) == []


def test_words_match_brute_force(spark):
    rng = random.Random(7)
    alphabet = "aBz09_ -.,!?\téÖß你好й́‍٣'\" ½"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(3000)]
    expected = sorted(word for text in texts for word in split_by_hand(text))
    assert sorted(words_of(spark, texts)) == expected


def test_golden_word_count(spark):
    sent = ["hello kafka streams", "all streams lead to kafka", "join kafka summit"]
    counts = word_count(spark.createDataFrame([(t,) for t in sent], "value string"))
    assert dict(rows_of(counts)) == {
        "hello": 1, "kafka": 3, "streams": 2, "all": 1, "lead": 1, "to": 1, "join": 1, "summit": 1,
    }


def test_lines_keep_empty_ones(spark):
    docs = spark.createDataFrame([("a\n\nb\n",)], "text string")
    assert [row.value for row in lines(docs).collect()] == ["a", "", "b", ""]


def test_is_blank(spark):
    cases = {None: True, "": True, " \t\n": True, " a": False, "{}": False}
    rows = spark.createDataFrame([(text,) for text in cases], "text string")
    found = {row.text: row.blank for row in rows.select("text", is_blank(F.col("text")).alias("blank")).collect()}
    assert found == cases


def test_lines_of(spark):
    row = spark.range(1).select(
        lines_of(F.array(F.lit("a"), F.lit("b"))).alias("two"),
        lines_of(F.array().cast("array<string>")).alias("none"),
    ).first()
    assert (row.two, row.none) == ("a\nb\n", "")
