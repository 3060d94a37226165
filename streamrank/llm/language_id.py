"""Language identification by compression.

Each language's sample text is a raw-content zstandard dictionary. A text is encoded
with every dictionary, a stretch at a time so that the dictionary and not the text's
own beginning decides, and the language with the fewest bytes wins. A text whose best
two languages are closer than a margin is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import is_held_out, mapped, table

#: Bytes of sample text in a language's dictionary.
DICTIONARY_BYTES = 96_000
#: Characters of a document that go into a dictionary, a stretch from anywhere in its text.
SHARE = 600
#: Documents per language that are drawn for the dictionary, by hash.
SAMPLE_DOCS = 200
#: Share of bytes that the best language must save against the next one.
MIN_MARGIN = 0.005
#: Characters encoded at a time.
STRETCH = 1_500
LEVEL = 5
UNDETERMINED = "und"

_OTHER = re.compile(r"[\W\d_]+")


def plain(text: str | None) -> str:
    """Letters in lower case, in words between single spaces; empty if there are none."""
    words = _OTHER.sub(" ", text or "")
    if not words.replace(" ", "").isalpha():
        # Number signs such as fractions and Roman numerals belong to words, but are no letters.
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    words = words.lower().strip()
    return f" {words} " if words else ""


def train_dictionaries(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES,
) -> dict[str, bytes]:
    """A raw-content dictionary for each non-null ``lang`` of ``docs`` (text, lang).

    At most ``sample_docs`` documents of a language are drawn, by the hash of their
    text, and a stretch of ``SHARE`` letters of each, from a place that the hash decides,
    reaches the driver; so the number of languages
    alone decides how much that is. Each task trims its languages before the shuffle.
    Rows without letters or language are no help. Languages come by their number of
    rows, most first, which settles ties.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    cleaned = F.regexp_replace("text", r"[^\p{L}]+", " ")
    places = F.greatest(F.length(cleaned) - SHARE + 1, F.lit(1))
    letters = F.substr(cleaned, (F.pmod(F.xxhash64("text"), places) + 1).cast("int"), F.lit(SHARE))
    order = Window.partitionBy("lang").orderBy("h", "sample")
    drawn = usable.select("lang", F.xxhash64("text").alias("h"), letters.alias("sample")).withColumn(
        "r", F.row_number().over(order)).where(F.col("r") <= sample_docs)
    frequent = [r["lang"] for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    samples: dict[str, list[str]] = {lang: [] for lang in frequent}
    for row in drawn.orderBy("lang", "h", "sample").collect():
        samples[row["lang"]].append(plain(row["sample"]))
    return {lang: "".join(texts).encode()[:dictionary_bytes] for lang, texts in samples.items()}


def _encoders(dictionaries: dict[str, bytes]) -> dict[str, zstandard.ZstdCompressor]:
    made = {}
    for lang, content in dictionaries.items():
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        made[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False)
    return made


def _classified(batch: dict[str, list], dictionaries: dict[str, bytes], min_margin: float) -> Iterable[dict]:
    encoders = _encoders(dictionaries)
    out: dict[str, list] = {"doc_id": batch["doc_id"], "lang_best": [], "score": [], "rejected": []}
    for text in batch["text"]:
        letters = plain(text)
        best, margin = UNDETERMINED, 0.0
        if letters and encoders:
            parts = [letters[i:i + STRETCH].encode() for i in range(0, len(letters), STRETCH)]
            sizes = {lang: sum(len(e.compress(p)) for p in parts) for lang, e in encoders.items()}
            best = min(sizes, key=sizes.get)
            others = [n for lang, n in sizes.items() if lang != best]
            margin = 1 - sizes[best] / min(others) if others else 1.0
        out["lang_best"].append(best)
        out["score"].append(margin)
        out["rejected"].append(margin < min_margin)
    yield out


def identify_languages(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """doc_id, lang (``und`` where rejected), lang_best, score and rejected per row.

    ``score`` is the share of bytes that ``lang_best`` saves against the next language,
    from 0 to 1. Null texts and texts without letters are ``und`` with score 0, as is
    every text where no dictionary was learned. Equal sizes go to the language that
    comes first in ``dictionaries``. Repeated rows give repeated results; other columns,
    a ``lang`` of the input among them, are never read.
    """
    found = mapped(docs.select("doc_id", "text"), "doc_id long, lang_best string, score double, rejected boolean",
                   _classified, dictionaries, min_margin)
    return found.select(
        "doc_id", F.when(F.col("rejected"), UNDETERMINED).otherwise(F.col("lang_best")).alias("lang"),
        "lang_best", "score", "rejected")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    dictionaries = train_dictionaries(docs.where(~is_held_out()))
    return identify_languages(docs, dictionaries).select(
        "doc_id", is_held_out().alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", "rejected")
