"""A corpus pipeline of five stages over ``documents``.

Every stage takes an empty table, null values in any column, empty and very long texts,
repeated rows, and further columns by whatever name; all but the last keep the columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamrank.llm.common import is_held_out, parked, table
from streamrank.llm.decontamination import without_leaks
from streamrank.llm.quality_classifier import keep_quality, train_quality
from streamrank.llm.simhash_dedup import deduplicated
from streamrank.llm.source_mixing import mixed
from streamrank.llm.token_output import document_digests, write_token_ids
from streamrank.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Held-out labels are not learned from.

    Null and empty texts score alike; repeated rows stay or go together; without labels
    every document scores one half and stays.
    """
    labels = table(spark, sf_dir, "labels").where(~is_held_out())
    return keep_quality(docs, train_quality(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id.

    Fingerprints are of three-word shingles and link at three differing bits. Null and
    wordless texts are one group; null ids come last; of repeated rows one stays.
    """
    return deduplicated(docs, words=3, bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null texts hold none; repeated rows go together."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as their source's weight asks for, in shuffled order.

    The null source is a source of its own; rows that share source and id share their count.
    """
    return mixed(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and what is read back from them for each document.

    A null text is empty and has its end id alone; each repeated row keeps an entry.
    """
    return document_digests(spark, write_token_ids(docs, shared_dir(spark, "pipeline-tokens")))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix),
    ("token ids", token_ids),
]

#: Trained scores, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each on what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = parked(docs, f"pipeline-{i + 1}")
    return docs
