"""Document quality by the votes of the most similar labelled documents.

Terms are a text's words and its runs of three and four letters, both hashed, so that
wording shows; its runs of one to three character classes, so that symbols, shouting,
tables and the like show whatever the language; and how often words repeat. TF-IDF
vectors, with document frequencies over all documents, are projected on the leading
singular vectors of the labelled ones. The labelled latent-semantic vectors, a bounded
number, go to every task, which computes the exact cosines of its documents with all
of them in blocks and weighs the labels of the nearest by similarity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import give_back, is_held_out, mapped, table
from .decontamination import tokens_of

#: Labelled documents that vote, drawn by the hash of their id.
MAX_LABELLED = 4096
RANK = 64
NEIGHBOURS = 15
#: A neighbour's vote counts as its cosine to this power.
SHARPNESS = 8
THRESHOLD = 0.3
#: Documents whose cosines are computed at a time.
BLOCK = 128

CLASSES = 12
_LOWER, _UPPER, _DIGIT, _SPACE, _BREAK, _STOP, _COMMA, _QUOTE, _BANG, _BAR, _SYMBOL, _OTHER = range(CLASSES)
#: Fixed: the class of each byte. Bytes of letters beyond ASCII count as small letters.
_CLASS_OF = {
    _LOWER: "abcdefghijklmnopqrstuvwxyz", _UPPER: "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _DIGIT: "0123456789",
    _SPACE: " ", _BREAK: "\n\r\t\x0b\x0c", _STOP: ".?", _COMMA: ",;:", _QUOTE: "'\"-()", _BANG: "!", _BAR: "|",
    _SYMBOL: "*#$%&@~^+=<>{}[]\\_/`",
}
TERMS = CLASSES + CLASSES ** 2 + CLASSES ** 3
#: Places that words and runs of letters are hashed to, and their length beside the other terms.
WORDS, GRAMS = 1 << 12, 1 << 11
WORD_SHARE, GRAM_SHARE = 0.7, 0.3
#: The places of a vector: character classes, words, runs of letters, and two shares.
COUNTED = TERMS + WORDS + GRAMS
WIDTH = COUNTED + 2
#: Directions beyond ``RANK`` and rounds of the randomised decomposition.
SPARE, ROUNDS = 16, 6


def _byte_classes() -> bytes:
    table_ = bytearray([_OTHER] * 128 + [_LOWER] * 128)
    for kind, members in _CLASS_OF.items():
        for char in members:
            table_[ord(char)] = kind
    return bytes(table_)


_CLASS_TABLE = _byte_classes()


def counts_of(text: str | None) -> tuple[np.ndarray, float, float]:
    """Counts of the terms, and two shares: words like the one before, and repeated words."""
    octets = (text or "").encode()
    kinds = np.frombuffer(octets.translate(_CLASS_TABLE), np.uint8)
    if len(kinds):  # a run of one class counts once, save for marks
        new = np.concatenate([[True], kinds[1:] != kinds[:-1]])
        kinds = kinds[new | (kinds == _BANG) | (kinds == _SYMBOL)]
    x = np.concatenate([[_BREAK], kinds, [_BREAK]]).astype(np.int32)
    pairs = CLASSES + x[:-1] * CLASSES + x[1:]
    triples = CLASSES + CLASSES ** 2 + (x[:-2] * CLASSES + x[1:-1]) * CLASSES + x[2:]
    counts = np.bincount(np.concatenate([x, pairs, triples]), minlength=TERMS)
    words = octets.split()
    n = max(1, len(words))
    again = sum(map(bytes.__eq__, words, words[1:])) / n
    repeated = 1 - len(set(words)) / n if words else 0.0
    # Common words repeat in any long text: only what exceeds that counts.
    return counts, again, max(0.0, repeated - 0.3 * min(1.0, float(np.log10(n)) / 3))


def wording_of(text: str | None) -> np.ndarray:
    """Counts of the hashed words, then of the hashed runs of three and four bytes, in lower case."""
    words = np.bincount(tokens_of(text) & np.uint32(WORDS - 1), minlength=WORDS)
    x = np.frombuffer((text or "").lower().encode(), np.uint8).astype(np.uint32)
    grams = []
    for n in (3, 4):
        runs = np.full(max(0, len(x) - n + 1), n, np.uint32)
        for i in range(n if len(runs) else 0):
            runs = runs * np.uint32(0x01000193) ^ x[i:i + len(runs)]
        grams.append((runs * np.uint32(0x9E3779B1)) >> np.uint32(21))
    return np.concatenate([words, np.bincount(np.concatenate(grams), minlength=GRAMS)])


def unit(values: np.ndarray) -> np.ndarray:
    return values / (np.linalg.norm(values) + 1e-9)


def vector_of(text: str | None, idf: np.ndarray) -> np.ndarray:
    counts, again, repeated = counts_of(text)
    form = np.sqrt(counts / max(1, counts.sum())) * idf[:TERMS]
    form = unit(np.append(form, (2 * np.sqrt(again), 2 * repeated)))
    wording = np.sqrt(wording_of(text)) * idf[TERMS:]
    made = np.concatenate([form[:TERMS], WORD_SHARE * unit(wording[:WORDS]), GRAM_SHARE * unit(wording[WORDS:]), form[TERMS:]])
    return unit(made.astype(np.float32))


def dense(rows: list) -> Iterator[np.ndarray]:
    """The collected vectors in blocks, so that the driver never holds all their zeros."""
    for i in range(0, len(rows), BLOCK):
        made = np.zeros((len(rows[i:i + BLOCK]), WIDTH), np.float32)
        for vector, row in zip(made, rows[i:i + BLOCK]):
            vector[np.frombuffer(row["places"], np.uint16)] = np.frombuffer(row["vector"], np.float32)
        yield made


def leading(rows: list) -> np.ndarray:
    """The leading right singular vectors of the collected vectors, by a randomised subspace iteration."""
    basis = np.random.default_rng(1).standard_normal((WIDTH, RANK + SPARE), np.float32)
    for _ in range(ROUNDS):
        total = np.zeros_like(basis)
        for made in dense(rows):
            total += made.T @ (made @ basis)
        basis = np.linalg.qr(total)[0]
    gram = np.zeros((RANK + SPARE, RANK + SPARE))
    for made in dense(rows):
        turned = made @ basis
        gram += turned.T @ turned
    return (basis @ np.linalg.eigh(gram)[1][:, ::-1][:, :RANK]).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    """What the tasks need: bounded by ``WIDTH``, ``RANK`` and the labelled documents."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, texts: Iterable[str | None]) -> np.ndarray:
        made = np.array([vector_of(t, self.idf) for t in texts], np.float32).reshape(-1, WIDTH) @ self.basis
        return made / (np.linalg.norm(made, axis=1, keepdims=True) + 1e-9)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The weighted share of label 1 among the nearest labelled documents."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        found = [np.zeros(0)]
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(texts), BLOCK):
            cosines = self.latent(texts[i:i + BLOCK]) @ self.vectors.T
            nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(cosines, nearest, 1), 1e-3, 1).astype(float) ** SHARPNESS
            found.append((weight * self.labels[nearest]).sum(1) / weight.sum(1))
        return np.clip(np.concatenate(found), 0, 1)


def _frequencies(batch: dict[str, list]) -> Iterable[dict]:
    seen = np.zeros(COUNTED, np.int64)
    for text in batch["text"]:
        seen[:TERMS] += counts_of(text)[0] > 0
        seen[TERMS:] += wording_of(text) > 0
    terms = np.nonzero(seen)[0]
    yield {"term": [-1, *terms], "n": [len(batch["text"]), *seen[terms]]}


def _labelled(batch: dict[str, list], idf: np.ndarray) -> Iterable[dict]:
    places, values = [], []  # without zeros, which the driver need not hold twice
    for text in batch["text"]:
        vector = vector_of(text, idf)
        places.append(np.nonzero(vector)[0].astype(np.uint16))
        values.append(vector[places[-1]])
    yield {"doc_id": batch["doc_id"], "quality": batch["quality"],
           "places": [p.tobytes() for p in places], "vector": [v.tobytes() for v in values]}


def train_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> QualityModel:
    """Fits the model on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Document frequencies count every row of ``docs``. Of the labelled ids (those with a
    null id or label are no help) ``max_labelled`` vote at most, drawn by hash; where an
    id has several labels their mean counts. Without labels every score is one half.
    """
    frequencies = mapped(docs.select("text"), "term int, n long", _frequencies, at_once=2048).groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in frequencies.collect()}  # no more rows than there are terms
    seen = np.array([df.get(t, 0) for t in range(COUNTED)], float)
    idf = (np.log((1 + df.get(-1, 0)) / (1 + seen)) + 0.2).astype(np.float32)
    drawn = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.avg("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.min("quality").alias("quality"))  # an id may be repeated
    rows = mapped(texts, "doc_id long, quality double, places binary, vector binary", _labelled, idf, at_once=BLOCK).orderBy("doc_id").collect()
    basis = leading(rows)
    latent = np.concatenate([np.zeros((0, RANK), np.float32), *(made @ basis for made in dense(rows))])
    latent /= np.linalg.norm(latent, axis=1, keepdims=True) + 1e-9
    return QualityModel(idf, basis, latent, np.array([r["quality"] for r in rows], float))


def _scored(batch: dict[str, list], model: QualityModel) -> Iterable[dict]:
    yield {"doc_id": batch["doc_id"], "score": model.scores(batch["text"])}


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score, from 0 to 1, of every row. Null texts count as empty ones.

    Only the text is looked at. Repeated rows give repeated results.
    """
    return mapped(docs.select("doc_id", "text"), "doc_id long, score double", _scored, model, at_once=BLOCK)


def keep_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns.

    Null and empty texts score like any other; repeated rows stay or go together; an empty
    table stays empty; no other column than the text is looked at.
    """
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for some in texts:
                yield pd.Series(np.concatenate([np.zeros(0), *(
                    model.scores(some.iloc[i:i + BLOCK].tolist()) for i in range(0, len(some), BLOCK))]))
        finally:
            give_back()

    # Only texts go to Python, and the rows wait for their scores in the JVM.
    return docs.where(score("text") >= threshold)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_quality(docs, labels.where(~is_held_out()))
    return score_quality(docs, model).select(
        "doc_id", is_held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
