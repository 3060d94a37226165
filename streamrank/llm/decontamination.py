"""Documents that hold benchmark items, found by latent semantic retrieval.

Documents and items are cut into overlapping passages of words. The TF-IDF vectors of
the corpus' passages, over hashed words, get a randomised singular value decomposition
in one distributed pass: the matrix is multiplied with a sparse random one, every task
adds up the Gram matrix of its products, and the eigenvectors of the sum turn a product
into coordinates along the leading left singular vectors. There, with all directions
weighed alike, each document passage is compared with every item passage by cosine.
Candidates are scored again by the full TF-IDF cosine, and then word by word: the
longest common subsequence of the item and the document around the passage says how
much of the item is there in order. Much of it is a leak; a fair part is one if the
item's answer, its last sentence, is there too.

Items of up to half a passage would be outvoted by the words around them there, so they
are compared with stretches of about their own length: all that hold enough of an item's
words are candidates.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import mapped, parked, table

#: Words of a passage, and from one passage to the next.
PASSAGE, STEP = 32, 16
FEATURES = 1 << 13
#: Columns of the random matrix, and leading directions that are kept.
SKETCH, RANK = 192, 128
#: Tokens that a task multiplies at a time.
CHUNK = 1 << 15
#: The least cosines of a candidate, in the latent space and of the full vectors.
LATENT_COSINE, FULL_COSINE = 0.35, 0.4
#: Shares of an item's words, in order: a leak, and a leak if the answer is there.
COPIED, PARAPHRASED, ANSWERED = 0.75, 0.55, 0.8
#: Words of the longest item that is also compared with stretches of its own length.
SHORT = 16
#: Gram matrices that one task adds up.
FAN_IN = 64
#: Text of the items that are sent to the tasks at once; more take further passes.
ITEM_BYTES = 128 << 10

_IN_WORD = np.array([chr(i).isalnum() and i < 128 or i == 95 or i >= 128 for i in range(256)])
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SENTENCE = re.compile(r"[.!?]\s|\n")


def tokens_of(text: str | None) -> np.ndarray:
    """A 32-bit number for each word, in lower case.

    Words are runs of letters, digits and underscores; Latin and general punctuation
    beyond ASCII ends a word as well. All words of a text are hashed at once, from
    running sums over its bytes.
    """
    octets = np.frombuffer((text or "").lower().encode(), np.uint8)
    if not len(octets):
        return np.zeros(0, np.uint32)
    inside = _IN_WORD[octets]
    if not text.isascii():
        latin = np.nonzero((octets[:-1] == 0xC2) & (octets[1:] < 0xC0))[0]
        general = np.nonzero((octets[:-2] == 0xE2) & (octets[1:-1] >> 1 == 0x40))[0]
        for spots, length in ((latin, 2), (general, 3)):
            for i in range(length):
                inside[spots + i] = False
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    powers = np.full(len(octets), _FACTOR)
    back = np.full(len(octets), _INVERSE)
    powers[0] = back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((octets.astype(np.uint64) + np.uint64(1)) * powers)])
    words = (sums[ends] - sums[starts]) * back[starts]
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    return (words >> np.uint64(32)).astype(np.uint32)


def answer_of(text: str | None) -> np.ndarray:
    """The words of the last sentence that has three at least; of the whole text without one."""
    parts = [tokens_of(p) for p in _SENTENCE.split(text or "")]
    return next((p for p in reversed(parts) if len(p) >= 3), tokens_of(text))


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common subsequence, all of ``a`` at once in a big integer."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for x in b.tolist():
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _tokenised(batch: dict[str, list]) -> Iterable[dict]:
    yield {"row_a": batch["row_a"], "row_b": batch["row_b"], "doc_id": batch["doc_id"],
           "tokens": [tokens_of(t).tobytes() for t in batch["text"]]}


def tokenised(docs: DataFrame, label: str = "tokens") -> DataFrame:
    """row_a, row_b (hashes of id and text), doc_id and tokens, written to the shared folder."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row_a"), F.xxhash64(F.lit(3), "text", "doc_id").alias("row_b"),
                       "doc_id", "text")
    return parked(mapped(rows, "row_a long, row_b long, doc_id long, tokens binary", _tokenised), label)


def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The features of many documents' tokens, and the passage of each, without overlap."""
    held: list[np.ndarray] = []
    places: list[np.ndarray] = []
    n, passage = 0, 0
    for batch in batches:
        for value in batch.column(0):
            tokens = np.frombuffer(value.as_buffer(), np.uint32)
            for i in range(0, len(tokens), CHUNK):
                part = tokens[i:i + CHUNK] & np.uint32(FEATURES - 1)
                held.append(part)
                places.append(np.arange(len(part)) // PASSAGE + passage)
                n += len(part)
                passage += -(-len(part) // PASSAGE)
                if n >= CHUNK:
                    yield np.concatenate(held).astype(np.int64), np.concatenate(places)
                    held, places, n, passage = [], [], 0, 0
    if n:
        yield np.concatenate(held).astype(np.int64), np.concatenate(places)


def inverse_frequencies(tokens: DataFrame) -> np.ndarray:
    """The IDF of each feature over all passages of ``tokens``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(FEATURES, np.int64), 0
        for features, places in passages(batches):
            pairs = np.sort((places * FEATURES + features).astype(np.int32))
            once = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
            seen += np.bincount(once & (FEATURES - 1), minlength=FEATURES)
            total += int(places[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(FEATURES)], pa.int32()), pa.array([total, *seen.tolist()], pa.int64())],
            names=["feature", "n"])

    rows = tokens.select("tokens").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df = {r["feature"]: r["n"] for r in rows.collect()}  # as many rows as there are features
    seen = np.array([df.get(f, 0) for f in range(FEATURES)], float)
    return np.log((1 + df.get(-1, 0)) / (1 + seen)).astype(np.float32)


def drawn_columns() -> tuple[np.ndarray, np.ndarray]:
    """The random matrix: each feature has one column and a sign."""
    draw = np.random.default_rng(1)
    return draw.integers(0, SKETCH, FEATURES), draw.choice([-1.0, 1.0], FEATURES)


def latent_basis(tokens: DataFrame, idf: np.ndarray) -> np.ndarray:
    """What turns a passage's product with the random matrix into latent coordinates.

    The products' Gram matrix covers all passages. Tasks' sums, each ``SKETCH`` squared, are
    added up in rounds of ``FAN_IN``, so that no task holds more however many there are.
    """
    columns, signs = drawn_columns()
    weights = signs * idf

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((SKETCH, SKETCH))
        for features, places in passages(batches):
            rows = int(places[-1]) + 1
            product = np.bincount(places * SKETCH + columns[features], weights[features], rows * SKETCH)
            product = product.reshape(rows, SKETCH).astype(np.float32)
            product /= np.linalg.norm(product, axis=1, keepdims=True) + 1e-9
            gram += product.T @ product
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary())], names=["part"])

    def added(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"place": [key[0]], "part": [sum(np.frombuffer(p) for p in frame["part"]).tobytes()]})

    sums = tokens.select("tokens").mapInArrow(multiply, "part binary").select(
        F.spark_partition_id().alias("place"), "part")
    left = tokens.rdd.getNumPartitions()
    while True:
        sums = sums.groupBy(F.floor(F.col("place") / FAN_IN).cast("int").alias("place")).applyInPandas(
            added, "place int, part binary")
        left = -(-left // FAN_IN)
        if left <= 1:
            break
    rows = sums.collect()
    if not rows:
        return np.zeros((SKETCH, RANK), np.float32)
    values, vectors = np.linalg.eigh(np.frombuffer(rows[0]["part"]).reshape(SKETCH, SKETCH))
    values, vectors = values[::-1][:RANK], vectors[:, ::-1][:, :RANK]
    return (vectors / np.sqrt(np.maximum(values, max(1e-6 * values[0], 1e-12)))).astype(np.float32)


def windows_of(tokens: np.ndarray) -> np.ndarray:
    """The starts of overlapping passages; the last one may be shorter."""
    return np.arange(0, max(1, len(tokens) - STEP), STEP) if len(tokens) else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Items:
    """Benchmark items and the model, as the tasks need them."""

    names: list[int]
    tokens: list[np.ndarray]
    answers: list[np.ndarray]
    idf: np.ndarray
    basis: np.ndarray

    def prepared(self) -> dict[str, np.ndarray]:
        columns, signs = drawn_columns()
        owner, full = [], []
        for i, tokens in enumerate(self.tokens):
            for start in windows_of(tokens):
                features = (tokens[start:start + PASSAGE] % FEATURES).astype(np.int64)
                owner.append(i)
                # One more feature stands for the filling of short passages.
                full.append(np.bincount(features, minlength=FEATURES + 1).astype(np.float32)[:FEATURES] * self.idf)
        full = np.pad(np.array(full, np.float32).reshape(-1, FEATURES), ((0, 0), (0, 1)))
        product = np.zeros((len(full), SKETCH), np.float32)
        for column in range(SKETCH):
            mine = columns == column
            product[:, column] = full[:, :FEATURES][:, mine] @ signs[mine].astype(np.float32)
        latent = product @ self.basis
        return {"owner": np.array(owner, np.int64), "idf": np.append(self.idf, 0).astype(np.float32),
                "columns": np.append(columns, 0), "weights": np.append(signs * self.idf, 0),
                "full": full / (np.linalg.norm(full, axis=1, keepdims=True) + 1e-9),
                "latent": latent / (np.linalg.norm(latent, axis=1, keepdims=True) + 1e-9)}

    def candidates(self, docs: list[np.ndarray], ready: dict[str, np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """Document, start of a passage, item and full cosine of each pair that passes both cosines.

        The documents' tokens lie in steps of half a passage, so neighbouring halves add
        up to the overlapping passages.
        """
        steps = np.array([-(-len(d) // STEP) for d in docs])
        ends = np.cumsum(steps)
        firsts = ends - steps
        features = np.full(int(ends[-1]) * STEP + PASSAGE, FEATURES)
        for first, tokens in zip(firsts, docs):
            features[first * STEP:first * STEP + len(tokens)] = tokens & np.uint32(FEATURES - 1)
        body, halves = features[:int(ends[-1]) * STEP], int(ends[-1])
        place = np.arange(len(body)) // STEP
        product = np.bincount(place * SKETCH + ready["columns"][body], ready["weights"][body], halves * SKETCH)
        product = product.reshape(halves, SKETCH).astype(np.float32)
        doc = np.repeat(np.arange(len(docs)), steps)
        last = np.zeros(halves, bool)
        last[ends[steps > 0] - 1] = True
        made = product
        made[:-1][~last[:-1]] += product[1:][~last[:-1]]
        starts = np.nonzero(~last | (steps[doc] == 1))[0]
        made = made[starts] @ self.basis
        made /= np.linalg.norm(made, axis=1, keepdims=True) + 1e-9
        at, item = np.nonzero(made @ ready["latent"].T >= LATENT_COSINE)
        if not len(at):
            return
        spots = starts[at][:, None] * STEP + np.arange(PASSAGE)
        # A passage ends with its document.
        inside = spots < (ends[doc[starts[at]]] * STEP)[:, None]
        words = np.where(inside, features[spots], FEATURES)
        dots = (ready["full"][item[:, None], words] * ready["idf"][words]).sum(1)
        cosines = dots / (np.sqrt((ready["idf"][words] ** 2).sum(1)) + 1e-9)
        for k in np.nonzero(cosines >= FULL_COSINE)[0]:
            half = starts[at[k]]
            yield int(doc[half]), int(half - firsts[doc[half]]) * STEP, int(ready["owner"][item[k]]), float(cosines[k])

    def leaks(self, tokens: np.ndarray, spots: dict[int, list[tuple[int, float]]]) -> dict[int, tuple[float, float, bool]]:
        """item -> cosine, share of its words found in order, whether its answer is there."""
        found: dict[int, tuple[float, float, bool]] = {}
        for item, hits in spots.items():
            words = self.tokens[item]
            reach = -1
            for start, _ in sorted(hits):
                if start + PASSAGE <= reach:
                    continue  # looked at with the passage before
                low, reach = max(0, start - len(words)), start + PASSAGE + len(words)
                around = tokens[low:reach]
                share = common_length(words, around) / len(words)
                answer = self.answers[item]
                answered = common_length(answer, around) >= ANSWERED * len(answer)
                if share >= COPIED or share >= PARAPHRASED and answered:
                    best = found.get(item, (0.0, 0.0, False))
                    found[item] = (max(c for _, c in hits), max(best[1], share), best[2] or answered)
        return found


    def short_lists(self) -> dict[str, np.ndarray]:
        """The words of the short items, each with the items that have it."""
        pairs = [(w, i) for i, t in enumerate(self.tokens) if len(t) <= SHORT for w in np.unique(t).tolist()]
        words, items = np.array(sorted(pairs), np.int64).reshape(-1, 2).T
        vocabulary, first, count = np.unique(words, return_index=True, return_counts=True)
        sizes = np.array([len(t) for t in self.tokens])
        return {"vocabulary": vocabulary.astype(np.uint32), "first": first, "count": count, "items": items,
                "need": np.ceil(PARAPHRASED * sizes - 1e-9).astype(np.int64), "reach": sizes + (sizes + 1) // 2}

    def short_leaks(self, docs: list[np.ndarray], lists: dict[str, np.ndarray]) -> Iterator[tuple[int, int, tuple]]:
        """Document, item and what ``leaks`` says of it, for short items.

        A stretch begins at one of the item's words and is half as long again as the
        item. Its words that the item has are no fewer than their common subsequence, so
        no stretch that is a leak is left out.
        """
        if not len(lists["vocabulary"]):
            return
        gap = 2 * SHORT  # no stretch reaches into the next document
        starts = np.cumsum([0] + [len(d) + gap for d in docs])
        place = np.concatenate([np.arange(len(d)) + s for d, s in zip(docs, starts)])
        words = np.concatenate(docs)
        spot = np.minimum(np.searchsorted(lists["vocabulary"], words), len(lists["vocabulary"]) - 1)
        hit = lists["vocabulary"][spot] == words
        place, spot = place[hit], spot[hit]
        counts = lists["count"][spot]
        offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        item = lists["items"][np.repeat(lists["first"][spot], counts) + offsets]
        width = int(starts[-1]) + gap
        met = np.sort(item * width + np.repeat(place, counts))
        item = met // width
        last = np.arange(len(met)) + lists["need"][item] - 1
        inside = np.minimum(last, len(met) - 1)
        near = (last < len(met)) & (met[inside] < met + lists["reach"][item])
        found: dict[tuple[int, int], tuple[float, float, bool]] = {}
        for i, at in zip(item[near].tolist(), (met[near] % width).tolist()):
            doc = int(np.searchsorted(starts, at, "right")) - 1
            best = found.get((doc, i), (0.0, 0.0, False))
            if best[1] == 1.0 and best[2]:
                continue
            at -= int(starts[doc])
            own, stretch = self.tokens[i], docs[doc][at:at + int(lists["reach"][i])]
            share = common_length(own, stretch) / len(own)
            answer = self.answers[i]
            answered = common_length(answer, stretch) >= ANSWERED * len(answer)
            if share >= COPIED or share >= PARAPHRASED and answered:
                cosine = max(self.cosine(own, stretch[:len(own)]), self.cosine(own, stretch))
                if cosine >= FULL_COSINE:
                    found[doc, i] = (max(best[0], cosine), max(best[1], share), best[2] or answered)
        for (doc, i), value in found.items():
            yield doc, i, value

    def cosine(self, a: np.ndarray, b: np.ndarray) -> float:
        x, y = (np.bincount((t % FEATURES).astype(np.int64), minlength=FEATURES) * self.idf for t in (a, b))
        return float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y) + 1e-9))


def _runs(tokens: list[np.ndarray]) -> Iterator[list[int]]:
    """The places of documents with words, in runs of about ``CHUNK`` tokens."""
    held, n = [], 0
    for i, part in enumerate(tokens):
        if len(part):
            held.append(i)
            n += len(part)
        if n >= CHUNK:
            yield held
            held, n = [], 0
    if held:
        yield held


def _retrieved(batch: dict[str, list], items: Items) -> Iterable[dict]:
    ready, lists = items.prepared(), items.short_lists()
    out: dict[str, list] = {k: [] for k in ("row_a", "row_b", "doc_id", "item_id", "cosine", "share", "answered")}
    tokens = [np.frombuffer(value, np.uint32) for value in batch["tokens"]]
    for run in _runs(tokens):
        spots: dict[int, dict[int, list[tuple[int, float]]]] = {}
        for doc, start, item, cosine in items.candidates([tokens[i] for i in run], ready):
            spots.setdefault(run[doc], {}).setdefault(item, []).append((start, cosine))
        leaks = {i: items.leaks(tokens[i], hits) for i, hits in spots.items()}
        for doc, item, (cosine, share, answered) in items.short_leaks([tokens[i] for i in run], lists):
            mine = leaks.setdefault(run[doc], {})
            best = mine.get(item, (0.0, 0.0, False))
            mine[item] = (max(best[0], cosine), max(best[1], share), best[2] or answered)
        for i, met in leaks.items():
            for item, (cosine, share, answered) in sorted(met.items()):
                row = (batch["row_a"][i], batch["row_b"][i], batch["doc_id"][i], items.names[item], cosine, share, answered)
                for column, v in zip(out, row):
                    out[column].append(v)
    yield out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """row_a, row_b, doc_id, item_id, cosine, share, answered: items found in documents.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Null and wordless texts
    match nothing. Repeated documents each have their rows; repeated items count as one,
    and items with one id, or none, and different texts are searched and reported each.
    Null ids are kept as nulls. Other columns are left out.
    """
    spark = docs.sparkSession
    tokens = tokenised(docs)
    idf = inverse_frequencies(tokens)
    basis = latent_basis(tokens, idf)
    kind = "row_a long, row_b long, doc_id long, item_id long, cosine double, share double, answered boolean"
    wanted = benchmark.where("text is not null").select("item_id", "text").distinct()
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    found = spark.createDataFrame([], kind)
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        rows = [r for r in rows if len(tokens_of(r["text"]))]
        if rows:
            items = Items([r["item_id"] for r in rows], [tokens_of(r["text"]) for r in rows],
                          [answer_of(r["text"]) for r in rows], idf, basis)
            found = found.union(mapped(tokens, kind, _retrieved, items))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark``, with all their columns."""
    leaky = parked(find_leaks(docs, benchmark).select("row_a", "row_b").distinct(), "leaks")
    rows = docs.select(
        F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("row_a"),
        F.xxhash64(F.lit(3), "text", "doc_id").alias("row_b"))
    return rows.join(leaky, ["row_a", "row_b"], "left_anti").select("doc.*")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "share", "answered")
