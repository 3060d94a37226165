"""Secrets in texts: fixed patterns, and strings that look random to character models.

Two Markov models of characters, one of random strings and one of ordinary identifiers,
are trained from labelled samples. A long run of key characters outside the fixed
patterns' finds is a secret if its log-likelihood ratio is high enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table, tidied
from .token_units import chunks_of

#: Fixed: kind, pattern, its group that must have so many characters, a pattern of what is long enough.
PATTERNS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
     r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?[A-Za-z0-9+/_.=-]{8,}"""),
    ("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12,}"),
    ("hex", r"[0-9a-f]+", 0, 32, r"[0-9a-f]{32,}"),
)
#: The kind of what the models find.
MARKOV = "markov"
KINDS = [p[0] for p in PATTERNS] + [MARKOV]
#: Characters of keys, and how many must stand together.
KEY_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 16
#: Natural logarithm of how much likelier a run must be as a random string.
MIN_RATIO = 12.0
#: Documents whose words are the samples of ordinary identifiers, by the hash of their text.
SAMPLE_DOCS = 500
#: Fewest characters of a sampled identifier.
MIN_IDENTIFIER = 4
#: Bytes of text looked at together; a longer text is taken whole.
CHUNK_BYTES = 1 << 22


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """text, is_random: identifiers of some documents, and random strings made from them.

    At most ``sample_docs`` texts are drawn, by their hash, which is all that is broadcast. Their
    distinct words are ordinary unless a fixed pattern holds them; of each word's digest
    there is a random string in base 64, one in base 16 and one of digits and capitals.
    """
    texts = docs.where("text is not null").select(F.xxhash64("text").alias("h"), "text")
    least = texts.select("h").distinct().orderBy("h").limit(sample_docs)
    drawn = texts.join(F.broadcast(least), "h", "left_semi").dropDuplicates(["h"])
    outside = F.col("text")
    for *_, whole in PATTERNS:
        outside = F.regexp_replace(outside, whole, " ")
    word = F.explode(F.regexp_extract_all(outside, F.lit(f"[A-Za-z0-9_+/=-]{{{MIN_IDENTIFIER},}}"), 0)).alias("word")
    words = drawn.select(word).distinct()
    digest = F.sha2("word", 256)
    random = [F.base64(F.unhex(digest)), F.substring(digest, 1, 40),
              F.concat(*(F.conv(F.substring(digest, i, 12), 16, 36) for i in (1, 13, 25, 37)))]
    return words.select(F.explode(F.array(
        F.struct(F.col("word").alias("text"), F.lit(False).alias("is_random")),
        *(F.struct(r.alias("text"), F.lit(True).alias("is_random")) for r in random))).alias("s")).select("s.*")


def train_markov(samples: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each character after another, from samples (text, is_random).

    Row 0 and column 0 stand for a run's beginning and for any other character. Every
    transition counts one more than it occurs. Spark counts the transitions; the driver
    gets one number for each of the few thousand. Samples that are null or empty, and
    samples without a label, count for nothing.
    """
    n = len(KEY_CHARACTERS) + 1
    shifted = samples.where("length(text) > 0 and is_random is not null").select(
        "is_random", F.concat(F.lit("\0"), "text").alias("text"))
    pairs = shifted.select("is_random", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("text") - 1), lambda i: F.substr("text", i, F.lit(2)))).alias("pair"))
    place = {c: i + 1 for i, c in enumerate(KEY_CHARACTERS)}
    counts = np.ones((2, n, n))
    other = F.regexp_replace("pair", f"[^{KEY_CHARACTERS[:-1]}\\-]", "\0")
    for row in pairs.groupBy("is_random", other.alias("pair")).count().collect():
        a, b = row["pair"]
        counts[int(row["is_random"]), place.get(a, 0), place.get(b, 0)] += row["count"]
    chance = np.log(counts / counts.sum(axis=2, keepdims=True))
    return chance[1] - chance[0]


def _patterned(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' finds, each kind for itself."""
    found = []
    for kind, (name, pattern, group, least, _) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text, re.ASCII | (re.IGNORECASE if name == "assign" else 0)):
            if len(m[group]) >= least:
                found.append((m.start(), kind, m.end()))
    return found


def _random_runs(texts: pa.Array, ratios: np.ndarray, min_ratio: float) -> Iterator[tuple[int, int, int, float]]:
    """(text, start, end, ratio) of runs of key characters that look random, in bytes of their text."""
    _, offsets, content = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(content or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    place = np.zeros(256, np.uint8)
    place[np.frombuffer(KEY_CHARACTERS.encode(), np.uint8)] = np.arange(1, len(KEY_CHARACTERS) + 1)
    held = place[raw]
    # Where a run ends, or a text does.
    stop = np.concatenate([held == 0, [True]])
    stops = np.union1d(np.flatnonzero(stop), offsets[1:])
    begins = np.concatenate([[0], stops[:-1] + (held[stops[:-1]] == 0)])
    long = np.flatnonzero(stops - begins >= MIN_RUN)
    for start, end in zip(begins[long].tolist(), stops[long].tolist()):
        run = held[start:end]
        ratio = float(ratios[np.concatenate([[0], run[:-1]]), run].sum())
        if ratio >= min_ratio:
            text = int(np.searchsorted(offsets, start, "right")) - 1
            yield text, start - int(offsets[text]), end - int(offsets[text]), ratio


def find_secrets(docs: DataFrame, ratios: np.ndarray, min_ratio: float = MIN_RATIO) -> DataFrame:
    """doc_id, text and spans (kind, start, end, ratio) of every row of ``docs``.

    Positions are code points, ends are exclusive; spans come by start, then kind.
    ``ratio`` is null for fixed patterns. A run that meets a fixed pattern's find is no
    find of the models. A null text has no spans, and stays null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_of = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("ratio", pa.float64())])
        for ids, texts in chunks_of(batches, CHUNK_BYTES):
            full = pc.fill_null(texts, "")
            spans: list[list] = [[] for _ in ids]
            known = np.zeros(len(ids), bool)
            for *_, coarse in PATTERNS:
                known |= pc.match_substring_regex(full, coarse).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(known).tolist():
                spans[i] = [(s, k, e, None) for s, k, e in _patterned(full[i].as_py())]
            for i, start, end, ratio in _random_runs(full, ratios, min_ratio):
                before = len(full[i].as_py().encode()[:start].decode())
                found = (before, len(PATTERNS), before + end - start, ratio)
                if all(found[2] <= s or e <= before for s, _, e, _ in spans[i]):
                    spans[i].append(found)
            out = [[{"kind": KINDS[k], "start": s, "end": e, "ratio": r} for s, k, e, r in sorted(found, key=lambda x: x[:3])]
                   for found in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), texts.cast(pa.string()), pa.array(out, pa.list_(kind_of))],
                names=["doc_id", "text", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        tidied(run), "doc_id long, text string, spans array<struct<kind string, start int, end int, ratio double>>")


def redacted(found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """doc_id and text of ``find_secrets`` rows, each stretch of spans replaced by ``mark``."""
    text = F.col("text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(done, span):
        gap = F.concat(F.substring(text, done["at"] + 1, span["start"] - done["at"]), F.lit(mark))
        return F.struct(
            F.when(span["start"] < done["at"], done["out"]).otherwise(F.concat(done["out"], gap)).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"))

    done = F.aggregate("spans", start, add)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    return found.select("doc_id", F.concat(done["out"], rest).alias("text"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the fixed patterns' finds, and all spans of every document.

    A null text is empty: no finds, and the digest of nothing. Texts are taken whole,
    rows with one doc_id are scanned each, an empty table gives no rows, and other
    columns are not read.
    """
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, train_markov(labelled_samples(docs)))
    base = F.filter("spans", lambda s: s["kind"] != MARKOV)
    spelled = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("spans", lambda s: s["kind"])
    return found.select(
        "doc_id",
        *((F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
