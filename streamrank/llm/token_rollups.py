"""Token counts kept up to date by signed deltas.

A change is an insert, a delete or a revised count of one document under one tokenizer
version. Each becomes one or two signed rows, and a batch of them is one small table of
sums by source, language and tokenizer version. Totals are the sums of all batches:
additive, so nothing is ever recounted.

A store is a folder. A batch is written whole under its number, and writing a number
again replaces it, so a batch that is replayed after a failure counts once. ``fold``
adds the batches up to a number, as far as none is missing, into a base; numbers it
covers are not taken again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import shared_dir
from .common import discard, parked, table, tidied
from .token_units import PIECES, UnitEncoder, chunks_of, units_of

KEYS = ["source", "lang", "tokenizer_version"]
TOTALS = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"
#: Versions of the counter: public byte-level vocabularies of one pattern of pieces.
VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")
#: Bytes of text counted together; a longer text is taken whole.
CHUNK_BYTES = 1 << 21


def ranks_file(version: str) -> bytes:
    """A public vocabulary as its file has it; tasks get it with the query, not by path."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{version}.tiktoken"), "rb") as file:
        return file.read()


class UnitCounter(UnitEncoder):
    """How many tokens a unit of text has, each distinct unit counted once while it is remembered."""

    def __init__(self, ranks: bytes, pattern: str = PIECES):
        import tiktoken
        from tiktoken import registry

        # The library's own registry holds the vocabulary for later tasks of the process, of a
        # fixed size; making it anew for each task costs more than its units.
        name = f"units-{hashlib.md5(ranks + pattern.encode()).hexdigest()}"
        if name not in registry.ENCODINGS:
            pairs = (line.split() for line in ranks.splitlines() if line)
            registry.ENCODINGS[name] = tiktoken.Encoding(
                name, pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
        self.encode = registry.ENCODINGS[name].encode_ordinary
        super().__init__()

    def new_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        counts = [len(self.encode(" " + u)) for u in units.to_pylist()]
        return np.array(counts, "<u4"), np.arange(len(units) + 1)

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text; null is empty."""
        cuts, index, units = units_of(texts)
        counts = self.of_units(units)[0].astype(np.int64)[index]
        # A text's first unit has no space before it.
        used = cuts[:-1][np.diff(cuts) > 0]
        firsts, place = np.unique(index[used], return_inverse=True)
        own = [len(self.encode(u)) for u in units.take(pa.array(firsts)).to_pylist()]
        counts[used] = np.array(own, np.int64)[place]
        return np.diff(np.concatenate([[0], np.cumsum(counts)])[cuts])


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums by key of ``changes``.

    Columns: ``op`` ("insert", "delete" or "revise"), ``n_tokens`` (the count now; of a
    delete, the one that goes), ``old_n_tokens`` (of a revision) and the keys; a revision
    to another version, language or source also has ``old_source``, ``old_lang`` and
    ``old_tokenizer_version``, null where that key stays. Null keys are keys of their own,
    null counts are zero, and other ops or columns do nothing. Changes add up, so repeated
    rows count repeatedly.
    """
    def row(sign: int, count: str, *keys: Column) -> Column:
        return F.struct(*(k.alias(n) for k, n in zip(keys, KEYS)), F.lit(sign).cast("long").alias("n_docs"),
                        (sign * F.coalesce(F.col(count), F.lit(0))).cast("long").alias("n_tokens"))

    now = [F.col(k) for k in KEYS]
    old = [F.coalesce(F.col(f"old_{k}"), F.col(k)) if f"old_{k}" in changes.columns else F.col(k) for k in KEYS]
    signed = F.when(F.col("op") == "insert", F.array(row(1, "n_tokens", *now)))
    signed = signed.when(F.col("op") == "delete", F.array(row(-1, "n_tokens", *now)))
    if "old_n_tokens" in changes.columns:
        signed = signed.when(F.col("op") == "revise", F.array(row(-1, "old_n_tokens", *old), row(1, "n_tokens", *now)))
    return changes.select(F.explode(signed).alias("d")).select("d.*").groupBy(*KEYS).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class RollupStore:
    """Totals under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entries(self) -> list[tuple[str, int]]:
        """The committed batches and bases: those that Spark has marked as complete."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        found = []
        for status in files.listStatus(place):
            kind, _, number = status.getPath().getName().partition("-")
            done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if kind in ("base", "batch") and number.isdigit() and files.exists(done):
                found.append((kind, int(number)))
        return sorted(found)

    def folded(self) -> int:
        """The last batch that the base covers, -1 without one."""
        return max((n for kind, n in self._entries() if kind == "base"), default=-1)

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Stores a batch, replacing what its number held; false if the base covers it."""
        if batch <= self.folded():
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")
        return True

    def _sum(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*(f"{self.path}/{n}" for n in names))
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where(
            "n_docs <> 0 or n_tokens <> 0")

    def _current(self, last: int | None = None) -> list[str]:
        base = self.folded()
        batches = [n for kind, n in self._entries() if kind == "batch" and n > base and (last is None or n <= last)]
        return [f"base-{base}"] * (base >= 0) + [f"batch-{n}" for n in batches]

    def totals(self) -> DataFrame:
        """n_docs and n_tokens by source, lang and tokenizer_version; zero rows are left out."""
        return self._sum(self._current())

    def fold(self, last: int) -> None:
        """Adds the batches up to ``last`` into a new base, and removes what it replaces.

        Batches may be committed in any order, and one that is still to come must not be
        covered: the base goes up to the first missing number, and no further.
        """
        base, numbers = self.folded(), {n for kind, n in self._entries() if kind == "batch"}
        last = next(n for n in range(base, last + 1) if n == last or n + 1 not in numbers) if last > base else base
        if last <= base:
            return
        names = self._current(last)
        self._sum(names).write.mode("overwrite").parquet(f"{self.path}/base-{last}")
        for name in names:
            discard(self.spark, f"{self.path}/{name}")


def token_counts(docs: DataFrame, versions: Sequence[str] = VERSIONS) -> DataFrame:
    """doc_id, source and lang of each row, a count of its tokens for every version, and its text's digest.

    Null texts have no tokens and the empty digest, which equals only itself. Texts are
    taken whole; other columns are left out.
    """
    rows = docs.select(F.struct(
        "doc_id", "source", "lang", F.coalesce(F.unhex(F.md5("text")), F.lit(b"")).alias("digest")).alias("doc"), "text")
    files = {version: ranks_file(version) for version in versions}
    schema = StructType([rows.schema["doc"], *(StructField(v, LongType()) for v in versions)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {version: UnitCounter(ranks) for version, ranks in files.items()}
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for found, texts in chunks_of([batch], CHUNK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, kind), *(pa.array(c.of_texts(texts)) for c in counters.values())],
                    names=["doc", *counters])

    return rows.mapInArrow(tidied(run), schema).select("doc.*", *versions)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents, one of them committed twice.

    Every document is inserted under the first version. Copies of a text in a smaller
    doc_id are deleted, and so are rows without a doc_id; null texts are copies of each
    other. Rows with the smallest doc_id of a text all stay. What is left is revised to the
    second version, which moves its counts. At last all documents are inserted once more
    under the first version. An empty table has no totals.
    """
    store, (old, new) = RollupStore(spark, shared_dir(spark, "token-rollup")), VERSIONS
    docs = parked(token_counts(table(spark, sf_dir, "documents")), "token-counts")
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first"))
    marked = docs.join(first, "digest").withColumn("kept", F.coalesce(F.col("doc_id") == F.col("first"), F.lit(False)))
    before = docs.select(*KEYS[:2], F.lit(old).alias("tokenizer_version"), F.col(old).alias("n_tokens"))
    copies = marked.where("not kept").select(
        *KEYS[:2], F.lit(old).alias("tokenizer_version"), F.col(old).alias("n_tokens"))
    revised = marked.where("kept").select(
        *KEYS[:2], F.lit(new).alias("tokenizer_version"), F.col(new).alias("n_tokens"),
        F.col(old).alias("old_n_tokens"), F.lit(old).alias("old_tokenizer_version"))
    store.commit(0, before.withColumn("op", F.lit("insert")))
    for _ in range(2):  # the second is a replay
        store.commit(1, copies.withColumn("op", F.lit("delete")))
    store.commit(2, revised.withColumn("op", F.lit("revise")))
    store.fold(1)
    store.commit(3, before.withColumn("op", F.lit("insert")))
    return store.totals()
