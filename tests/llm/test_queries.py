"""The registered queries and the pipeline over whole test tables, against SQL or brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from helpers import SF_DIR, canonical, duck
from streamrank.llm.quality_classifier import is_held_out, score_quality, train_quality
from streamrank.llm.registry import ORACLES, QUERIES
from streamrank.llm.token_output import tokenizer_json

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def least_of_groups(names, linked):
    group = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return group


def shingles(text, n, lower=True):
    raw = (text or "").encode()
    words = WORDS.findall(raw.lower() if lower else raw)
    return [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


def test_every_dealt_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_with_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck(("documents",)).execute(ORACLES[name]).fetch_df()
    assert sorted(found.columns) == sorted(expected.columns) and canonical(found) == canonical(expected)


def simhash(text):
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op1(spark, docs):
    prints = {i: simhash(row.text) for i, row in docs.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    least = least_of_groups(prints, links)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, SF_DIR).collect()}
    assert found == {i: (f"{prints[i]:016x}", least[i]) for i in docs}


def test_op3(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    found = {}
    for r in QUERIES["op3_neighbours"](spark, SF_DIR).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == {r.vec_id for r in rows if r.vec_id % 20 == 0}
    recall = []
    for q in (r for r in rows if r.vec_id in found):
        scored = sorted((-math.fsum(a * b for a, b in zip(q.embedding, r.embedding)), r.vec_id) for r in rows if r.vec_id != q.vec_id)
        recall.append(len({i for _, i in scored[:20]} & set(found[q.vec_id])) / 20)
    assert np.mean(recall) >= 0.95


def test_op4(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = {r.page_id: r.text for r in QUERIES["op4_html"](spark, SF_DIR).collect()}
    import html

    for i, page in pages.items():
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert found[i] == "\n".join(filter(None, blocks))


def token_rows(tokenizer, texts):
    at = 0
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        yield i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_op5(spark, docs):
    tokenizer = Tokenizer.from_str(tokenizer_json())
    found = [tuple(r) for r in QUERIES["op5_token_ids"](spark, SF_DIR).orderBy("doc_id").collect()]
    assert found == [*token_rows(tokenizer, ((i, docs[i].text) for i in sorted(docs)))]


def test_op6(spark, docs):
    seen, expected = set(), {}
    for i in sorted(docs):
        words = WORDS.findall((docs[i].text or "").encode())
        gone = np.zeros(len(words), bool)
        for s in range(len(words) - 19):
            gone[s:s + 20] |= tuple(words[s:s + 20]) in seen
            seen.add(tuple(words[s:s + 20]))
        expected[i] = (len(words), int(gone.sum()), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest())
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op6_substrings"](spark, SF_DIR).collect()}
    assert found == expected


def test_op7_and_op10(spark, docs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op7_quality"](spark, SF_DIR).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]) >= 0.9
    rows = QUERIES["op10_language"](spark, SF_DIR).collect()
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]) >= 0.95


def plain(text):
    return " " + " ".join(re.findall(r"\w+", text.lower())) + " "


def test_op9(spark, docs):
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op9_decontaminate"](spark, SF_DIR).collect()}
    assert found == {(i, j) for i, r in docs.items() for j, t in items.items() if t in plain(r.text)}


def test_pipeline_like_brute_force(spark, docs):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(~is_held_out())
    scores = {r.doc_id: r.score for r in score_quality(table, train_quality(table, labels)).collect()}
    left = [i for i in sorted(docs) if scores[i] >= 0.3]
    prints = {i: simhash(docs[i].text) for i in left}
    links = [(a, b) for a in left for b in left if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    least = least_of_groups(left, links)
    left = [i for i in left if least[i] == i]
    items = [plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    left = [i for i in left if not any(t in plain(docs[i].text) for t in items)]

    sources = Counter(docs[i].source for i in left)
    whole = sum(n ** 0.7 for n in sources.values())
    drawn = []
    for i in left:
        source = docs[i].source
        rate = sources[source] ** 0.7 / whole * len(left) / sources[source]
        u = int(hashlib.md5(f"mix-1:{source}:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        count, term, total = 0, math.exp(-rate), math.exp(-rate)
        while total <= u:
            count += 1
            term *= rate / count
            total += term
        drawn += [i] * count
    tokenizer = Tokenizer.from_str(tokenizer_json())
    expected = [*token_rows(tokenizer, ((i, docs[i].text) for i in drawn))]
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).withColumn("row_a", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row_a"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 0
