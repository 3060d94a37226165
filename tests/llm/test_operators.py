"""Each operator against brute force, and on odd rows: nulls, empty and long texts, repeats, no rows."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from streamrank.llm import (
    decontamination, html_text, language_id, quality_classifier, simhash_dedup, source_mixing, substring_dedup,
    token_output, token_rollups, vector_search,
)
from streamrank.llm.common import components
from streamrank.llm.token_units import ByteLevel

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * i % 977}" for i in range(30_000))
COPY = "the quick brown fox jumps over the lazy dog while seven other animals look on from afar and say nothing at all today"
ODD = [
    (1, COPY, "en", "a", 1), (1, COPY, "en", "a", 1), (2, COPY.upper(), "en", None, 1), (3, None, None, None, None),
    (4, "", "en", "a", 0), (5, " \n\t ", "en", "a", 3), (None, COPY, "en", "a", 1), (6, LONG, "en", "b", 9),
    (7, "¿Qué? — «naïve» 漢字 \U0001f600", "es", "b", 9), (8, "one", "en", "b", 3), (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents with further columns whose names operators use themselves."""
    rows = spark.createDataFrame(ODD, DOCS)
    return rows.withColumns({name: F.lit(name) for name in (
        "fp", "score", "row_a", "doc", "copy", "shuffle_key", "part", "start", "key", "group", "u", "rate")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=lambda i: (i is None, i or 0))


ALL_IDS = [1, 1, 2, 3, 4, 5, 6, 7, 8, None, None]


def grouped(pairs):
    """node -> least node of its group."""
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {x: find(x) for x in least}


def test_components(spark):
    draw = np.random.default_rng(3)
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)]
    pairs += [tuple(map(int, draw.integers(5000, 5400, 2))) for _ in range(300)]
    pairs = [(a, b) for a, b in pairs if a != b]
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == grouped(pairs)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# SimHash

@pytest.mark.parametrize("bits", [1, 3, 5])
def test_pigeonring_loses_no_link(spark, bits):
    draw = np.random.default_rng(bits)
    centres = draw.integers(0, 1 << 63, 40).astype(np.uint64)
    prints = {int(c) for c in centres} | {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(30):
            flips = draw.choice(64, draw.integers(0, 7), replace=False)
            prints.add(int(c) ^ sum(1 << int(f) for f in flips))
    values = np.array(sorted(prints), np.uint64)
    links = [(int(a), int(b)) for i, a in enumerate(values.view(np.int64))
             for b in values.view(np.int64)[:i][np.bitwise_count(values[:i] ^ values[i]) <= bits]]
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = components(simhash_dedup.print_links(rows, bits))
    assert {r.node: r.root for r in found.collect()} == grouped(links)


def test_blocks_of_a_key_all_meet(spark):
    """A key with more fingerprints than a block, in a row of small steps."""
    rows = spark.createDataFrame([(1, i) for i in range(50)], "key long, fp long")
    met = simhash_dedup.met(rows, block=8).collect()
    assert len(met) > 1
    seen = {(min(a, b), max(a, b)) for r in met for a in r.left for b in (r.right or r.left)}
    assert len(seen) == 50 * 51 // 2


def test_fingerprints_of_odd_documents(odd, none):
    found = simhash_dedup.simhash_components(odd)
    rows = {(r.doc_id, r.fingerprint): r.component_id for r in found.collect()}
    assert ids(found) == ALL_IDS
    assert {rows[i, "0" * 16] for i in (3, 4, 5, None)} == {3}
    copies = {f: c for (i, f), c in rows.items() if i in (1, 2) and f != "0" * 16}
    assert len(copies) == 1 and set(copies.values()) == {1}
    ones = [sum((h >> b) & 1 for h in simhash_dedup.shingle_hashes(b"The quick  brown fox", 3).tolist()) for b in range(64)]
    assert simhash_dedup.fingerprint(
        simhash_dedup.shingle_hashes(b"The quick  brown fox", 3)) == sum((n > 1) << b for b, n in enumerate(ones))
    assert simhash_dedup.simhash_components(none).count() == 0


def near_copies(n=60, words=200):
    draw = np.random.default_rng(5)
    rows = []
    for group in range(8):
        base = [f"g{group}w{draw.integers(5000)}" for _ in range(words)]
        for i in range(n // 8):
            text = list(base)
            for _ in range(i % 5):
                text[int(draw.integers(words))] = f"x{draw.integers(99999)}"
            rows.append((100 * group + i, " ".join(text)))
    return rows + [(9000 + i, f"short text number {i}") for i in range(20)]


def test_one_of_each_component_stays(spark):
    rows = near_copies()
    prints = {i: simhash_dedup.fingerprint(simhash_dedup.shingle_hashes(t.encode(), 3)) for i, t in rows}
    least = grouped([(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    kept = simhash_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert 0 < len(least) and ids(kept) == sorted({least.get(i, i) for i, _ in rows})


def test_one_document_of_a_group_stays(odd, none):
    kept = simhash_dedup.deduplicated(odd)
    assert ids(kept) == [1, 3, 6, 7, 8] and kept.columns == odd.columns
    assert kept.where("row_a = 'row_a' and doc = 'doc'").count() == 5
    assert simhash_dedup.deduplicated(none).count() == 0


# Mixing

def test_mixing_follows_the_weights(spark, odd, none):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 5000, "big").otherwise("small").alias("source"))
    drawn = source_mixing.mixed(docs, {"big": 1.0, "small": 3.0}, size=8000)
    counts = {r.source: r["count"] for r in drawn.groupBy("source").count().collect()}
    assert abs(counts["big"] - 2000) < 200 and abs(counts["small"] - 6000) < 300
    assert drawn.select("shuffle_key").rdd.map(lambda r: r[0]).collect() == sorted(r[0] for r in drawn.select("shuffle_key").collect())
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, source_mixing.mixed(docs.repartition(3), {"big": 1.0, "small": 3.0}, size=8000).collect()))
    found = source_mixing.mixed(odd, size=110.0)
    assert set(ids(found)) <= {1, 2, 3, 4, 5, 6, 7, 8, None} and found.count() > 40
    assert found.columns == [c for c in odd.columns if c not in ("copy", "shuffle_key")] + ["copy", "shuffle_key"]
    assert source_mixing.mixed(none).count() == source_mixing.mixed(odd, {}).count() == 0


def test_poisson_probabilities(spark):
    from math import exp, factorial

    for rate in (0.0, 0.3, 4.0, 900.0):
        cdf = spark.range(1).select(source_mixing.poisson_cdf(F.lit(rate)).alias("c")).first().c
        assert cdf == sorted(cdf) and abs(cdf[-1] - 1) < 1e-9
        if rate < 100:
            assert abs(cdf[2] - sum(exp(-rate) * rate ** k / factorial(k) for k in range(3))) < 1e-12


# Vectors

def exact_nearest(rows, queries, k):
    found = {}
    for q in queries:
        scored = sorted((-float((np.array(rows[q]) * np.array(v)).sum()), i) for i, v in rows.items() if i != q)
        found[q] = [(i, -s) for s, i in scored[:k]]
    return found


def test_exact_search_with_ties(spark):
    draw = np.random.default_rng(7)
    rows = {i: draw.normal(size=12).round(2).tolist() for i in range(600)}
    rows |= {i: rows[0] for i in range(600, 700)}
    table = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    queries = [i for i in rows if i % 20 == 0]
    found = vector_search.nearest(table, "vec_id % 20 = 0", 20, factor=1.0, shard=150, query_block=16)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = exact_nearest(rows, queries, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
    assert all(abs(s - t) < 1e-12 for q in got for (_, s), (_, t) in zip(got[q], expected[q]))


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (1, [None, 1.0]),
            (2, [0.5, 0.5]), (3, [0.5, -0.5]), (None, [1.0, 1.0]), (3, [0.5, -0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    found = vector_search.nearest(table)
    assert sorted(map(tuple, found.collect())) == [(0, 1, 2, 0.5), (0, 2, 3, 0.5), (0, 3, 3, 0.5)]
    assert vector_search.nearest(table.limit(0)).count() == 0


def test_many_equal_products(spark):
    """Different vectors, one product: the smallest ids are the nearest."""
    draw = np.random.default_rng(23)
    rows = [(0, [1.0] + [0.0] * 7)] + [(i, [0.25, *draw.normal(size=7).tolist()]) for i in range(1, 201)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for factor, shard in ((1.0, 1000), (1.0, 40)):
        found = vector_search.nearest(table, "vec_id = 0", 20, factor=factor, shard=shard)
        assert [(r.rank, r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(i, i, 0.25) for i in range(1, 21)]


def test_repeated_ids_unequal_lengths_and_overflow(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 0.0]), (1, [1.0, 2.0]), (20, [1.0, 1.0, 1.0]), (2, [0.0, 0.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in vector_search.nearest(table).collect())
    one = [(0, 1, 0, 5.0), (0, 2, 1, 5.0), (0, 3, 0, 3.0)]
    assert found == sorted([*one, *one, (0, 1, 0, 3.0), (0, 2, 0, 3.0), (0, 3, 1, 3.0), (20, 1, 2, 2.0)])
    huge = [(0, [1e200, 1.0]), (1, [1e200, 0.0]), (2, [1.0, 0.0]), (3, [-1e200, 0.0])]
    table = spark.createDataFrame(huge, "vec_id long, embedding array<double>")
    found = [(r.vec_id, r.score) for r in vector_search.nearest(table).orderBy("rank").collect()]
    assert found == [(1, float("inf")), (2, 1e200), (3, float("-inf"))]


def test_recall_of_the_relaxed_search(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    found = vector_search.nearest(table)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    expected = exact_nearest(rows, list(got), 20)
    assert np.mean([len(got[q] & {i for i, _ in expected[q]}) / 20 for q in got]) >= 0.95


# Pages

PAGE = """<html><body class="has-sidebar"><!-- <p>no</p> --><div class="cookie-notice"><p>We use cookies</p></div>
<header><h1>Site</h1></header><nav><ul><li><a href="x">One</a></ul></nav><%s><h1>A &amp; B</h1><p>First   para
graph &lt;here&gt; of some length.<aside>buy now</aside><ul><li>an <a href=q>item</a> more</li></ul><form><input>Name</form>
<p><b>Last<br>line</p></%s><section id="comments"><p>A reader says a lot of words about all this here</p></section>
<script>var t = "</p><p>x";</script><footer>end</footer></body></html>"""
TEXT = "A & B\nFirst para graph <here> of some length.\nan item more\nLast line"


@pytest.mark.parametrize("tag", ["article", "main", 'div class="post-content"'])
def test_main_text_of_pages(spark, tag):
    pages = spark.createDataFrame([(1, "u", PAGE % (tag, tag.split()[0]))], "page_id long, url string, html string")
    row = html_text.extract_text(pages, html_text.train_html(pages)).first()
    assert row.text == TEXT and row.n_chars == len(TEXT)


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>" + "word " * 200_000), (4, "u", "<!-- never closed"),
            (5, "u", "<script>x"), (None, "u", "plain &eacute;"), (6, "u", "a < b > c"), (6, "u", "a < b > c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = html_text.extract_text(pages, html_text.train_html(pages)).collect()
    texts = [(r.page_id, r.text) for r in found]
    assert texts[0] == (1, "") and texts[1] == (2, "") and texts[3:5] == [(4, ""), (5, "")]
    assert len(texts[2][1]) == 5 * 200_000 - 1 and texts[5] == (None, "plain é") and texts[6] == texts[7]
    assert html_text.extract_text(pages.limit(0), html_text.train_html(pages.limit(0))).count() == 0


def test_all_test_pages_without_their_declaration(spark):
    """The scan finds the same text where a page does not say which part is the main one."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_text.train_html(pages)
    bare = pages.withColumn("html", F.regexp_replace("html", "(</?)article>", "$1div>"))
    said, found = (html_text.extract_text(p, model).orderBy("page_id").collect() for p in (pages, bare))
    assert np.mean([a.text == b.text for a, b in zip(said, found)]) > 0.95


MODEL = html_text.HtmlModel({"p": 3.0, "h2": 2.0, "h3": 2.0, "a": 0.01}, {"p": -0.01, "h2": -0.1, "a": -1.0, "div": -1.0})
BODY = "".join(f"<p>{' '.join(f's{i}w{j}' for j in range(40))}</p>" for i in range(6))
BODY_TEXT = "\n".join(" ".join(f"s{i}w{j}" for j in range(40)) for i in range(6))


@pytest.mark.parametrize("around", ["<main>%s</main>", "<div class=content>%s</div>"])
def test_teaser_articles_beside_the_main_text(around):
    cards = "".join(f"<article><h3><a href=x>card {i}</a></h3><p>few words {i}</p></article>" for i in range(3))
    latest = f"<section class=latest>{cards}</section>"
    for page in (around % BODY + latest, latest + around % BODY):
        assert MODEL.extract(f"<html><body>{page}</body></html>") == BODY_TEXT
    # Where nothing else is declared the teasers may come along, but the text stays.
    assert BODY_TEXT in MODEL.extract(f"<body><div>{BODY}</div>{latest}</body>")


@pytest.mark.parametrize("around", [
    "<div class=page-with-sidebar>%s</div>", "<form>%s</form>", "<form><main>%s</main></form>", "<aside><article>%s</article></aside>"])
def test_wrappers_do_not_hide_a_page(around):
    assert MODEL.extract(f"<body>{around % BODY}</body>") == BODY_TEXT


def test_names_inside_an_article():
    said = ("<h2 id=discussion>Discussion</h2><p>It was talked over</p><section id=related-work><h2 id=search>Search</h2>"
            "<p>Others did it</p></section><div id=copyright><p>Law of copies</p></div>")
    found = MODEL.extract(f"<article>{BODY}<div class=share><a href=x>Tweet this</a></div>{said}</article>"
                          f"<section id=comments>{BODY.replace('s', 'c')}</section>")
    assert found == BODY_TEXT + "\nDiscussion\nIt was talked over\nSearch\nOthers did it\nLaw of copies"


ASIDE = "<p>one reader said a few words here and some more</p><p>another one did as well</p>"


@pytest.mark.parametrize("inside", [
    "<section class=comments>%s</section>", "<div id=comments>%s</div>", "<ol class=comment-list><li>%s</li></ol>",
    "<div class=ad>%s</div>", "<div class=cookie-notice>%s</div>", "<section class=newsletter>%s</section>",
    "<ul class=related><li>%s</li></ul>", "<form>%s</form>", "<div class='social share-buttons'>%s</div>"])
def test_asides_inside_an_article_go(inside):
    for around in ("<article>%s%s</article>", "<main><article><h1></h1>%s%s</article></main>"):
        assert MODEL.extract(f"<html><body>{around % (BODY, inside % ASIDE)}</body></html>") == BODY_TEXT
        half = BODY.index("<p>", len(BODY) // 2)
        found = MODEL.extract(around % (BODY[:half] + inside % ASIDE + BODY[half:], ""))
        assert found == BODY_TEXT


def test_long_comments_without_a_declaration():
    talk = "".join(f"<p>{' '.join(f'c{i}w{j}' for j in range(40))}</p>" for i in range(20))
    assert MODEL.extract(f"<body><div>{BODY}</div><div id=comments>{talk}</div></body>") == BODY_TEXT
    assert MODEL.extract(f"<body><article class='post comments-open'>{BODY}</article></body>") == BODY_TEXT


@pytest.mark.parametrize("piece", [
    "<a ", "<div>", "<div>x ", "<form>", "<form>x ", "<b>", "<span>x<div></div>", "</x>", "<a \"", "<a '\"", "<!", "<p><b>",
    "<li><b>x", "<script/>", "<section class=comments>y ", "<", "&amp;", "<a href=x>"])
def test_odd_pages_take_time_in_proportion(piece):
    import time

    def took(n):
        start = time.process_time()
        MODEL.extract(piece * (n // len(piece)))
        return time.process_time() - start

    took(20_000)
    assert took(2_000_000) < 40 and took(800_000) < 12 * max(took(200_000), 0.05)


# Tokens

@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files_round_trip(spark, odd, tmp_path, planes):
    definition = token_output.tokenizer_json()
    tokenizer = Tokenizer.from_str(definition)
    path = token_output.write_token_ids(odd, str(tmp_path / "ids"), planes=planes, block_ids=64, segment_ids=500)
    rows = sorted(((r.start, r.doc_id, r.ids) for r in token_output.read_documents(spark, path).collect()))
    assert [i for _, i, _ in rows] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert sorted(map(tuple, (r[2] for r in rows))) == sorted(tuple(
        [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for _, t, *_ in ODD)
    flat, at = [], 0
    for start, _, found in rows:
        assert start == at
        flat += found
        at += len(found)
    index = spark.read.parquet(f"{path}/chunks").orderBy("start").collect()
    assert sum(r.n_ids for r in index) == len(flat) and max(r.n_ids for r in index) == 64
    assert all(a.start + a.n_ids == b.start for a, b in zip(index, index[1:]))
    pieces = token_output.read_range(spark, path, 30, 1030).orderBy("start").collect()
    assert [i for p in pieces for i in p.ids] == flat[30:1030]
    digests = {(r.start, r.n_tokens, r.ids_crc32) for r in token_output.document_digests(spark, path).collect()}
    assert digests == {(s, len(f), zlib.crc32(np.array(f, "<u4").tobytes())) for s, _, f in rows}


def test_token_files_of_no_documents(spark, none, tmp_path):
    path = token_output.write_token_ids(none, str(tmp_path / "ids"))
    assert token_output.read_documents(spark, path).count() == token_output.document_digests(spark, path).count() == 0
    with pytest.raises(ValueError):
        token_output.write_token_ids(none, path, planes="nibble")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_whole_texts(name):
    definition = token_output.tokenizer_json(name)
    tokenizer, encoder = Tokenizer.from_str(definition), ByteLevel(definition)
    draw = np.random.default_rng(11)
    alphabet = list(" '\n\t\r\x0b\x1c\x85\xa0 　abstd'llveERé漢٣½́​<|>._-1 2") + ["<|endoftext|>", "  ", " \n", "n't"]
    texts = ["".join(draw.choice(alphabet, draw.integers(0, 14))) for _ in range(4000)] + ["", " ", "a  b", "<|endoftext|>", LONG[:9999]]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [b.tolist() for b in encoder.ids(pa.array(texts))] == expected


@pytest.mark.parametrize("text,letters", [
    ("½ ²", ""), ("Ⅷ Ⅸ", ""), ("a½b C_d", " a b c d "), (None, ""), ("ÀÉ 漢字", " àé 漢字 "), ("٣", "")])
def test_letters_of_a_text(text, letters):
    assert language_id.plain(text) == letters


# Substrings

def removed_by_force(docs, length):
    seen, found = set(), {}
    for i, text in sorted(docs.items()):
        words = (text or "").encode().split()
        gone = np.zeros(len(words), bool)
        for s in range(len(words) - length + 1):
            window = tuple(words[s:s + length])
            gone[s:s + length] |= window in seen
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        found[i] = (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    return found


def test_repeats_like_brute_force(spark):
    draw = np.random.default_rng(13)
    shared = [" ".join(f"p{j}w{i}" for i in range(n)) for j, n in enumerate((19, 20, 21, 60, 200))]
    docs = {}
    for i in range(80):
        parts = [" ".join(f"r{draw.integers(60)}" for _ in range(draw.integers(0, 40))) for _ in range(3)]
        parts.insert(int(draw.integers(4)), shared[int(draw.integers(5))])
        docs[i] = "  ".join(parts)
    docs |= {80: docs[3], 81: "again " * 70, 82: "a b " * 40, 83: None, 84: "", 85: "x " * 19, 86: "x " * 19, 87: LONG}
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    found = substring_dedup.remove_repeats(rows).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == removed_by_force(docs, 20)


def test_repeats_of_odd_documents(odd, none):
    rows = {(r.doc_id, r.n_words): (r.n_removed, r.starts, r.ends) for r in substring_dedup.remove_repeats(odd).collect()}
    n = len(COPY.split())
    assert rows[1, n] == (0, [], []) and rows[None, n] == (n, [0], [n]) and rows[2, n][0] == 0 and rows[3, 0][0] == 0
    assert substring_dedup.remove_repeats(none).count() == 0


# Quality

def test_quality_learns_what_is_marked(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = labels.where(quality_classifier.is_held_out())
    model = quality_classifier.train_quality(docs, labels.where(~quality_classifier.is_held_out()), max_labelled=1500)
    assert len(model.labels) == 1500
    scored = quality_classifier.score_quality(docs.join(held, "doc_id", "left_semi"), model).join(held, "doc_id").collect()
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in scored]) > 0.97


def test_quality_learns_wording(spark):
    """Bad and good texts of the same form, letters and length: only some of their words differ."""
    draw = np.random.default_rng(29)
    names = ["".join(draw.choice(list("abcdefghij"), 6)) for _ in range(620)]
    rows = []
    for i in range(1000):
        words = [names[j] for j in draw.integers(20, 600, 60)]
        for at in draw.choice(60, 12, replace=False):
            words[at] = names[draw.integers(20) if i % 2 else 600 + draw.integers(20)]
        rows.append((i, " ".join(words).capitalize() + ".", i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_classifier.train_quality(docs, docs.where("doc_id < 600"))
    scores = {r.doc_id: r.score for r in quality_classifier.score_quality(docs, model).collect()}
    assert np.mean([(scores[i] >= 0.5) == bool(i % 2) for i in range(600, 1000)]) > 0.95


def test_quality_of_odd_documents(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (2, None, 0), (6, 1, 1), (None, 0, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train_quality(odd, labels)
    assert sorted(model.labels.tolist()) == [0.5, 1.0]
    scores = quality_classifier.score_quality(odd, model)
    assert ids(scores) == ALL_IDS and all(0 <= r.score <= 1 for r in scores.collect())
    kept = quality_classifier.keep_quality(odd, model, 0.0)
    assert kept.columns == odd.columns and ids(kept) == ALL_IDS and kept.where("score = 'score'").count() == 11
    bare = quality_classifier.train_quality(none, labels)
    assert [r.score for r in quality_classifier.score_quality(odd, bare).collect()] == [0.5] * 11
    assert quality_classifier.score_quality(none, model).count() == quality_classifier.keep_quality(none, model).count() == 0


# Token counts

CHANGES = "op string, source string, lang string, tokenizer_version string, n_tokens long, old_n_tokens long, old_tokenizer_version string, extra int"


def test_rollups_add_up_once(spark, tmp_path):
    store = token_rollups.RollupStore(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    batch = lambda *rows: spark.createDataFrame([(*r, 0) for r in rows], CHANGES)
    first = batch(("insert", "s", "en", "v1", 10, None, None), ("insert", "s", "en", "v1", 5, None, None),
                  ("insert", None, None, "v1", None, None, None), ("other", "s", "en", "v1", 7, None, None))
    second = batch(("delete", "s", "en", "v1", 5, None, None), ("revise", "s", "en", "v2", 12, 10, "v1"))
    total = lambda: sorted(map(tuple, store.totals().collect()), key=repr)
    for number, rows in ((0, first), (1, second), (1, second), (0, first)):
        assert store.commit(number, rows)
    expected = sorted([("s", "en", "v2", 1, 12), (None, None, "v1", 1, 0)], key=repr)
    assert total() == expected
    store.fold(0)
    assert not store.commit(0, second) and total() == expected
    store.commit(1, batch())  # the batch is replaced by an empty one
    assert total() == sorted([("s", "en", "v1", 2, 15), (None, None, "v1", 1, 0)], key=repr)


# Benchmark

def test_rollups_take_batches_in_any_order(spark, tmp_path):
    store = token_rollups.RollupStore(spark, str(tmp_path / "store"))
    row = spark.createDataFrame([("insert", "s", "en", "v", 1)], "op string, source string, lang string, tokenizer_version string, n_tokens long")
    for batch in (0, 2, 3):
        assert store.commit(batch, row)
    store.fold(3)
    assert store.folded() == 0 and store.totals().first()["n_docs"] == 3
    assert store.commit(1, row)
    store.fold(2)
    assert store.folded() == 2 and store.totals().first()["n_docs"] == 4
    assert not store.commit(1, row) and store.commit(3, row)
    store.fold(9)
    assert store.folded() == 3 and store.totals().first()["n_docs"] == 4


def totals_by_force(rows):
    """The totals of op8 from (doc_id, text, source, lang) rows, each text encoded whole."""
    import base64

    import tiktoken

    counts = {}
    for version in token_rollups.VERSIONS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, token_rollups.ranks_file(version).splitlines())}
        encode = tiktoken.Encoding("x", pat_str=token_rollups.PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        counts[version] = [len(encode(t or "")) for _, t, *_ in rows]
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    old, new = token_rollups.VERSIONS
    total = {}
    for k, (i, t, *keys) in enumerate(rows):
        for version in [old] + [new] * (i is not None and least[t] == i):
            held = total.setdefault((*keys, version), [0, 0])
            held[0] += 1
            held[1] += counts[version][k]
    return {(*k, *v) for k, v in total.items()}


def test_rollups_of_null_texts_and_repeated_rows(spark, tmp_path):
    texts = [(1, "a b"), (1, "a b"), (2, "a b"), (3, None), (4, None), (5, None), (1, "c! d"), (6, "c! d"), (None, "e"), (7, ""),
             (8, "  two  blanks \n\n x "), (9, "<|endoftext|> 漢字"), (10, LONG)]
    rows = [(i, t, None if i == 9 else "s", "en") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("digest", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {tuple(r) for r in token_rollups.op8_token_counts(spark, str(tmp_path)).collect()} == totals_by_force(rows)
    docs.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert token_rollups.op8_token_counts(spark, str(tmp_path / "none")).count() == 0


def test_op8_over_the_test_table(spark):
    from helpers import SF_DIR

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source", "lang").collect()]
    assert {tuple(r) for r in token_rollups.op8_token_counts(spark, SF_DIR).collect()} == totals_by_force(rows)


def test_leaks_and_paraphrases(spark, odd, none):
    draw = np.random.default_rng(17)
    word = lambda n=1: [f"{'bcdfgh'[i % 6]}o{i}" for i in draw.integers(0, 3000, n)]
    items = [(i, " ".join(word(25)) + ". " + " ".join(word(6)) + ".") for i in range(12)] + [(50, None), (51, ""), (None, " ".join(word(30)))]
    rows = [(i, " ".join(word(300))) for i in range(200)]
    for i in range(12):
        tokens = items[i][1].upper().split()
        for _ in range(0 if i < 8 else 6):
            tokens[int(draw.integers(25))] = "other"
        rows.append((1000 + i, " ".join([*word(77), *tokens, *word(120)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(odd.select("doc_id", "text"))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontamination.find_leaks(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1000 + i, i) for i in range(12)}
    kept = decontamination.without_leaks(docs, benchmark)
    assert kept.count() == docs.count() - 12 and kept.columns == docs.columns
    assert decontamination.without_leaks(odd, benchmark.limit(0)).columns == odd.columns
    assert decontamination.find_leaks(none, benchmark).count() == 0


def test_short_items_and_shared_ids(spark):
    """Verbatim items of few words amid others, common ones included; ids repeated or missing."""
    draw = np.random.default_rng(23)
    items, docs, expected = [], [], set()
    for i in range(60):
        size = (5, 6, 8, 10)[i % 4]
        item = " ".join(f"z{min(int(draw.zipf(1.3)), 5000)}q{i if j % 2 else ''}" for j in range(size))
        around = [f"z{min(int(draw.zipf(1.3)), 5000)}q" for _ in range(120)]
        at = int(draw.integers(121))
        docs.append((i, " ".join([*around[:at], item, *around[at:]])))
        items.append((None if i % 3 == 0 else 7 if i % 3 == 1 else i, item))
        expected.add((i, items[-1][0]))
    found = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                       spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.where("share = 1").collect()} >= expected


def test_common_subsequences():
    draw = np.random.default_rng(19)
    for _ in range(50):
        a, b = draw.integers(0, 6, draw.integers(1, 40)), draw.integers(0, 6, draw.integers(0, 40))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontamination.common_length(a, b) == table[-1, -1]


def test_tokens_of_words():
    one = decontamination.tokens_of("Der Hund, «naïve» — ÉTÉ_2 漢字 x")
    other = decontamination.tokens_of("x; der\nhund naïve été_2 漢字")
    assert len(one) == 6 and sorted(one) == sorted(other)
    assert len(decontamination.tokens_of(None)) == len(decontamination.tokens_of(" .,")) == 0


# Languages

def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    learned = language_id.train_dictionaries(docs.where(~language_id.is_held_out()))
    assert set(learned) == {"en", "de", "fr", "es"} and all(len(d) <= language_id.DICTIONARY_BYTES for d in learned.values())
    held = docs.where(language_id.is_held_out())
    found = language_id.identify_languages(held, learned).join(held.select("doc_id", F.col("lang").alias("true")), "doc_id").collect()
    assert np.mean([r.lang_best == r.true for r in found]) > 0.98
    assert all(r.lang == ("und" if r.rejected else r.lang_best) for r in found)


def test_languages_of_odd_documents(odd, none):
    learned = language_id.train_dictionaries(odd)
    rows = language_id.identify_languages(odd, learned)
    assert ids(rows) == ALL_IDS
    assert {r.doc_id for r in rows.where("lang_best = 'und'").collect()} == {3, 4, 5, None}
    assert all(0 <= r.score <= 1 for r in rows.collect())
    assert language_id.train_dictionaries(none) == {}
    assert {r.lang for r in language_id.identify_languages(odd, {}).collect()} == {"und"}
    assert language_id.identify_languages(none, learned).count() == 0
