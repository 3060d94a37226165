"""Top pages, ranks and collections under change."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import at, clock, rows_of
from streamrank.operators.changelog import count_changelog
from streamrank.operators.projections import page_stats, rekey_views
from streamrank.operators.ranking import first_in_group, standings, top_n
from streamrank.plans.top_pages import GROUP, page_counts, top_pages

VIEW = "user string, page string, industry string, flags string, timestamp timestamp"


def views(spark, rows):
    return spark.createDataFrame(
        [(f"u{i}", page, industry, flags, when) for i, (page, industry, flags, when) in enumerate(rows)], VIEW
    )


def many_views(seed=1, count=6000):
    """A third of the views fall in one industry and hour, on very many pages."""
    rng = random.Random(seed)
    for _ in range(count):
        if rng.random() < 0.34:
            yield f"p{rng.randrange(900)}", "hot", "ARTICLE", at(rng.randrange(3_600_000))
        else:
            yield (f"p{rng.randrange(30)}", f"i{rng.randrange(4)}",
                   rng.choice(["ARTICLE", "xARTICLE", None, "article"]), at(rng.randrange(20_000_000)))


def counted_by_hand(rows):
    return Counter(
        (industry, int(when.timestamp()) // 3600 * 3600, page)
        for page, industry, flags, when in rows if flags and "ARTICLE" in flags
    )


def test_top_pages_match_brute_force(spark):
    rows = list(many_views())
    groups = defaultdict(list)
    for (industry, hour, page), count in counted_by_hand(rows).items():
        groups[(industry, hour)].append((-count, page))
    expected = {
        group: "".join(page + "\n" for _, page in sorted(pages)[:100]) for group, pages in groups.items()
    }
    found = top_pages(page_counts(views(spark, rows)))
    assert {
        (row.industry, row.start): row.pages
        for row in found.select("industry", F.unix_seconds("window.start").alias("start"), "pages").collect()
    } == expected
    assert max(len(pages) for pages in groups.values()) > 500


def test_ties_go_by_page_name(spark):
    noon = clock("12:00:00")
    rows = [("b", "x", "ARTICLE", noon), ("a", "x", "ARTICLE", noon), ("c", "x", "ARTICLE", noon),
            ("c", "x", "ARTICLE", noon)]
    counts = page_counts(views(spark, rows))
    assert top_pages(counts).first().pages == "c\na\nb\n"
    assert top_pages(counts, n=1).first().pages == "c\n"
    first = first_in_group(counts, GROUP, [-F.col("count"), F.col("page")], F.col("page"))
    assert first.first()["first"] == "c"


def test_standings_match_brute_force(spark):
    rows = list(many_views(2))
    by_hand = counted_by_hand(rows)
    groups = defaultdict(list)
    for (industry, hour, _), count in by_hand.items():
        groups[(industry, hour)].append(count)
    expected = {
        key: 1 + sum(other > count for other in groups[key[:2]]) for key, count in by_hand.items()
    }
    found = standings(page_counts(views(spark, rows)), GROUP)
    assert {
        (row.industry, row.start, row.page): row["rank"]
        for row in found.select("*", F.unix_seconds("window.start").alias("start")).collect()
    } == expected


@pytest.mark.parametrize("n", [3, 5000])
def test_lists_of_any_length(spark, n):
    """Beyond Spark's own threshold groups are trimmed in parts first."""
    rows = spark.range(12_000, numPartitions=4).select(
        F.lit("g").alias("g"), (F.col("id") * 7919 % 12_000).alias("count"), F.col("id").alias("page"))
    found = top_n(rows, ["g"], [F.desc("count"), F.asc("page")], n)
    assert [r["count"] for r in found.orderBy("position").collect()] == [*range(11_999, 11_999 - n, -1)]
    windows = found._jdf.queryExecution().executedPlan().toString().count("row_number()")
    assert windows >= (2 if n > 1000 else 1)


def test_standings_keep_null_groups(spark):
    rows = spark.createDataFrame([(None, "a", 2), (None, "b", 1), ("g", "c", 1)], "g string, p string, count long")
    assert rows_of(standings(rows, ["g"])) == sorted(
        [(None, "a", 2, 1), (None, "b", 1, 2), ("g", "c", 1, 1)], key=repr
    )


def test_changes_replace_old_entries(spark):
    noon = [clock(t) for t in ("12:00:01", "12:00:02", "12:00:15", "12:40:00", "13:00:00")]
    rows = views(spark, [("p", "x", "ARTICLE", t) for t in noon])
    changes = count_changelog(rows, ["page", "industry"], "1 hour", "10 seconds")
    found = changes.select(F.unix_seconds("committed").alias("c"), "old_count", "new_count").orderBy("c")
    base = int(noon[0].timestamp()) // 60 * 60
    assert [tuple(row) for row in found.collect()] == [
        (base + 10, None, 2), (base + 20, 2, 3), (base + 2410, 3, 4), (base + 3610, None, 1),
    ]


def test_changes_end_at_the_counts(spark):
    rows = views(spark, list(many_views(3, 2000)))
    changes = count_changelog(rows, ["page", "industry"], "1 hour", "10 seconds")
    held = changes.groupBy("industry", "window", "page").agg(F.max("new_count").alias("count"))
    counts = page_counts(rows, marker="").unionByName(
        page_counts(rows.filter("flags is null").withColumn("flags", F.lit("ARTICLE")))
    )
    merged = counts.groupBy("industry", "window", "page").agg(F.sum("count").alias("count"))
    assert rows_of(held) == rows_of(merged)


def test_rekeyed_and_selected_records(spark):
    rows = views(spark, [("p", "x", "ARTICLE", clock("12:00:00"))])
    assert rows_of(rekey_views(rows)) == [("user", "p", "x", None)]
    stats = page_stats(page_counts(rows)).first()
    assert (stats.industry, tuple(stats.stats)) == ("x", ("user", "p", "x", 1))
