"""Mixing sources to target weights by Poisson replication.

A source's target rate is how often a document of it appears on average, so that the
sources take up their weights. Each document's count is the Poisson distribution with
that mean, inverted at a number that the seed and the document's own hash give: the
same document gets the same count in every run, wherever it lies. Documents are then
exploded by their counts and shuffled globally by another hash.

Everything is DataFrame expressions. A source's distribution is an array of cumulative
probabilities, worked out once per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table

SEED = "mix-1"
#: Sources weigh as their share of documents to this power, unless weights are given.
TEMPERATURE = 0.7
#: The distributions go to every task while they take no more than this.
BROADCAST_BYTES = 16 << 20


def hash_unit(*parts: str | Column) -> Column:
    """A number from 0 to 1 (not included) from 52 bits of the parts' MD5 digest."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p)
                              for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... up to eight deviations and 20 beyond the mean.

    What lies beyond is rarer than the 52 bits of a draw can show.
    """
    # Terms come from logarithms: exp(-rate) alone underflows for large means.
    steps = F.sequence(F.lit(0), F.ceil(rate + 8 * F.sqrt(rate) + 20).cast("int"))
    start = F.struct(F.lit(0.0).alias("log_factorial"), F.lit(0.0).alias("total"),
                     F.array().cast("array<double>").alias("cdf"))

    def add(state: Column, k: Column) -> Column:
        log_factorial = state["log_factorial"] + F.when(k > 1, F.log(k.cast("double"))).otherwise(0.0)
        term = F.when(rate > 0, F.exp(k * F.log(rate) - rate - log_factorial)).otherwise(
            F.when(k == 0, 1.0).otherwise(0.0))
        total = state["total"] + term
        return F.struct(log_factorial.alias("log_factorial"), total.alias("total"),
                        F.concat(state["cdf"], F.array(total)).alias("cdf"))

    return F.aggregate(steps, start, add, lambda s: s["cdf"])


def mixing_rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None) -> DataFrame:
    """source, n_docs and rate: the mean number of times a document of the source appears.

    ``weights`` maps sources to target weights; sources it does not name weigh nothing.
    Without it a source weighs its number of documents to the power ``TEMPERATURE``.
    ``size`` is the number of documents to aim at, as many as there are by default. The
    null source is a source like any other, which ``weights`` cannot name. Counts combine
    before the shuffle, so a source with a third of all documents costs no more; only
    their sum reaches the driver.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(TEMPERATURE))
    elif any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    else:
        named = F.create_map(*(F.lit(x) for name, value in weights.items() for x in (name, float(value))))
        weight = F.coalesce(F.try_element_at(named, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0)
    weighed = counts.withColumn("weight", weight)
    whole = weighed.agg(F.sum("weight").alias("weight"), F.sum("n_docs").alias("n_docs")).first()
    if not whole["weight"]:
        return weighed.select("source", "n_docs", F.lit(0.0).alias("rate"))
    aim = float(whole["n_docs"] if size is None else size)
    return weighed.select(
        "source", "n_docs", (F.col("weight") / F.lit(whole["weight"]) * F.lit(aim) / F.col("n_docs")).alias("rate"))


def mixed(
    docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None, seed: str = SEED,
) -> DataFrame:
    """``docs`` with each document as often as drawn, in an order shuffled over all.

    Added columns are ``copy`` (from 0) and ``shuffle_key``; columns of the input by
    these names give way. Null ids hash like empty ones, so rows that share source and
    id share their count; no other column matters. An empty input gives an empty result.
    """
    rates = mixing_rates(docs, weights, size).select(
        F.col("source").alias("rate_source"), poisson_cdf(F.col("rate")).alias("cdf"))
    cdf_bytes = 16 + 8 * F.size("cdf") + F.coalesce(F.octet_length("rate_source"), F.lit(0))
    if (rates.agg(F.sum(cdf_bytes)).first()[0] or 0) <= BROADCAST_BYTES:
        rates = F.broadcast(rates)  # else Spark joins by source and splits large ones
    wanted = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    doc = F.struct(*(F.col(c) for c in wanted)).alias("doc")
    keyed = docs.select(doc, F.col("source").alias("doc_source"), F.col("doc_id").alias("id"))
    drawn = keyed.join(rates, F.col("doc_source").eqNullSafe(F.col("rate_source"))).withColumn(
        "u", hash_unit(seed, F.col("doc_source"), F.col("id")))
    counted = drawn.select("doc", "id", "doc_source", F.size(F.filter("cdf", lambda p: p <= F.col("u"))).alias("n"))
    copies = counted.where("n > 0").select(
        "doc", "id", "doc_source", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    keyed_copies = copies.withColumn("shuffle_key", hash_unit(
        seed + "/order", F.col("doc_source"), F.col("id"), F.col("copy")))
    return keyed_copies.orderBy("shuffle_key", "id", "copy").select("doc.*", "copy", "shuffle_key")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as drawn for its source's weight, shuffled."""
    return mixed(table(spark, sf_dir, "documents"))


#: The same in DuckDB.
OP2_SQL = f"""
with recursive counts as (
    select source, count(*) as n_docs, pow(count(*)::double, {TEMPERATURE}) as weight from documents group by source
), rates as (
    select source, weight / (select sum(weight) from counts) * (select sum(n_docs)::bigint from counts) / n_docs as rate
    from counts
), steps as (
    select source, rate, 0 as k, 0.0::double as log_factorial, exp(-rate) as total from rates
    union all
    select source, rate, k + 1, log_factorial + ln((k + 1)::double),
        total + exp((k + 1) * ln(rate) - rate - (log_factorial + ln((k + 1)::double)))
    from steps where k < ceil(rate + 8 * sqrt(rate) + 20)::int
), cdfs as (
    select source, list(total order by k) as cdf from steps group by source
), drawn as (
    select d.*, len(list_filter(cdf, lambda p: p <=
        ('0x' || substr(md5('{SEED}:' || coalesce(d.source, '') || ':' || coalesce(d.doc_id::varchar, '')), 1, 13))::bigint
        / 4503599627370496.0::double)) as n
    from documents d join cdfs c on d.source is not distinct from c.source
), copies as (
    select * exclude (n), unnest(range(n))::int as copy from drawn where n > 0
)
select *, ('0x' || substr(md5('{SEED}/order:' || coalesce(source, '') || ':' || coalesce(doc_id::varchar, '')
        || ':' || copy::varchar), 1, 13))::bigint / 4503599627370496.0::double as shuffle_key
from copies
"""
