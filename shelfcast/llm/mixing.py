"""Mixing sources to target weights by Poisson replication.

A source with target weight w gets the mean repetition rate
``w * budget / size`` per document, where size is the UTF-8 size of the
source's texts over all documents.  Each document draws its count from the
Poisson distribution of that mean by inverting it at a uniform number taken
from a hash of seed and ``doc_id``; it is exploded by the count, and the copies
are shuffled globally by a hash of seed, ``doc_id`` and copy.  Draws depend on
nothing but seed, ``doc_id`` and rate, so a lost task repeats them exactly.

Defined cases: a null ``source`` is a source of its own; sources without bytes
get rate 1; a null ``doc_id`` draws as the text ``null``; repeated rows draw
alike, each for itself; an empty table gives an empty result; other columns
are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, read_table

SEED = "mix-1"
#: weight of a source = its size to this power (0.5: between proportional and uniform)
EXPONENT = 0.5
#: up to so many sources their rates are broadcast; beyond, they are joined by a shuffle
BROADCAST_SOURCES = 10_000
#: a larger mean is drawn as a sum of independent draws of at most this mean (exp(-mean) stays far from 0)
MEAN_PER_DRAW = 256


def source_rates(df: DataFrame, weights: DataFrame | None = None, budget: float = 1.0,
                 exponent: float = EXPONENT) -> DataFrame:
    """Per source: size, weight and mean repetition ``rate``.

    ``weights`` (columns source, weight) names targets; sources that it does not
    name get weight 0.  Without it, weights follow size ** exponent.  ``budget``
    is the wanted size of the mix in multiples of the input.
    """
    sizes = (df.groupBy("source")
             .agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")).alias("size")))
    if weights is None:
        weighted = sizes.withColumn("raw", F.pow(F.col("size").cast("double"), F.lit(exponent)))
    else:
        wanted = weights.select(F.col("source").alias("_w_source"), F.col("weight").cast("double").alias("raw"))
        weighted = (sizes.join(wanted, sizes["source"].eqNullSafe(wanted["_w_source"]), "left")
                    .drop("_w_source").fillna({"raw": 0.0}))
    weighted = cut(weighted)                                # a row per source; read again for the totals
    totals = weighted.agg(F.sum("size").alias("all_size"), F.sum("raw").alias("all_raw")).first()
    all_size, all_raw = float(totals["all_size"] or 0), float(totals["all_raw"] or 0)
    rate = F.when(F.col("size") > 0, F.col("raw") / F.lit(all_raw or 1.0) * F.lit(all_size * budget) / F.col("size"))
    return weighted.withColumn("weight", F.col("raw") / F.lit(all_raw or 1.0)) \
                   .withColumn("rate", F.coalesce(rate, F.lit(1.0))).drop("raw")


def _with_cdf(rates: DataFrame) -> DataFrame:
    """``draws`` (number of independent draws) and ``cdf`` (of one draw, up to where it is 1 in double precision)."""
    mean = F.col("rate") / F.col("draws")
    return (rates.withColumn("draws", F.greatest(F.ceil(F.col("rate") / MEAN_PER_DRAW), F.lit(1)).cast("int"))
            .withColumn("mean", mean)
            .withColumn("cdf", F.expr(
                "aggregate(sequence(1, cast(ceil(mean + 12 * sqrt(mean) + 30) as int)), "
                "named_struct('p', exp(-mean), 's', exp(-mean), 'c', array(exp(-mean))), "
                "(a, k) -> named_struct('p', a.p * mean / k, 's', a.s + a.p * mean / k, "
                "'c', concat(a.c, array(a.s + a.p * mean / k))), a -> a.c)")))


def _uniform(seed: str, identity: Column, draw: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash."""
    word = F.md5(F.concat_ws(":", F.lit(seed), identity, draw.cast("string")))
    return (F.conv(F.substring(word, 1, 13), 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def mix(df: DataFrame, rates: DataFrame, seed: str = SEED) -> DataFrame:
    """Documents repeated to their rates, in a globally shuffled order.

    Adds ``copy`` (0-based) and ``shuffle_key``; rows are dealt over all tasks
    by the key and sorted by it inside each, a random order of the whole.
    """
    cols = df.columns
    tables = _with_cdf(rates).select(F.col("source").alias("_m_source"), F.col("cdf").alias("_m_cdf"),
                                     F.col("draws").alias("_m_draws"))
    if rates.count() <= BROADCAST_SOURCES:
        tables = F.broadcast(tables)
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    joined = df.join(tables, df["source"].eqNullSafe(tables["_m_source"]), "inner")
    count = F.when(F.col("_m_draws") == 1, _count_below(_uniform(seed, identity, F.lit(0)))) \
        .otherwise(F.aggregate(F.sequence(F.lit(0), F.col("_m_draws") - 1), F.lit(0),
                               lambda total, j: total + _count_below(_uniform(seed, identity, j))))
    counted = joined.withColumn("_m_count", count).filter("_m_count > 0")
    copies = counted.select(*[F.col(f"`{c}`") for c in cols],
                            F.explode(F.sequence(F.lit(0), F.col("_m_count") - 1)).alias("copy"))
    key = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), identity, F.col("copy").cast("string"))), 1, 16)
    return copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _count_below(u: Column) -> Column:
    """How many entries of the cdf are at most u; u is bound once, not once per entry."""
    return F.element_at(F.transform(F.array(u), lambda x: F.size(F.filter("_m_cdf", lambda c: c <= x))), 1)


def op7(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mix(docs, source_rates(docs))


ORACLE = f"""
with sizes as (
  select source, sum(coalesce(strlen(text), 0))::bigint as size from documents group by source
), rates as (
  select source, coalesce(case when size > 0 then
           pow(size::double, {EXPONENT}) / (select sum(pow(size::double, {EXPONENT})) from sizes)
           * (select sum(size) from sizes)::double / size end, 1.0) as rate
  from sizes
), mass as (
  select source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) as p
  from rates, (select unnest(range(0, 400)) as k)
), cdf as (
  select source, k, sum(p) over (partition by source order by k) as c from mass
), drawn as (
  select *, (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, 'null') || ':0'), 1, 13))::bigint::double + 0.5)
            / 4503599627370496.0 as u
  from documents
), counted as (
  select d.*, (select count(*) from cdf where cdf.source is not distinct from d.source and cdf.c <= d.u) as n from drawn d
), copied as (
  select doc_id, text, lang, source, n_chars, unnest(range(0, n))::integer as copy from counted
)
select *, substr(md5('{SEED}:order:' || coalesce(doc_id::varchar, 'null') || ':' || copy::varchar), 1, 16) as shuffle_key
from copied
"""
