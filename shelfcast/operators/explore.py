"""Exploration helpers: column profile, histogram, reproducible stratified sample."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def _estimated_distinct(col: Column) -> Column:
    """HyperLogLog estimate (about 1 % off); the sketch skips empty strings, hence the letter before each value."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.concat(F.lit("v"), col.cast("string")), 14))


def _distinct(df: DataFrame, c: str) -> Column:
    """Number of different values of a column, as a scalar subquery."""
    return df.select(F.col(c).alias("v")).where(F.col("v").isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()


def profile_table(df: DataFrame, exact_distinct: bool = False, digits: int = 6) -> DataFrame:
    """One row per column: rows, nulls, distinct, min, max, mean, sd.

    All measures come from a single aggregation pass, HyperLogLog estimates
    of the distinct values included, which is the choice for wide tables at scale.
    ``exact_distinct`` counts the values of each column by themselves, in a pass that reads that
    column only: a task holds the different values of one column, never rows of all
    columns (several COUNT(DISTINCT) in one aggregation repeat every row per
    column and, beside minima of texts, sort them in the task).
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    for i, c in enumerate(df.columns):
        col = F.col(c)
        if not exact_distinct:
            aggs.append(_estimated_distinct(col).alias(f"d{i}"))
        aggs += [F.count(col).alias(f"n{i}"), F.min(col).cast("string").alias(f"lo{i}"), F.max(col).cast("string").alias(f"hi{i}")]
        if c in numeric:
            x = col.cast("double")
            aggs += [F.round(F.avg(x), digits).alias(f"m{i}"), F.round(F.stddev_samp(x), digits).alias(f"s{i}")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"m{i}"), F.lit(None).cast("double").alias(f"s{i}")]
    wide = df.agg(*aggs)
    if exact_distinct:
        wide = wide.select("*", *[_distinct(df, c).alias(f"d{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("_rows").alias("n_rows"),
                              (F.col("_rows") - F.col(f"n{i}")).alias("n_null"),
                              F.col(f"d{i}").cast("bigint").alias("n_distinct"),
                              F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                              F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"))
                     for i, c in enumerate(df.columns)])
    return wide.select(F.inline(rows))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram of a numeric column over [min, max].

    Bounds come from one scalar subquery; bucket b covers
    [lo + (b-1)w, lo + bw), the maximum falls in the last bucket.  Only
    non-empty buckets are returned; NULLs are not counted.
    """
    stats = df.select(F.struct(F.min(col).cast("double").alias("lo"),
                               F.max(col).cast("double").alias("hi")).alias("b")).scalar()
    # the bounds subquery is referenced once; buckets and edges read the column
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"), stats.alias("b"))
    lo, hi = F.col("b.lo"), F.col("b.hi")
    raw = F.when(hi == lo, F.lit(1)).otherwise(F.floor((F.col("x") - lo) * bins / (hi - lo)) + 1)
    bucket = F.least(raw.cast("int"), F.lit(bins))
    counted = x.groupBy(bucket.alias("bucket"), "b").agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return counted.select("bucket", (lo + (F.col("bucket") - 1) * width).alias("lo_edge"),
                          (lo + F.col("bucket") * width).alias("hi_edge"), "n")


def profile_sources(tables: Mapping[str, DataFrame], digits: int = 6) -> DataFrame:
    """L5 for several tables: ``profile_table`` with a leading ``source``; one pass per table, HLL distinct counts."""
    parts = [profile_table(df, digits=digits).select(F.lit(name).alias("source"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def histogram_numeric(df: DataFrame, bins: int) -> DataFrame:
    """L6 for every numeric column: ``column`` and the columns of ``histogram``.

    One pass for all bounds and one for all counts; each row becomes one
    (column, value) pair per numeric column, which is counted before the shuffle.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if not names:
        raise ValueError("the table has no numeric column")
    bounds = df.select(F.struct(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"))
                                  .alias(f"b{i}") for i, c in enumerate(names)]).alias("b")).scalar()
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"),
                               F.col(f"_bounds.b{i}.lo").alias("lo"), F.col(f"_bounds.b{i}.hi").alias("hi"))
                      for i, c in enumerate(names)])
    x = df.select(*names, bounds.alias("_bounds")).select(F.inline(cells)).where(F.col("x").isNotNull())
    lo, hi = F.col("lo"), F.col("hi")
    raw = F.when(hi == lo, F.lit(1)).otherwise(F.floor((F.col("x") - lo) * bins / (hi - lo)) + 1)
    counted = x.groupBy("column", "lo", "hi", F.least(raw.cast("int"), F.lit(bins)).alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return counted.select("column", "bucket", (lo + (F.col("bucket") - 1) * width).alias("lo_edge"),
                          (lo + F.col("bucket") * width).alias("hi_edge"), "n")


# --------------------------------------------------------------------------- stored summaries
#: log2 of the HyperLogLog registers (relative standard error 1.04 / sqrt(2**14) = 0.8 %), and the KLL size
#: (ranks of quantiles within 1.4 % of the rows)
HLL_BITS, KLL_SIZE = 14, 200
SUMMARY = ("n_rows", "n_null", "n_numbers", "total", "squares", "lo_number", "hi_number", "lo_text", "hi_text", "hll", "kll")


def summarize(df: DataFrame, day_col: str | None = None) -> DataFrame:
    """Mergeable summaries: one row per column, and per day of ``day_col`` if there is one.

    Counts, bounds, sums, a HyperLogLog sketch of the values and, for numbers, a KLL
    sketch for quantiles.  One aggregation pass over the input (the rows are
    not repeated for each column), whose result for a day never has to be computed again:
    ``merge_summaries`` puts days, or parts of any kind, together.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    none = lambda kind: F.lit(None).cast(kind)
    aggs, cells = [F.count(F.lit(1)).alias("_rows")], []
    names = [c for c in df.columns]
    for i, c in enumerate(names):
        col, x = F.col(c), F.col(c).cast("double")
        number = c in numeric
        # the sketch skips empty strings, hence the letter before each value
        parts = {"n_null": F.count_if(col.isNull()), "hll": F.hll_sketch_agg(F.concat(F.lit("v"), col.cast("string")), HLL_BITS)}
        if number:
            parts |= {"n_numbers": F.count(x), "total": F.sum(x), "squares": F.sum(x * x), "lo_number": F.min(x),
                      "hi_number": F.max(x), "kll": F.kll_sketch_agg_double(x, KLL_SIZE)}
        else:
            parts |= {"lo_text": F.min(col).cast("string"), "hi_text": F.max(col).cast("string")}
        aggs += [a.alias(f"{k}{i}") for k, a in parts.items()]
        kinds = {"n_numbers": "bigint", "total": "double", "squares": "double", "lo_number": "double", "hi_number": "double",
                 "lo_text": "string", "hi_text": "string", "kll": "binary"}
        cells.append(F.struct(F.lit(c).alias("column"), F.col("_rows").alias("n_rows"), *[
            (F.col(f"{k}{i}") if k in parts else none(kinds[k])).alias(k) for k in SUMMARY[1:]]))
    day = [] if day_col is None else [F.col(day_col).cast("date").alias("day")]
    wide = df.groupBy(*day).agg(*aggs)
    return wide.select(*(["day"] if day else []), F.inline(F.array(*cells)))


def merge_summaries(parts: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """One summary per column (and whatever else ``by`` names) from summaries of parts."""
    return parts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_numbers", "total", "squares")],
        F.min("lo_number").alias("lo_number"), F.max("hi_number").alias("hi_number"),
        F.min("lo_text").alias("lo_text"), F.max("hi_text").alias("hi_text"),
        F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"))


def profile_from(summaries: DataFrame, digits: int = 6) -> DataFrame:
    """L5 read from merged summaries: counts, estimated distinct values, bounds, mean and sd."""
    n, mean = F.col("n_numbers"), F.col("total") / F.col("n_numbers")
    variance = F.greatest((F.col("squares") - F.col("total") * mean) / (n - 1), F.lit(0.0))
    out = [c for c in summaries.columns if c not in SUMMARY]
    return summaries.select(
        *out, "n_rows", "n_null", F.hll_sketch_estimate("hll").alias("n_distinct"), "lo_number", "hi_number", "lo_text",
        "hi_text", F.when(n > 0, F.round(mean, digits)).alias("mean"),
        F.when(n > 1, F.round(F.sqrt(variance), digits)).alias("stddev"))


def equal_depth_histogram(summaries: DataFrame, bins: int) -> DataFrame:
    """L6 read from merged summaries: edges of ``bins`` buckets of about equally many rows, by KLL quantiles."""
    out = [c for c in summaries.columns if c not in SUMMARY]
    ranks = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    edges = summaries.where(F.col("n_numbers") > 0).select(
        *out, "n_numbers", "lo_number", "hi_number", F.kll_sketch_get_quantile_double("kll", ranks).alias("_edges"))
    rows = F.expr(f"transform(sequence(1, {bins}), i -> struct(i as bucket, _edges[i - 1] as lo_edge, _edges[i] as hi_edge))")
    return edges.select(*out, (F.col("n_numbers") / bins).alias("n_about"), F.inline(rows))


def write_summaries(df: DataFrame, path: str, source: str, day_col: str | None = None) -> None:
    """Add the summaries of ``df`` to the store at ``path`` (partitioned by source); days written before are replaced
    by writing them to a new store, never in place."""
    rows = summarize(df, day_col)
    if day_col is None:
        rows = rows.withColumn("day", F.lit(None).cast("date"))
    rows.withColumn("source", F.lit(source)).coalesce(1).write.mode("append").partitionBy("source").parquet(path)


def read_summaries(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Summaries per source and column, merged over the stored days from ``first`` to ``last`` (all without them)."""
    parts = spark.read.parquet(path)
    if first is not None:
        parts = parts.where(F.col("day") >= F.lit(first))
    if last is not None:
        parts = parts.where(F.col("day") <= F.lit(last))
    return merge_summaries(parts, ("source", "column"))


def histogram_sources(tables: Mapping[str, DataFrame], bins: int) -> DataFrame:
    """L6 for every numeric column of several tables: ``histogram_numeric`` with a leading ``source``."""
    parts = [histogram_numeric(df, bins).select(F.lit(name).alias("source"), "*") for name, df in tables.items()
             if any(isinstance(f.dataType, NumericType) for f in df.schema.fields)]
    return reduce(DataFrame.unionByName, parts)


def hash_unit(key, seed: int = 0) -> Column:
    """Key (any type) and seed -> pseudo-random value in [0, 1), the same on every run and engine.

    The seed is part of the hashed text, so another seed gives another, unrelated value.
    """
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{int(seed)}:"), k.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(2 ** 32))


def sample_stratified(df: DataFrame, key: str, strata_col: str | None,
                      fraction: float | Mapping, seed: int = 0) -> DataFrame:
    """Keep a row when the hash of seed and key is below its stratum's fraction.

    A pure per-row filter (no shuffle, no driver round trip); the same key
    is always kept or always dropped, so samples are reproducible and
    nested across fractions.  ``fraction`` is one number or a mapping from
    stratum value to fraction (missing strata are dropped).
    """
    u = hash_unit(key, seed)
    if isinstance(fraction, Mapping):
        if strata_col is None:
            raise ValueError("per-stratum fractions need strata_col")
        limit = None
        for value, frac in fraction.items():
            limit = (F.when(F.col(strata_col) == value, F.lit(float(frac))) if limit is None
                     else limit.when(F.col(strata_col) == value, F.lit(float(frac))))
        return df.where(u < limit)
    return df.where(u < F.lit(float(fraction)))


def sample_exact(df: DataFrame, key: str, n: int, strata_col: str | None = None, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows of every stratum (all, if it has fewer): those with the smallest hashes of seed and key.

    Bottom-k: every task keeps its ``n`` best rows of a stratum before the
    shuffle, so a stratum of any size sends ``n`` rows a task.  Equal hashes go by the key.
    Rows of a missing key or stratum count as those of any other value.
    """
    names = [strata_col] if strata_col is not None else []
    # without a stratum one group of n rows a task, merged in one task
    by = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    order = [F.md5(F.concat(F.lit(f"{int(seed)}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), F.col(key)]
    return df.withColumn("_place", F.row_number().over(by.orderBy(*order))).where(F.col("_place") <= n).drop("_place")
