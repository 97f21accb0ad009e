"""Document fingerprints: weighted SimHash and permuted block tables.

Terms are the lower-cased words of a text.  Each occurrence votes with the
64-bit hash of its term, weighted by the term's length (1 to 8), so longer
terms count for more; bit k is 1 if over half of the weight has it set.  The
votes are summed by one grouped aggregation, 32 long sums per text.

``within_radius`` finds all fingerprints within a Hamming radius: with more
blocks than the radius, two such fingerprints agree in at least
``blocks - radius`` whole blocks, so one table per choice of that many blocks,
keyed by their permuted bits, and an equality join find every pair; each
candidate is verified.

Defined cases: null and empty texts have no terms and the fingerprint 0;
equal texts have equal fingerprints; repeated rows are kept as they are;
rows without ``doc_id`` come first in the order of documents; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAP, bit_sum_lanes, cut, hex64, majority_bits, read_table

#: the order of documents is cut into ranges of about so many rows, up to so many ranges (more rows each beyond)
ROWS_PER_RANGE, MAX_RANGES = 1000, 8192


def term_weight(term: Column) -> Column:
    return F.least(F.length(term), F.lit(8)).cast("bigint")


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``fp`` (long) of every row; ``keys`` must tell the rows apart."""
    terms = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_GAP, -1), lambda w: w != "")
    # explode_outer keeps texts without terms, and the terms are split only once
    words = df.select(*keys, F.explode_outer(terms).alias("_f_term"))
    hashed = words.select(*keys, F.when(F.col("_f_term").isNull(), F.lit(0).cast("bigint"))
                          .otherwise(F.xxhash64("_f_term")).alias("_f_hash"),
                          F.coalesce(term_weight(F.col("_f_term")), F.lit(0).cast("bigint")).alias("_f_weight"))
    summed = hashed.groupBy(*keys).agg(*bit_sum_lanes(F.col("_f_hash"), F.col("_f_weight")),
                                       F.sum("_f_weight").alias("_f_total"))
    return summed.select(*keys, majority_bits(F.col("_f_total")).alias("fp"))


def _long_array(values: list[int]) -> Column:
    """A constant array (one folded literal, however long)."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _count_at_most(bounds: list[int], value: Column) -> Column:
    """How many of the sorted ``bounds`` are at most ``value`` (binary search; null for null)."""
    if not bounds:
        return F.when(value.isNotNull(), F.lit(0))
    array, steps = _long_array(bounds), len(bounds).bit_length()
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(a, _):
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        up = F.get(array, mid) <= value
        return F.when(a["lo"] < a["hi"], F.struct(F.when(up, mid + 1).otherwise(a["lo"]).alias("lo"),
                                                  F.when(up, a["hi"]).otherwise(mid).alias("hi"))).otherwise(a)

    return F.when(value.isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda a: a["lo"]))


def ordered_with_next(df: DataFrame, rows_per_range: int = ROWS_PER_RANGE, max_ranges: int = MAX_RANGES) -> DataFrame:
    """Every row with ``range_no``, ``row_no`` in it and the next row's text and place, by ascending doc_id.

    The order is cut into ranges of doc_id at quantiles (at most ``max_ranges``
    numbers at the driver), so no task holds it all.  The first row of each
    range also goes to the range before as its last, and the first of all to
    the last range: the row after the last is the first.
    """
    n = df.count()
    ranges = max(1, min(max_ranges, n // rows_per_range))
    found = df.agg(F.percentile_approx("doc_id", [i / ranges for i in range(ranges)], 10 * ranges)).first()[0] or []
    bounds = sorted({int(c) for c in found})[1:]                    # the smallest opens range 0
    # a null doc_id comes before all others
    placed = df.withColumn("range_no", F.coalesce(_count_at_most(bounds, F.col("doc_id")), F.lit(0)))
    heads = {r["range_no"]: (None if r["no_id"] else r["least"]) for r in placed.groupBy("range_no").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("no_id")).collect()}
    places = sorted(heads)
    head_ids = [heads[p] if heads.get(p) is not None else 0 for p in range(len(bounds) + 1)]
    is_head = F.col("doc_id").eqNullSafe(F.get(_long_array(head_ids), F.col("range_no")))
    if places and heads[places[0]] is None:
        is_head = F.when(F.col("range_no") == places[0], F.col("doc_id").isNull()).otherwise(is_head)
    firsts = placed.filter(is_head).groupBy("range_no", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    before = [0] * (len(bounds) + 1)
    for i, p in enumerate(places):
        before[p] = places[i - 1]
    guests = firsts.select("doc_id", "text", F.get(_long_array(before), F.col("range_no")).cast("int").alias("range_no"),
                           F.col("range_no").alias("home"))
    rows = placed.select("doc_id", "text", "range_no", F.lit(None).cast("int").alias("home")).unionByName(guests)
    order = Window.partitionBy("range_no").orderBy(F.col("home").isNotNull(), F.col("doc_id").asc_nulls_first(),
                                                   F.xxhash64("text"))
    out = (rows.withColumn("row_no", F.row_number().over(order))
           .withColumn("next_text", F.lead("text").over(order))
           .withColumn("next_home", F.lead("home").over(order))
           .filter(F.col("home").isNull()))
    return out.withColumn("next_range", F.coalesce("next_home", "range_no")) \
              .withColumn("next_row", F.when(F.col("next_home").isNull(), F.col("row_no") + 1).otherwise(F.lit(1))) \
              .drop("home", "next_home")


def edited(text: Column, next_text: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def within_radius(queries: DataFrame, table: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """All pairs (``query_fp``, ``fp``) at most ``radius`` bits apart; both inputs are distinct ``fp`` columns.

    One permuted table per choice of ``blocks - radius`` blocks.  A pair that
    agrees in several choices is kept by the first of them only.
    """
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]

    def block(fp: Column, i: int) -> Column:
        width = edges[i + 1] - edges[i]
        return F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << width) - 1))

    choices = list(combinations(range(blocks), blocks - radius))

    def keyed(df: DataFrame, name: str) -> DataFrame:
        entries = [F.struct(F.lit(n).alias("choice"), F.xxhash64(*[block(F.col("fp"), i) for i in chosen]).alias("key"))
                   for n, chosen in enumerate(choices)]
        return df.select(F.col("fp").alias(name), F.explode(F.array(*entries)).alias("e")).select(name, "e.*")

    pairs = keyed(queries, "query_fp").join(keyed(table, "fp"), ["choice", "key"])
    differ = F.col("query_fp").bitwiseXOR(F.col("fp"))
    agreeing = F.array(*[F.when(_all_zero([block(differ, i) for i in chosen]), F.lit(n))
                         for n, chosen in enumerate(choices)])
    return (pairs.filter((F.bit_count(differ) <= radius) & (F.array_min(agreeing) == F.col("choice")))
            .select("query_fp", "fp"))


def _all_zero(parts: list[Column]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & (p == 0)
    return out


def op8(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = ordered_with_next(docs)
    changed = edited(F.col("text"), F.col("next_text"))
    rows = placed.select("doc_id", "range_no", "row_no", "next_range", "next_row",
                         F.length("text").cast("bigint").alias("n_chars"), "text", changed.alias("edited_text"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited_text"), 256))
    keys = ["range_no", "row_no", "doc_id", "next_range", "next_row", "n_chars", "edited_sha256", "is_edited"]
    versions = rows.select("*", F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("version")),
                                                  F.struct(F.lit(True).alias("is_edited"), F.col("edited_text").alias("version")))).alias("v")) \
        .select(*keys[:-1], "v.is_edited", "v.version")
    each = fingerprints(versions, keys, "version")
    both = each.groupBy(*keys[:-1]).agg(F.max(F.when(~F.col("is_edited"), F.col("fp"))).alias("fp"),
                                        F.max(F.when(F.col("is_edited"), F.col("fp"))).alias("edited_fp"))
    both = cut(both)                                   # about 100 bytes a document; read four times below
    following = both.select(F.col("range_no").alias("next_range"), F.col("row_no").alias("next_row"),
                            F.col("fp").alias("next_fp"))
    joined = both.join(following, ["next_range", "next_row"], "left")
    # search: every doc_id divisible by 100 against all, over distinct fingerprints
    sizes = both.groupBy("fp").agg(F.count("*").alias("holders"))
    asked = both.filter(F.col("doc_id") % 100 == 0).select("fp").distinct()
    near = (within_radius(asked, sizes.select("fp")).join(sizes, "fp")
            .groupBy("query_fp").agg(F.sum("holders").alias("n_within_3")))
    near = near.select(F.col("query_fp").alias("fp"), (F.col("n_within_3") - 1).alias("n_within_3"))
    joined = joined.join(near, "fp", "left")
    return joined.select("doc_id", "n_chars", "edited_sha256", hex64(F.col("fp")).alias("fingerprint"),
                         hex64(F.col("edited_fp")).alias("edited_fingerprint"),
                         likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                         likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
                         F.when(F.col("doc_id") % 100 == 0, F.col("n_within_3")).alias("n_within_3"))
