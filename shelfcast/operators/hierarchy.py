"""Category queries over the nested classification documents.

All list/set queries start from one unpivot of the six level paths
(``explode`` over an array of six structs), i.e. a single scan of the
documents instead of six UNION ALL branches.  Paths into missing
sub-documents give NULL (missing and NULL are the same here).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.classification import LEVELS, level_path
from .relational import running_total

NOT_AVAILABLE = "N/A"


def _sorted(df: DataFrame, col: str, ordered: bool) -> DataFrame:
    """optional final order; SQL++ ascending puts missing/NULL first."""
    return df.orderBy(F.col(col).asc_nulls_first()) if ordered else df


def flatten_categories(doc: DataFrame, ordered: bool = False) -> DataFrame:
    """H1: nodeid, classification, level0..level5 (``ordered``: by nodeid)."""
    return _sorted(doc.select(F.col("nodeID").alias("nodeid"), "classification",
                              *[F.col(level_path(i)).alias(f"level{i}") for i in range(LEVELS)]), "nodeid", ordered)


def any_level_is(category) -> Column:
    """The category equals the value at some level (NULL levels never match)."""
    lit = F.lit(category) if not isinstance(category, Column) else category
    cond = None
    for i in range(LEVELS):
        c = F.coalesce(F.col(level_path(i)) == lit, F.lit(False))
        cond = c if cond is None else (cond | c)
    return cond


def find_category(doc: DataFrame, category: str, ordered: bool = False) -> DataFrame:
    """H2: distinct nodes that have ``category`` at any level (``ordered``: by nodeid)."""
    return _sorted(doc.where(any_level_is(category)).select(F.col("nodeID").alias("nodeid")).distinct(),
                   "nodeid", ordered)


def category_pairs(doc: DataFrame, with_level: bool = False) -> DataFrame:
    """G1: one (category, nodeid[, level]) row per level of every document, NULLs kept."""
    items = F.array(*[F.struct(F.lit(i).alias("level"), F.col(level_path(i)).alias("category"))
                      for i in range(LEVELS)])
    out = doc.select(F.col("nodeID").alias("nodeid"), "classification", F.inline(items))
    cols = ["category", "nodeid"] + (["level", "classification"] if with_level else [])
    return out.select(*cols)


def category_node_lists(doc: DataFrame, ordered: bool = False) -> DataFrame:
    """Category -> node list with duplicates, sorted; NULL and 'N/A' groups kept.

    A small view: a list holds up to six entries per category document (one per level)
    and is one row.  ``category_node_chunks`` has the same lists in rows of bounded size.
    """
    return _sorted(category_pairs(doc).groupBy("category")
                   .agg(F.sort_array(F.collect_list("nodeid")).alias("nodeids")), "category", ordered)


def category_node_chunks(doc: DataFrame, chunk_size: int = 10_000) -> DataFrame:
    """H3 / D13 in bounded rows: category, chunk (from 0), nodeids: at most ``chunk_size`` entries of the sorted list.

    The chunks of a category in their order are its list in ``category_node_lists``.
    A node's entries in a category are counted first; the count of the entries before
    it (``running_total``: no task holds a whole category) says which chunks they fall in.
    """
    counted = category_pairs(doc).where(F.col("nodeid").isNotNull()).groupBy("category", "nodeid") \
        .agg(F.count(F.lit(1)).alias("times"))
    at = running_total(counted, ["category"], "nodeid", "times", "before")
    first, last = F.floor(F.col("before") / chunk_size), F.floor((F.col("before") + F.col("times") - 1) / chunk_size)
    pieces = at.select("category", "nodeid", "before", "times", F.explode(F.sequence(first, last)).alias("chunk"))
    inside = F.least(F.col("before") + F.col("times"), (F.col("chunk") + 1) * chunk_size) \
        - F.greatest("before", F.col("chunk") * chunk_size)
    lists = pieces.select("category", "chunk", F.struct("nodeid", inside.cast("int").alias("times")).alias("entry")) \
        .groupBy("category", "chunk").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    # categories all of whose documents lack a node have an empty list
    empty = category_pairs(doc).groupBy("category").agg(F.count("nodeid").alias("n")).where("n = 0").select(
        "category", F.lit(0).cast("bigint").alias("chunk"), F.array().cast("array<bigint>").alias("nodeids"))
    return lists.select("category", "chunk", F.flatten(F.transform(
        "entries", lambda e: F.array_repeat(e["nodeid"], e["times"]))).alias("nodeids")).unionByName(empty)


def category_nodes(doc: DataFrame, ordered: bool = False) -> DataFrame:
    """Distinct (category, nodeid) without missing levels and without 'N/A'."""
    p = category_pairs(doc)
    return _sorted(p.where(F.col("nodeid").isNotNull() & F.col("category").isNotNull()
                           & (F.col("category") != NOT_AVAILABLE)).distinct(), "category", ordered)


def categories_all(doc: DataFrame, ordered: bool = False) -> DataFrame:
    """H5: distinct category names at any level (NULL and 'N/A' kept)."""
    return _sorted(category_pairs(doc).select("category").distinct(), "category", ordered)


def register_find_category(spark, doc: DataFrame, view: str = "classification_flat",
                           function: str = "find_category") -> None:
    """H2 as a SQL table function: ``SELECT * FROM find_category('Education')``.

    Registers the flattened documents as temp view ``view`` and a temporary
    SQL table function over it (the parameterised function of the source
    query language).  NULL levels never match, as in ``find_category``.
    """
    flatten_categories(doc).createOrReplaceTempView(view)
    levels = ", ".join(f"level{i}" for i in range(LEVELS))
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {function}(category STRING)
        RETURNS TABLE (nodeid BIGINT)
        RETURN SELECT DISTINCT nodeid FROM {view} WHERE category IN ({levels})""")
