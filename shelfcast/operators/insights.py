"""Jobs the reference declares (DDL) or asks for (ReadMe) without computing code.

Meanings chosen here are documented per function; every job is built from
the same pre-aggregated facts as the views (product x month sales, asin x
month reviews), so raw rows are shuffled at most once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import money_from_cents, month_index, node_id, rounded_mean, season
from ..sources.tables import SourceSet
from . import hierarchy
from .relational import dense_rank_top
from .views import node_month_reviews, node_month_sales, node_sales, product_month_facts

TOKEN_SPLIT = r"[^\p{L}]+"    # a token is a maximal run of letters, after lower-casing


# --------------------------------------------------------------------------- L1 TF-IDF
def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, len, cnt): occurrences of each term per document and the document's token count.

    Texts are tokenised once, where they are read; what is partitioned by ``id`` are the
    terms, and vocabulary, weights and a join by id all read that one exchange.
    """
    tokens = F.filter(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT), lambda t: t != "")
    tok = docs.select(F.col(id_col).alias("id"), tokens.alias("terms"))
    # explode_outer: a plain explode makes the optimizer add a size(terms) > 0
    # filter below the projection, which would tokenise every text twice.
    ex = tok.select("id", F.size("terms").alias("len"), F.explode_outer("terms").alias("term"))
    return ex.where(F.col("term").isNotNull()).repartition("id").groupBy("id", "term", "len") \
        .agg(F.count(F.lit(1)).alias("cnt"))


def vocabulary(counts: DataFrame, top_n: int = 50) -> DataFrame:
    """termid 0.., word, df: the ``top_n`` terms in most documents (ties by word), by a distributed top-k."""
    dfreq = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    order = (F.col("df").desc(), F.col("term").asc())
    top = dfreq.orderBy(*order).limit(top_n)
    return top.select((F.row_number().over(Window.orderBy(*order)) - 1).alias("termid"), F.col("term").alias("word"), "df")


def term_weights(counts: DataFrame, n_docs, top_n: int = 50, digits: int = 6) -> DataFrame:
    """``id`` and the weights term0..term{n-1} of every document with a vocabulary term.

    tf = count of term in doc / tokens in doc; idf = ln(N / df) with ``n_docs`` the
    number of documents; weight = tf * idf rounded to ``digits``, 0 for a term that the
    document lacks.  The vocabulary (its size is the parameter) is broadcast; the
    pivot needs no exchange, as the counts are partitioned by ``id``.
    """
    vocab = vocabulary(counts, top_n).select("termid", F.col("word").alias("term"), "df")
    w = counts.join(F.broadcast(vocab), "term").select(
        "id", "termid", F.round(F.col("cnt") / F.col("len") * F.log(n_docs / F.col("df")), digits).alias("w"))
    # (document, term) pairs are unique here: one aggregation pivots them (pivot() would aggregate twice)
    return w.groupBy("id").agg(*[F.expr(f"coalesce(max(case when termid = {i} then w end), 0D) as term{i}")
                                 for i in range(top_n)])


def tfidf(docs: DataFrame, id_col: str, text_col: str, top_n: int = 50, digits: int = 6):
    """L1: (vocabulary, weights) for the ``top_n`` terms of highest document frequency; one lazy plan each."""
    counts = term_counts(docs, id_col, text_col)
    n_docs = docs.select(F.count_distinct(F.col(id_col))).scalar()
    return vocabulary(counts, top_n), term_weights(counts, n_docs, top_n, digits)


def _review_terms(src: SourceSet) -> DataFrame:
    """Term counts of the texts that belong to a review."""
    counts = term_counts(src.review_text, "reviewid", "text")
    return counts.join(src.reviews.select(F.col("reviewid").alias("id")), "id", "left_semi")


def tfidf_vocabulary(src: SourceSet, top_n: int = 50) -> DataFrame:
    return vocabulary(_review_terms(src), top_n).select("termid", "word")


def reviews_tfidf(src: SourceSet, top_n: int = 50) -> DataFrame:
    """ReviewsTFIDF: reviewid, asin, term0..term{n-1}."""
    corpus = src.reviews.select("reviewid", "asin").join(src.review_text.select("reviewid"), "reviewid")
    wide = term_weights(_review_terms(src), corpus.select(F.count_distinct("reviewid")).scalar(), top_n)
    zeros = [F.coalesce(F.col(f"term{i}"), F.lit(0.0)).alias(f"term{i}") for i in range(top_n)]
    return corpus.join(wide.withColumnRenamed("id", "reviewid"), "reviewid", "left").select("reviewid", "asin", *zeros)


# --------------------------------------------------------------------------- L2 L3 L4
def review_summary(src: SourceSet) -> DataFrame:
    """L2: per asin: number of reviews, mean rating, mean review length (characters).

    Lengths are computed on the text side and only the (reviewid, length)
    pair is joined; reviews without text do not count for the length mean.
    """
    lengths = src.review_text.select("reviewid", F.length("text").alias("len"))
    r = src.reviews.select("reviewid", "asin", "overall").join(lengths, "reviewid", "left")
    g = r.groupBy("asin").agg(F.count("reviewid").alias("numreviews"), F.sum("overall").alias("s"),
                              F.count("overall").alias("n"), F.sum("len").alias("sl"), F.count("len").alias("nl"))
    return g.select("asin", "numreviews", rounded_mean("s", "n", 2).alias("avgrating"),
                    rounded_mean("sl", "nl", 2).alias("avgreviewlength"))


def review_sentiment(src: SourceSet) -> DataFrame:
    """L3: the reviews aggregate (D2) with the mean sentiment of the same reviews."""
    g = node_month_reviews(src)
    return g.select("asin", "nodeid", "month", "year", "season",
                    F.col("n_reviews").alias("numreviews"),
                    rounded_mean("sum_overall", "n_overall", 2).alias("avgrating"),
                    rounded_mean("sum_sent", "n_sent", 2).alias("avgsentiment"))


def category_avg_price(src: SourceSet) -> DataFrame:
    """L4: (nodeid, classification, categoryname, categorylevel, avgproductprice).

    One row per named level of each node (missing levels and 'N/A' left
    out); the price is the mean full price of the node's products.
    """
    cats = hierarchy.category_pairs(src.classification, with_level=True)
    cats = cats.where(F.col("category").isNotNull() & (F.col("category") != hierarchy.NOT_AVAILABLE))
    price = (src.products.select(node_id("nodeid").alias("nodeid"), "fullprice")
             .groupBy("nodeid").agg(F.sum("fullprice").alias("s"), F.count("fullprice").alias("n")))
    return (cats.join(price, "nodeid", "left")
                .select("nodeid", "classification", F.col("category").alias("categoryname"),
                        F.col("level").alias("categorylevel"), rounded_mean("s", "n", 2).alias("avgproductprice")))


# --------------------------------------------------------------------------- L8-L13
def _node_names(src: SourceSet) -> DataFrame:
    return hierarchy.flatten_categories(src.classification).select("nodeid", "classification")


def top_categories(src: SourceSet, month: int = 12, k: int = 3) -> DataFrame:
    """Classifications ranked by sales in ``month`` (all years), dense rank <= k."""
    s = node_sales(src, ("month",)).where(F.col("month") == month)
    g = s.join(_node_names(src), "nodeid").groupBy("classification").agg(
        money_from_cents(F.sum("price_c")).alias("sales"))
    return dense_rank_top(g, "sales", k, rank_name="rank_sales")


def category_peak(src: SourceSet, name: str) -> DataFrame:
    """Season and month with the highest sales of the nodes carrying category ``name``."""
    nodes = hierarchy.find_category(src.classification, name)
    s = node_sales(src, ("month",)).join(nodes, "nodeid", "left_semi")
    g = s.groupBy("month").agg(money_from_cents(F.sum("price_c")).alias("sales"), F.sum("units").alias("vol"))
    return dense_rank_top(g, "sales", 1).select(season("month").alias("season"), "month", "sales", "vol")


def demand_by_price_band(src: SourceSet, name: str, low, high, above=None) -> DataFrame:
    """Historic units and sales per node for products of category ``name`` priced
    in [low, high] (or above ``above``)."""
    band = F.col("fullprice").between(low, high)
    if above is not None:
        band = band | (F.col("fullprice") > above)
    nodes = hierarchy.find_category(src.classification, name)
    p = (src.products.where(band).select("productid", node_id("nodeid").alias("nodeid"))
         .join(nodes, "nodeid", "left_semi"))
    f = product_month_facts(src).join(p, "productid")
    return f.groupBy("nodeid").agg(F.sum("units").alias("vol"), money_from_cents(F.sum("price_c")).alias("sales"),
                                   F.count_distinct("productid").alias("n_products"))


def falling_demand(src: SourceSet) -> DataFrame:
    """Classifications whose spring units fall below the preceding winter's.

    Winter of year Y is December Y-1 plus January and February Y; spring is
    March to May of Y.  Only years with both seasons present are compared.
    """
    s = node_month_sales(src).join(_node_names(src), "nodeid")
    sy = F.when(F.col("month") == 12, F.col("year") + 1).otherwise(F.col("year"))
    g = (s.withColumn("sy", sy).groupBy("classification", "sy")
          .agg(F.sum(F.when(F.col("month").isin(12, 1, 2), F.col("units"))).alias("winter_vol"),
               F.sum(F.when(F.col("month").isin(3, 4, 5), F.col("units"))).alias("spring_vol")))
    return (g.where(F.col("spring_vol") < F.col("winter_vol"))
             .select("classification", F.col("sy").alias("yr"), "winter_vol", "spring_vol"))


def high_demand_products(src: SourceSet, as_of_year: int, as_of_month: int, k: int = 10) -> DataFrame:
    """Products with the most units in the 12 months before the as-of month (dense rank <= k)."""
    now = as_of_year * 12 + as_of_month - 1
    f = product_month_facts(src)
    f = f.where(month_index("year", "month").between(now - 12, now - 1))
    g = f.groupBy("productid").agg(F.sum("units").alias("vol"), money_from_cents(F.sum("price_c")).alias("sales"))
    return dense_rank_top(g, "vol", k, rank_name="rank_vol")


def discontinue_candidates(src: SourceSet, as_of_year: int, as_of_month: int, k: int = 5) -> DataFrame:
    """Nodes whose units fell year over year, lowest last-12-month units first (dense rank <= k)."""
    now = as_of_year * 12 + as_of_month - 1
    s = node_month_sales(src).where(F.col("nodeid").isNotNull())
    i = month_index("year", "month")
    g = (s.where(i.between(now - 24, now - 1)).groupBy("nodeid")
          .agg(F.coalesce(F.sum(F.when(i >= now - 12, F.col("units"))), F.lit(0)).cast("bigint").alias("vol_last"),
               F.coalesce(F.sum(F.when(i < now - 12, F.col("units"))), F.lit(0)).cast("bigint").alias("vol_prev")))
    f = g.where(F.col("vol_last") < F.col("vol_prev"))
    return dense_rank_top(f, "vol_last", k, descending=False, rank_name="rank_low")
