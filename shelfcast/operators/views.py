"""Integrated views: sales star, monthly/yearly aggregates with ranks, reviews.

Plan notes (what runs at scale):

* The calendar of a ``SourceSet`` built from a day span has exactly one row
  per date, so ``orders JOIN calendar ON orderdate = date`` is evaluated as a
  range filter on ``orderdate`` plus month/year/season derived from it: no
  join, and the filter sits on the orders scan.  A calendar given as a table
  is joined (it is one row per day, small; AQE broadcasts it by measured size).
* Aggregates do not build the 24-column ``sales`` rows.  The left joins to
  customers and campaigns are on their primary keys, so they neither add nor
  remove fact rows and no aggregate reads their columns; aggregates therefore
  read the narrow star orderlines -> orders -> products.
* Lines are pre-aggregated to (productid, year, month) right after the
  orderid join, before the shuffle towards the product lookup.  A product
  holding a third of all lines collapses map-side into one row per month.
* Means are carried as exact (sum, count) pairs and divided once at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cents, holiday_season, money_from_cents, node_id, rounded_mean, season
from ..sources.tables import SourceSet
from .relational import dense_ranks, salted_left_join


# --------------------------------------------------------------------------- dating
def dated(src: SourceSet, df: DataFrame, date_col: str) -> DataFrame:
    """Inner join with the calendar on ``date_col``: adds month, year, season, holidayseason."""
    if src.calendar_table is None and src.span is not None:
        d = F.col(date_col)
        m = F.month(d)
        return df.where(src.span.contains(d)).select(
            "*", m.alias("month"), F.year(d).alias("year"), season(m).alias("season"),
            holiday_season(m).alias("holidayseason"))
    cal = src.calendar.select(F.col("date").alias("_cal_date"), "month", "year", "season", "holidayseason")
    return df.join(cal, F.col(date_col) == F.col("_cal_date")).drop("_cal_date")


# --------------------------------------------------------------------------- C1 C2
SALES_COLUMNS = ("orderid", "orderdate", "month", "year", "season", "holidayseason", "customerid",
                 "householdid", "gender", "city", "state", "zipcode", "productid", "asin", "nodeid",
                 "isinstock", "fullprice", "unitprice", "numunits", "totalprice", "campaignid",
                 "campaignchannel", "campaigndiscount", "campaignfreeshippingflag")


def _star(src: SourceSet, with_calendar: bool, cast_node: bool) -> DataFrame:
    o = src.orders.select("orderid", "orderdate", "customerid", "city", "state", "zipcode", "campaignid")
    if with_calendar:
        o = dated(src, o, "orderdate")
    ol = src.orderlines.select("orderid", "productid", "unitprice", "numunits", "totalprice")
    p = src.products.select("productid", "asin",
                            (node_id("nodeid") if cast_node else F.col("nodeid")).alias("nodeid"),
                            "isinstock", "fullprice")
    c = src.customers.select("customerid", "householdid", "gender")
    cp = src.campaigns.select("campaignid", F.col("channel").alias("campaignchannel"),
                              F.col("discount").alias("campaigndiscount"),
                              F.col("freeshppingflag").alias("campaignfreeshippingflag"))
    # Order-level dimensions are attached to orders before the line join: their
    # predicates read only order columns, so the result is the same as joining
    # them last, but the customer shuffle moves orders, not order lines.
    enriched = salted_left_join(o.join(c, "customerid", "left"), cp, "campaignid", "orderid")
    return enriched.join(ol, "orderid").join(p, "productid")


def sales(src: SourceSet) -> DataFrame:
    """One row per order line on a calendar day, 24 columns; node id cast to bigint."""
    return _star(src, True, True).select(*SALES_COLUMNS)


def is_sales(src: SourceSet) -> DataFrame:
    """The earlier star without calendar columns; node id kept as text."""
    cols = [c for c in SALES_COLUMNS if c not in ("month", "year", "season", "holidayseason")]
    return _star(src, False, False).select(*cols)


# --------------------------------------------------------------------------- facts
def season_key(src: SourceSet) -> tuple[str, ...]:
    """Grouping column for the season: none where it follows from the month, the calendar's own where one is given."""
    return () if src.calendar_table is None and src.span is not None else ("season",)


def add_season(df: DataFrame) -> DataFrame:
    """``df`` with its calendar's season, or the month's."""
    return df if "season" in df.columns else df.withColumn("season", season("month"))


def product_month_facts(src: SourceSet, more: tuple[str, ...] = ()) -> DataFrame:
    """(productid, year, month, *more) -> units/price sums and counts, pre-aggregated.

    Reads only orderid/productid/numunits/totalprice of the lines and
    orderid/orderdate of the orders.  ``more``: further calendar columns.
    """
    o = src.orders.select("orderid", "orderdate")
    o = dated(src, o, "orderdate").select("orderid", "year", "month", *more)
    ol = src.orderlines.select("orderid", "productid", "numunits", "totalprice")
    return (ol.join(o, "orderid")
              .groupBy("productid", "year", "month", *more)
              .agg(F.sum("numunits").alias("units"), F.count("numunits").alias("n_units"),
                   F.sum(cents("totalprice")).alias("price_c"), F.count("totalprice").alias("n_price")))


def node_sales(src: SourceSet, keys: tuple[str, ...] = ("year", "month"), cast_node: bool = True) -> DataFrame:
    """(nodeid, *keys) -> units, n_units, price_c (cents), n_price (node NULL kept as a group).

    ``keys`` is a subset of (year, month, season): the product-month facts are
    grouped straight to the requested grain, one aggregation after the
    product lookup.
    """
    more = tuple(k for k in keys if k == "season")
    p = src.products.select("productid", (node_id("nodeid") if cast_node else F.col("nodeid")).alias("nodeid"))
    return (product_month_facts(src, more).join(p, "productid")
              .groupBy("nodeid", *keys)
              .agg(F.sum("units").alias("units"), F.sum("n_units").alias("n_units"),
                   F.sum("price_c").alias("price_c"), F.sum("n_price").alias("n_price")))


def node_month_sales(src: SourceSet, cast_node: bool = True) -> DataFrame:
    """(nodeid, year, month) -> units, n_units, price_c (cents), n_price (node NULL kept as a group)."""
    return node_sales(src, ("year", "month"), cast_node)


# --------------------------------------------------------------------------- D1
def salesaggregate(src: SourceSet) -> DataFrame:
    """By nodeid, month, year, season: total/avg units, total/avg price."""
    f = add_season(node_sales(src, ("year", "month", *season_key(src))))
    return f.select(
        "nodeid", "month", "year", "season",
        F.col("units").alias("total_sales_volume"),
        rounded_mean("units", "n_units", 4).alias("avg_sales_volume"),
        money_from_cents("price_c").alias("total_sales_price"),
        rounded_mean("price_c", "n_price", 2, total_scale=2).alias("avg_sales_price"),
    )


# --------------------------------------------------------------------------- D4-D6 E1 E2
def sales_agg(src: SourceSet, by: list[str]) -> DataFrame:
    """Sales, vol, avgprice by node and ``by`` (subset of yr, mn).

    With one grouping column (mn or yr) the two dense ranks of a node inside
    that month/year are added, descending, NULLs first as in PostgreSQL.  No task
    holds all nodes of a month or year (``relational.dense_ranks``).
    """
    names = {"yr": "year", "mn": "month"}
    g = node_sales(src, tuple(names[b] for b in by))
    g = g.select("nodeid", *[F.col(names[b]).alias(b) for b in by], F.col("price_c").alias("_sales_c"),
                 F.col("units").alias("vol"), F.col("n_price").alias("_n_price"))
    out = g.select("nodeid", *by, money_from_cents("_sales_c").alias("sales"), "vol",
                   rounded_mean("_sales_c", "_n_price", 2, total_scale=2).alias("avgprice"))
    if len(by) == 1:
        out = dense_ranks(out, by[0], {"sales": "rank_sales", "vol": "rank_vol"}, "decimal(38,2)")
    return out


def sales_agg_mn(src: SourceSet) -> DataFrame:
    return sales_agg(src, ["mn"])


def sales_agg_yr(src: SourceSet) -> DataFrame:
    return sales_agg(src, ["yr"])


def sales_agg_yrmn(src: SourceSet) -> DataFrame:
    return sales_agg(src, ["yr", "mn"])


# --------------------------------------------------------------------------- D7 D8 D9 C10
def days_in_month(cal: DataFrame) -> DataFrame:
    """max(dom) per month and year of the calendar."""
    return cal.groupBy("month", "year").agg(F.max("dom").alias("tot_days_in_month"))


def monthly_sales_with_days(src: SourceSet) -> DataFrame:
    """All-node monthly units and sales joined to the days per month."""
    m = (node_month_sales(src).groupBy("year", "month")
         .agg(F.sum("units").alias("vol"), money_from_cents(F.sum("price_c")).alias("sales")))
    return m.join(days_in_month(src.calendar), ["month", "year"]).select(
        "year", "month", "tot_days_in_month", "vol", "sales")


def is_sales_by_month(src: SourceSet, with_season: bool = False) -> DataFrame:
    """D7 (v2) / D8 (v3, with season and the join to days per month).

    Node id stays text as in the earlier star.  In v3 the inner join to the
    per-month day counts is applied after aggregation: it only compares
    month and year, so joining before or after grouping keeps the same rows,
    and after grouping it touches a few rows per node instead of every line.
    """
    f = node_sales(src, ("year", "month", *(season_key(src) if with_season else ())), cast_node=False)
    keys = ["nodeid", "month", "year"] + (["season"] if with_season else [])
    out = (add_season(f) if with_season else f).select(
        *keys,
        F.col("units").alias("total_sales_volume"),
        rounded_mean("units", "n_units", 4).alias("avg_sales_volume"),
        money_from_cents("price_c").alias("total_sales_price"),
        rounded_mean("price_c", "n_price", 2, total_scale=2).alias("avg_sales_price"),
    )
    if with_season:
        out = out.join(days_in_month(src.calendar).select("month", "year"), ["month", "year"]).select(
            *keys, "total_sales_volume", "avg_sales_volume", "total_sales_price", "avg_sales_price")
    return out


# --------------------------------------------------------------------------- reviews
def asin_month_reviews(src: SourceSet, score_col: str = "sentiment", more: tuple[str, ...] = ()) -> DataFrame:
    """(asin, year, month, *more) -> review counts and rating/score sums, pre-aggregated.

    Reviews whose day is not in the calendar are dropped (inner join).
    ``score_col`` is the per-review score averaged by ``mlview`` (sentiment).
    """
    has_score = score_col in src.reviews.columns
    r = src.reviews.select("reviewid", "asin", "overall", "reviewtime",
                           *([F.col(score_col).alias("_score")] if has_score else []))
    r = dated(src, r, "reviewtime")
    aggs = [F.count("reviewid").alias("n_reviews"),
            F.sum("overall").alias("sum_overall"), F.count("overall").alias("n_overall")]
    if has_score:
        aggs += [F.sum("_score").alias("sum_sent"), F.count("_score").alias("n_sent")]
    else:
        aggs += [F.lit(None).cast("decimal(15,2)").alias("sum_sent"), F.lit(0).cast("bigint").alias("n_sent")]
    return r.groupBy("asin", "year", "month", *more).agg(*aggs)


def review_sums():
    return [F.sum("n_reviews").alias("n_reviews"), F.sum("sum_overall").alias("sum_overall"),
            F.sum("n_overall").alias("n_overall"), F.sum("sum_sent").alias("sum_sent"),
            F.sum("n_sent").alias("n_sent")]


def reviews_by_node(src: SourceSet, how: str, default_node: int | None, more: tuple[str, ...] = ()) -> DataFrame:
    """(asin, nodeid, year, month, *more) review sums after joining products on asin.

    ``how='left'`` keeps reviews without a product; ``default_node`` replaces a
    NULL node (unknown product or product without node).  Two products with
    one asin count that asin's reviews twice, as the source join does.
    """
    p = src.products.select("asin", node_id("nodeid").alias("nodeid"))
    j = asin_month_reviews(src, more=more).join(p, "asin", how)
    node = F.col("nodeid") if default_node is None else F.coalesce("nodeid", F.lit(default_node).cast("bigint"))
    return j.withColumn("nodeid", node)


def node_month_reviews(src: SourceSet) -> DataFrame:
    """Review sums by asin, node (0 if unknown), month, year and the calendar's season."""
    more = season_key(src)
    return add_season(reviews_by_node(src, "left", 0, more).groupBy("asin", "nodeid", "month", "year", *more)
                       .agg(*review_sums()))


def reviewsaggregate(src: SourceSet) -> DataFrame:
    """By asin, node (0 if unknown), month, year, season: numreviews, avgrating."""
    g = node_month_reviews(src)
    return g.select("asin", "nodeid", "month", "year", "season",
                    F.col("n_reviews").alias("numreviews"),
                    rounded_mean("sum_overall", "n_overall", 2).alias("avgrating"))


def reviews_agg_yrmn(src: SourceSet) -> DataFrame:
    """D3: by node (NULL kept as its own group), yr, mn: numreviews, avgrating."""
    j = reviews_by_node(src, "left", None)
    g = j.groupBy("nodeid", F.col("year").alias("yr"), F.col("month").alias("mn")).agg(*review_sums())
    return g.select("nodeid", "yr", "mn", F.col("n_reviews").alias("numreviews"),
                    rounded_mean("sum_overall", "n_overall", 2).alias("avgrating"))


# --------------------------------------------------------------------------- A3
def register_views(spark, src: SourceSet, year_from: int, year_to: int, prefix: str = "") -> list[str]:
    """A3: the integrated views as session temp views (lazy; nothing runs).

    Registers the store tables and every view under ``prefix + name`` so SQL
    users can query them: sales, salesaggregate, reviewsaggregate,
    reviews_agg_yrmn, sales_agg_mn/yr/yrmn, baseline_grid, ml_features,
    mlview and the flattened classification.
    """
    from . import features, hierarchy
    frames = {
        "products": src.products, "orders": src.orders, "orderlines": src.orderlines,
        "customers": src.customers, "campaigns": src.campaigns, "reviews": src.reviews,
        "calendar": src.calendar,
        "sales": sales(src), "salesaggregate": salesaggregate(src), "reviewsaggregate": reviewsaggregate(src),
        "reviews_agg_yrmn": reviews_agg_yrmn(src), "sales_agg_mn": sales_agg_mn(src),
        "sales_agg_yr": sales_agg_yr(src), "sales_agg_yrmn": sales_agg_yrmn(src),
        "baseline_grid": features.baseline_grid(src, year_from, year_to),
        "ml_features": features.ml_features(src, year_from, year_to),
        "mlview": features.mlview(src, year_from, year_to),
    }
    if src.classification is not None:
        frames["classification"] = hierarchy.flatten_categories(src.classification)
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in frames]
