"""Node x month feature table (sales, reviews, sentiment over 1/3/12 past months).

Plan (one shuffle by node for the window, no cross join, no subqueries):

1. Baseline grid: distinct nodes of ``products``; each node row generates
   its months with ``explode(sequence(lo, hi))`` (month index =
   year*12 + month-1, so frames never cross a yyyymm gap).
2. Monthly measures per (node, month index): sales from the pre-aggregated
   star, reviews from (asin, month) pre-aggregates joined once to products
   with a "matched" flag.  Only months in ``[lo-12, hi]`` are kept.
3. Grid rows and measure rows are unioned and a single window, partitioned
   by node and ordered by month index, sums every measure over
   ``rangeBetween(0,0)``, ``(-1,-1)``, ``(-3,-1)`` and ``(-12,-1)``; grid rows
   are kept.  Each node holds at most (months + 12) x 3 rows, whatever the
   skew of the raw data, because everything is aggregated before the shuffle.

Semantics kept from the source view: a NULL node has a grid row of zeros
(its sales never match); previous-month reviews count every review (unknown
product -> node 0), 3/12-month reviews only reviews with a product (its NULL
node -> 0); ratings average reviews, not monthly means; no reviews -> 0.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (holiday_season, money_from_cents_sql, month_index, node_id,
                                 rounded_mean_sql, season, yyyymm)
from ..sources.tables import SourceSet
from .views import asin_month_reviews, node_month_sales

FRAMES = {"": (0, 0), "pm_": (-1, -1), "p3m_": (-3, -1), "p12m_": (-12, -1)}
# Names and order of the feature columns.
FEATURE_COLUMNS = ("nodeid", "yr", "mn", "sales", "vol", "pm_sales", "pm_vol", "p3m_sales", "p3m_vol",
                   "p12m_sales", "p12m_vol", "pm_numreviews", "pm_avgrating", "p3m_numreviews",
                   "p3m_avgrating", "p12m_numreviews", "p12m_avgrating")
SENTIMENT_COLUMNS = ("nodeid", "yr", "mn", "pm_avgsntp", "p3m_avgsntp", "p12m_avgsntp")


Months = tuple[int, int] | None


def _span_months(src: SourceSet, year_from: int, year_to: int, months: Months) -> Months:
    """(lo, hi) month index of the baseline, cut to ``months``; None for a calendar table."""
    if src.calendar_table is not None or src.span is None:
        return None
    s, e = src.span.start, src.span.end
    first, last = months or (0, 12 * 9999)
    return (max(year_from * 12, s.year * 12 + s.month - 1, first),
            min(year_to * 12 + 11, e.year * 12 + e.month - 1, last))


def _month_bounds(src: SourceSet, year_from: int, year_to: int, months: Months = None):
    """(lo, hi) month index of the baseline as Columns (literals for a day span)."""
    known = _span_months(src, year_from, year_to, months)
    if known is not None:
        return F.lit(known[0]), F.lit(known[1])
    cal = src.calendar.where(F.col("year").between(year_from, year_to))
    idx = month_index("year", "month")
    if months is not None:
        cal = cal.where(idx.between(*months))
    return cal.select(F.min(idx)).scalar(), cal.select(F.max(idx)).scalar()


def baseline_months(src: SourceSet, year_from: int, year_to: int) -> list[int]:
    """Month indexes of the baseline (collected: at most the calendar's months)."""
    known = _span_months(src, year_from, year_to, None)
    if known is not None:
        return list(range(known[0], known[1] + 1))
    idx = month_index("year", "month").alias("m")
    return sorted(r["m"] for r in src.calendar.where(F.col("year").between(year_from, year_to)).select(idx).distinct().collect())


def _frame_days(lo: int, hi: int) -> tuple[dt.date, dt.date]:
    """First day of the 12 months before month ``lo`` and last day of month ``hi``."""
    start, after = lo - 12, hi + 1
    return (dt.date(start // 12, start % 12 + 1, 1),
            dt.date(after // 12, after % 12 + 1, 1) - dt.timedelta(days=1))


def _grid_index(src: SourceSet, year_from: int, year_to: int, months: Months = None) -> DataFrame:
    """(nodeid, midx) for every distinct product node and calendar month in range."""
    lo, hi = _month_bounds(src, year_from, year_to, months)
    nodes = src.products.select(node_id("nodeid").alias("nodeid")).distinct()
    # no month in range: no rows (a sequence would count down)
    grid = nodes.select("nodeid", F.explode(F.when(lo <= hi, F.sequence(lo, hi))).alias("midx"))
    if src.calendar_table is not None or src.span is None:
        months = src.calendar.select(month_index("year", "month").alias("midx")).distinct()
        grid = grid.join(months, "midx", "left_semi")
    return grid


def baseline_grid(src: SourceSet, year_from: int, year_to: int) -> DataFrame:
    """The baseline with season, holiday season and the shifted month keys."""
    g = _grid_index(src, year_from, year_to)
    yr, mn = F.floor(F.col("midx") / 12).cast("int"), (F.col("midx") % 12 + 1).cast("int")
    first = F.make_date(yr, mn, F.lit(1))
    p1, p3, p12 = (F.col("midx") - k for k in (1, 3, 12))
    key = lambda i: yyyymm(F.floor(i / 12), i % 12 + 1)
    return g.select(
        "nodeid", yr.alias("year"), mn.alias("month"), F.date_format(first, "MMM").alias("monthabbr"),
        yyyymm(yr, mn).alias("yyyymm"), season(mn).alias("season"), holiday_season(mn).alias("holidayseason"),
        (p1 % 12 + 1).cast("int").alias("pm"), F.floor(p1 / 12).cast("int").alias("pmy"),
        key(p3).alias("p3myyyymm"), key(p12).alias("p12myyyymm"),
    )


_MEASURES = ("units", "price_c", "a_n", "a_sum", "a_cnt", "a_ssum", "a_scnt",
             "m_n", "m_sum", "m_cnt", "m_ssum", "m_scnt")


def _measure_rows(src: SourceSet, year_from: int, year_to: int, score_col: str = "sentiment",
                  with_sales: bool = True, with_reviews: bool = True, months: Months = None) -> DataFrame:
    """Union of grid rows and monthly measure rows, keyed by (nodeid, midx).

    The sales branch (the star join) and the review branch are left out when
    none of their measures is asked for: a union branch is never pruned by
    the optimizer, even when all of its measure columns are.  With a day
    span, the baseline months and the 12 before them become date bounds that
    reach the scans of orders and reviews.
    """
    grid = _grid_index(src, year_from, year_to, months)
    lo, hi = _month_bounds(src, year_from, year_to, months)
    in_frame = F.col("midx").between(lo - 12, hi)
    known = _span_months(src, year_from, year_to, months)
    if known is not None and known[0] <= known[1]:
        src = src.within(*_frame_days(*known))

    s = None
    if with_sales:
        s = node_month_sales(src).where(F.col("nodeid").isNotNull())
        s = s.select("nodeid", month_index("year", "month").alias("midx"), "units", "price_c").where(in_frame)

    # one projection per branch; missing measures are typed NULLs
    types = {m: "bigint" for m in _MEASURES} | {"a_ssum": "decimal(38,2)", "m_ssum": "decimal(38,2)"}

    def shaped(df, is_base):
        have = set(df.columns)
        return df.selectExpr("nodeid", "midx", f"{str(is_base).lower()} as is_base",
                             *[m if m in have else f"cast(null as {types[m]}) as {m}" for m in _MEASURES])

    out = shaped(grid, True)
    if s is not None:
        out = out.unionByName(shaped(s, False))
    return out.unionByName(shaped(_review_rows(src, score_col, in_frame), False)) if with_reviews else out


def _review_rows(src: SourceSet, score_col: str, in_frame) -> DataFrame:
    """(nodeid, midx) -> review sums; "a_" counts every review, "m_" those whose product exists."""
    p = src.products.select("asin", node_id("nodeid").alias("pnode"), F.lit(True).alias("hit"))
    r = asin_month_reviews(src, score_col).withColumn("midx", month_index("year", "month")).where(in_frame)
    r = r.join(p, "asin", "left").withColumn("nodeid", F.coalesce("pnode", F.lit(0).cast("bigint")))
    sums = (("n", "n_reviews"), ("sum", "sum_overall"), ("cnt", "n_overall"), ("ssum", "sum_sent"),
            ("scnt", "n_sent"))
    return r.groupBy("nodeid", "midx").agg(
        *[F.expr(f"sum({c}) as a_{k}") for k, c in sums],
        *[F.expr(f"sum(case when hit is not null then {c} end) as m_{k}") for k, c in sums])


def _frame_sum(col: str, frame: str) -> str:
    lo, hi = FRAMES[frame]
    bound = lambda k: "current row" if k == 0 else f"{-k} preceding"
    return f"sum({col}) over (partition by nodeid order by midx range between {bound(lo)} and {bound(hi)})"


def _windowed(src: SourceSet, year_from: int, year_to: int, which: tuple[str, ...],
              score_col: str = "sentiment", months: Months = None) -> DataFrame:
    """One window pass: every frame is an expression of the same (nodeid, midx) window.

    ``which``: "sales", "ratings", "sentiment"; ``months`` cuts the baseline to a range of month indexes.
    """
    rows = _measure_rows(src, year_from, year_to, score_col, "sales" in which,
                         "ratings" in which or "sentiment" in which, months)
    cols: dict[str, str] = {}
    if "sales" in which:
        for pre in ("", "pm_", "p3m_", "p12m_"):
            cols[f"{pre}sales"] = money_from_cents_sql(f"coalesce({_frame_sum('price_c', pre)}, 0)")
            cols[f"{pre}vol"] = f"coalesce({_frame_sum('units', pre)}, cast(0 as bigint))"
    if "ratings" in which:
        for pre, tag in (("pm_", "a"), ("p3m_", "m"), ("p12m_", "m")):
            cols[f"{pre}numreviews"] = f"coalesce({_frame_sum(f'{tag}_n', pre)}, cast(0 as bigint))"
            mean = rounded_mean_sql(_frame_sum(f"{tag}_sum", pre), _frame_sum(f"{tag}_cnt", pre), 2)
            cols[f"{pre}avgrating"] = f"coalesce({mean}, cast(0 as double))"
    if "sentiment" in which:
        for pre, tag in (("pm_", "a"), ("p3m_", "m"), ("p12m_", "m")):
            mean = rounded_mean_sql(_frame_sum(f"{tag}_ssum", pre), _frame_sum(f"{tag}_scnt", pre), 2)
            cols[f"{pre}avgsntp"] = f"coalesce({mean}, cast(0 as double))"
    out = rows.selectExpr("nodeid", "midx", "is_base", *[f"{e} as {n}" for n, e in cols.items()])
    return out.where("is_base").selectExpr(
        "nodeid", "cast(floor(midx / 12) as int) as yr", "cast(midx % 12 + 1 as int) as mn", *cols)


def ml_features(src: SourceSet, year_from: int, year_to: int, ordered: bool = False, months: Months = None,
                columns: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """The 17-column feature table of the baseline months.

    ``ordered`` adds the view's final ORDER BY nodeid, yr, mn (F4; PostgreSQL
    puts NULL last); leave it off when the table is written or joined, a
    global sort is a full range shuffle.  ``months`` keeps a range of month
    indexes (year * 12 + month - 1) and reads only those and the 12 before;
    facts that no column of ``columns`` needs are not read.
    """
    reviews = any(c.endswith(("numreviews", "avgrating")) for c in columns)
    sales = any(c.endswith(("sales", "vol")) for c in columns)
    which = (("sales",) if sales else ()) + (("ratings",) if reviews else ())
    out = _windowed(src, year_from, year_to, which, months=months).select(*columns)
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in ("nodeid", "yr", "mn")]) if ordered else out


def mlview(src: SourceSet, year_from: int, year_to: int, score_col: str = "sentiment", months: Months = None
           ) -> DataFrame:
    """Previous-month / 3-month / 12-month mean review sentiment per node and month.

    The reference only lists the columns; the recipe is that of the ratings
    (mean over reviews, rounded to 2 places, 0 when there is none).
    """
    return _windowed(src, year_from, year_to, ("sentiment",), score_col, months).select(*SENTIMENT_COLUMNS)


def ml_features_all(src: SourceSet, year_from: int, year_to: int, months: Months = None) -> DataFrame:
    """Both sources of the ``mlfeatures`` relation from one window pass (20 columns)."""
    both = _windowed(src, year_from, year_to, ("sales", "ratings", "sentiment"), months=months)
    return both.select(*FEATURE_COLUMNS, *SENTIMENT_COLUMNS[3:])
