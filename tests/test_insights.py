"""Hand-computed cases for the jobs whose meaning is ours (tier 3)."""

import datetime as dt
import math
from decimal import Decimal as Dec

from conftest import mini
from shelfcast.operators import insights
from shelfcast.sources.classification import nest_levels


def test_tfidf_values(spark):
    docs = spark.createDataFrame([(1, "Apple apple, banana!"), (2, "banana cherry"), (3, "")],
                                 "id long, text string")
    vocab, wide = insights.tfidf(docs, "id", "text", top_n=3)
    words = [r.word for r in vocab.orderBy("termid").collect()]
    assert words == ["banana", "apple", "cherry"]           # df 2, then ties by word
    w = {r.id: (r.term0, r.term1, r.term2) for r in wide.collect()}
    n = 3
    assert w[1][0] == round(1 / 3 * math.log(n / 2), 6)    # banana: 1 of 3 tokens, df 2
    assert w[1][1] == round(2 / 3 * math.log(n / 1), 6)    # apple: 2 of 3 tokens, df 1
    assert w[2] == (round(1 / 2 * math.log(n / 2), 6), 0.0, round(1 / 2 * math.log(n / 1), 6))
    assert 3 not in w                                       # no tokens: no weight row


def _doc(spark, node_names):
    flat = spark.createDataFrame([(n, c, "Books", c, None, None, None, None) for n, c in node_names],
                                 "nodeid long, classification string, level0 string, level1 string, "
                                 "level2 string, level3 string, level4 string, level5 string")
    return nest_levels(flat)


def _src(spark, lines_by_month):
    """One product of node 1 ('Kids'); ``lines_by_month``: [(date, units)]."""
    orders = [(i, d, 1, "c", "s", "00001", 1) for i, (d, _) in enumerate(lines_by_month)]
    lines = [(i, 1, Dec("1.00"), u, Dec(u)) for i, (_, u) in enumerate(lines_by_month)]
    return mini(spark, products=[(1, "B1", "1", "Y", Dec("10.00"))], orders=orders, orderlines=lines,
                classification=_doc(spark, [(1, "Kids")]))


def test_winter_spans_the_year_boundary(spark):
    src = _src(spark, [(dt.date(2000, 12, 5), 10), (dt.date(2001, 1, 5), 5), (dt.date(2001, 4, 5), 3),
                       (dt.date(2001, 12, 5), 1), (dt.date(2002, 3, 5), 4)])
    got = {(r.classification, r.yr): (r.winter_vol, r.spring_vol) for r in insights.falling_demand(src).collect()}
    # winter 2001 = Dec 2000 + Jan 2001 = 15 > spring 2001 = 3; winter 2002 = 1 < spring 2002 = 4 (not falling)
    assert got == {("Kids", 2001): (15, 3)}


def test_high_demand_window_edges(spark):
    src = _src(spark, [(dt.date(2000, 1, 31), 7), (dt.date(1999, 12, 31), 100), (dt.date(2000, 12, 1), 2),
                       (dt.date(2001, 1, 1), 50)])
    rows = insights.high_demand_products(src, 2001, 1, k=5).collect()
    # last 12 months before Jan 2001 = Jan 2000 .. Dec 2000: 7 + 2 (Dec 1999 and Jan 2001 excluded)
    assert [(r.productid, r.vol, r.rank_vol) for r in rows] == [(1, 9, 1)]
