"""Hand-made cases for the semantic traps (T1-T12) and the mediated API checks."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import mini
from shelfcast.operators import features, hierarchy, quality, views
from shelfcast.operators.features import FEATURE_COLUMNS
from shelfcast.operators.relational import dense_rank_top, order_by_op, top_n_op
from shelfcast.plans.mediated import RELATIONS, Mediator, used_sources
from shelfcast.sources.classification import nest_levels

P = lambda pid, node: (pid, f"B{pid}", node, "Y", Dec("10.00"))


def order(oid, day):
    return (oid, day, 1, "c", "s", "00001", 1)


def line(oid, pid, units, price):
    return (oid, pid, Dec("1.00"), units, None if price is None else Dec(price))


def review(rid, asin, overall, day, sent="0.00"):
    return (rid, asin, overall, day, Dec(sent))


# --------------------------------------------------------------------------- T1
def test_t1_null_measure_ranks_first(spark):
    src = mini(spark, products=[P(1, "1"), P(2, "2"), P(3, "3")],
               orders=[order(100, dt.date(2000, 12, 5))],
               orderlines=[line(100, 1, 1, None), line(100, 2, 1, "7.00"), line(100, 3, 1, "5.00")])
    got = {r.nodeid: r.rank_sales for r in views.sales_agg_mn(src).collect()}
    assert got == {1: 1, 2: 2, 3: 3}


# --------------------------------------------------------------------------- T3
def test_t3_history_before_first_baseline_month(spark):
    src = mini(spark, products=[P(1, "1")], orders=[order(100, dt.date(2000, 12, 15))],
               orderlines=[line(100, 1, 4, "40.00")])
    f = features.ml_features(src, 2001, 2001).where("yr = 2001 and mn = 1").collect()[0]
    assert (f.sales, f.pm_sales, f.p3m_sales, f.p12m_sales) == (0, Dec("40.00"), Dec("40.00"), Dec("40.00"))
    assert (f.vol, f.pm_vol, f.p3m_vol, f.p12m_vol) == (0, 4, 4, 4)
    # and the 2000 months are not part of the result
    assert features.ml_features(src, 2001, 2001).where("yr = 2000").count() == 0


# --------------------------------------------------------------------------- T5
def test_t5_rating_averages_reviews_not_months(spark):
    src = mini(spark, products=[P(1, "1")],
               reviews=[review(1, "B1", 5, dt.date(2001, 1, 10))]
               + [review(i, "B1", 1, dt.date(2001, 2, 10)) for i in (2, 3, 4)])
    f = features.ml_features(src, 2001, 2001).where("mn = 4").collect()[0]
    assert f.p3m_avgrating == 2.0 and f.p3m_numreviews == 4


# --------------------------------------------------------------------------- T8
def test_t8_only_keys_keeps_first_source(spark):
    rel = RELATIONS["mlfeatures"]
    cols = ["nodeid", "yr", "mn"] + ["_"] * 17
    binding = {a: v for a, v in zip(rel.attrs, cols) if v != "_"}
    kept = used_sources(rel, binding)
    assert [s.table for s in kept] == ["mv_ml_features"]


def test_source_skip_keeps_both_when_sentiment_used():
    rel = RELATIONS["mlfeatures"]
    binding = {"nodeid": "n", "yr": "y", "mn": "m", "sales": "s", "pm_avgsntp": "p"}
    assert [s.table for s in used_sources(rel, binding)] == ["mv_ml_features", "mlview"]
    binding = {"nodeid": "n", "yr": "y", "mn": "m", "pm_avgsntp": "p"}
    assert [s.table for s in used_sources(rel, binding)] == ["mlview"]


def test_t8_rows_returned(smoke_src):
    m = Mediator(smoke_src, year_from=1996, year_to=2001)
    df = m.query("mlfeatures", ["nodeid", "yr", "mn"] + ["_"] * 17)
    assert df.columns == ["nodeid", "yr", "mn"] and df.count() > 0


def test_fused_source_equals_join(smoke_src):
    m = Mediator(smoke_src, year_from=1996, year_to=2001)
    cols = list(RELATIONS["mlfeatures"].attrs)
    fused = m.relation("mlfeatures", cols)
    joined = features.ml_features(smoke_src, 1996, 2001).join(features.mlview(smoke_src, 1996, 2001),
                                                               ["nodeid", "yr", "mn"]).select(*cols)
    assert fused.exceptAll(joined).count() == 0 and joined.exceptAll(fused).count() == 0


# --------------------------------------------------------------------------- T9
def test_t9_orphan_reviews_only_in_previous_month(spark):
    src = mini(spark, products=[P(1, "0")],
               reviews=[review(1, "X9", 4, dt.date(2001, 2, 3)), review(2, "B1", 2, dt.date(2001, 2, 4))])
    f = features.ml_features(src, 2001, 2001).where("mn = 3").collect()[0]
    assert f.nodeid == 0
    assert f.pm_numreviews == 2 and f.pm_avgrating == 3.0
    assert f.p3m_numreviews == 1 and f.p3m_avgrating == 2.0


def test_null_node_gets_zero_row(spark):
    src = mini(spark, products=[P(1, None)], orders=[order(100, dt.date(2001, 1, 5))],
               orderlines=[line(100, 1, 3, "9.00")])
    rows = features.ml_features(src, 2001, 2001).where("mn = 2").collect()
    assert len(rows) == 1 and rows[0].nodeid is None and rows[0].pm_sales == 0


def test_frames_cross_year_boundary(spark):
    src = mini(spark, products=[P(1, "1")],
               orders=[order(i, dt.date(2000, m, 1)) for i, m in ((1, 10), (2, 11), (3, 12))],
               orderlines=[line(1, 1, 1, "1.00"), line(2, 1, 2, "2.00"), line(3, 1, 4, "4.00")])
    f = features.ml_features(src, 2001, 2001).where("mn = 1").collect()[0]
    assert f.pm_vol == 4 and f.p3m_vol == 7 and f.p12m_vol == 7
    f2 = features.ml_features(src, 2001, 2001).where("mn = 2").collect()[0]
    assert f2.pm_vol == 0 and f2.p3m_vol == 6


# --------------------------------------------------------------------------- T11
def test_t11_na_and_missing(spark):
    flat = spark.createDataFrame([(1, "c", "A", "N/A", None, None, None, None)],
                                 "nodeid long, classification string, level0 string, level1 string, "
                                 "level2 string, level3 string, level4 string, level5 string")
    doc = nest_levels(flat)
    assert [(r.category, r.nodeid) for r in hierarchy.category_nodes(doc).collect()] == [("A", 1)]
    assert {r.category for r in hierarchy.categories_all(doc).collect()} == {"A", "N/A", None}
    lists = {r.category: list(r.nodeids) for r in hierarchy.category_node_lists(doc).collect()}
    assert lists == {"A": [1], "N/A": [1], None: [1, 1, 1, 1]}
    assert hierarchy.find_category(doc, "N/A").count() == 1


# --------------------------------------------------------------------------- T12 / J8
@pytest.mark.parametrize("extra", [-1, 1])
@pytest.mark.parametrize("name", sorted(RELATIONS))
def test_every_relation_checks_its_arity(smoke_src, name, extra):
    cols = [f"v{i}" for i in range(len(RELATIONS[name].attrs) + extra)]
    with pytest.raises(ValueError, match=f"{name} takes {len(cols) - extra} attributes, {len(cols)} given"):
        Mediator(smoke_src).query(name, cols)


def test_t12_aggregate_arity_is_checked(smoke_src):
    with pytest.raises(ValueError, match="reviews_agg_yrmn takes 5 attributes, 2 given"):
        Mediator(smoke_src).query("reviews_agg_yrmn", ["node", "year"], group_by=(["node"], "years", "count", "year"))


def test_head_attribute_not_in_body(smoke_src):
    with pytest.raises(ValueError, match="head attribute season is not bound by the relation"):
        Mediator(smoke_src).query("reviews_agg_yrmn", ["node", "_", "month", "_", "rating"], head=["node", "season"])


def test_condition_attribute_not_in_body(smoke_src):
    with pytest.raises(ValueError, match="condition attribute year is not bound by the relation"):
        Mediator(smoke_src).query("reviews_agg_yrmn", ["node", "_", "month", "_", "rating"], where=[("year", "=", 1999)])


def test_condition_on_alias_filters_after_grouping(smoke_src):
    m = Mediator(smoke_src)
    cols = ["n", "y", "m", "s", "_", "_"]
    all_ = m.query("sales_agg_yrmn", cols, group_by=(["n"], "tot", "sum", "s"))
    big = m.query("sales_agg_yrmn", cols, group_by=(["n"], "tot", "sum", "s"), where=[("tot", ">", 10 ** 9)])
    assert all_.count() > 0 and big.count() == 0


def test_repeated_variable_is_equality(spark):
    from shelfcast.operators.relational import bind
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, z string")
    assert [r.z for r in bind(df, ["v", "v", "z"]).collect()] == ["a"]


def test_cross_product_refused(spark):
    from shelfcast.operators.relational import join_atoms
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "y int")
    with pytest.raises(ValueError, match="share no variable"):
        join_atoms((a, ["p"]), (b, ["q"]))


# --------------------------------------------------------------------------- order / top / rank
def test_order_by_nulls_like_postgres(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, v int")
    assert [r.k for r in order_by_op(df, [("v", "d")]).collect()] == [2, 3, 1]
    assert [r.k for r in order_by_op(df, [("v", "a")]).collect()] == [1, 3, 2]


def test_top_n_breaks_ties_deterministically(spark):
    df = spark.createDataFrame([(3, 10), (1, 10), (2, 10), (4, 1)], "k int, v int")
    assert [r.k for r in top_n_op(df, 2, [("v", "d")]).collect()] == [1, 2]


def test_dense_rank_top_matches_window(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None] + list(range(8)))) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, v int")
    for desc in (True, False):
        order = F.col("v").desc_nulls_first() if desc else F.col("v").asc_nulls_last()
        ref = df.withColumn("r", F.dense_rank().over(Window.orderBy(order))).where("r <= 3")
        got = dense_rank_top(df, "v", 3, descending=desc, rank_name="r")
        assert sorted(map(tuple, ref.collect()), key=str) == sorted(map(tuple, got.select("k", "v", "r").collect()),
                                                                      key=str)


# --------------------------------------------------------------------------- quality
def test_unknown_member_added_once(spark):
    c = spark.createDataFrame([(5, 1, "F", "Ann")], "customerid bigint, householdid int, gender string, firstname string")
    once = quality.with_unknown_member(c)
    assert sorted(r.customerid for r in once.collect()) == [0, 5]
    assert quality.with_unknown_member(once).count() == 2


def test_fk_orphans_counts_rows(spark):
    src = mini(spark, products=[P(1, "1")], orders=[order(100, dt.date(2001, 1, 1))],
               orderlines=[line(100, 1, 1, "1.00"), line(100, 9, 1, "1.00"), line(200, 1, 1, "1.00")],
               customers=[(1, 1, "F", "A")], campaigns=[])
    got = {r.relation: r.orphan_rows for r in quality.fk_orphans(src).collect()}
    assert got == {"orders.campaignid": 1, "orders.customerid": 0, "orderlines.orderid": 1,
                   "orderlines.productid": 1}


# --------------------------------------------------------------------------- demo cases (validation, pruning)
FEAT17 = ["nodeId", *FEATURE_COLUMNS[1:]]


def test_body_variable_outside_head_keeps_its_source(smoke_src):
    rel = RELATIONS["mlfeatures"]
    cols = FEAT17 + ["_", "_", "SENTIMENT_ATTRIBUTE"]
    binding = {a: v for a, v in zip(rel.attrs, cols) if v != "_"}
    assert [s.table for s in used_sources(rel, binding)] == ["mv_ml_features", "mlview"]
    df = Mediator(smoke_src).query("mlfeatures", cols, head=FEAT17)
    assert df.columns == FEAT17 and df.count() > 0


def test_without_sentiment_only_first_source(smoke_src):
    rel = RELATIONS["mlfeatures"]
    binding = {a: v for a, v in zip(rel.attrs, FEAT17 + ["_", "_", "_"]) if v != "_"}
    assert [s.table for s in used_sources(rel, binding)] == ["mv_ml_features"]


def test_valid_demo_query_runs(smoke_src):
    df = Mediator(smoke_src).query("sales_agg_mn", ["nodeid", "mn", "sales", "vol", "_", "_", "rank_vol"],
                                   head=["nodeid", "sales", "vol"],
                                   where=[("mn", "=", 12), ("rank_vol", "<=", 3)])
    assert 3 <= df.count() and df.columns == ["nodeid", "sales", "vol"]


def test_materialized_sources_answer_like_lazy_ones(smoke_src):
    from shelfcast.plans.mediated import materialize_sources
    tables = materialize_sources(smoke_src, 1996, 2001)
    lazy, stored = Mediator(smoke_src), Mediator(smoke_src, tables=tables)
    for rel, cols, kw in (
        ("sales_agg_mn", ["nodeid", "mn", "sales", "_", "_", "rank_sales", "_"],
         dict(head=["nodeid", "sales"], where=[("mn", "=", 12), ("rank_sales", "<=", 3)])),
        ("mlfeatures", list(RELATIONS["mlfeatures"].attrs), dict(where=[("yr", "=", 2000)])),
        ("classification", list(RELATIONS["classification"].attrs), {}),
    ):
        a, b = lazy.query(rel, cols, **kw), stored.query(rel, cols, **kw)
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _with_unknown_nodes(src):
    """The same tables, a part of the products without node."""
    from shelfcast.sources.tables import SourceSet
    blank = F.when(F.col("productid") % 97 != 0, F.col("nodeid")).alias("nodeid")
    products = src.products.select(*[blank if c == "nodeid" else c for c in src.products.columns])
    return SourceSet(src.spark, orders=src.orders, orderlines=src.orderlines, products=products,
                     customers=src.customers, campaigns=src.campaigns, reviews=src.reviews, span=src.span,
                     classification=src.classification)


def test_f4_final_orders(smoke_src):
    smoke_src = _with_unknown_nodes(smoke_src)
    rows = [(r.nodeid, r.yr, r.mn) for r in features.ml_features(smoke_src, 1996, 2001, ordered=True).collect()]
    assert rows[-1][0] is None and rows[:-72] == sorted(rows[:-72])     # NULL node last, as in PostgreSQL
    cats = [r.category for r in hierarchy.categories_all(smoke_src.classification, ordered=True).collect()]
    assert cats[0] is None and cats[1:] == sorted(cats[1:])              # missing first, as in SQL++
    nodes = [r.nodeid for r in hierarchy.flatten_categories(smoke_src.classification, ordered=True).collect()]
    assert nodes == sorted(nodes)


def test_find_category_as_sql_table_function(spark, smoke_src):
    hierarchy.register_find_category(spark, smoke_src.classification, view="t_cls", function="t_find_category")
    for name in ("SMALL", "Books", "N/A", "no such category"):
        sql = {r.nodeid for r in spark.sql(f"select * from t_find_category('{name}')").collect()}
        api = {r.nodeid for r in hierarchy.find_category(smoke_src.classification, name).collect()}
        assert sql == api


def test_head_outside_group_by_output_is_an_error(smoke_src):
    cols = ["n", "y", "m", "s"] + ["_"] * 16
    with pytest.raises(ValueError, match="head attribute y is neither"):
        Mediator(smoke_src).query("mlfeatures", cols, head=["n", "y", "agg"],
                                  group_by=(["n"], "agg", "sum", "s"))


# --------------------------------------------------------------------------- conditions, own sources, money
def test_column_conditions_filter_like_tuples(smoke_src):
    m = Mediator(smoke_src)
    cols = ["nodeid", "mn", "sales", "_", "_", "rank_sales", "_"]
    by_tuple = m.query("sales_agg_mn", cols, where=[("mn", "=", 12)])
    by_column = m.query("sales_agg_mn", cols, where=[F.col("mn") == 12])
    assert 0 < by_tuple.count() == by_column.count() and by_tuple.exceptAll(by_column).count() == 0
    total = m.query("sales_agg_mn", cols, group_by=(["mn"], "total", "sum", "sales"))
    level = total.agg(F.avg("total")).first()[0]
    kept = m.query("sales_agg_mn", cols, group_by=(["mn"], "total", "sum", "sales"), where=[F.col("total") > level])
    assert 0 < kept.count() < total.count()
    with pytest.raises(ValueError):
        m.query("sales_agg_mn", cols, where=[F.col("nowhere") == 1])


@pytest.mark.parametrize("key,column", [("S2.mlview", "pm_avgsntp"), ("S1.mv_ml_features", "sales")])
def test_own_source_is_used(smoke_src, key, column):
    from shelfcast.plans.mediated import default_tables
    own = default_tables(smoke_src, 1996, 2001)[key]().withColumn(column, F.lit(99))
    m = Mediator(smoke_src, tables={key: lambda: own}, year_from=1996, year_to=2001)
    rows = m.relation("mlfeatures", list(RELATIONS["mlfeatures"].attrs)).select(column).distinct().collect()
    assert [r[0] for r in rows] == [99]


def test_money_as_double_keeps_its_cents(spark):
    from shelfcast.functions.columns import cents
    df = spark.createDataFrame([(1.15,), (19.99,), (None,)], "x double")
    assert [r[0] for r in df.select(cents("x")).collect()] == [115, 1999, None]


def test_store_tables_are_checked(spark):
    from shelfcast.sources.tables import checked
    lines = spark.createDataFrame([(1, 2, 1.15, 3, 3.45)], "orderid int, productid bigint, unitprice double, numunits int, "
                                                          "totalprice double")
    row = checked(lines, "orderlines").first()
    assert (row["orderid"], str(row["unitprice"]), str(row["totalprice"])) == (1, "1.15", "3.45")
    with pytest.raises(ValueError, match="numunits"):
        checked(lines.drop("numunits"), "orderlines")
    with pytest.raises(ValueError, match="unitprice"):
        checked(lines.withColumn("unitprice", F.col("unitprice").cast("decimal(14,4)")), "orderlines")


def test_calendar_covers_all_orders(smoke_src):
    first, last = smoke_src.orders.agg(F.min("orderdate"), F.max("orderdate")).first()
    assert smoke_src.span.start < first and smoke_src.span.end >= last
    assert smoke_src.years() == (first.year - 1, last.year)
