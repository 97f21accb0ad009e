"""Plan-shape guards: what the queries must never do at scale."""

import re

import pytest

import __spark_entry__ as E
from conftest import SMOKE

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
HEADLINE = ("sales", "salesaggregate", "sales_agg_mn", "ml_features", "mlfeatures", "mlfeatures_no_sentiment",
            "category_nodes", "reviews_tfidf", "fk_orphans", "top3_xmas_categories", "high_demand_products",
            "multi_atom_join", "histogram", "sample_stratified")


def _plan(spark, name):
    return E.queries()[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEADLINE)
def test_no_cross_product_no_python(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # plans as on large inputs
    try:
        plan = _plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [f for f in FORBIDDEN if f in plan]


def test_features_single_window_pass(spark):
    plan = _plan(spark, "mlfeatures")
    assert plan.count("Window [") == 1
    assert plan.count("FileScan parquet") <= 6


def test_calendar_join_is_a_pushed_filter(spark):
    plan = _plan(spark, "salesaggregate")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "calendar" not in plan.lower().replace("calendarspan", "")


def test_aggregate_before_product_shuffle(spark):
    """Lines are partially aggregated to (product, year, month) before any exchange by product."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = E.queries()["salesaggregate"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_product = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(productid" in x and "month" in x]
    assert by_product
    # the operator that feeds the exchange is the partial sum over the joined lines
    assert all("partial_sum" in lines[i + 1] and "productid" in lines[i + 1] for i in by_product)
    # and no exchange by product moves single lines
    assert not [x for x in lines if "Exchange hashpartitioning(productid" in x and "numunits" in x]


def test_tfidf_moves_terms_not_texts(spark):
    """No exchange of a text, no file written, and both uses of the terms read one exchange."""
    for name in ("reviews_tfidf", "tfidf_vocabulary"):
        df = E.queries()[name](spark, SMOKE)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        at = [i for i, x in enumerate(lines) if "Exchange" in x]
        assert at and not [i for i in at if "text#" in lines[i] or ("text#" in lines[i + 1] and "FileScan" not in lines[i + 1])]
        assert [i for i in at if "REPARTITION_BY_COL" in lines[i]]
    df = E.queries()["reviews_tfidf"](spark, SMOKE)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReusedExchange \[.*REPARTITION_BY_COL", plan)   # vocabulary and weights share the terms


def test_feature_conditions_reach_the_scans(spark):
    """One month asked for: orders are read for that month and the 12 before."""
    plan = _plan(spark, "dec_features")
    first, after = (re.search(rf"o_orderdate#\d+ {op} (\d{{4}})-(\d\d)", plan) for op in (">=", "<"))
    months = [int(m[1]) * 12 + int(m[2]) for m in (first, after) if m]
    assert months[0] % 12 == 0 and (len(months) == 1 or months[1] - months[0] == 13)   # a December; the end may be cut off


def test_unused_review_branch_is_left_out(spark):
    assert "events.parquet" not in _plan(spark, "range_join_rolling")


@pytest.mark.parametrize("name", ["category_peak_month", "high_demand_products"])
def test_rank_winners_read_the_star_once(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[name](spark, SMOKE)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("FileScan" in x and "l_orderkey" in x for x in final.splitlines()) == 1
