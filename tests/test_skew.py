"""A product holding two thirds of all order lines: AQE splits the hot join
partitions, results stay whole, aggregates equal a brute-force count."""

import datetime as dt
from decimal import Decimal as Dec

from conftest import mini
from shelfcast.operators import views

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_product_is_split_and_results_stay_whole(spark):
    n = 30000
    products = [(p, f"B{p}", str(p % 5), "Y", Dec("10.00")) for p in range(1, 101)]
    orders = [(o, dt.date(2000, 1 + o % 12, 1 + o % 28), o % 50, "c", "s", "00001", 1 + o % 5)
              for o in range(n // 3)]
    lines = [(i % (n // 3), 1 if i % 3 else 2 + i % 99, Dec("1.00"), 1, Dec("2.50")) for i in range(n)]
    src = mini(spark, products=products, orders=orders, orderlines=lines,
               customers=[(c, 1, "F", "x") for c in range(50)], campaigns=[(k, "ch", 5, "N") for k in range(1, 6)])
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = views.sales(src)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        agg = {(r.nodeid, r.month): r.total_sales_volume for r in views.salesaggregate(src).collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == n
    assert "SortMergeJoin(skew=true) [productid" in plan
    # brute force: units of the hot product's node (1 % 5 = 1) per month
    want = {}
    for i in range(n):
        pid = 1 if i % 3 else 2 + i % 99
        o = i % (n // 3)
        key = (pid % 5, 1 + o % 12)
        want[key] = want.get(key, 0) + 1
    assert agg == want
