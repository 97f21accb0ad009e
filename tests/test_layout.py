"""Bucketed store tables: the orders/lines join needs no shuffle."""

import uuid

from conftest import SMOKE
from shelfcast.functions.columns import decimals_to_double
from shelfcast.operators import views
from shelfcast.session import fresh_path
from shelfcast.sources.layout import write_bucketed
from shelfcast.sources.tables import SourceSet


def test_bucketed_star_join_has_no_shuffle_below_the_join(spark):
    db = f"shelf_{uuid.uuid4().hex[:8]}"
    src = SourceSet.load(spark, SMOKE)
    write_bucketed(spark, src, db, buckets=8, location=fresh_path(spark, "warehouse"))
    cat = SourceSet.from_catalog(spark, db, span=SourceSet.load(spark, SMOKE).span)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = views.product_month_facts(cat)
        plan = facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join_part = plan[plan.index("SortMergeJoin"):]
    # no exchange between the join and the two bucketed scans
    assert "Exchange" not in join_part
    a, b = decimals_to_double(facts), decimals_to_double(views.product_month_facts(src))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
