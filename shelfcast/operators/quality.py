"""Referential checks of the store tables and the unknown-customer member."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import SourceSet

UNKNOWN_CUSTOMER = (0, 0, "NOT DEFINED", "NOT DEFINED")   # fixed values of the reference insert


def _orphans(name: str, child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose non-NULL ``key`` has no ``parent`` row.

    Child keys are counted per key value first, so a key holding a third of
    all rows becomes one row before the anti join shuffle.
    """
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = per_key.join(parent.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows")) \
                  .select(F.lit(name).alias("relation"), "orphan_rows")


def fk_orphans(src: SourceSet) -> DataFrame:
    """C11: orphan counts for the four foreign keys of the store schema."""
    checks = [
        _orphans("orders.campaignid", src.orders, src.campaigns, "campaignid"),
        _orphans("orders.customerid", src.orders, src.customers, "customerid"),
        _orphans("orderlines.orderid", src.orderlines, src.orders, "orderid"),
        _orphans("orderlines.productid", src.orderlines, src.products, "productid"),
    ]
    return reduce(DataFrame.unionByName, checks)


def with_unknown_member(customers: DataFrame) -> DataFrame:
    """Customers plus the (0, 0, 'NOT DEFINED', 'NOT DEFINED') row unless id 0 exists."""
    spark = customers.sparkSession
    types = {f.name: f.dataType for f in customers.schema.fields}
    names = ("customerid", "householdid", "gender", "firstname")
    one = spark.range(1).select(*[F.lit(v).cast(types[n]).alias(n) for n, v in zip(names, UNKNOWN_CUSTOMER)])
    one = one.join(customers.select("customerid").where(F.col("customerid") == 0), "customerid", "left_anti")
    return customers.select(*names).unionByName(one)
