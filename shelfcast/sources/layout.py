"""Physical layout for the star join: bucketed catalog tables.

Orders and order lines bucketed (and sorted) by ``orderid`` with the same
bucket count make ``orderlines JOIN orders`` a sort-merge join with no
shuffle on either side; products bucketed by ``productid`` do the same for
the product lookup of the pre-aggregated facts.  The tables are written once
per data refresh with ``saveAsTable`` into a database whose location is on
shared storage.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# table -> bucketing column
BUCKET_KEYS = {"orders": "orderid", "orderlines": "orderid", "products": "productid"}
PLAIN = ("customers", "campaigns", "reviews")


def write_bucketed(spark: SparkSession, src, database: str, buckets: int, location: str | None = None) -> None:
    """Write the store tables of ``src`` into ``database`` (bucketed where it pays)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    for name, key in BUCKET_KEYS.items():
        (getattr(src, name).write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
         .saveAsTable(f"{database}.{name}"))
    for name in PLAIN:
        getattr(src, name).write.mode("errorifexists").saveAsTable(f"{database}.{name}")
    if src.review_text is not None:
        src.review_text.write.mode("errorifexists").saveAsTable(f"{database}.reviewtext")
