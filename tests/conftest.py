import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from shelfcast.sources.calendar import CalendarSpan  # noqa: E402
from shelfcast.sources.tables import SourceSet  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


D = T.DecimalType(12, 2)
SCHEMAS = {
    "orders": "orderid bigint, orderdate date, customerid bigint, city string, state string, zipcode string, "
              "campaignid int",
    "orderlines": "orderid bigint, productid bigint, unitprice decimal(12,2), numunits int, totalprice decimal(12,2)",
    "products": "productid bigint, asin string, nodeid string, isinstock string, fullprice decimal(12,2)",
    "customers": "customerid bigint, householdid int, gender string, firstname string",
    "campaigns": "campaignid int, channel string, discount int, freeshppingflag string",
    "reviews": "reviewid bigint, asin string, overall int, reviewtime date, sentiment decimal(5,2)",
}


def mini(spark, span=(dt.date(2000, 1, 1), dt.date(2001, 12, 31)), classification=None, **rows) -> SourceSet:
    """A hand-made SourceSet: keyword = table name, value = list of tuples."""
    frames = {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()}
    return SourceSet(spark=spark, span=CalendarSpan(*span), classification=classification, **frames)


@pytest.fixture(scope="session")
def smoke_src(spark):
    return SourceSet.load(spark, SMOKE)
