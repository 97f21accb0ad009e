"""Relational sources: the seven store tables, reviews text and categories.

``SourceSet`` holds lazy DataFrames with the column names and types the
views expect.  Two loaders exist:

* ``SourceSet.from_tables`` reads parquet tables that already have the store
  schema (``orders.parquet``, ``orderlines.parquet`` ...).
* ``SourceSet.load`` binds the driver's TPC-H-like test tables to that schema
  (the bindings are the ones written down in FIXTURES.md, except that the
  stand-in address columns of orders come from ``orders`` itself, so the
  orders source is a plain projection with no join).

Every table is a projection of a parquet scan, so column pruning and filters
reach the scan.  No table runs a job.  One thing does: the calendar of ``load``
covers the years of the orders, whose first and last date are read from the one
date column of a folder when a query first needs them, once per folder and application.
Give a span to ``from_tables`` (or a calendar table) and nothing is read.
"""

from __future__ import annotations

import copy
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MONEY
from .calendar import CalendarSpan, calendar, enrich_calendar
from .classification import nest_levels, read_classification

# stand-in day of the first review: the test events carry no dates within the orders' years
REVIEW_EPOCH = dt.date(1995, 1, 1)


_DATES: dict[tuple[str, str], tuple] = {}


def order_dates(orders: DataFrame, folder: str, again: bool = False) -> tuple[dt.date | None, dt.date | None]:
    """First and last order date of a folder; ``again`` reads them anew after the folder has changed."""
    key = (orders.sparkSession.sparkContext.applicationId, folder)
    if again or key not in _DATES:
        _DATES[key] = tuple(orders.agg(F.min("orderdate"), F.max("orderdate")).first())
    return _DATES[key]


def order_span(first: dt.date | None, last: dt.date | None) -> CalendarSpan:
    """Whole years that hold all order dates, and the year before for the first months' history (trap T3)."""
    first, last = first or dt.date(1970, 1, 1), last or dt.date(1970, 1, 1)
    return CalendarSpan(dt.date(first.year - 1, 1, 1), dt.date(last.year, 12, 31))


# Column types of the store tables.  Money may come as decimal with at most
# two places, as an integer or as double; it is cast to decimal(12,2) on reading.
STORE_SCHEMAS = {
    "orders": "orderid bigint, orderdate date, customerid bigint, city string, state string, zipcode string, "
              "campaignid int",
    "orderlines": "orderid bigint, productid bigint, unitprice decimal(12,2), numunits int, totalprice decimal(12,2)",
    "products": "productid bigint, asin string, nodeid string, isinstock string, fullprice decimal(12,2)",
    "customers": "customerid bigint, householdid int, gender string, firstname string",
    "campaigns": "campaignid int, channel string, discount int, freeshppingflag string",
    "reviews": "reviewid bigint, asin string, overall int, reviewtime date, sentiment decimal(5,2)",
}


def checked(df: DataFrame, name: str) -> DataFrame:
    """Columns of a store table with its types; a missing column or a type that would lose digits is an error."""
    found = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for field in T.StructType.fromDDL(STORE_SCHEMAS[name]).fields:
        if field.name not in found:
            raise ValueError(f"table {name} has no column {field.name}")
        have, want = found[field.name].dataType, field.dataType
        exact = have == want
        if isinstance(want, T.DecimalType):
            exact = exact or isinstance(have, (T.DoubleType, T.FloatType, T.IntegralType)) \
                or (isinstance(have, T.DecimalType) and have.scale <= want.scale)
        elif isinstance(want, T.LongType):
            exact = isinstance(have, T.IntegralType)
        elif isinstance(want, T.IntegerType):
            exact = isinstance(have, (T.IntegerType, T.ShortType, T.ByteType))
        if not exact:
            raise ValueError(f"column {field.name} of table {name} is {have.simpleString()}, not {want.simpleString()}")
        out.append(F.col(field.name).cast(want).alias(field.name))
    return df.select(*out)


def _cents(whole):
    """Integer number of cents -> exact decimal amount."""
    return whole.cast("bigint").cast("decimal(20,0)") / F.lit(100)


# Declared input schemas of the test tables (only the columns the bindings
# read).  Reading with a declared schema skips the footer-reading job of
# schema inference, and a file whose types differ fails at the scan.
TEST_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double",
    "events": "event_id bigint, user_id bigint, props string",
    "documents": "doc_id bigint, text string",
}


def _read(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LAZY = ("orders", "orderlines", "products", "customers", "campaigns", "reviews",
         "calendar_table", "classification", "review_text")


class SourceSet:
    """The store tables as lazy DataFrames.

    Each table is given as a DataFrame or as a zero-argument callable that
    builds one; callables run on first use, so a query opens (and lists the
    files of) only the tables it reads.

    orders: orderid, orderdate, customerid, city, state, zipcode, campaignid
    orderlines: orderid, productid, unitprice, numunits, totalprice
    products: productid, asin, nodeid (text), isinstock, fullprice
    customers: customerid, householdid, gender, firstname
    campaigns: campaignid, channel, discount, freeshppingflag
    reviews: reviewid, asin, overall, reviewtime, sentiment
    classification: nested category documents; review_text: reviewid, text
    """

    def __init__(self, spark: SparkSession, orders=None, orderlines=None, products=None, customers=None,
                 campaigns=None, reviews=None, span: CalendarSpan | None = None, calendar_table=None,
                 classification=None, review_text=None, root: str | None = None):
        self.spark = spark
        self._span = span
        self.root = root
        self._given = dict(orders=orders, orderlines=orderlines, products=products, customers=customers,
                           campaigns=campaigns, reviews=reviews, calendar_table=calendar_table,
                           classification=classification, review_text=review_text)
        self._built: dict = {}
        self._cal = None

    def _get(self, name: str):
        if name not in self._built:
            v = self._given.get(name)
            self._built[name] = v if (v is None or isinstance(v, DataFrame)) else v()
        return self._built[name]

    orders = property(lambda self: self._get("orders"))
    orderlines = property(lambda self: self._get("orderlines"))
    products = property(lambda self: self._get("products"))
    customers = property(lambda self: self._get("customers"))
    campaigns = property(lambda self: self._get("campaigns"))
    reviews = property(lambda self: self._get("reviews"))
    calendar_table = property(lambda self: self._get("calendar_table"))
    classification = property(lambda self: self._get("classification"))
    review_text = property(lambda self: self._get("review_text"))

    @property
    def span(self) -> CalendarSpan | None:
        """Days of the calendar: a given span, or a callable's (asked once)."""
        if callable(self._span):
            self._span = self._span()
        return self._span

    def within(self, start: dt.date, end: dt.date) -> "SourceSet":
        """The same tables with the calendar span cut to the days ``start`` .. ``end``."""
        other = copy.copy(self)
        other._span = CalendarSpan(max(self.span.start, start), min(self.span.end, end))
        other._cal = None
        return other

    def years(self) -> tuple[int, int]:
        """First and last year of the calendar."""
        if self.calendar_table is None and self.span is not None:
            return self.span.start.year, self.span.end.year
        return tuple(self.calendar.agg(F.min("year"), F.max("year")).first())

    @property
    def calendar(self) -> DataFrame:
        """date, year, month, dom, monthabbr, season, holidayseason."""
        if self._cal is None:
            base = self.calendar_table if self.calendar_table is not None else calendar(self.spark, self.span)
            self._cal = base if "season" in base.columns else enrich_calendar(base)
        return self._cal

    def table(self, name: str) -> DataFrame:
        """Another parquet table of the same folder (e.g. a raw test table)."""
        return _read(self.spark, self.root, name)

    # ------------------------------------------------------------------ loaders
    @classmethod
    def load(cls, spark: SparkSession, sf_dir: str, again: bool = False) -> "SourceSet":
        """Bind the driver test tables (region ... documents) to the store schema.

        ``again``: read the span of the order dates anew (the folder has changed since it was first loaded).
        """
        raw: dict[str, DataFrame] = {}

        def read(name):
            if name not in raw:
                raw[name] = _read(spark, sf_dir, name, TEST_SCHEMAS[name])
            return raw[name]

        def products():
            return cls._products(read("part"))

        def customers():
            return cls._customers(read("customer"))

        def orders():
            return cls._orders(read("orders"))

        def orderlines():
            return cls._orderlines(read("lineitem"))

        def campaigns():
            return cls._campaigns(read("orders"))

        def reviews():
            return cls._reviews(read("events"))

        def review_text():
            return read("documents").select(F.col("doc_id").alias("reviewid"), "text")

        return cls(spark=spark, orders=orders, orderlines=orderlines, products=products,
                   customers=customers, campaigns=campaigns, reviews=reviews, span=lambda: order_span(*order_dates(orders(), sf_dir, again)),
                   classification=lambda: classification_from_part(read("part")),
                   review_text=review_text, root=sf_dir)

    # bindings of the test tables (FIXTURES.md rules)
    @staticmethod
    def _products(part: DataFrame) -> DataFrame:
        return part.select(
            F.col("p_partkey").alias("productid"),
            F.concat(F.lit("B"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("asin"),
            F.col("p_size").cast("string").alias("nodeid"),
            F.when(F.col("p_partkey") % 10 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("isinstock"),
            F.col("p_retailprice").cast(MONEY).alias("fullprice"),
        )

    @staticmethod
    def _customers(customer: DataFrame) -> DataFrame:
        return customer.select(
            F.col("c_custkey").alias("customerid"),
            F.col("c_nationkey").alias("householdid"),
            F.col("c_mktsegment").alias("gender"),
            F.col("c_name").alias("firstname"),
        )

    @staticmethod
    def _orders(o: DataFrame) -> DataFrame:
        prio = F.substring("o_orderpriority", 1, 1)
        return o.select(
            F.col("o_orderkey").alias("orderid"),
            F.col("o_custkey").alias("customerid"),
            prio.cast("int").alias("campaignid"),
            F.col("o_orderdate").cast("date").alias("orderdate"),
            F.col("o_orderstatus").alias("city"),
            F.substring("o_orderpriority", 3, 100).alias("state"),
            F.format_string("%05d", F.col("o_custkey")).alias("zipcode"),
        )

    @staticmethod
    def _orderlines(li: DataFrame) -> DataFrame:
        return li.select(
            F.col("l_orderkey").alias("orderid"),
            F.col("l_partkey").alias("productid"),
            F.col("l_quantity").cast("int").alias("numunits"),
            _cents(F.floor(F.round(F.col("l_extendedprice") * 100) / F.col("l_quantity")))
            .cast(MONEY).alias("unitprice"),
            F.col("l_extendedprice").cast(MONEY).alias("totalprice"),
        )

    @staticmethod
    def _campaigns(o: DataFrame) -> DataFrame:
        prio = F.substring("o_orderpriority", 1, 1)
        return (o.select(prio.cast("int").alias("campaignid"),
                             F.substring("o_orderpriority", 3, 100).alias("channel"))
                     .distinct()
                     .select("campaignid", "channel",
                             (F.col("campaignid") * 5).alias("discount"),
                             F.when(F.col("campaignid").isin(1, 2), F.lit("Y")).otherwise(F.lit("N"))
                              .alias("freeshppingflag")))

    @staticmethod
    def _reviews(ev: DataFrame) -> DataFrame:
        return ev.select(
            F.col("event_id").alias("reviewid"),
            F.when(F.col("user_id") % 10 == 0,
                   F.concat(F.lit("X"), F.lpad(F.col("user_id").cast("string"), 9, "0")))
             .otherwise(F.concat(F.lit("B"), F.lpad(F.regexp_extract("props", "([0-9]+)", 1), 9, "0")))
             .alias("asin"),
            (F.lit(1) + (F.col("event_id") * 7 + F.col("user_id")) % 5).cast("int").alias("overall"),
            F.date_add(F.lit(REVIEW_EPOCH), (F.col("event_id") % 2400).cast("int")).alias("reviewtime"),
            _cents(F.col("event_id") % 201 - 100).cast("decimal(5,2)").alias("sentiment"),
        )

    @classmethod
    def from_tables(cls, spark: SparkSession, table_dir: str, span: CalendarSpan | None = None,
                    classification_json: str | None = None) -> "SourceSet":
        """Read store-schema parquet tables; calendar from ``calendar.parquet`` unless a span is given."""
        def r(name):
            def read():
                df = _read(spark, table_dir, name)
                return checked(df, name) if name in STORE_SCHEMAS else df
            return read

        return cls(spark=spark, orders=r("orders"), orderlines=r("orderlines"), products=r("products"),
                   customers=r("customers"), campaigns=r("campaigns"), reviews=r("reviews"),
                   span=span, calendar_table=None if span is not None else r("calendar"),
                   classification=(lambda: read_classification(spark, classification_json))
                   if classification_json else None,
                   review_text=r("reviewtext"), root=table_dir)


def _from_catalog(cls, spark: SparkSession, database: str, span: CalendarSpan | None = None,
                  classification_json: str | None = None) -> "SourceSet":
    """Store tables from the session catalog (``database.orders`` ...), e.g. the
    bucketed tables written by ``sources.layout.write_bucketed``."""
    def t(name):
        def read():
            df = spark.table(f"{database}.{name}")
            return checked(df, name) if name in STORE_SCHEMAS else df
        return read

    has_text = spark.catalog.tableExists(f"{database}.reviewtext")
    return cls(spark=spark, orders=t("orders"), orderlines=t("orderlines"), products=t("products"),
               customers=t("customers"), campaigns=t("campaigns"), reviews=t("reviews"), span=span,
               calendar_table=None if span is not None else t("calendar"),
               classification=(lambda: read_classification(spark, classification_json))
               if classification_json else None,
               review_text=t("reviewtext") if has_text else None)


SourceSet.from_catalog = classmethod(_from_catalog)


def classification_from_part(part: DataFrame) -> DataFrame:
    """Category documents of the test binding: one per ``p_size`` node.

    level0 'Books', level1 type, level2/3 the two words of the name, level4
    brand and level5 'N/A'; nodes divisible by 7 lack levels 4 and 5.
    """
    per_node = part.groupBy(F.col("p_size").cast("bigint").alias("nodeid")).agg(
        F.min_by("p_type", "p_partkey").alias("l1"),
        F.min_by("p_name", "p_partkey").alias("nm"),
        F.min_by("p_brand", "p_partkey").alias("br"),
    )
    short = F.col("nodeid") % 7 == 0
    flat = per_node.select(
        "nodeid",
        F.col("l1").alias("classification"),
        F.lit("Books").alias("level0"),
        F.col("l1").alias("level1"),
        F.split_part("nm", F.lit(" "), F.lit(1)).alias("level2"),
        F.split_part("nm", F.lit(" "), F.lit(2)).alias("level3"),
        F.when(~short, F.col("br")).alias("level4"),
        F.when(~short, F.lit("N/A")).alias("level5"),
    )
    return nest_levels(flat)
