"""Store-schema tables read with SourceSet.from_tables, calendar given as a table."""

import pytest

from conftest import SMOKE
from shelfcast.functions.columns import decimals_to_double
from shelfcast.operators import features, views
from shelfcast.session import fresh_path
from shelfcast.sources.tables import SourceSet


@pytest.fixture(scope="module")
def store_dir(spark):
    src = SourceSet.load(spark, SMOKE)
    path = fresh_path(spark, "store-tables")
    for name in ("orders", "orderlines", "products", "customers", "campaigns", "reviews"):
        getattr(src, name).write.parquet(f"{path}/{name}.parquet")
    src.calendar.write.parquet(f"{path}/calendar.parquet")
    src.review_text.write.parquet(f"{path}/reviewtext.parquet")
    return path


def _same(a, b):
    a, b = decimals_to_double(a), decimals_to_double(b)
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_calendar_table_path_matches_span_path(spark, store_dir):
    span_src = SourceSet.load(spark, SMOKE)
    table_src = SourceSet.from_tables(spark, store_dir)          # calendar read from calendar.parquet
    assert table_src.calendar_table is not None
    assert _same(views.sales_agg_mn(span_src), views.sales_agg_mn(table_src))
    assert _same(views.reviewsaggregate(span_src), views.reviewsaggregate(table_src))
    assert _same(features.ml_features(span_src, 1996, 2001), features.ml_features(table_src, 1996, 2001))
    assert _same(features.baseline_grid(span_src, 1996, 2001), features.baseline_grid(table_src, 1996, 2001))


def test_from_tables_with_span(spark, store_dir):
    src = SourceSet.from_tables(spark, store_dir, span=SourceSet.load(spark, SMOKE).span)
    assert src.calendar_table is None
    assert _same(views.sales(SourceSet.load(spark, SMOKE)), views.sales(src))


def test_lazy_tables_open_only_what_is_used(spark):
    src = SourceSet.load(spark, SMOKE)
    views.sales_agg_mn(src)
    assert set(src._built) <= {"orders", "products", "orderlines", "calendar_table"}
    assert "reviews" not in src._built and "review_text" not in src._built


def test_order_dates_are_read_once_a_folder(spark, monkeypatch):
    from shelfcast.sources import tables
    first = SourceSet.load(spark, SMOKE).span
    # a second load of the folder opens no orders for its span
    monkeypatch.setattr(SourceSet, "_orders", staticmethod(lambda o: o.where("1 / 0 > 0")))
    src = SourceSet.load(spark, SMOKE)
    assert src.span == first and tables.order_span(None, None).start.year == 1969


def test_calendar_days_and_holidays(spark):
    import datetime as dt

    from shelfcast.sources.calendar import CalendarSpan, calendar, calendar_days, with_holidays
    days = calendar_days(calendar(spark, CalendarSpan(dt.date(2000, 1, 1), dt.date(2000, 12, 31))))
    rows = {r.date: r for r in days.collect()}
    r = rows[dt.date(2000, 12, 25)]
    assert (r.iso, r.datenum, r.dow, r.dowint, r.dom, r.monthabbr, r.doy) == ("2000-12-25", 20001225, "Mon", 1, 25, "Dec", 360)
    assert (r.mondays, r.sundays, r.season, r.holidayseason) == (1, 0, "Winter", "Christmas_season")
    assert rows[dt.date(2000, 12, 31)].dowint == 0
    assert sum(r.fridays for r in rows.values() if r.month == 12) == 5
    holidays = spark.createDataFrame([(dt.date(2000, 12, 25), "Christmas", "Christian"), (dt.date(2000, 12, 25), "Day off", "National"),
                                      (dt.date(2000, 12, 25), "Day off", "National"), (dt.date(2000, 5, 5), "Odd", "Unheard"),
                                      (None, "x", "Minor"), (dt.date(2000, 6, 1), None, "Minor")],
                                     "date date, name string, kind string")
    got = {r.date: r for r in with_holidays(days, holidays).collect()}
    r = got[dt.date(2000, 12, 25)]
    assert (r.numholidays, r.holidayname, r.holidaytype, r.hol_christian, r.hol_national, r.hol_minor) == (
        2, "Christmas; Day off", "National", "Christmas", "Day off", None)
    assert (got[dt.date(2000, 5, 5)].hol_other, got[dt.date(2000, 5, 5)].holidaytype) == ("Odd", "Other")
    assert got[dt.date(2000, 6, 1)].numholidays == 0 and len(got) == 366
