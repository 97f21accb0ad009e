"""Calendar source: one row per day, generated on the executors."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import holiday_season, season


@dataclass(frozen=True)
class CalendarSpan:
    """Contiguous day range ``[start, end]``; a calendar built from it has
    exactly one row per date, so a join on ``date`` is a range filter."""

    start: dt.date
    end: dt.date

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def contains(self, date_col):
        return F.col(date_col).between(F.lit(self.start), F.lit(self.end)) \
            if isinstance(date_col, str) else date_col.between(F.lit(self.start), F.lit(self.end))


def calendar(spark: SparkSession, span: CalendarSpan) -> DataFrame:
    """date, year, month, dom, monthabbr (+ season, holidayseason via enrich)."""
    days = spark.range(span.days).select(
        F.date_add(F.lit(span.start), F.col("id").cast("int")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("dom"),
        F.date_format("date", "MMM").alias("monthabbr"),
    )


def enrich_calendar(cal: DataFrame) -> DataFrame:
    """Add ``season`` and ``holidayseason`` (no ELSE: other months give NULL)."""
    return cal.withColumn("season", season("month")).withColumn("holidayseason", holiday_season("month"))


# Weekday columns of the calendar, Monday first, and the kinds of holidays it has a column for.
WEEKDAYS = ("Mondays", "Tuesdays", "Wednesdays", "Thursdays", "Fridays", "Saturdays", "Sundays")
HOLIDAY_KINDS = ("National", "Minor", "Christian", "Jewish", "Muslim", "Chinese", "Other")


def calendar_days(cal: DataFrame) -> DataFrame:
    """The calendar with every date column of the store schema, computed from ``date``.

    iso ``yyyy-mm-dd``; datenum ``yyyymmdd`` as a number; dow three letters and dowint 0 (Sunday)
    to 6; dom; monthabbr; doy; and one column per weekday that is 1 on that weekday, so
    that its sum over any days counts them.  Season and holiday season are the calendar's own.
    """
    d, base = F.col("date"), cal if "season" in cal.columns else enrich_calendar(cal)
    return base.select(
        "date", F.year(d).alias("year"), F.month(d).alias("month"), "season", "holidayseason",
        F.date_format(d, "yyyy-MM-dd").alias("iso"),
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("datenum"),
        F.date_format(d, "E").alias("dow"), (F.dayofweek(d) - 1).alias("dowint"), F.dayofmonth(d).alias("dom"),
        F.date_format(d, "MMM").alias("monthabbr"), F.dayofyear(d).alias("doy"),
        *[(F.weekday(d) == i).cast("int").alias(name.lower()) for i, name in enumerate(WEEKDAYS)])


def with_holidays(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """``days`` with numholidays, holidayname, holidaytype and one ``hol_`` column per kind from (date, name, kind).

    Several holidays of one day are joined by ``"; "`` in the order of their names; the
    type of a day is that of its first holiday in the order of ``HOLIDAY_KINDS``.  Kinds that the
    schema has no column for, and missing ones, are ``Other``.
    """
    kind = F.when(F.col("kind").isin(*HOLIDAY_KINDS), F.col("kind")).otherwise(F.lit("Other"))
    rows = holidays.where(F.col("date").isNotNull() & F.col("name").isNotNull()).select(
        "date", "name", kind.alias("kind")).distinct()
    place = F.array_position(F.array(*[F.lit(k) for k in HOLIDAY_KINDS]), F.col("kind"))
    names = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("name")))), "; ")
    per_day = rows.groupBy("date").agg(
        F.count(F.lit(1)).cast("int").alias("numholidays"), names(F.lit(True)).alias("holidayname"),
        F.min_by("kind", place).alias("holidaytype"),
        *[F.nullif(names(F.col("kind") == k), F.lit("")).alias(f"hol_{k.lower()}") for k in HOLIDAY_KINDS])
    return days.join(per_day, "date", "left").withColumn("numholidays", F.coalesce("numholidays", F.lit(0)))
