"""Scalar column expressions (all built-in, JVM side, inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values taken over from the reference calendar update: season by
# month (no ELSE branch, so any other value gives NULL) and the holiday label.
SEASON_MONTHS = (
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Fall", (9, 10, 11)),
    ("Winter", (12, 1, 2)),
)
HOLIDAY_MONTH = 12
HOLIDAY_SEASON = "Christmas_season"

MONEY = "decimal(12,2)"
# Wide exact type for means: the quotient keeps 18 decimals, so rounding it
# to 2 or 4 places equals rounding the exact rational value (no double
# rounding as with avg(decimal(12,2)) -> decimal(16,6)).
_MEAN_NUM = "decimal(38,18)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season(month) -> Column:
    m = _col(month)
    expr = None
    for name, months in SEASON_MONTHS:
        expr = (F.when(m.isin(*months), F.lit(name)) if expr is None
                else expr.when(m.isin(*months), F.lit(name)))
    return expr


def holiday_season(month) -> Column:
    return F.when(_col(month) == HOLIDAY_MONTH, F.lit(HOLIDAY_SEASON))


def node_id(text) -> Column:
    """Text node id -> bigint (ANSI cast: bad text raises, like the source DB)."""
    return _col(text).cast("bigint")


def money(c) -> Column:
    return _col(c).cast(MONEY)


def yyyymm(year, month) -> Column:
    return (_col(year) * 100 + _col(month)).cast("int")


def month_index(year, month) -> Column:
    """Contiguous month number (year*12 + month-1): frames use this, never yyyymm."""
    return (_col(year) * 12 + _col(month) - 1).cast("int")


def month_idx(date_col, shift: int = 0) -> Column:
    """Contiguous month number of a date, ``shift`` months later (negative: earlier)."""
    d = _col(date_col)
    return (month_index(F.year(d), F.month(d)) + shift).cast("int")


def month_shift(date_col, months: int) -> Column:
    """First day of the month ``months`` away from the month of ``date_col``."""
    return F.add_months(F.trunc(_col(date_col), "month"), months)


def rounded_mean(total, count, scale: int, total_scale: int = 0) -> Column:
    """round(total / 10^total_scale / count, scale), half away from zero, exact; NULL if count is 0.

    ``total`` is an exact (decimal or integral) sum, so partial sums can be
    combined across pre-aggregation steps before the single division;
    ``total_scale=2`` reads an integer number of cents.
    """
    n = _col(count)
    denom = n if total_scale == 0 else n * (10 ** total_scale)
    q = _col(total).cast(_MEAN_NUM) / denom.cast("decimal(20,0)")
    return F.when(n > 0, F.round(q, scale)).cast("double")


def rounded_mean_sql(total: str, count: str, scale: int) -> str:
    """SQL-expression form of ``rounded_mean`` (same rule), for wide ``selectExpr`` lists."""
    return (f"cast(case when ({count}) > 0 then round(cast(({total}) as {_MEAN_NUM}) / "
            f"cast(({count}) as decimal(20,0)), {scale}) end as double)")


def money_from_cents_sql(c: str) -> str:
    """SQL-expression form of ``money_from_cents``."""
    return f"cast(cast(({c}) as decimal(38,0)) / 100 as decimal(38,2))"


def cents(amount) -> Column:
    """Money amount -> exact integer cents (bigint), so sums stay on the long fast path.

    The amount is rounded to money first: a double times 100 may lie just below the cent.
    """
    return (money(amount) * 100).cast("bigint")


def money_from_cents(c) -> Column:
    """Integer cents -> exact decimal(38,2) amount."""
    return (_col(c).cast("decimal(38,0)") / 100).cast("decimal(38,2)")


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Present decimal columns as doubles (exact sums convert correctly rounded)."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def presentable(df: DataFrame) -> DataFrame:
    """Engine-neutral result types: decimals as doubles, dates as ISO ``yyyy-MM-dd`` text."""
    from pyspark.sql.types import DateType, DecimalType

    def out(f):
        if isinstance(f.dataType, DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, DateType):
            return F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        return F.col(f.name)
    return df.select(*[out(f) for f in df.schema.fields])


def split_lat_long(df: DataFrame, col: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Split a ``"lat, long"`` text column into two doubles (NULL when not numeric)."""
    two = F.size(F.split(F.col(col), ",")) == 2
    part = "try_cast(trim(split(`{}`, ',')[{}]) as double)"
    return (df.withColumn(lat, F.when(two, F.expr(part.format(col, 0))))
              .withColumn(lon, F.when(two, F.expr(part.format(col, 1)))))
