"""Scalar functions, exploration helpers and sinks."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.columns import month_index, rounded_mean, season, split_lat_long, yyyymm
from shelfcast.functions.conditions import to_column
from shelfcast.operators import explore
from shelfcast.session import fresh_path
from shelfcast.sources.calendar import CalendarSpan, calendar, enrich_calendar
from shelfcast.sources.sinks import write_predictions


def test_rounded_mean_half_away_from_zero(spark):
    df = spark.createDataFrame([(Dec("0.25"), 2), (Dec("-0.25"), 2), (Dec("1.00"), 3), (Dec("5"), 0)],
                               "t decimal(12,2), n long")
    got = [r[0] for r in df.select(rounded_mean("t", "n", 2)).collect()]
    assert got == [0.13, -0.13, 0.33, None]


def test_season_and_keys(spark):
    df = spark.createDataFrame([(2000, m) for m in range(1, 13)], "y int, m int")
    out = df.select(season("m").alias("s"), yyyymm("y", "m").alias("k"), month_index("y", "m").alias("i")).collect()
    assert [r.s for r in out] == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer",
                                  "Fall", "Fall", "Fall", "Winter"]
    assert out[0].k == 200001 and out[11].k == 200012
    assert out[11].i + 1 == 2001 * 12   # December 2000 is followed by January 2001


def test_calendar_has_one_row_per_day(spark):
    cal = enrich_calendar(calendar(spark, CalendarSpan(dt.date(2000, 1, 1), dt.date(2000, 12, 31))))
    assert cal.count() == 366 and cal.select("date").distinct().count() == 366
    dec = cal.where("month = 12").select("season", "holidayseason").distinct().collect()
    assert [(r.season, r.holidayseason) for r in dec] == [("Winter", "Christmas_season")]


def test_conditions(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string")
    assert df.where(to_column(("a", "in", [1, 3]))).count() == 2
    assert df.where(to_column(("b", "is_null"))).count() == 1
    assert df.where(to_column(("b", "is_not_null"))).count() == 2
    assert df.where(to_column(("a", "!=", 2))).count() == 2
    with pytest.raises(ValueError):
        to_column(("a", "~", 1))


def test_split_lat_long(spark):
    df = spark.createDataFrame([("32.7, -117.1",), ("bad",), ("1,2,3",)], "t string")
    got = [(r.lat, r.lon) for r in split_lat_long(df, "t").collect()]
    assert got == [(32.7, -117.1), (None, None), (None, None)]


def test_histogram_puts_max_in_last_bucket(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)] + [(None,)], "x double")
    h = {r.bucket: r.n for r in explore.histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 11 and max(h) == 5 and h[5] == 3


def test_sample_is_reproducible_and_nested(spark):
    df = spark.range(20000).withColumnRenamed("id", "k").withColumn("s", F.col("k") % 2)
    a = explore.sample_stratified(df, "k", "s", {0: 0.1, 1: 0.3})
    b = explore.sample_stratified(df, "k", "s", {0: 0.1, 1: 0.3})
    assert a.exceptAll(b).count() == 0
    n0, n1 = a.where("s = 0").count(), a.where("s = 1").count()
    assert 700 < n0 < 1300 and 2600 < n1 < 3400
    small = explore.sample_stratified(df, "k", None, 0.05)
    big = explore.sample_stratified(df, "k", None, 0.2)
    assert small.exceptAll(big).count() == 0


def test_profile_estimates_distinct_values(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("a"), F.lit("").alias("b"), F.lit(None).cast("int").alias("c"))
    got = {(r["source"], r["column"]): r.n_distinct for r in explore.profile_sources({"t": df}).collect()}
    assert abs(got["t", "a"] - 5000) < 200 and got["t", "b"] == 1 and got["t", "c"] == 0


def test_samples_reach_beyond_32_bits(spark):
    df = spark.range(2000).select((F.col("id") + 2 ** 33).alias("k"), F.col("id").alias("j"))
    far = explore.sample_stratified(df, "k", None, 0.3).select("j")
    near = explore.sample_stratified(df, "j", None, 0.3).select("j")
    assert 400 < far.count() < 800 and far.intersect(near).count() < 300


def test_histograms_of_all_numeric_columns_equal_one_by_one(spark):
    df = spark.range(100).select(F.col("id").alias("a"), (F.col("id") * F.col("id")).alias("b"), F.lit(1.5).alias("c"),
                                 F.lit("x").alias("d"), F.lit(None).cast("int").alias("e"))
    many = {tuple(r) for r in explore.histogram_numeric(df, 7).collect()}
    assert many == {(c, *r) for c in "abce" for r in explore.histogram(df, c, 7).collect()}


def test_profile_single_pass(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "x int, y string")
    rows = {r.column: r for r in explore.profile_table(df, exact_distinct=True).collect()}
    assert rows["x"].n_distinct == 2 and rows["x"].min_value == "1" and rows["x"].mean == pytest.approx(5 / 3, 1e-6)
    assert rows["y"].n_null == 1 and rows["y"].mean is None


def test_exact_distinct_counts_neither_repeat_nor_sort_the_rows(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, None, -0.0), (2, "", float("nan")), (None, "a", float("nan")), (1, "a", None)],
                               "x int, y string, z double")
    out = explore.profile_table(df, exact_distinct=True)
    assert {r.column: (r.n_rows, r.n_null, r.n_distinct) for r in out.collect()} == {"x": (5, 1, 2), "y": (5, 1, 2), "z": (5, 1, 2)}
    assert [r.n_distinct for r in explore.profile_table(df.limit(0), exact_distinct=True).collect()] == [0, 0, 0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Expand" not in plan and "Sort [" not in plan


def test_predictions_key_must_be_unique(spark):
    df = spark.createDataFrame([(1, 1, 1, 2000, "Winter", 5), (1, 2, 1, 2000, "Winter", 5)],
                               "demandid long, nodeid long, month int, year int, season string, predictedsales int")
    with pytest.raises(ValueError, match="unique"):
        write_predictions(df, fresh_path(spark, "pred-test"))


def test_rounded_mean_matches_exact_decimal_rounding(spark):
    """Property: equals round-half-away-from-zero of the exact rational mean."""
    from decimal import ROUND_HALF_UP, Decimal
    from hypothesis import given, settings
    from hypothesis import strategies as st

    cases = []

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(-10 ** 9, 10 ** 9), min_size=1, max_size=12), st.sampled_from([2, 4]))
    def collect(cents_list, scale):
        cases.append((cents_list, scale))

    collect()
    rows = [(i, Decimal(c) / 100, s) for i, (cl, s) in enumerate(cases) for c in cl]
    df = spark.createDataFrame(rows, "g int, x decimal(12,2), s int")
    sums = df.groupBy("g", "s").agg(F.sum("x").alias("t"), F.count("x").alias("n"))
    got = {r.g: (r.r2, r.r4) for r in sums.select("g", rounded_mean("t", "n", 2).alias("r2"),
                                                   rounded_mean("t", "n", 4).alias("r4")).collect()}
    for i, (cl, s) in enumerate(cases):
        exact = (Decimal(sum(cl)) / 100) / len(cl)
        want2 = float(exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        want4 = float(exact.quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP))
        assert got[i] == (want2, want4), (cl, got[i], want2, want4)


def test_month_idx_matches_shifted_month_start(spark):
    from shelfcast.functions.columns import month_idx, month_shift
    df = spark.createDataFrame([(dt.date(2001, 1, 15),), (dt.date(2000, 12, 31),)], "d date")
    for k in (-1, -3, -12):
        rows = df.select(month_idx("d", k).alias("a"), month_idx(month_shift("d", k)).alias("b")).collect()
        assert all(r.a == r.b for r in rows)
