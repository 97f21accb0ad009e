"""Forms made for large inputs: ranks without hot partitions, bounded lists, salted joins, refresh, publish, summaries."""

import datetime as dt
import random
from decimal import Decimal as Dec

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMOKE, mini
from shelfcast.functions.columns import decimals_to_double
from shelfcast.operators import explore, features, hierarchy, views
from shelfcast.operators.relational import dense_ranks, running_total, salted_left_join
from shelfcast.session import fresh_path
from shelfcast.sources import sinks
from shelfcast.sources.classification import nest_levels
from shelfcast.sources.tables import SourceSet


# --------------------------------------------------------------------------- ranks and running totals
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("few_groups", [True, False])
def test_running_total(spark, descending, few_groups):
    rnd = random.Random(3)
    rows = [(g, v, rnd.randint(0, 9)) for g, n in (("a", 500), ("b", 3), (None, 40)) for v in [None, *range(n)]]
    df = spark.createDataFrame(rows, "g string, v int, w int").repartition(5)
    got = {(r.g, r.v): r.before for r in running_total(df, ["g"], "v", "w", "before", descending, 8, few_groups).collect()}
    want = {}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, r[1] if r[1] is not None else 0),
                     reverse=descending)
        total = 0
        for _, v, w in own:
            want[g, v] = total
            total += w
    assert got == want


def test_dense_ranks_equal_the_window(spark):
    rnd = random.Random(5)
    # a third of the rows share one value, some are missing
    rows = [(rnd.randint(1, 3), i, Dec(rnd.choice([7, 7, 7, i % 400])) if i % 50 else None, i % 90 if i % 3 else 0)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "mn int, id int, sales decimal(12,2), vol bigint")
    w = Window.partitionBy("mn")
    want = df.withColumn("rs", F.dense_rank().over(w.orderBy(F.col("sales").desc_nulls_first()))) \
        .withColumn("rv", F.dense_rank().over(w.orderBy(F.col("vol").desc_nulls_first())))
    got = dense_ranks(df, "mn", {"sales": "rs", "vol": "rv"}, "decimal(38,2)")
    assert sorted(map(tuple, got.select("id", "rs", "rv").collect())) == sorted(map(tuple, want.select("id", "rs", "rv").collect()))
    empty = dense_ranks(df.where("id < 0"), "mn", {"sales": "rs", "vol": "rv"}, "decimal(38,2)")
    assert empty.collect() == [] and empty.columns == want.columns


def test_no_window_holds_a_whole_month(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = E.queries()["sales_agg_mn"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # by range of values, or over the totals of the ranges, or the bounded sample of hashes
    assert windows and "dense_rank" not in plan
    assert all("_rt_range" in line or "xxhash64" in line or "row_number" in line for line in windows)


# --------------------------------------------------------------------------- lists
def test_chunks_are_the_lists(spark):
    rows = [(n % 50 if n % 11 else None, "c", "Books", f"t{n % 3}", None, "N/A" if n % 2 else None, None, None)
            for n in range(400)] + [(None, "c", "only missing", None, None, None, None, None)]
    flat = spark.createDataFrame(rows, "nodeid long, classification string, level0 string, level1 string, "
                                       "level2 string, level3 string, level4 string, level5 string")
    doc = nest_levels(flat)
    lists = {r.category: [n for n in r.nodeids] for r in hierarchy.category_node_lists(doc).collect()}
    for size in (1, 7, 10_000):
        chunks = {}
        for r in hierarchy.category_node_chunks(doc, size).collect():
            assert len(r.nodeids) <= size
            chunks.setdefault(r.category, {})[r.chunk] = r.nodeids
        assert {c: [n for k in sorted(own) for n in own[k]] for c, own in chunks.items()} == lists
        assert all(sorted(own) == list(range(len(own))) for own in chunks.values())


# --------------------------------------------------------------------------- star
def test_salted_join(spark):
    facts = spark.createDataFrame([(i, 1 if i % 3 else (i % 7 if i % 5 else None)) for i in range(3000)], "id int, k int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k int, name string")
    got = salted_left_join(facts, dim, "k", "id")
    want = facts.join(dim, "k", "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns


def test_a_campaign_with_a_third_of_the_orders_is_spread(spark):
    n = 6000
    src = mini(spark, products=[(1, "B1", "1", "Y", Dec("10.00"))],
               orders=[(o, dt.date(2000, 5, 1), 1, "c", "s", "1", 1 if o % 3 == 0 else 2 + o % 4) for o in range(n)],
               orderlines=[(o, 1, Dec("1.00"), 1, Dec("1.00")) for o in range(n)],
               customers=[(1, 1, "F", "x")], campaigns=[(k, f"ch{k}", 5, "N") for k in range(1, 6)])
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = views.sales(src)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = df.groupBy("campaignid", "campaignchannel").count().collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {(r.campaignid, r.campaignchannel): r["count"] for r in rows} == {
        (k, f"ch{k}"): sum(1 for o in range(n) if (1 if o % 3 == 0 else 2 + o % 4) == k) for k in range(1, 6)}
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(campaignid" in line]
    assert exchanges and all("_salt" in line for line in exchanges)


# --------------------------------------------------------------------------- season of a given calendar
def test_the_calendars_own_season_is_a_group(spark):
    """A calendar table whose season changes inside a month: both parts are rows of their own."""
    src = mini(spark, products=[(1, "B1", "7", "Y", Dec("1.00"))],
               orders=[(1, dt.date(2000, 3, 5), 1, "c", "s", "1", 1), (2, dt.date(2000, 3, 25), 1, "c", "s", "1", 1)],
               orderlines=[(1, 1, Dec("1.00"), 2, Dec("2.00")), (2, 1, Dec("1.00"), 5, Dec("5.00"))],
               reviews=[(1, "B1", 4, dt.date(2000, 3, 5), Dec("0.10")), (2, "B1", 2, dt.date(2000, 3, 25), Dec("0.20"))])
    days = [(dt.date(2000, 3, d), 2000, 3, d, "Mar", "Winter" if d < 20 else "Spring", None) for d in range(1, 32)]
    calendar = spark.createDataFrame(days, "date date, year int, month int, dom int, monthabbr string, season string, "
                                           "holidayseason string")
    own = SourceSet(spark, orders=src.orders, orderlines=src.orderlines, products=src.products, reviews=src.reviews,
                    calendar_table=calendar)
    assert {r.season: r.total_sales_volume for r in views.salesaggregate(own).collect()} == {"Winter": 2, "Spring": 5}
    assert {r.season: r.avgrating for r in views.reviewsaggregate(own).collect()} == {"Winter": 4.0, "Spring": 2.0}
    assert {r.season: r.total_sales_volume for r in views.is_sales_by_month(own, True).collect()} == {"Winter": 2, "Spring": 5}
    assert [r.total_sales_volume for r in views.salesaggregate(src).collect()] == [7]


# --------------------------------------------------------------------------- refresh
def _store(spark, lines, nodes=("1", "2"), last=dt.date(2001, 12, 31)):
    """``lines``: (order day, product, units)."""
    return mini(spark, span=(dt.date(2000, 1, 1), last),
                products=[(i + 1, f"B{i + 1}", n, "Y", Dec("1.00")) for i, n in enumerate(nodes)],
                orders=[(i, d, 1, "c", "s", "1", 1) for i, (d, _, _) in enumerate(lines)],
                orderlines=[(i, p, Dec("1.00"), u, Dec(u)) for i, (_, p, u) in enumerate(lines)],
                reviews=[(i, "B1", 1 + i % 5, d, Dec("0.10")) for i, (d, _, _) in enumerate(lines)])


def _rows(df):
    return sorted(map(str, decimals_to_double(df.select(*features.FEATURE_COLUMNS)).collect()))


def _files(spark, path):
    return {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}


def test_refresh_equals_a_rebuild(spark):
    first = [(dt.date(2000, m, 3), 1 + m % 2, m) for m in range(1, 13)]
    path = fresh_path(spark, "refresh")
    before = _store(spark, first)
    sinks.write_features(features.ml_features(before, 2000, 2001), path)
    assert len(_files(spark, path)) <= 24                              # one a month
    old = _files(spark, path)
    # a line more in May 2000
    changed = first + [(dt.date(2000, 5, 20), 2, 100)]
    now = _store(spark, changed)
    months = sinks.changed_months(spark.createDataFrame([(dt.date(2000, 5, 20),)], "d date"), "d")
    assert sinks.refresh_features(now, path, months, 2000, 2001) == [(2000 * 12 + 4, 2001 * 12 + 4)]
    assert _rows(spark.read.parquet(path)) == _rows(features.ml_features(now, 2000, 2001))
    kept = {f for f in old if "yr=2000/mn=1/" in f or "yr=2000/mn=4/" in f or "yr=2001/mn=6/" in f}
    assert len(kept) == 3 and kept <= _files(spark, path)              # untouched months keep their files
    # a later calendar: its months are added without being named
    longer = _store(spark, changed + [(dt.date(2002, 2, 2), 1, 9)], last=dt.date(2002, 12, 31))
    sinks.refresh_features(longer, path, [2002 * 12 + 1], 2000, 2002)
    assert _rows(spark.read.parquet(path)) == _rows(features.ml_features(longer, 2000, 2002))
    # a new node has rows in every month
    wider = _store(spark, changed, nodes=("1", "2", None), last=dt.date(2002, 12, 31))
    assert sinks.refresh_features(wider, path, [], 2000, 2002) == [(2000 * 12, 2002 * 12 + 11)]
    assert _rows(spark.read.parquet(path)) == _rows(features.ml_features(wider, 2000, 2002))
    assert sinks.refresh_features(wider, path, [], 2000, 2002) == []
    with pytest.raises(ValueError, match="not in the calendar"):
        sinks.refresh_features(now, path, [], 2000, 2001)


# --------------------------------------------------------------------------- publish
PRED = "demandid long, nodeid long, month int, year int, season string, predictedsales int"


def test_a_failing_load_leaves_what_was_published(spark):
    path = fresh_path(spark, "published")
    load = lambda *ids: spark.createDataFrame([(i, 1, 1, 2000, "Winter", 5) for i in ids], PRED)
    seen = lambda: sorted(r.demandid for r in sinks.read_predictions(spark, path).collect())
    with pytest.raises(ValueError, match="no predictions"):
        sinks.read_predictions(spark, path)
    with pytest.raises(ValueError, match="unique"):
        sinks.publish_predictions(load(1, 1), path)
    with pytest.raises(ValueError, match="no predictions"):            # the bad load lies there, unseen
        sinks.read_predictions(spark, path)
    sinks.publish_predictions(load(1, 2), path)
    assert seen() == [1, 2]
    for bad, error in ((load(3, None), "present"), (load(2, 3), "already published"), (load(3).drop("season"), "lacks columns"),
                       (load(3).withColumn("month", F.lit("x")), "column types")):
        with pytest.raises(ValueError, match=error):
            sinks.publish_predictions(bad, path)
        assert seen() == [1, 2]
    sinks.publish_predictions(load(3), path)
    assert seen() == [1, 2, 3]
    sinks.publish_predictions(load(2, 9), path, "replace")
    assert seen() == [2, 9]
    sinks.publish_predictions(load(1), path)                           # free again
    assert seen() == [1, 2, 9]
    with pytest.raises(ValueError, match="already"):
        sinks.write_predictions(load(4), path)


# --------------------------------------------------------------------------- summaries and samples
def test_distinct_estimates_of_all_sources(spark):
    """Estimates are within 2.5 % (three standard errors of 0.8 %), and no plan repeats its rows."""
    src = SourceSet.load(spark, "/root/testdata/sf0.01")
    for source in ("orders", "orderlines", "products", "customers", "campaigns", "reviews"):
        df = getattr(src, source)
        merged = explore.merge_summaries(explore.summarize(df))
        assert "Expand" not in merged._jdf.queryExecution().optimizedPlan().toString()
        exact = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first()
        for r in explore.profile_from(merged).collect():
            assert abs(r.n_distinct - exact[r.column]) <= max(0.025 * exact[r.column], 0.5), (source, r)
        for r in explore.profile_sources({source: df}).collect():
            assert abs(r.n_distinct - exact[r.column]) <= max(0.025 * exact[r.column], 0.5), (source, r)


def test_summaries_merge_to_the_whole(spark):
    rnd = random.Random(2)
    rows = [(dt.date(2000, 1, 1) + dt.timedelta(days=i % 40), None if i % 17 == 0 else rnd.gauss(50, 20), f"k{i % 300}")
            for i in range(20_000)]
    df = spark.createDataFrame(rows, "d date, x double, k string")
    path = fresh_path(spark, "summaries-test")
    explore.write_summaries(df.where("d < '2000-01-20'"), path, "s", "d")
    explore.write_summaries(df.where("d >= '2000-01-20'"), path, "s", "d")
    explore.write_summaries(df.select("k"), path, "t")
    merged = explore.read_summaries(spark, path)
    got = {(r.source, r.column): r for r in explore.profile_from(merged).collect()}
    xs = sorted(r[1] for r in rows if r[1] is not None)
    mean = sum(xs) / len(xs)
    sd = (sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) ** 0.5
    r = got["s", "x"]
    assert (r.n_rows, r.n_null, r.lo_number, r.hi_number) == (len(rows), len(rows) - len(xs), xs[0], xs[-1])
    assert r.mean == pytest.approx(mean, abs=1e-6) and r.stddev == pytest.approx(sd, abs=1e-5)
    assert got["s", "k"].n_distinct == 300 and got["t", "k"].lo_text == "k0"
    part = explore.profile_from(explore.read_summaries(spark, path, dt.date(2000, 1, 5), dt.date(2000, 1, 30)))
    assert part.where("column = 'x'").first().n_rows == sum(dt.date(2000, 1, 5) <= r[0] <= dt.date(2000, 1, 30) for r in rows)
    # equal depth: an edge's true rank is within 2 % of the asked one (KLL of size 200)
    for e in explore.equal_depth_histogram(merged.where("source = 's'"), 10).collect():
        if e.column == "x":
            below = sum(x <= e.hi_edge for x in xs) / len(xs)
            assert abs(below - e.bucket / 10) <= 0.02


def test_samples_of_two_seeds_are_independent(spark):
    df = spark.range(20_000).select(F.col("id"), F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") % 4).alias("s"))
    one, two = ({r.id for r in explore.sample_stratified(df, "id", None, 0.1, seed).collect()} for seed in (0, 1))
    assert 1800 < len(one) < 2200 and 1800 < len(two) < 2200
    assert 120 < len(one & two) < 280                                  # a tenth of a tenth: 200 expected
    assert len({i + 1 for i in two} & one) < 280                       # not the same sample shifted by one
    text = explore.sample_stratified(df, "k", None, 0.1)               # text keys too
    assert 1800 < text.count() < 2200
    exact, other = (explore.sample_exact(df, "k", 500, "s", seed) for seed in (0, 1))
    assert {r.s: r["count"] for r in exact.groupBy("s").count().collect()} == {0: 500, 1: 500, 2: 500, 3: 500}
    both = exact.select("id").intersect(other.select("id")).count()
    assert 130 < both < 270                                            # 500 * 500 / 5000 * 4 = 200 expected
    assert explore.sample_exact(df, "id", 7).count() == 7 and explore.sample_exact(df, "id", 10**6, "s").count() == 20_000
