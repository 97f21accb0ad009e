"""DuckDB SQL for the correctness oracle.

Each oracle statement is ``WITH <bindings> <query>``: the bindings turn the
driver's test tables into the store tables with the same rules as
``SourceSet.load``; the query is written independently from the Spark code:
rolling measures are range joins over monthly totals, numbered by month.
Decimal outputs are cast to double; rounded means use integer arithmetic so
that rounding is exact (half away from zero).
"""

from __future__ import annotations

from ..functions.columns import SEASON_MONTHS
from ..operators.features import FEATURE_COLUMNS


def season_sql(month: str) -> str:
    """Season of a month number (no ELSE: other values give NULL)."""
    return "case " + " ".join(f"when {month} in {months} then '{name}'" for name, months in SEASON_MONTHS) + " end"


BINDINGS = {
    "products": """
select p_partkey as productid, concat('B', lpad(cast(p_partkey as varchar), 9, '0')) as asin,
  cast(p_size as varchar) as nodeid,
  case when p_partkey % 10 = 0 then 'N' else 'Y' end as isinstock,
  cast(p_retailprice as decimal(12,2)) as fullprice
from part""",
    "customers": """
select c_custkey as customerid, c_nationkey as householdid, c_mktsegment as gender, c_name as firstname
from customer""",
    "bk_orders": """
select o_orderkey as orderid, o_custkey as customerid,
  cast(substr(o_orderpriority, 1, 1) as int) as campaignid,
  cast(o_orderdate as date) as orderdate, o_orderstatus as city, substr(o_orderpriority, 3) as state,
  printf('%05d', o_custkey) as zipcode
from orders""",
    "orderlines": """
select l_orderkey as orderid, l_partkey as productid, cast(l_quantity as int) as numunits,
  cast(cast(floor(round(l_extendedprice * 100) / l_quantity) as bigint) * 0.01 as decimal(12,2)) as unitprice,
  cast(l_extendedprice as decimal(12,2)) as totalprice
from lineitem""",
    "campaigns": """
select distinct cast(substr(o_orderpriority, 1, 1) as int) as campaignid,
  substr(o_orderpriority, 3) as channel,
  5 * cast(substr(o_orderpriority, 1, 1) as int) as discount,
  case when substr(o_orderpriority, 1, 1) in ('1', '2') then 'Y' else 'N' end as freeshppingflag
from orders""",
    "reviews": """
select event_id as reviewid,
  case when user_id % 10 = 0 then concat('X', lpad(cast(user_id as varchar), 9, '0'))
       else concat('B', lpad(regexp_extract(props, '([0-9]+)', 1), 9, '0')) end as asin,
  cast(1 + (event_id * 7 + user_id) % 5 as int) as overall,
  cast(date '1995-01-01' + cast(event_id % 2400 as int) as date) as reviewtime,
  cast((event_id % 201 - 100) * 0.01 as decimal(5,2)) as sentiment
from events""",
    "calendar": f"""
select cast(d as date) as date, cast(year(d) as int) as year, cast(month(d) as int) as month,
  cast(day(d) as int) as dom, strftime(d, '%b') as monthabbr,
  {season_sql('month(d)')} as season,
  case when month(d) = 12 then 'Christmas_season' end as holidayseason
from (select unnest(range(date_trunc('year', min(o_orderdate))::timestamp - interval 1 year,
                          date_trunc('year', max(o_orderdate))::timestamp + interval 1 year, interval 1 day)) as d
      from orders) t""",
    "reviewtext": """
select doc_id as reviewid, text from documents""",
    "classification": """
select nodeid, l1 as classification, 'Books' as level0, l1 as level1,
  split_part(nm, ' ', 1) as level2, split_part(nm, ' ', 2) as level3,
  case when nodeid % 7 = 0 then null else br end as level4,
  case when nodeid % 7 = 0 then null else 'N/A' end as level5
from (select cast(p_size as bigint) as nodeid, min_by(p_type, p_partkey) as l1,
        min_by(p_name, p_partkey) as nm, min_by(p_brand, p_partkey) as br
      from part group by p_size) t""",
}

# order lines with everything that hangs on them; the calendar is added by ``sales``
BINDINGS["line_star"] = """
select lines.* exclude (orderid), ord.*, prod.* exclude (productid), cust.householdid, cust.gender,
  camp.channel as campaignchannel, camp.discount as campaigndiscount,
  camp.freeshppingflag as campaignfreeshippingflag
from orderlines lines
  join products prod using (productid)
  join bk_orders ord using (orderid)
  left join campaigns camp using (campaignid)
  left join customers cust using (customerid)"""

BINDINGS["sales"] = """
select star.* replace (cast(star.nodeid as bigint) as nodeid), day.year, day.month, day.season, day.holidayseason
from line_star star join calendar day on day.date = star.orderdate"""

# every review with its product's node (null if the product is unknown) and its month
BINDINGS["node_reviews"] = """
select rv.reviewid, rv.asin, rv.overall, rv.sentiment, prod.productid is not null as known,
  cast(prod.nodeid as bigint) as nodeid, day.year, day.month, day.season
from calendar day join reviews rv on rv.reviewtime = day.date left join products prod using (asin)"""

BINDINGS["month_days"] = """
select distinct year, month, cast(day(last_day(date)) as int) as tot_days_in_month from calendar"""

_ORDER = ["products", "customers", "bk_orders", "orderlines", "campaigns", "reviews", "calendar",
          "reviewtext", "classification", "line_star", "sales", "node_reviews", "month_days"]


def with_bindings(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` all bindings (DuckDB drops unused CTEs) plus ``extra`` CTEs, then ``body``."""
    parts = [f"{name} as ({BINDINGS[name]}\n)" for name in _ORDER]
    for name, sql in (extra or {}).items():
        parts.append(f"{name} as ({sql}\n)")
    return "with " + ",\n".join(parts) + "\n" + body


def round_mean(expr: str, in_scale: int, out_scale: int) -> str:
    """Exact round(avg(expr), out_scale) for a column with ``in_scale`` decimals, as double."""
    s = f"cast(sum(({expr}) * {10 ** in_scale}) as hugeint)"
    d = f"(cast(count({expr}) as hugeint) * {10 ** in_scale})"
    k = f"(2 * abs({s}) * {10 ** out_scale} + {d}) // (2 * {d})"
    return f"(case when count({expr}) > 0 then cast(sign({s}) * {k} as double) / {10 ** out_scale} end)"


def round_ratio(total: str, count: str, in_scale: int, out_scale: int) -> str:
    """Exact round(total / count, out_scale) for pre-summed values (total has ``in_scale`` decimals)."""
    s = f"cast(({total}) * {10 ** in_scale} as hugeint)"
    d = f"(cast({count} as hugeint) * {10 ** in_scale})"
    k = f"(2 * abs({s}) * {10 ** out_scale} + {d}) // (2 * {d})"
    return f"(case when ({count}) > 0 then cast(sign({s}) * {k} as double) / {10 ** out_scale} end)"


def _key_of(month_no: str) -> str:
    """yyyymm of a month number (year * 12 + month - 1)."""
    return f"cast(({month_no}) // 12 * 100 + ({month_no}) % 12 + 1 as int)"


def _grid(year_from: int, year_to: int) -> str:
    """Every node of the products (null too) in every month of the years, with its month number ``m``."""
    return f"""
select nodes.nodeid, months.* from (
  select year, month, year * 12 + month - 1 as m, min(monthabbr) as monthabbr, min(season) as season,
    min(holidayseason) as holidayseason
  from calendar where year between {year_from} and {year_to} group by year, month) months,
  (select cast(nodeid as bigint) as nodeid from products group by 1) nodes"""


def baseline_sql(year_from: int, year_to: int) -> str:
    """The grid with its shifted keys."""
    return f"""
select nodeid, year, month, monthabbr, {_key_of('m')} as yyyymm, season, holidayseason,
  cast((m - 1) % 12 + 1 as int) as pm, cast((m - 1) // 12 as int) as pmy,
  {_key_of('m - 3')} as p3myyyymm, {_key_of('m - 12')} as p12myyyymm
from ({_grid(year_from, year_to)}) grid"""


_AGES = {"pm": (1, 1), "p3m": (1, 3), "p12m": (1, 12)}


def _between(ages: tuple[int, int]) -> str:
    return f"age = {ages[0]}" if ages[0] == ages[1] else f"age between {ages[0]} and {ages[1]}"


def _measures() -> dict[str, tuple[str, tuple[int, int], str]]:
    """Feature column -> (facts it comes from, ages in months that it reaches back, expression)."""
    def total(column: str, ask: str) -> str:
        return f"sum({column}) filter (where {ask})"

    out = {}
    for name, ages in [("", (0, 0)), *[(f"{k}_", ages) for k, ages in _AGES.items()]]:
        ask = _between(ages)
        out[f"{name}sales"] = ("sold", ages, f"coalesce({total('price', ask)}, 0)::double")
        out[f"{name}vol"] = ("sold", ages, f"coalesce({total('units', ask)}, 0)::bigint")
    for k, ages in _AGES.items():
        # unknown products belong to node 0 in the previous month only
        ask = _between(ages) if k == "pm" else f"known and {_between(ages)}"
        out[f"{k}_numreviews"] = ("told", ages, f"coalesce({total('n', ask)}, 0)::bigint")
        out[f"{k}_avgrating"] = ("told", ages,
                                 f"coalesce({round_ratio(total('stars', ask), total('n_stars', ask), 0, 2)}, 0)")
        out[f"{k}_avgsntp"] = ("told", ages, f"coalesce({round_ratio(total('mood', ask), total('n_mood', ask), 2, 2)}, 0)")
    return out


def features_ctes(year_from: int, year_to: int, only: tuple[str, ...] | None = None) -> dict[str, str]:
    """CTEs up to ``measures``: monthly totals, then one range join of the months back to the grid for each kind of facts.

    ``only``: measures to build; kinds of facts and months that none of them needs are left
    out.  Without it all are built, with ``ml_features`` and ``mlview`` as the two views of them.
    """
    measures = {k: v for k, v in _measures().items() if only is None or k in only}
    ctes = {
        "grid": _grid(year_from, year_to),
        "sold": """
select nodeid, year * 12 + month - 1 as m, sum(totalprice) as price, sum(numunits) as units from sales group by 1, 2""",
        "told": """
select coalesce(nodeid, 0) as nodeid, year * 12 + month - 1 as m, known, count(reviewid) as n,
  sum(overall) as stars, count(overall) as n_stars, sum(sentiment) as mood, count(sentiment) as n_mood
from node_reviews group by 1, 2, 3""",
    }
    built = []
    for facts in ("sold", "told"):
        own = {k: v for k, v in measures.items() if v[0] == facts}
        if not own:
            del ctes[facts]
            continue
        youngest, oldest = min(v[1][0] for v in own.values()), max(v[1][1] for v in own.values())
        built.append(facts)
        ctes[f"{facts}_measures"] = f"""
select nodeid, m, {', '.join(f'{v[2]} as {k}' for k, v in own.items())}
from (select grid.nodeid, grid.m, grid.m - f.m as age, f.* exclude (nodeid, m)
      from grid left join {facts} f on f.nodeid = grid.nodeid and f.m between grid.m - {oldest} and grid.m - {youngest}) g
group by nodeid, m"""
    join = " join ".join(f"{f}_measures {f}_" for f in built)
    if len(built) > 1:
        join += " on sold_.m = told_.m and sold_.nodeid is not distinct from told_.nodeid"
    ctes["measures"] = f"""
select {built[0]}_.nodeid, ({built[0]}_.m // 12)::int as yr, ({built[0]}_.m % 12 + 1)::int as mn, {', '.join(measures)}
from {join}"""
    if only is None:
        ctes["ml_features"] = f"select {FEATURE_COLS} from measures"
        ctes["mlview"] = "select nodeid, yr, mn, pm_avgsntp, p3m_avgsntp, p12m_avgsntp from measures"
    return ctes


FEATURE_COLS = ", ".join(FEATURE_COLUMNS)


def mlfeatures_cte() -> str:
    """S1 natural-join S2 on (nodeid, yr, mn): the 20-attribute relation."""
    return "select * from ml_features join mlview using (nodeid, yr, mn)"
