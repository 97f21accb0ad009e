"""Rules of several atoms and steps: checks before anything is built, join order, inherited order, results."""

import datetime as dt
from decimal import Decimal as Dec

import pytest

from conftest import mini
from shelfcast.plans.mediated import Mediator, Relation, Source
from shelfcast.plans.rules import Rule, check, join_order, topological

ATTRS = {"a": ("x", "y"), "b": ("y", "z"), "c": ("z", "w")}


def _mediator(spark, **rows):
    tables = {n: spark.createDataFrame(rows.get(n, []), f"{ATTRS[n][0]} int, {ATTRS[n][1]} int") for n in ATTRS}
    relations = {n: Relation(n, attrs, (Source("S", n, attrs),)) for n, attrs in ATTRS.items()}
    return Mediator(relations=relations, tables={f"S.{n}": (lambda df=df: df) for n, df in tables.items()})


@pytest.mark.parametrize("rules, error", [
    ([Rule("h", [("nope", ["x"])])], "unknown mediated relation"),
    ([Rule("h", [("a", ["x"])])], "takes 2 attributes"),
    ([Rule("h", [("a", ["x", "y"])], ["x"]), Rule("g", [("h", ["x", "y"])])], "h takes 1 attributes"),
    ([Rule("h", [("a", ["x", "y"])]), Rule("h", [("b", ["y", "z"])])], "defined twice"),
    ([Rule("a", [("b", ["y", "z"])])], "name of a mediated relation"),
    ([Rule("h", [("g", ["x", "y"])]), Rule("g", [("h", ["x", "y"])])], "reads its own head"),
    ([Rule("h", [])], "no body atom"),
    ([Rule("h", [("a", ["x", "y"]), ("c", ["z", "w"])])], "cross product"),
    ([Rule("h", [("a", ["x", "y"])], ["z"])], "head attribute z"),
    ([Rule("h", [("a", ["x", "y"])], ["x", "x"])], "twice"),
    ([Rule("h", [("a", ["x", "y"])], where=[("z", "=", 1)])], "condition attribute z"),
    ([Rule("h", [("a", ["x", "y"])], group_by=(["x"], "n", "median", "y"))], "not supported"),
    ([Rule("h", [("a", ["x", "y"])], group_by=(["x"], "n", "sum", "z"))], "group_by attribute z"),
    ([Rule("h", [("a", ["x", "y"])], ["y"], group_by=(["x"], "n", "sum", "y"))], "neither a group_by"),
    ([Rule("h", [("a", ["x", "y"])], group_by=(["x"], "n", "sum", "y"), order_by=["y"])], "order attribute"),
    ([Rule("h", [("a", ["x", "y"])], order_by=[("x", "up")])], "direction"),
    ([Rule("h", [("a", ["x", "y"])], top=-1)], "top takes"),
    # the fault is in a step that a later rule reads: found before anything is built
    ([Rule("s", [("a", ["x", "y"])], where=[("q", ">", 1)]), Rule("h", [("s", ["x", "y"])], ["x"])], "condition attribute q"),
])
def test_faults_are_found_before_building(rules, error):
    with pytest.raises(ValueError, match=error):
        check(rules, ATTRS)


def test_graph_and_join_order():
    third = Rule("third", [("first", ["x", "y"]), ("second", ["y", "z"])])
    rules = [third, Rule("second", [("b", ["y", "z"])]), Rule("first", [("a", ["x", "y"])])]
    assert [r.name for r in topological(rules)][-1] == "third"
    assert join_order([("a", ["x", "y"]), ("c", ["z", "w"]), ("b", ["y", "z"])]) == [0, 2, 1]


def test_atoms_are_joined_grouped_and_cut(spark):
    a = [(1, 10), (2, 10), (3, 20), (4, None), (5, 40)]
    b = [(10, 100), (10, 101), (20, 100), (None, 100), (50, 500)]
    c = [(100, 7), (101, 9)]
    m = _mediator(spark, a=a, b=b, c=c)
    # the first two atoms share nothing: the third connects them
    atoms = [("a", ["x", "y"]), ("c", ["z", "w"]), ("b", ["y", "z"])]
    want = sorted((x, y, z, w) for x, y in a for z, w in c for yy, zz in b if y is not None and y == yy and z == zz)
    got = m.query(atoms=atoms, head=["x", "y", "z", "w"])
    assert sorted(map(tuple, got.collect())) == want
    top = m.query(atoms=atoms, where=[("x", "<", 4), ("total", ">", 5)], group_by=(["x"], "total", "sum", "w"),
                  order_by=[("total", "d")], top=2)
    sums = {}
    for x, _, _, w in want:
        sums[x] = sums.get(x, 0) + w
    best = sorted(((x, s) for x, s in sums.items() if x < 4 and s > 5), key=lambda p: (-p[1], p[0]))[:2]
    assert [tuple(r) for r in top.collect()] == best


def test_a_head_read_twice_and_one_not_needed(spark):
    m = _mediator(spark, a=[(1, 2), (2, 3), (3, 4)], b=[(2, 9)])
    built = []
    real = m.relation
    m.relation = lambda name, cols, months=None: built.append(name) or real(name, cols, months)
    rules = [Rule("unused", [("b", ["y", "z"])]), Rule("step", [("a", ["x", "y"])]),
             Rule("Ans", [("step", ["p", "q"]), ("step", ["q", "r"])])]
    assert sorted(map(tuple, m.run(rules).collect())) == [(1, 2, 3), (2, 3, 4)]
    assert built == ["a"]                                              # once, and not the unused head
    assert [tuple(r) for r in m.run(rules, "unused").collect()] == [(2, 9)]
    with pytest.raises(ValueError, match="no rule has the head"):
        m.run(rules, "nope")


def test_order_is_taken_over_by_the_next_rule(spark):
    m = _mediator(spark, a=[(1, 5), (2, 9), (3, None), (4, 7)])
    step = Rule("step", [("a", ["x", "y"])], order_by=[("y", "d")])
    assert [r.n for r in m.run([step, Rule("Ans", [("step", ["n", "v"])], top=3)]).collect()] == [3, 2, 4]   # null first
    # without the ordering attribute in the head there is no order to take over: by the columns themselves
    short = Rule("step", [("a", ["x", "y"])], ["x"], order_by=[("y", "d")])
    assert [r.n for r in m.run([short, Rule("Ans", [("step", ["n"])], top=2)]).collect()] == [1, 2]
    assert [r.n for r in m.run([step, Rule("Ans", [("step", ["n", "v"])], order_by=["n"], top=2)]).collect()] == [1, 2]


def test_source_skip_holds_in_each_atom(spark):
    src = mini(spark, products=[(1, "B1", "7", "Y", Dec("1.00"))], orders=[(1, dt.date(2000, 5, 5), 1, "c", "s", "1", 1)],
               orderlines=[(1, 1, Dec("1.00"), 3, Dec("3.00"))])
    m = Mediator(src, year_from=2000, year_to=2001)
    used = []
    real = m._table
    m._table = lambda key, months: used.append(key) or real(key, months)
    features = ["n", "y", "m", "sales", *["_"] * 16]
    rows = m.query(atoms=[("mlfeatures", features), ("sales_agg_yrmn", ["n", "y", "m", "_", "vol", "_"])],
                   head=["n", "m", "sales", "vol"]).collect()
    assert [tuple(r) for r in rows] == [(7, 5, Dec("3.00"), 3)]
    assert used == ["S1.mv_ml_features", "S1.sales_agg_yrmn"]
