"""Rules over mediated relations: several body atoms, and heads that later rules read.

A ``Rule`` names its head and lists its body atoms; an atom is a mediated relation or
the head of another rule, bound by position.  Rules form a graph whose edges
are the heads they read.  ``check`` looks at every rule before any DataFrame is
built; ``evaluate`` builds each head that the asked one needs once, in topological
order, as one lazy plan.

A rule's atoms are joined on the variables they share, in an order in which every
atom shares one with those before it.  Conditions on body variables filter before
grouping, conditions on the aggregate after.  A rule over a single earlier head that
neither groups nor orders takes over that head's order, so "order, then take the
first three" can be two rules.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame

from ..functions.conditions import condition_attr, conjunction
from ..operators.relational import AGGREGATES, SKIP, bind, group_by_op, natural_join, order_by_op, top_n_op

Atom = tuple[str, Sequence[str | None]]


@dataclass(frozen=True)
class Rule:
    """``name(head) :- atoms, where`` with an optional aggregate, order and top.

    ``group_by = (by_vars, alias, fn, on_var)``; ``order_by``: variables or ``(var, 'a'|'d')``
    pairs; ``head=None`` takes every body variable (or the grouping and its aggregate).
    """

    name: str
    atoms: Sequence[Atom]
    head: Sequence[str] | None = None
    where: Sequence = ()
    group_by: tuple | None = None
    order_by: Sequence = ()
    top: int | None = None
    body: tuple[str, ...] = field(init=False, compare=False, default=())

    def __post_init__(self):
        variables = dict.fromkeys(v for _, cols in self.atoms for v in cols if v not in SKIP)
        object.__setattr__(self, "body", tuple(variables))

    @property
    def alias(self) -> str | None:
        return self.group_by[1] if self.group_by else None

    @property
    def columns(self) -> tuple[str, ...]:
        """Attributes of the head."""
        if self.head is not None:
            return tuple(self.head)
        return (*self.group_by[0], self.group_by[1]) if self.group_by else self.body


def join_order(atoms: Sequence[Atom]) -> list[int]:
    """Numbers of the atoms such that each shares a variable with those before it."""
    bound = [{v for v in cols if v not in SKIP} for _, cols in atoms]
    order, seen, left = [0], set(bound[0]), list(range(1, len(atoms)))
    while left:
        nxt = next((i for i in left if bound[i] & seen), None)
        if nxt is None:
            raise ValueError("atoms share no variable; a cross product is not evaluated")
        order.append(nxt)
        seen |= bound[nxt]
        left.remove(nxt)
    return order


def topological(rules: Sequence[Rule]) -> list[Rule]:
    """Rules after the rules whose heads they read."""
    by_name: dict[str, Rule] = {}
    for r in rules:
        if r.name in by_name:
            raise ValueError(f"head {r.name} is defined twice")
        by_name[r.name] = r
    done: dict[str, bool] = {}
    out: list[Rule] = []

    def visit(rule: Rule) -> None:
        if rule.name in done:
            if not done[rule.name]:
                raise ValueError(f"rule {rule.name} reads its own head")
            return
        done[rule.name] = False
        for name, _ in rule.atoms:
            if name in by_name:
                visit(by_name[name])
        done[rule.name] = True
        out.append(rule)

    for r in rules:
        visit(r)
    return out


def check(rules: Sequence[Rule], relations: Mapping[str, Sequence[str]]) -> list[Rule]:
    """The rules in topological order, or a ValueError that says what is wrong with one of them."""
    arity = {name: len(attrs) for name, attrs in relations.items()}
    ordered = topological(rules)
    for rule in ordered:
        if rule.name in relations:
            raise ValueError(f"head {rule.name} has the name of a mediated relation")
        if not rule.atoms:
            raise ValueError(f"rule {rule.name} has no body atom")
        for name, cols in rule.atoms:
            if name not in arity:
                raise ValueError(f"unknown mediated relation {name!r}")
            if len(cols) != arity[name]:
                raise ValueError(f"{name} takes {arity[name]} attributes, {len(cols)} given")
        join_order(rule.atoms)
        _check_variables(rule)
        arity[rule.name] = len(rule.columns)
    return ordered


def _check_variables(rule: Rule) -> None:
    body = set(rule.body)
    known = body | ({rule.alias} if rule.alias else set())
    for cond in rule.where:
        attr = condition_attr(cond)
        if attr is not None and attr not in known:
            raise ValueError(f"condition attribute {attr} is not bound by the relation")
    for h in rule.columns:
        if h not in known:
            raise ValueError(f"head attribute {h} is not bound by the relation")
    if len(set(rule.columns)) != len(rule.columns):
        raise ValueError(f"head {rule.name} names an attribute twice")
    available = known
    if rule.group_by:
        by, alias, fn, on = rule.group_by
        if fn not in AGGREGATES:
            raise ValueError(f"aggregate {fn!r} not supported; use one of {sorted(AGGREGATES)}")
        for v in [*by, on]:
            if v not in body:
                raise ValueError(f"group_by attribute {v} is not bound by the relation")
        available = set(by) | {alias}
        for h in rule.columns:
            if h not in available:
                raise ValueError(f"head attribute {h} is neither a group_by attribute nor the aggregate")
    for item in rule.order_by:
        attr, direction = (item, "a") if isinstance(item, str) else item
        if attr not in available:
            raise ValueError(f"order attribute {attr} is not bound by the relation")
        if direction not in ("a", "d"):
            raise ValueError(f"order direction must be 'a' or 'd', got {direction!r}")
    if rule.top is not None and rule.top < 0:
        raise ValueError("top takes a number of rows")


def _resolves(df: DataFrame, condition: Column) -> bool:
    try:
        return bool(df.select(condition).columns)
    except AnalysisException:
        return False


def _inherited_order(rule: Rule, orders: Mapping[str, Sequence], heads: Mapping[str, Sequence[str]]) -> list:
    """The order of the only earlier head that the rule reads, in the rule's own variables."""
    if len(rule.atoms) != 1 or rule.group_by or rule.atoms[0][0] not in orders:
        return []
    name, cols = rule.atoms[0]
    own = {attr: v for attr, v in zip(heads[name], cols, strict=True) if v not in SKIP}
    out = []
    for attr, direction in orders[name]:
        if attr not in own:
            break                                                      # beyond an unbound attribute the order is unknown
        out.append((own[attr], direction))
    return out


def _apply(rule: Rule, df: DataFrame, order: Sequence) -> DataFrame:
    pre, post = [], []
    for c in rule.where:
        if isinstance(c, Column):
            if _resolves(df, c):
                pre.append(c)
            elif rule.group_by:
                post.append(c)                                         # on the aggregate; refused below if it does not fit
            else:
                raise ValueError(f"condition {c} reads attributes that the body does not bind")
        else:
            (post if rule.group_by and condition_attr(c) == rule.alias else pre).append(c)
    cond = conjunction(pre)
    if cond is not None:
        df = df.where(cond)
    if rule.group_by:
        df = group_by_op(df, *rule.group_by)
        for c in post:
            if isinstance(c, Column) and not _resolves(df, c):
                raise ValueError(f"condition {c} mixes the aggregate with attributes that are grouped away")
        cond = conjunction(post)
        df = df if cond is None else df.where(cond)
    # keep the head plus any order variable, order (and cut), then project the head
    keep = list(dict.fromkeys([*rule.columns, *[o if isinstance(o, str) else o[0] for o in order]]))
    df = df.select(*keep)
    if rule.top is not None:
        df = top_n_op(df, rule.top, order)
    elif rule.order_by:
        df = order_by_op(df, order)
    return df.select(*rule.columns)


def evaluate(rules: Sequence[Rule], relations: Mapping[str, Sequence[str]],
             relation: Callable[[str, Sequence[str | None], Sequence], DataFrame], result: str | None = None
             ) -> DataFrame:
    """The head ``result`` (default: the last rule's) as one plan.

    ``relation(name, cols, where)`` builds a body atom of a mediated relation; ``where`` are the
    rule's conditions, as a hint.  Heads that the result does not need are checked, not built.
    """
    ordered = check(rules, relations)
    result = rules[-1].name if result is None else result
    by_name = {r.name: r for r in ordered}
    if result not in by_name:
        raise ValueError(f"no rule has the head {result}")
    needed, todo = set(), [result]
    while todo:
        name = todo.pop()
        if name in by_name and name not in needed:
            needed.add(name)
            todo.extend(n for n, _ in by_name[name].atoms)
    frames: dict[str, DataFrame] = {}
    orders: dict[str, list] = {}
    heads = {r.name: r.columns for r in ordered}
    for rule in ordered:
        if rule.name not in needed:
            continue
        atoms = [rule.atoms[i] for i in join_order(rule.atoms)]
        parts = [bind(frames[name], list(cols), list(heads[name])) if name in frames
                 else relation(name, list(cols), rule.where) for name, cols in atoms]
        order = [(o, "a") if isinstance(o, str) else tuple(o) for o in rule.order_by] \
            or _inherited_order(rule, orders, heads)
        frames[rule.name] = _apply(rule, natural_join(parts), order)
        if order and all(o in rule.columns for o, _ in order):
            orders[rule.name] = order
    return frames[result]
