"""Condition terms of mediated queries: ``(attr, op, value)`` tuples or Columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

OPS = ("<", ">", "<=", ">=", "=", "!=", "in", "is_null", "is_not_null")


def condition_attr(cond) -> str | None:
    """Attribute a tuple condition reads (None for a free Column)."""
    return cond[0] if isinstance(cond, tuple) else None


def to_column(cond) -> Column:
    if isinstance(cond, Column):
        return cond
    if not isinstance(cond, tuple) or len(cond) not in (2, 3):
        raise ValueError(f"condition must be (attr, op, value) or a Column, got {cond!r}")
    attr, op = cond[0], cond[1]
    c = F.col(attr)
    if op == "is_null":
        return c.isNull()
    if op == "is_not_null":
        return c.isNotNull()
    if len(cond) != 3:
        raise ValueError(f"operator {op!r} needs a value")
    v = cond[2]
    if op == "in":
        if not isinstance(v, Iterable) or isinstance(v, str):
            raise ValueError("'in' needs a list of values")
        return c.isin(*list(v))
    if op == "<":
        return c < v
    if op == ">":
        return c > v
    if op == "<=":
        return c <= v
    if op == ">=":
        return c >= v
    if op == "=":
        return c == v
    if op == "!=":
        return c != v
    raise ValueError(f"unknown operator {op!r}; expected one of {OPS}")


def conjunction(conds) -> Column | None:
    out = None
    for cond in conds:
        c = to_column(cond)
        out = c if out is None else (out & c)
    return out
