"""Query shapes of the mediated language as DataFrame operators.

An *atom* binds the columns of a DataFrame by position to variable names,
``_`` meaning "not used".  A variable used twice in one atom is an equality;
atoms are joined on the variables they share (natural join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKIP = ("_", None)
AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}


def bind(df: DataFrame, variables: Sequence[str | None], columns: Sequence[str] | None = None) -> DataFrame:
    """Select ``columns`` (default: all, in order) renamed to ``variables``; drop ``_``."""
    columns = list(columns or df.columns)
    if len(columns) != len(variables):
        raise ValueError(f"the table has {len(columns)} columns, {len(variables)} variables given")
    first: dict[str, str] = {}
    eq: list[Column] = []
    for col, var in zip(columns, variables):
        if var in SKIP:
            continue
        if var in first:
            eq.append(F.col(first[var]) == F.col(col))
        else:
            first[var] = col
    out = df
    for cond in eq:
        out = out.where(cond)
    return out.select(*[F.col(c).alias(v) for v, c in first.items()])


def natural_join(frames: Sequence[DataFrame], how: str = "inner") -> DataFrame:
    """Fold of joins on shared column names; frames sharing nothing are an error
    (a cartesian product is never built)."""
    out = frames[0]
    for nxt in frames[1:]:
        shared = [c for c in out.columns if c in nxt.columns]
        if not shared:
            raise ValueError("atoms share no variable; a cross product is not evaluated")
        out = out.join(nxt, shared, how)
    return out


def join_atoms(*atoms: tuple[DataFrame, Sequence[str | None]]) -> DataFrame:
    """Several body atoms joined on their shared variables."""
    return natural_join([bind(df, vars_) for df, vars_ in atoms])


def group_by_op(df: DataFrame, by: Sequence[str], alias: str, fn: str, on: str,
                having: Sequence | None = None) -> DataFrame:
    """``group_by(rel, by, alias=fn(on))`` with optional conditions on the alias."""
    from ..functions.conditions import conjunction
    if fn not in AGGREGATES:
        raise ValueError(f"aggregate {fn!r} not supported; use one of {sorted(AGGREGATES)}")
    out = df.groupBy(*by).agg(AGGREGATES[fn](on).alias(alias))
    cond = conjunction(having or [])
    return out if cond is None else out.where(cond)


def sort_keys(order: Sequence[tuple[str, str]] | Sequence[str]) -> list[Column]:
    """(attr, 'a'|'d') pairs; ascending puts NULLs last, descending first (PostgreSQL)."""
    keys = []
    for item in order:
        attr, direction = (item, "a") if isinstance(item, str) else (item[0], item[1] or "a")
        if direction not in ("a", "d"):
            raise ValueError(f"order direction must be 'a' or 'd', got {direction!r}")
        c = F.col(attr)
        keys.append(c.desc_nulls_first() if direction == "d" else c.asc_nulls_last())
    return keys


def order_by_op(df: DataFrame, order: Sequence) -> DataFrame:
    """global order (range-partitioned sort)."""
    return df.orderBy(*sort_keys(order))


def top_n_op(df: DataFrame, n: int, order: Sequence = ()) -> DataFrame:
    """first ``n`` rows under ``order``; the remaining columns break ties so
    the result is deterministic.  Runs as a distributed top-k (each task keeps
    ``n`` rows, the driver merges n x tasks rows)."""
    named = {item if isinstance(item, str) else item[0] for item in order}
    keys = sort_keys(order) + [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    return df.orderBy(*keys).limit(n)


def dense_rank_top(df: DataFrame, col: str, k: int, descending: bool = True,
                   rank_name: str = "rank") -> DataFrame:
    """Rows whose ``col`` value is among the ``k`` best distinct values, with their dense rank.

    Distributed form of ``dense_rank() over (order by col) <= k``: the
    distinct values go through a top-k (each task keeps k), the k winners
    are ranked (k rows) and broadcast back (size bounded by ``k``).  No
    window ever holds the whole table.  Descending puts NULLs first,
    ascending last (PostgreSQL order).
    """
    order = F.col("_v").desc_nulls_first() if descending else F.col("_v").asc_nulls_last()
    # the winners' branch reads every column, so both branches share one exchange below the aggregation
    # that made ``df`` instead of computing it twice with different columns
    others = [F.col(c) for c in df.columns if c != col] or [F.lit(0)]
    best = (df.groupBy(F.col(col).alias("_v")).agg(F.max(F.xxhash64(*others)).alias("_rest"))
              .where(F.col("_rest").isNotNull()).orderBy(order).limit(k))
    ranked = best.select("_v", F.dense_rank().over(Window.orderBy(order)).alias(rank_name))
    return (df.join(F.broadcast(ranked), F.col(col).eqNullSafe(F.col("_v")))
              .drop("_v"))


def running_total(df: DataFrame, group: Sequence[str], value: str, weight: str, before: str, descending: bool = False,
                  ways: int = 64, few_groups: bool = False) -> DataFrame:
    """``df`` plus ``before``: the total ``weight`` of the group's rows that come before the row's ``value``.

    ``df`` has one row per group and value.  No window partition holds a whole
    group: the ``ways - 1`` rows of a group with the smallest hashes are an even and
    repeatable sample of its values; they split the group into ranges of about equal
    size, each range is summed in its own window partition, and the totals of the
    ranges before it are added.  Missing values are a range of their own, the first one
    descending and the last one ascending (PostgreSQL).  ``few_groups``: the groups are known to be few
    (months, years), so their splitters, ``ways`` values a group, are broadcast; otherwise
    the size is measured, and a group with many rows is split by the skew join.
    """
    keys = [F.col(g) for g in group]
    hashed = F.xxhash64(*keys, F.col(value))
    by_hash = Window.partitionBy(*group).orderBy(hashed, F.col(value))
    splitters = df.where(F.col(value).isNotNull()).select(*group, value).withColumn("_rt_n", F.row_number().over(by_hash)) \
        .where(F.col("_rt_n") < ways).groupBy(*group).agg(F.array_sort(F.collect_list(value)).alias("_rt_splitters"))
    same = [F.col(f"_l.{g}").eqNullSafe(F.col(f"_r.{g}")) for g in group]

    def with_groups(left: DataFrame, right: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
        right = F.broadcast(right) if few_groups else right
        cond = [*same, *more]
        extra = [c for c in right.columns if c not in left.columns]
        return left.alias("_l").join(right.alias("_r"), cond, "left").select("_l.*", *[F.col(f"_r.{c}") for c in extra])

    v = F.col(value)
    passed = F.size(F.filter("_rt_splitters", (lambda x: x >= v) if descending else (lambda x: x <= v)))
    placed = with_groups(df, splitters).withColumn(
        "_rt_range", F.when(v.isNull(), F.lit(-1 if descending else ways)).otherwise(F.coalesce(passed, F.lit(0)))) \
        .drop("_rt_splitters")
    order = v.desc_nulls_first() if descending else v.asc_nulls_last()
    inside = Window.partitionBy(*group, "_rt_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_rt_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    ranges = placed.groupBy(*group, "_rt_range").agg(F.sum(weight).alias("_rt_total"))
    earlier = Window.partitionBy(*group).orderBy("_rt_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*group, "_rt_range", F.coalesce(F.sum("_rt_total").over(earlier), F.lit(0)).alias("_rt_before"))
    out = with_groups(summed, ranges, [F.col("_l._rt_range") == F.col("_r._rt_range")])
    return out.withColumn(before, (F.col("_rt_inside") + F.col("_rt_before")).cast("bigint")) \
        .drop("_rt_range", "_rt_inside", "_rt_before")


def dense_ranks(df: DataFrame, group: str, ranks: Mapping[str, str], value_type: str, ways: int = 64) -> DataFrame:
    """``df`` plus a descending dense rank in ``group`` (few groups) for each ``{column: rank name}``, NULLs first.

    Equal to ``dense_rank() over (partition by group order by column desc nulls first)``, but
    only distinct values are ranked, by ``running_total``: rows of one hot value
    become one row before any window.  ``value_type`` holds the values of all ranked columns.
    """
    columns = list(ranks)
    # every column is read here, so that both branches share one exchange below the aggregation that made ``df``
    rest = F.xxhash64(*[F.col(c) for c in df.columns])
    cells = df.select(group, rest.alias("_rest"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("_which"), F.col(c).cast(value_type).alias("_value")) for i, c in enumerate(columns)])))
    values = cells.groupBy(group, "_which", "_value").agg(F.max("_rest").alias("_rest")) \
        .where(F.col("_rest").isNotNull()).select(group, "_which", "_value", F.lit(1).alias("_one"))
    ranked = running_total(values, [group, "_which"], "_value", "_one", "_before", True, ways, few_groups=True)
    out = df
    for i, c in enumerate(columns):
        own = ranked.where(F.col("_which") == i).select(
            F.col(group).alias("_g"), F.col("_value").alias("_v"), (F.col("_before") + 1).cast("int").alias(ranks[c]))
        out = out.join(own, F.col(group).eqNullSafe(F.col("_g")) & F.col(c).cast(value_type).eqNullSafe(F.col("_v"))) \
            .drop("_g", "_v")
    return out


#: ways a key of few values is split in a salted join
SALTS = 32


def salted_left_join(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str, salts: int = SALTS) -> DataFrame:
    """Left join of ``facts`` with a dimension whose ``key`` takes few values.

    Partitioned by the key alone, all facts would go to as many tasks as there are keys.  A
    salt from ``spread_by`` splits every key ``salts`` ways, and the dimension is
    repeated once for each salt.  Where the dimension's measured size is below the
    broadcast threshold, the adaptive plan sends it to the facts instead.
    """
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")
