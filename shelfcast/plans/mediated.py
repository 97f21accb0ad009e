"""Mediated relations: named views over two sources, queried through one call.

A relation has an ordered attribute list and one or more source mappings.
``Mediator.query`` binds attributes by position (as a Datalog atom does),
checks the request, leaves out every source whose used attributes all come
from other sources, joins the rest on their shared variables, and applies
conditions, one aggregate, an order and a top-n.  ``Mediator.run`` takes several
rules, whose atoms may be heads of other rules (``plans.rules``).  The result is a
lazy DataFrame; Catalyst plans it as one query.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import FEATURE_COLUMNS, SENTIMENT_COLUMNS
from ..operators.relational import SKIP, bind, natural_join
from .rules import Rule, evaluate


@dataclass(frozen=True)
class Source:
    source: str                 # source system, e.g. "S1"
    table: str                  # table in that source
    attrs: tuple[str, ...]      # relation attributes it provides, in its order
    key: str | None = None      # declared, not used for joining (shared variables are)


@dataclass(frozen=True)
class Relation:
    name: str
    attrs: tuple[str, ...]
    sources: tuple[Source, ...]
    fused: str | None = None    # table holding every attribute, computed in one pass (optional)


def _rel(name, attrs, *sources, fused=None):
    attrs = tuple(attrs.split())
    return Relation(name, attrs, tuple(Source(s, t, tuple(a.split()) if a else attrs, k) for s, t, a, k in sources),
                    fused)


# The six mediated relations, their attribute order and source
# mappings, as the reference's mapping file defines them.
_FEATURES = " ".join(FEATURE_COLUMNS)
RELATIONS: dict[str, Relation] = {r.name: r for r in (
    _rel("classification", "nodeid classification level0 level1 level2 level3 level4 level5",
         ("S2", "ClassificationInfo", None, None)),
    _rel("sales_agg_mn", "nodeid mn sales vol avgprice rank_sales rank_vol",
         ("S1", "sales_agg_mn", None, None)),
    _rel("sales_agg_yr", "nodeid yr sales vol avgprice rank_sales rank_vol",
         ("S1", "sales_agg_yr", None, None)),
    _rel("sales_agg_yrmn", "nodeid yr mn sales vol avgprice",
         ("S1", "sales_agg_yrmn", None, None)),
    _rel("reviews_agg_yrmn", "nodeid yr mn numreviews avgrating",
         ("S1", "reviews_agg_yrmn", None, None)),
    _rel("mlfeatures", " ".join((*FEATURE_COLUMNS, *SENTIMENT_COLUMNS[3:])),
         ("S1", "mv_ml_features", _FEATURES, "nodeid"),
         ("S2", "mlview", " ".join(SENTIMENT_COLUMNS), "nodeid"),
         fused="mlfeatures"),
)}


#: tables of the default binding that are computed per month
FEATURE_TABLES = frozenset({"S1.mv_ml_features", "S2.mlview", "mlfeatures"})


def used_sources(rel: Relation, binding: dict[str, str]) -> list[Source]:
    """Source skip: keep a source only if it supplies a used variable no other
    source supplies.  When that leaves nothing (only shared keys used), the
    first source is kept so that rows are still returned."""
    ordered = sorted(rel.sources, key=lambda s: (s.source, s.table))
    vars_of = {s: {binding[a] for a in s.attrs if a in binding} for s in ordered}
    kept = []
    for s in ordered:
        others = set().union(*[v for t, v in vars_of.items() if t is not s]) if len(ordered) > 1 else set()
        if vars_of[s] - others:
            kept.append(s)
    return kept or ordered[:1]


def month_range(rel: Relation, cols: Sequence[str | None], where: Sequence) -> tuple[int, int] | None:
    """Month indexes that tuple conditions on ``yr`` and ``mn`` leave possible (None: no bound on the year)."""
    bounds = {"yr": [0, 9998], "mn": [1, 12]}
    names = {v: a for a, v in zip(rel.attrs, cols) if a in bounds and v not in SKIP}
    for cond in where:
        if not isinstance(cond, tuple) or len(cond) != 3 or cond[0] not in names:
            continue
        values = list(cond[2]) if cond[1] == "in" else [cond[2]]
        if not values or not all(type(v) is int for v in values):
            continue
        span = bounds[names[cond[0]]]
        if cond[1] in ("=", "in", ">", ">="):
            span[0] = max(span[0], min(values))
        if cond[1] in ("=", "in", "<", "<="):
            span[1] = min(span[1], max(values))
    if bounds["yr"] == [0, 9998]:
        return None
    return bounds["yr"][0] * 12 + bounds["mn"][0] - 1, bounds["yr"][1] * 12 + bounds["mn"][1] - 1


class Mediator:
    """Binds relation source tables to DataFrame factories.

    ``tables`` maps ``"<source>.<table>"`` to a zero-argument callable; the
    default binding computes every table from a ``SourceSet``.
    """

    def __init__(self, src=None, tables: dict[str, Callable[[], DataFrame]] | None = None,
                 relations: dict[str, Relation] | None = None, year_from: int | None = None,
                 year_to: int | None = None, features_path: str | None = None):
        """``features_path``: a feature table written by ``write_features``; S1
        then reads it (partition pruning on ``yr``) instead of recomputing, and
        S1 and S2 are joined rather than fused.  Without years, the feature
        tables cover the calendar's own."""
        self.relations = relations or RELATIONS
        self.tables = dict(tables or {})
        self._given = frozenset(self.tables)
        if features_path is not None and src is not None:
            from ..sources.sinks import read_features
            self.tables.setdefault("S1.mv_ml_features",
                                   lambda: read_features(src.spark, features_path, FEATURE_COLUMNS))
            self.tables.setdefault("mlfeatures", None)
        self._computed: set[str] = set()                   # feature tables that can be computed for some months
        if src is not None:
            for k, v in default_tables(src, year_from, year_to).items():
                if k not in self.tables:
                    self.tables[k] = v
                    self._computed |= {k} & FEATURE_TABLES
        self.tables = {k: v for k, v in self.tables.items() if v is not None}

    def _table(self, key: str, months: tuple[int, int] | None) -> DataFrame:
        return self.tables[key](months) if key in self._computed else self.tables[key]()

    def relation(self, name: str, cols: Sequence[str | None], months: tuple[int, int] | None = None) -> DataFrame:
        """Body atom ``name(cols...)`` unfolded to its sources and joined.

        ``months``: feature tables need only these month indexes (a hint; rows are not filtered by it otherwise).
        """
        rel = self._get(name)
        if len(cols) != len(rel.attrs):
            raise ValueError(f"{name} takes {len(rel.attrs)} attributes, {len(cols)} given")
        binding = {a: v for a, v in zip(rel.attrs, cols) if v not in SKIP}
        kept = used_sources(rel, binding)
        own = any(f"{s.source}.{s.table}" in self._given for s in kept)
        # the fused table stands for the default sources only, unless it was given with them
        if len(kept) > 1 and rel.fused in self.tables and (not own or rel.fused in self._given):
            # The sources share their key space one to one, so their natural
            # join equals the fused table without rows whose join variables
            # are NULL (NULL never joins).
            shared = set.intersection(*[{binding[a] for a in s.attrs if a in binding} for s in kept])
            if not shared:
                raise ValueError("atoms share no variable; a cross product is not evaluated")
            df = bind(self._table(rel.fused, months), list(cols), list(rel.attrs))
            for v in sorted(shared):
                df = df.where(F.col(v).isNotNull())
            return df
        frames = []
        for s in kept:
            df = self._table(f"{s.source}.{s.table}", months)
            frames.append(bind(df, [binding.get(a) for a in s.attrs], list(s.attrs)))
        return natural_join(frames)

    def query(self, name: str | None = None, cols: Sequence[str | None] | None = None, head: Sequence[str] | None = None,
              where: Sequence = (), group_by: tuple | None = None, order_by: Sequence | None = None,
              top: int | None = None, atoms: Sequence[tuple[str, Sequence[str | None]]] | None = None) -> DataFrame:
        """One mediated rule over the atom ``name(cols)``, or over several ``atoms`` joined on their shared variables.

        ``group_by = (by_vars, alias, fn, on_var)``; ``order_by`` = list of
        ``(var, 'a'|'d')``; ``top`` = n.  Conditions on relation variables
        filter before grouping/ordering/top, conditions on the aggregate alias
        filter after grouping.
        """
        if (name is None) == (atoms is None) or (name is not None and cols is None):
            raise ValueError("give one relation with its variables, or atoms")
        body = [(name, cols)] if atoms is None else atoms
        return self.run([Rule("Ans", body, head, where, group_by, order_by or (), top)])

    def run(self, rules: Sequence[Rule], result: str | None = None) -> DataFrame:
        """Several rules; an atom may name the head of another one.  Returns the head ``result`` (default: the last)."""
        def relation(name: str, cols: Sequence[str | None], where: Sequence) -> DataFrame:
            return self.relation(name, cols, month_range(self._get(name), cols, where))

        return evaluate(rules, {r.name: r.attrs for r in self.relations.values()}, relation, result)

    def _get(self, name: str) -> Relation:
        if name not in self.relations:
            raise ValueError(f"unknown mediated relation {name!r}")
        return self.relations[name]


def mediated(src, rel: str, cols: Sequence[str | None], year_from: int | None = None, year_to: int | None = None,
             **query) -> DataFrame:
    """One-call form: ``mediated(src, "sales_agg_mn", [...], where=[...], top=3)``."""
    return Mediator(src, year_from=year_from, year_to=year_to).query(rel, cols, **query)


def default_tables(src, year_from: int | None = None, year_to: int | None = None
                   ) -> dict[str, Callable[[], DataFrame]]:
    from ..operators import features, hierarchy, views

    def years() -> tuple[int, int]:
        if year_from is not None and year_to is not None:
            return year_from, year_to
        first, last = src.years()
        return (first if year_from is None else year_from), (last if year_to is None else year_to)

    return {
        "S2.ClassificationInfo": lambda: hierarchy.flatten_categories(src.classification),
        "S1.sales_agg_mn": lambda: views.sales_agg_mn(src),
        "S1.sales_agg_yr": lambda: views.sales_agg_yr(src),
        "S1.sales_agg_yrmn": lambda: views.sales_agg_yrmn(src),
        "S1.reviews_agg_yrmn": lambda: views.reviews_agg_yrmn(src),
        "S1.mv_ml_features": lambda months=None: features.ml_features(src, *years(), months=months),
        "S2.mlview": lambda months=None: features.mlview(src, *years(), months=months),
        "mlfeatures": lambda months=None: features.ml_features_all(src, *years(), months=months),
    }


def materialize_sources(src, year_from: int | None = None, year_to: int | None = None, root: str | None = None
                        ) -> dict[str, Callable[[], DataFrame]]:
    """Write every source table of the mediated relations once and return readers.

    Meant for serving many mediated queries over one data refresh: the star
    join, the aggregates and the feature windows run once; each query then
    reads small parquet tables (the feature tables partitioned by ``yr`` for
    pruning).  ``root`` defaults to a new folder under the shared checkpoint
    folder.  Pass the result as ``Mediator(src, tables=...)``.
    """
    from ..session import fresh_path
    root = root or fresh_path(src.spark, "mediated-sources")
    readers: dict[str, Callable[[], DataFrame]] = {}
    for name, build in default_tables(src, year_from, year_to).items():
        path = f"{root}/{name.replace('.', '_')}"
        df = build()
        writer = df.write.mode("errorifexists")
        if "yr" in df.columns and name in ("S1.mv_ml_features", "S2.mlview", "mlfeatures"):
            writer = writer.partitionBy("yr")
        writer.parquet(path)
        readers[name] = (lambda p=path, sch=df.schema: src.spark.read.schema(sch).parquet(p).select(*sch.names))
    return readers
