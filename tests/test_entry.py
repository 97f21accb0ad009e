"""Driver contract: the entry module loads by path, schemas are stable, columns are aliased."""

import importlib.util
import os
import re

from conftest import SMOKE

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load():
    spec = importlib.util.spec_from_file_location("entry_by_path", os.path.join(HERE, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_schema_is_stable(spark):
    mod = _load()
    a, b = mod.entry(spark), mod.entry(spark)
    assert a.schema == b.schema and a.count() == b.count() > 0


def test_every_query_has_unique_aliased_columns(spark):
    mod = _load()
    # training-data queries have tests of their own
    queries = {k: v for k, v in mod.queries().items() if k != "pipeline" and not k[2:3].isdigit()}
    oracle = {k: v for k, v in mod.oracle_sql().items() if k in queries}
    assert set(queries) == set(oracle) and len(queries) >= 69
    for name, fn in queries.items():
        cols = fn(spark, SMOKE).columns
        assert len(cols) == len(set(c.lower() for c in cols)), name
        assert all(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", c) for c in cols), (name, cols)
