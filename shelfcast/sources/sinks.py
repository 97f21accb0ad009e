"""Sinks: the materialised feature table with its refresh, and the published prediction loads.

Tables live under a folder on shared storage that the caller names, or in a fresh
folder under the cluster's checkpoint folder (never a machine-local path).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import month_idx, month_index
from ..session import fresh_path

PREDICTION_COLUMNS = ("demandid", "nodeid", "month", "year", "season", "predictedsales")
#: a changed fact reaches the features of its own month and of the 12 after it
REACH_MONTHS = 12


# --------------------------------------------------------------------------- A4 feature table
def _by_month(df: DataFrame, files_per_month: int):
    """Writer of at most ``files_per_month`` files a month: rows of a month go to that many tasks."""
    salt = F.pmod(F.xxhash64("nodeid"), F.lit(files_per_month))
    return df.repartition("yr", "mn", salt).write.partitionBy("yr", "mn")


def write_features(df: DataFrame, path: str, files_per_month: int = 1) -> None:
    """A4: feature table as parquet partitioned by year and month (12 * ``files_per_month`` files a year at most)."""
    _by_month(df, files_per_month).mode("errorifexists").parquet(path)


def read_features(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None,
                  schema=None) -> DataFrame:
    """Feature table written by ``write_features``; ``schema`` skips inference."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    return df.select(*columns) if columns else df


def materialize_features(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Write ``df`` to a new shared location and return the re-read table."""
    path = fresh_path(df.sparkSession, "mv_ml_features")
    write_features(df, path)
    return read_features(df.sparkSession, path, columns, schema=df.schema)


def changed_months(facts: DataFrame, date_col: str) -> list[int]:
    """Month indexes (year * 12 + month - 1) of changed orders or reviews; at most the calendar's months."""
    rows = facts.where(F.col(date_col).isNotNull()).select(month_idx(date_col).alias("m")).distinct().collect()
    return sorted(r["m"] for r in rows)


def month_runs(months: Iterable[int]) -> list[tuple[int, int]]:
    """Months as (first, last) runs without gaps."""
    runs: list[list[int]] = []
    for m in sorted(set(months)):
        if runs and m == runs[-1][1] + 1:
            runs[-1][1] = m
        else:
            runs.append([m, m])
    return [tuple(r) for r in runs]


def refresh_features(src, path: str, changed: Iterable[int], year_from: int, year_to: int,
                     files_per_month: int = 1) -> list[tuple[int, int]]:
    """Bring the feature table at ``path`` up to the tables of ``src``; returns the rewritten runs of months.

    ``changed``: month indexes with added, corrected or removed orders, order lines or
    reviews (``changed_months``).  A month's facts reach the features of that month and the
    12 after it; only those are computed, from the facts of their own 12 months
    before, and replace their partitions.  Months that the calendar has and the table has not are
    added; if the nodes of the products are not those of the table, every month is
    rewritten.  The result equals a full rebuild, except that changes of products
    that leave the nodes as they are (another node for a product) must be given as changes of
    every month they sold in.
    """
    from ..operators import features
    from ..operators.features import FEATURE_COLUMNS, baseline_months

    spark = src.spark
    table = read_features(spark, path)
    wanted = baseline_months(src, year_from, year_to)
    present = [r["m"] for r in table.select(month_index("yr", "mn").alias("m")).distinct().collect()]
    gone = set(present) - set(wanted)
    if gone:
        raise ValueError(f"{len(gone)} months of the table are not in the calendar any more: write it anew")
    if _nodes_differ(src, table, max(present, default=None)):
        touched = set(wanted)
    else:
        reached = {m + k for m in changed for k in range(REACH_MONTHS + 1)}
        touched = set(wanted) & (reached | (set(wanted) - set(present)))
    runs = month_runs(touched)
    for run in runs:
        rows = features.ml_features(src, year_from, year_to, months=run).select(*FEATURE_COLUMNS)
        _by_month(rows, files_per_month).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return runs


def _nodes_differ(src, table: DataFrame, month: int | None) -> bool:
    """Whether the nodes of the products are other ones than those of the table (every month has them all)."""
    from ..functions.columns import node_id
    if month is None:
        return True
    now = src.products.select(node_id("nodeid").alias("nodeid")).distinct()
    then = table.where((F.col("yr") == month // 12) & (F.col("mn") == month % 12 + 1)).select("nodeid").distinct()
    both = now.withColumn("_now", F.lit(1)).alias("n").join(
        then.withColumn("_then", F.lit(1)).alias("t"), F.col("n.nodeid").eqNullSafe(F.col("t.nodeid")), "full")
    return not both.where(F.col("_now").isNull() | F.col("_then").isNull()).isEmpty()


# --------------------------------------------------------------------------- A5 predictions
MANIFEST = "version bigint, kind string, load string, schema string"


def check_predictions(df: DataFrame) -> None:
    """Schema and key checks of the prediction table (distributed, one small job)."""
    missing = [c for c in PREDICTION_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"prediction table lacks columns {missing}")
    bad = (df.groupBy("demandid").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("demandid").isNull() | (F.col("n") > 1)).limit(1).count())
    if bad:
        raise ValueError("demandid must be present and unique")


def _manifest(spark: SparkSession, path: str) -> list:
    """Rows of the manifest that count: those of the last replacing load and the loads after it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return []
    rows = sorted(spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect(), key=lambda r: (r["version"], r["load"]))
    last = max((i for i, r in enumerate(rows) if r["kind"] == "replace"), default=0)
    return rows[last:]


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The published predictions: the loads that the manifest names, and nothing else that lies in the folder."""
    rows = _manifest(spark, path)
    if not rows:
        raise ValueError(f"no predictions are published at {path}")
    schema = rows[-1]["schema"]
    return spark.read.schema(schema).parquet(*[f"{path}/loads/{r['load']}" for r in rows]).select(*PREDICTION_COLUMNS)


def publish_predictions(df: DataFrame, path: str, kind: str = "append") -> str:
    """A5: one load of (demandid, nodeid, month, year, season, predictedsales), seen by readers only when it is right.

    The rows are written once to a folder of their own and checked there: columns,
    present and unique keys, and for ``append`` no key of an earlier published load (an
    anti join of the keys).  Then one manifest row publishes the load, alone
    (``replace``) or beside the earlier ones.  A load that fails is never in the manifest,
    so readers keep what was published before.  Returns the load's name.
    """
    if kind not in ("append", "replace"):
        raise ValueError(f"a load is 'append' or 'replace', not {kind!r}")
    missing = [c for c in PREDICTION_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"prediction table lacks columns {missing}")
    spark, load = df.sparkSession, uuid.uuid4().hex
    rows = df.select(*PREDICTION_COLUMNS)
    rows.write.mode("errorifexists").parquet(f"{path}/loads/{load}")
    stage = spark.read.schema(rows.schema).parquet(f"{path}/loads/{load}")
    check_predictions(stage)
    before = _manifest(spark, path)
    if before:
        if kind == "append":
            if _types(before[-1]["schema"]) != _types(rows.schema):
                raise ValueError("the load's column types are not those of the published loads")
            clash = stage.select("demandid").join(read_predictions(spark, path).select("demandid"), "demandid", "left_semi")
            if not clash.isEmpty():
                raise ValueError("demandid is already published")
    version = before[-1]["version"] + 1 if before else 0
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.createDataFrame([(version, kind, load, ddl)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return load


def _types(schema) -> list[tuple[str, str]]:
    from pyspark.sql.types import StructType
    fields = StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    return [(f.name, f.dataType.simpleString()) for f in fields]


def write_predictions(df: DataFrame, path: str) -> None:
    """A5 for a single load: published at ``path``, where no load may be yet; a failing one publishes nothing."""
    if _manifest(df.sparkSession, path):
        raise ValueError(f"predictions are already published at {path}")
    publish_predictions(df, path)
