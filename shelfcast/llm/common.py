"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: characters that separate words in every contract here (space and \t \n \v \f \r)
WORD_GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the standard tables under ``sf_dir`` (any path that Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only in local mode without a setting."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, as ``--py-files`` does (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(prefix="py-files-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join(name, os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut through the shared checkpoint folder, survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Jobs run inside send at most ``rows`` rows at a time to a Python worker: for rows of large binary values, whose
    batches Spark measures by rows and keeps outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bit_sum_lanes(value: Column, weight: Column | None = None) -> list[Column]:
    """32 sums that count, for one 64-bit hash per row, how much weight has each bit set.

    Sum k holds bit k in its low and bit k + 32 in its high 32 bits, so 64
    counters cost 32 long additions.  Total weight of a group must stay below 2**31.
    """
    lanes = []
    for k in range(32):
        pair = F.shiftrightunsigned(value, k).bitwiseAND(F.lit(0x0000000100000001))
        lanes.append(F.sum(pair if weight is None else pair * weight).alias(f"lane{k}"))
    return lanes


def majority_bits(total: Column) -> Column:
    """Fingerprint from ``bit_sum_lanes``: a bit is 1 if over half of the weight has it set."""
    out = F.lit(0).cast("bigint")
    for k in range(32):
        lane = F.col(f"lane{k}")
        low = F.when(2 * lane.bitwiseAND(F.lit(0xFFFFFFFF)) > total, F.lit(1 << k)).otherwise(F.lit(0))
        bit = 1 << (k + 32)
        bit = bit - (1 << 64) if bit >= 1 << 63 else bit
        high = F.when(2 * F.shiftrightunsigned(lane, 32) > total, F.lit(bit)).otherwise(F.lit(0))
        out = out.bitwiseOR(low.cast("bigint")).bitwiseOR(high.cast("bigint"))
    return out


def hex64(value: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
