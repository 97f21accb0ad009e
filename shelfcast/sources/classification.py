"""Nested product-category documents (six levels, lower levels may be missing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

LEVELS = 6


def _level_type(i: int) -> StructType:
    fields = [StructField(f"level_{i}", StringType())]
    if i + 1 < LEVELS:
        fields.append(StructField("nested", _level_type(i + 1)))
    return StructType(fields)


CLASSIFICATION_SCHEMA = StructType([
    StructField("nodeID", LongType()),
    StructField("classification", StringType()),
    StructField("category", _level_type(0)),
])


def level_path(i: int) -> str:
    """Dotted path of level ``i``: category.nested....level_i (null-safe access)."""
    return "category." + "nested." * i + f"level_{i}"


def read_classification(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents with the fixed nested schema (never inferred)."""
    return spark.read.schema(CLASSIFICATION_SCHEMA).json(path)


def nest_levels(flat: DataFrame, node: str = "nodeid", name: str = "classification",
                levels: tuple[str, ...] = tuple(f"level{i}" for i in range(LEVELS))) -> DataFrame:
    """Build nested documents from flat level columns.

    A level that is NULL together with every level below it becomes a missing
    sub-document, as in the source collection.
    """
    sub = None
    for i in reversed(range(LEVELS)):
        fields = [F.col(levels[i]).alias(f"level_{i}")]
        if sub is not None:
            fields.append(sub.alias("nested"))
        struct = F.struct(*fields)
        if i > 0:
            present = F.col(levels[i]).isNotNull()
            for j in range(i + 1, LEVELS):
                present = present | F.col(levels[j]).isNotNull()
            struct = F.when(present, struct)
        sub = struct
    return flat.select(F.col(node).cast("bigint").alias("nodeID"), F.col(name).alias("classification"),
                       sub.alias("category"))
