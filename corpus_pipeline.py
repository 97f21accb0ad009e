"""Corpus pipeline: quality rules, SimHash near-dedup, PII, mixing to target weights, BPE.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the next stage's documents.  ``run`` writes every stage as Parquet
under the session's shared checkpoint folder and reads it again for the next.

Defined cases are those of the operators: null and empty texts fail the
quality rules, repeated rows are one near-duplicate group, an empty table stays
empty through all stages, columns beyond those of ``documents`` are dropped at
the start.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import bpe, mixing, neardup, pii, quality
from shelfcast.llm.common import ensure_checkpoint_dir, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs.select(*COLUMNS))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.keep_one(docs.select(*COLUMNS))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; ``n_chars`` follows."""
    docs = docs.select(*COLUMNS)
    return pii.redact(docs, pii.fit(docs)).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in shuffled order."""
    docs = docs.select(*COLUMNS)
    return mixing.mix(docs, mixing.source_rates(docs)).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests that tell a lossless round trip."""
    coded = bpe.encode_decode(docs.select("doc_id", "source", "text"))
    return coded.select("doc_id", "source", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: near-duplicate groups, the trained PII model and BPE are beyond SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
