"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (rows with equal texts) are never split.  Sorted by size, each goes
into the bin with the tightest remaining capacity that still takes it; bins
are held in a balanced tree ordered by remaining capacity.

At scale the groups do not pass through one place: groups of at least
``total / (shards * GRAIN)`` bytes are packed one by one (there can be at most
``shards * GRAIN`` of them), smaller ones are first summed into a fixed number of
hash bundles, each packed as one group.  So the packing sees a number of units
bounded by parameters, whatever the input, and the assignment goes back to the
rows through a join with that bounded table.

``pack_capacity`` is the form with a given capacity: shards open as needed, as few as
best fit decreasing finds.  Groups are dealt by hash into parts of bounded size, each
packed in one task; shards that are not nearly full go through another
round, as units, until one part is left or ``ROUNDS`` have passed.  Nothing of it
passes through the driver, whatever the number of shards.

Law ``bytes``: the smallest capacity is searched at which the units fit into
the wanted number of shards.  A group larger than an even share makes its
shard as much larger; groups stay whole in every case.

Defined cases: null and empty texts are groups of their own of size 1 a row;
rows with null ``doc_id`` and repeated rows count and get slots like others;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, read_table, ship_package

#: units per shard that the packing sees at most (large groups), and hash bundles of small groups per shard
GRAIN, BUNDLES = 1024, 512
#: rows that share one slot counter at most on average, and counters per shard at least
SLOT_ROWS, SLOT_CHUNKS = 50_000, 32


class CapacityTree:
    """Balanced (AVL) tree of bins ordered by (remaining capacity, bin)."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None                                  # node: [key, left, right, height]

    @staticmethod
    def _height(n):
        return n[3] if n else 0

    def _fix(self, n):
        n[3] = 1 + max(self._height(n[1]), self._height(n[2]))
        lean = self._height(n[1]) - self._height(n[2])
        if lean > 1:
            if self._height(n[1][1]) < self._height(n[1][2]):
                n[1] = self._turn(n[1], 2)
            return self._turn(n, 1)
        if lean < -1:
            if self._height(n[2][2]) < self._height(n[2][1]):
                n[2] = self._turn(n[2], 1)
            return self._turn(n, 2)
        return n

    def _turn(self, n, side):
        """Rotate the child on ``side`` up."""
        up, other = n[side], 3 - side
        n[side], up[other] = up[other], n
        for x in (n, up):
            x[3] = 1 + max(self._height(x[1]), self._height(x[2]))
        return up

    def add(self, key) -> None:
        def put(n):
            if n is None:
                return [key, None, None, 1]
            side = 1 if key < n[0] else 2
            n[side] = put(n[side])
            return self._fix(n)
        self.root = put(self.root)

    def remove(self, key) -> None:
        def drop(n, k):
            if k != n[0]:
                side = 1 if k < n[0] else 2
                n[side] = drop(n[side], k)
                return self._fix(n)
            if n[1] is None or n[2] is None:
                return n[1] or n[2]
            least = n[2]
            while least[1] is not None:
                least = least[1]
            n[0] = least[0]
            n[2] = drop(n[2], least[0])
            return self._fix(n)
        self.root = drop(self.root, key)

    def tightest(self, size: int):
        """Smallest key with remaining capacity >= size, or None."""
        n, best = self.root, None
        while n is not None:
            if n[0][0] >= size:
                best, n = n[0], n[1]
            else:
                n = n[2]
        return best


def best_fit_decreasing(sizes: list[int], capacity: int, max_bins: int | None = None) -> list[int] | None:
    """Bin of every item (bins open as needed); None if more than ``max_bins`` would be needed.

    Items above the capacity raise ValueError: they are indivisible.
    """
    if sizes and max(sizes) > capacity:
        raise ValueError("a group is larger than the capacity")
    tree, out, bins = CapacityTree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        key = tree.tightest(sizes[i])
        if key is None:
            if max_bins is not None and bins == max_bins:
                return None
            key = (capacity, bins)
            bins += 1
        else:
            tree.remove(key)
        out[i] = key[1]
        tree.add((key[0] - sizes[i], key[1]))
    return out


def pack_evenly(sizes: list[int], shards: int) -> list[int]:
    """Best fit decreasing into ``shards`` bins at the smallest capacity found by bisection."""
    if not sizes:
        return []
    low = max(max(sizes), -(-sum(sizes) // shards))
    found = best_fit_decreasing(sizes, low, shards)
    if found is not None:
        return found
    step = 1
    while (found := best_fit_decreasing(sizes, low + step, shards)) is None:
        step *= 2
    low, high = low + step // 2, low + step                # low fails, high fits
    while high - low > 1:
        middle = (low + high) // 2
        tried = best_fit_decreasing(sizes, middle, shards)
        if tried is None:
            low = middle
        else:
            high, found = middle, tried
    return found


def assign_shards(rows: DataFrame, shards: int, group: str = "group_key", size: str = "size") -> DataFrame:
    """``rows`` plus ``shard``; rows of a group share a shard, bytes are near equal.

    ``rows`` is read twice: pass a table that is cheap to read.
    """
    spark = rows.sparkSession
    groups = rows.groupBy(group).agg(F.sum(size).alias("bytes"))
    total = int(rows.agg(F.sum(size)).first()[0] or 0)
    limit = max(1, total // (shards * GRAIN))
    n_bundles = shards * BUNDLES
    bundle = F.pmod(F.xxhash64(group, F.lit("bundle")), F.lit(n_bundles)).cast("int")
    units = (groups.withColumn("big", F.when(F.col("bytes") >= limit, F.col(group)))
             .withColumn("bundle", F.when(F.col("big").isNull(), bundle))
             .groupBy("big", "bundle").agg(F.sum("bytes").alias("bytes")))
    found = sorted(units.collect(), key=lambda r: (-r["bytes"], r["bundle"] is None, r["bundle"] or 0, bytes(r["big"] or b"")))
    bins = pack_evenly([r["bytes"] for r in found], shards)
    schema = T.StructType([T.StructField("big", T.BinaryType()), T.StructField("bundle", T.IntegerType()),
                           T.StructField("shard", T.IntegerType())])
    table = spark.createDataFrame([(r["big"], r["bundle"], b) for r, b in zip(found, bins, strict=True)], schema)
    # at most shards * (GRAIN + BUNDLES) rows, by construction
    big = F.broadcast(table.filter("big is not null").select(F.col("big").alias(group), F.col("shard").alias("_big_shard")))
    small = F.broadcast(table.filter("big is null").select(F.col("bundle").alias("_bundle"),
                                                          F.col("shard").alias("_small_shard")))
    return (rows.join(big, group, "left").withColumn("_bundle", bundle).join(small, "_bundle", "left")
            .withColumn("shard", F.coalesce("_big_shard", "_small_shard"))
            .drop("_bundle", "_big_shard", "_small_shard"))


#: groups packed in one task, rounds, and the share of the capacity above which a shard is full
PART_UNITS, ROUNDS, FULL = 100_000, 3, 0.98


def _pack_part(capacity: int, round_: int):
    """Units of a part, largest first -> (unit, bin, filled): best fit decreasing, part by part."""
    def scan(batches):
        part, tree, bins, rows, filled = None, None, 0, [], []

        def done():
            return pd.DataFrame({"unit": [u for u, _ in rows], "bin": [f"{round_}:{part}:{b}".encode() for _, b in rows],
                                 "filled": [filled[b] for _, b in rows]})

        for batch in batches:
            for p, unit, size in zip(batch["part"].tolist(), batch["unit"], batch["bytes"].tolist(), strict=True):
                if p != part:
                    if rows:
                        yield done()
                    part, tree, bins, rows, filled = p, CapacityTree(), 0, [], []
                key = tree.tightest(size)
                if key is None:
                    key = (max(capacity, size), bins)      # a group above the capacity has a shard of its own
                    bins += 1
                    filled.append(0)
                else:
                    tree.remove(key)
                rows.append((unit, key[1]))
                filled[key[1]] += size
                tree.add((key[0] - size, key[1]))
        if rows:
            yield done()

    return scan


def pack_capacity(rows: DataFrame, capacity: int, group: str = "group_key", size: str = "size",
                  part_units: int = PART_UNITS) -> DataFrame:
    """``rows`` plus ``shard`` (0, 1, 2, ...): as few shards of at most ``capacity`` as best fit decreasing needs.

    ``group`` is binary; rows of a group share a shard, and a group above the capacity has one of its
    own.  With up to ``part_units`` groups the packing is that of ``best_fit_decreasing``; beyond, a part can
    leave one shard half empty, which the next round fills with those of other parts.
    """
    ship_package(rows.sparkSession)
    units = cut(rows.groupBy(group).agg(F.sum(size).alias("bytes")).select(F.col(group).alias("unit"), "bytes"))
    placed = units.select(F.col("unit").alias("_group"), F.col("unit").alias("_bin"))
    n = units.count()
    for round_ in range(ROUNDS):
        parts = max(1, -(-n // part_units))
        dealt = units.withColumn("part", F.pmod(F.xxhash64("unit", F.lit(round_)), F.lit(parts)).cast("int"))
        packed = cut(dealt.repartition(parts, "part").sortWithinPartitions("part", F.desc("bytes"), "unit")
                     .mapInPandas(_pack_part(capacity, round_), "unit binary, bin binary, filled bigint"))
        placed = placed.join(packed.select(F.col("unit").alias("_bin"), "bin"), "_bin", "left") \
            .select("_group", F.coalesce("bin", "_bin").alias("_bin"))
        if parts == 1:
            break
        units = cut(packed.groupBy("bin").agg(F.max("filled").alias("bytes")).filter(F.col("bytes") < FULL * capacity)
                    .select(F.col("bin").alias("unit"), "bytes"))
        n = units.count()
        if not n:
            break
    placed = cut(placed)
    bins = placed.select("_bin").distinct()
    chunks = max(1, bins.count() // SLOT_ROWS)
    chunked = bins.withColumn("_chunk", F.pmod(F.xxhash64("_bin"), F.lit(chunks)))
    counts = chunked.groupBy("_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)   # a row a chunk
    starts = counts.select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    numbers = chunked.withColumn("_at", F.row_number().over(Window.partitionBy("_chunk").orderBy("_bin"))) \
        .join(starts, "_chunk").select("_bin", (F.col("_first") + F.col("_at") - 1).cast("bigint").alias("shard"))
    return rows.join(placed.join(numbers, "_bin").drop("_bin"), rows[group] == F.col("_group")).drop("_group")


def number_slots(rows: DataFrame, order: list[str], shards: int) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... without gaps in every shard.

    Rows of a shard are dealt over chunks by hash; chunk counts (a bounded
    number of rows) give each chunk its first slot.
    """
    n = rows.count()
    chunks = max(SLOT_CHUNKS, n // (SLOT_ROWS * shards))
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    counts = dealt.groupBy("shard", "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("shard", "_chunk").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (dealt.withColumn("_row", F.row_number().over(inside)).join(starts, ["shard", "_chunk"])
            .withColumn("slot", (F.col("_first") + F.col("_row") - 1).cast("bigint"))
            .drop("_chunk", "_row", "_first"))


def shard_documents(df: DataFrame, shards: int = 8, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    # the text itself goes no further; a null text has a key of its own
    rows = cut(df.select("doc_id", (F.length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"),
                         F.when(F.col(text).isNull(), F.lit(b"null")).otherwise(F.unhex(F.sha2(raw, 256)))
                         .alias("group_key")))
    placed = cut(assign_shards(rows, shards))
    return number_slots(placed, ["doc_id", "text_crc32", "size"], shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2(spark, sf_dir) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
