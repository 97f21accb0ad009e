"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: XXH64 (seed 42) of every 3-word shingle, a bit is 1 if set in
over half of the hashes.  Two fingerprints link at ``max_bits`` or fewer
differing bits; linked documents form groups.

Candidate search over *distinct* fingerprints (a group of equal ones, however
large, is one row):

* bits are grouped into ``parts`` partitions, correlated bits together;
* per fingerprint, thresholds t_1..t_m of at least -1 with sum
  ``max_bits - parts + 1`` are chosen by dynamic programming on the estimated
  number of candidates.  A fingerprint within ``max_bits`` differs by at most
  t_i in some partition i, because otherwise the distances add up to more;
* each partition value within its threshold is probed by an equality join
  with the index (partition, value), and each candidate is verified.

Estimates come from bounded statistics over all fingerprints: the 64 x 64
counts of common bits and one histogram of at most 2**11 cells per half
partition.  Groups are connected components by alternating star contraction
(every round is one aggregation and one join, cut through the checkpoint
folder until the edges stand still).

Defined cases: null and empty texts have no words and the fingerprint 0,
linked like any other; texts of one or two words hash their whole sequence;
null ``doc_id`` rows get the group's smallest ``doc_id`` (null if it has none);
repeated rows stay; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hex64, read_table, ship_package

SHINGLE, MAX_BITS = 3, 2


# ---------------------------------------------------------------- fingerprints

def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z only; ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], dtype=np.uint64)
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = np.fromiter((digest(join(gram), 42) for gram in zip(*(words[i:] for i in range(shingle)), strict=False)),
                             dtype=np.uint64, count=len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i:i + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Input columns plus ``fp`` (long)."""
    ship_package(df.sparkSession)

    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.withColumn("fp", simhash(F.col(text)))


# ---------------------------------------------------------------- partitions

def _common_bits(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for every two bits, how many have both (64 x 64 numbers)."""
    def count(batches):
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            bits = np.unpackbits(batch["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.float64)
            n += len(bits)
        cells = total.astype(np.int64).ravel()
        yield pd.DataFrame({"cell": np.arange(4097), "c": np.append(cells, n)})

    sums = distinct.mapInPandas(count, "cell bigint, c bigint").groupBy("cell").agg(F.sum("c").alias("c")).collect()
    flat = np.zeros(4097)
    for r in sums:
        flat[r["cell"]] = r["c"]
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def group_bits(n: int, common: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` partitions of about equal width, each grown by the bit most correlated with it."""
    share = common / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        seed = max(free, key=lambda b: (corr[b, free].max(), -b))
        chosen = [seed]
        free.remove(seed)
        while len(chosen) < width:
            best = max(free, key=lambda b: (corr[b, chosen].mean(), -b))
            chosen.append(best)
            free.remove(best)
        out.append(sorted(chosen))
    return out


def extract(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint, packed."""
    out = np.zeros(len(fps), dtype=np.int64)
    for i, b in enumerate(bits):
        out |= ((fps >> np.int64(b)) & np.int64(1)) << np.int64(i)
    return out


def _halves(part: list[int]) -> list[list[int]]:
    """Sub-partitions of at most 11 bits."""
    pieces = -(-len(part) // 11)
    return [part[i * len(part) // pieces:(i + 1) * len(part) // pieces] for i in range(pieces)]


def _histograms(distinct: DataFrame, layout: list[list[int]]) -> dict[int, np.ndarray]:
    pieces = [h for part in layout for h in _halves(part)]

    def count(batches):
        totals = [np.zeros(1 << len(h), dtype=np.int64) for h in pieces]
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for total, h in zip(totals, pieces, strict=True):
                total += np.bincount(extract(fps, h), minlength=len(total))
        for i, total in enumerate(totals):
            at = np.flatnonzero(total)
            yield pd.DataFrame({"piece": i, "value": at, "c": total[at]})

    rows = distinct.mapInPandas(count, "piece int, value bigint, c bigint").groupBy("piece", "value").agg(
        F.sum("c").alias("c")).collect()
    out = {i: np.zeros(1 << len(h)) for i, h in enumerate(pieces)}
    for r in rows:
        out[r["piece"]][r["value"]] = r["c"]
    return out


def _around(histogram: np.ndarray, max_bits: int) -> np.ndarray:
    """Row e, column v: how many fingerprints are at distance e from value v."""
    values = np.arange(len(histogram))
    width = len(histogram).bit_length() - 1
    rows = []
    for e in range(max_bits + 1):
        total = np.zeros(len(histogram))
        for flips in combinations(range(width), e):
            total += histogram[values ^ sum(1 << b for b in flips)]
        rows.append(total)
    return np.array(rows)


def estimated_candidates(fps: np.ndarray, n: int, part: list[int], around: list[np.ndarray], max_bits: int) -> np.ndarray:
    """Row e, column i: estimated fingerprints within e bits of fps[i] in this partition (its pieces as independent)."""
    exact = np.zeros((max_bits + 1, len(fps)))
    exact[0] = 1.0
    for piece, table in zip(_halves(part), around, strict=True):
        share = table[:, extract(fps, piece)] / max(n, 1)
        mixed = np.zeros_like(exact)
        for a in range(max_bits + 1):
            for b in range(max_bits + 1 - a):
                mixed[a + b] += exact[a] * share[b]
        exact = mixed
    return np.cumsum(exact, axis=0) * n


def allocate(cost: np.ndarray, total: int) -> np.ndarray:
    """Thresholds of the least summed cost, by dynamic programming over partitions.

    ``cost[i, e + 1, q]`` is the cost of threshold e >= -1 in partition i for
    query q; thresholds of a query sum to ``total``.
    """
    parts, levels, n = cost.shape
    lowest, highest = -parts, parts * (levels - 2)
    best = np.full((parts + 1, highest - lowest + 1, n), np.inf)
    choice = np.zeros((parts, highest - lowest + 1, n), dtype=np.int8)
    best[0, -lowest] = 0
    for i in range(parts):
        for s in range(lowest, highest + 1):
            for e in range(-1, levels - 1):
                if lowest <= s - e <= highest:
                    c = best[i, s - e - lowest] + cost[i, e + 1]
                    better = c < best[i + 1, s - lowest]
                    best[i + 1, s - lowest][better] = c[better]
                    choice[i, s - lowest][better] = e
    out = np.zeros((parts, n), dtype=np.int64)
    left = np.full(n, total)
    for i in range(parts - 1, -1, -1):
        out[i] = choice[i, left - lowest, np.arange(n)]
        left = left - out[i]
    return out


def choose_parts(n: int, max_bits: int) -> int:
    """Few wide partitions for many fingerprints: a partition value should be shared by few of them."""
    for parts in range(max_bits + 1, 1, -1):
        if n / float(1 << (64 // parts)) <= 64:
            return parts
    return 2


# ---------------------------------------------------------------- links

def links(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """Pairs (``a`` < ``b``) of distinct fingerprints at most ``max_bits`` apart, each once."""
    ship_package(distinct.sparkSession)
    n, common = _common_bits(distinct)
    parts = parts or choose_parts(n, max_bits)
    layout = group_bits(n, common, parts)
    tables = [_around(h, max_bits) for _, h in sorted(_histograms(distinct, layout).items())]
    around, at = [], 0
    for part in layout:
        around.append(tables[at:at + len(_halves(part))])
        at += len(_halves(part))
    masks = [[[sum(1 << b for b in flips) for flips in combinations(range(len(part)), e)] for e in range(max_bits + 1)]
             for part in layout]

    def index(batches):
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for i, part in enumerate(layout):
                yield pd.DataFrame({"part": np.int32(i), "value": extract(fps, part), "b": fps})

    def probe(batches):
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            if not len(fps):
                continue
            cost = np.zeros((parts, max_bits + 2, len(fps)))
            for i, part in enumerate(layout):
                probes = np.cumsum([len(m) for m in masks[i]])[:, None]
                cost[i, 1:] = estimated_candidates(fps, n, part, around[i], max_bits) + probes
            thresholds = allocate(cost, max_bits - parts + 1)
            for i, part in enumerate(layout):
                values = extract(fps, part)
                for e in range(max_bits + 1):
                    chosen = thresholds[i] >= e
                    for mask in masks[i][e] if chosen.any() else ():
                        yield pd.DataFrame({"part": np.int32(i), "value": values[chosen] ^ mask, "a": fps[chosen]})

    indexed = distinct.mapInPandas(index, "part int, value bigint, b bigint")
    probes = distinct.mapInPandas(probe, "part int, value bigint, a bigint")
    # every pair is found from both sides: the smaller one's probe is enough
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return probes.join(indexed, ["part", "value"]).filter(close).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) of every node of the edges (``a``, ``b``); root is the smallest node reachable."""
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b"))
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = None
    while True:
        # large star: every node's larger neighbours move to its smallest neighbour
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: every node's smaller neighbours move to the smallest of them
        least = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        joined = large.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
        small = joined.filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")) \
            .union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()
        edges = cut(small)
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")) \
        .union(edges.select(F.col("a"), F.col("a")).distinct())


def near_duplicates(df: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``doc_id``, ``text_hash`` (xxhash64 of the text), ``fp``, ``group_fp``, ``component_id``."""
    rows = cut(fingerprints(df.select("doc_id", F.col(text).alias("_n_text")), "_n_text", shingle)
               .select("doc_id", F.xxhash64("_n_text").alias("text_hash"), "fp"))
    holders = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")))
    roots = components(links(holders.select("fp"), max_bits))
    grouped = holders.join(roots, holders["fp"] == roots["node"], "left") \
        .select("fp", "smallest", F.coalesce("root", "fp").alias("group_fp"))
    least = grouped.groupBy("group_fp").agg(F.min("smallest").alias("component_id"))
    labels = cut(grouped.join(least, "group_fp").select("fp", "group_fp", "component_id"))
    return rows.join(labels, "fp").select("doc_id", "text_hash", "fp", "group_fp", "component_id")


def keep_one(df: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, with the columns of ``df``: the smallest (doc_id, text hash), repeated rows once."""
    tagged = near_duplicates(df, text, shingle, max_bits)
    # rows without doc_id come last
    first = tagged.groupBy("group_fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
                                           .alias("k"))
    winners = first.select(F.col("k.doc_id").alias("_k_id"), F.col("k.text_hash").alias("_k_hash"))
    hashed = df.withColumn("_hash", F.xxhash64(text))
    kept = hashed.join(winners, hashed["doc_id"].eqNullSafe(winners["_k_id"]) & (F.col("_hash") == F.col("_k_hash")),
                       "left_semi")
    return kept.dropDuplicates(["doc_id", "_hash"]).drop("_hash")


def op3(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")
