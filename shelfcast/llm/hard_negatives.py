"""Hard-negative mining with rotated one-bit codes and deterministic residual intervals.

Vectors become integers, ``floor(scale * x)``.  The index keeps for every row its
integer vector o, the signs of the rotated vector R o (one bit a dimension),
the norm |o| and the alignment a = <c, R o> / |o| with the unit code vector
c = sign(R o) / sqrt(d).  With R o = |o| (a c + sqrt(1 - a^2) e), e a unit vector
orthogonal to c, the score with an anchor q is

    <o, q> = |o| a <c, R q> + |o| sqrt(1 - a^2) <e, R q>,

and by Cauchy-Schwarz ``|<e, R q>| <= sqrt(|q|^2 - <c, R q>^2)``.  The anchor's rotated
vector is quantised to a few bits a dimension, so <c, R q> is a sum of popcounts
of code bits and bit planes; the quantisation error d adds |o| |d|.  That interval
holds the true score without any chance of error.  Rows whose interval can't reach
the list that is wanted are dropped, the others are scored in integers.

Anchors are taken in blocks of bounded bytes.  For a block, every task reads its
part of the index once, against all anchors of the block, and returns only
the best rows of each anchor, so nothing but short lists is shuffled.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part; an empty vector scores 0; vectors of different
lengths are not compared; repeated rows are rows of their own, but a row with
the anchor's id is not among its positives, and equal anchor rows count once;
scores beyond 64 bits are held at the limits of a long; equal scores go by the smaller
id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, read_table, ship_package

#: bits of a quantised anchor component
PLANES = 6
#: bytes of the integer vectors of one block of anchors, at most
BLOCK_BYTES = 16 << 20
#: anchors and rows that are compared at a time in a task
ANCHOR_STEP, ROW_STEP = 512, 2048
_LONG = (1 << 63) - 1
INDEX = "vec_id bigint, label bigint, dim int, v binary, code binary, norm double, align double"
FOUND = "a bigint, list int, id bigint, score bigint"


def rotation(dim: int) -> np.ndarray:
    """The fixed random rotation of ``dim`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(v: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (uint64 words), norms and alignments of the rows of ``v``."""
    n, dim = v.shape
    norm = np.sqrt((v * v).sum(axis=1))
    turned = v @ turn.T
    bits = turned >= 0
    with np.errstate(invalid="ignore", divide="ignore"):
        align = np.where(norm > 0, np.abs(turned).sum(axis=1) / (np.sqrt(max(dim, 1)) * norm), 1.0)
    padded = np.zeros((n, -(-dim // 64) * 64), dtype=np.uint8)
    padded[:, :dim] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64).reshape(n, -1), norm, np.minimum(align, 1.0)


class Planes:
    """Rotated anchors in bit planes: estimates of <c, R q> by popcounts."""

    def __init__(self, v: np.ndarray, turn: np.ndarray):
        turned = v @ turn.T
        self.dim = v.shape[1]
        low, high = (f(turned, axis=1) if self.dim else np.zeros(len(v)) for f in (np.min, np.max))
        step = np.maximum((high - low) / ((1 << PLANES) - 1), 1e-300)
        level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        near = low[:, None] + step[:, None] * level
        padded = np.zeros((len(v), -(-self.dim // 64) * 64), dtype=np.int64)
        padded[:, :self.dim] = level
        self.planes = [np.packbits((padded >> j & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
                       .reshape(len(v), -1) for j in range(PLANES)]
        self.low, self.step, self.total = low, step, near.sum(axis=1)
        self.norm = np.sqrt((near * near).sum(axis=1))
        self.error = np.sqrt(((turned - near) ** 2).sum(axis=1))
        self.exact_norm = np.sqrt((v * v).sum(axis=1))

    def interval(self, part: slice, code: np.ndarray, norm: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the score of every anchor of ``part`` with every row."""
        levels = np.zeros((len(self.low[part]), len(code)))
        for w in range(code.shape[1]):
            for j, plane in enumerate(self.planes):
                levels += np.bitwise_count(plane[part, w][:, None] & code[:, w][None]) * float(1 << j)
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        along = (2 * (self.low[part][:, None] * ones + self.step[part][:, None] * levels)
                 - self.total[part][:, None]) / np.sqrt(max(self.dim, 1))
        middle = (norm * align) * along
        rest = norm * np.sqrt(1 - align * align)
        half = rest * np.sqrt(np.maximum(self.norm[part][:, None] ** 2 - along * along, 0)) + norm * self.error[part][:, None]
        half += 1 + 1e-9 * norm * self.exact_norm[part][:, None]       # rounding of the floats above
        return middle - half, middle + half


def integer_scores(a: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Exact inner products (long) where ``wanted``, other cells are undefined."""
    out = np.zeros(wanted.shape, dtype=np.int64)
    if not wanted.any():
        return out
    use_a, use_r = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    x, y = a[use_a], rows[use_r]
    size = np.sqrt((x * x).sum(axis=1).max()) * np.sqrt((y * y).sum(axis=1).max()) * 1.001
    if size < 1 << 53:                                                 # sums of integers below 2**53: floats are exact
        found = (x @ y.T).astype(np.int64)
    elif size < 1 << 62 and max(np.abs(x).max(), np.abs(y).max()) < 1 << 62:
        found = x.astype(np.int64) @ y.astype(np.int64).T
    else:
        exact = [[int(c) for c in r] for r in x], [[int(c) for c in r] for r in y]
        found = np.array([[max(-_LONG, min(_LONG, sum(i * j for i, j in zip(p, q, strict=True)))) for q in exact[1]]
                          for p in exact[0]], dtype=np.int64)
    out[np.ix_(use_a, use_r)] = found
    return out


class Best:
    """The ``k`` best (score, then smaller id) of every anchor so far, as flat arrays."""

    def __init__(self, anchors: int, k: int):
        self.k, self.anchors = k, anchors
        self.a = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.least = np.full(anchors, -np.inf)                         # score of the k-th, if there are k

    def add(self, start: int, scores: np.ndarray, wanted: np.ndarray, ids: np.ndarray) -> None:
        if scores.shape[1] > self.k:
            held = np.where(wanted, scores, -_LONG - 1)
            edge = np.partition(held, -self.k, axis=1)[:, -self.k]
            wanted = wanted & (scores >= edge[:, None])
        a, r = np.nonzero(wanted)
        if not len(a):
            return
        a_all = np.concatenate([self.a, a + start])
        id_all = np.concatenate([self.id, ids[r]])
        score_all = np.concatenate([self.score, scores[a, r]])
        order = np.lexsort((id_all, ~score_all, a_all))                # ~x falls as x rises and can't overflow
        a_all, id_all, score_all = a_all[order], id_all[order], score_all[order]
        first = np.searchsorted(a_all, a_all, side="left")
        place = np.arange(len(a_all)) - first
        keep = place < self.k
        self.a, self.id, self.score = a_all[keep], id_all[keep], score_all[keep]
        last = place[keep] == self.k - 1
        self.least[self.a[last]] = self.score[last]


def _rows(batch: pd.DataFrame, dim: int):
    """Columns of the index rows of one length, in steps."""
    batch = batch[batch["dim"] == dim]
    for at in range(0, len(batch), ROW_STEP):
        part = batch.iloc[at:at + ROW_STEP]
        n = len(part)
        yield (part["vec_id"].to_numpy(np.int64), part["label"].to_numpy(np.int64),
               np.frombuffer(b"".join(part["v"]), dtype=np.float64).reshape(n, dim),
               np.frombuffer(b"".join(part["code"]), dtype=np.uint64).reshape(n, -1),
               part["norm"].to_numpy(np.float64), part["align"].to_numpy(np.float64))


class AnchorBlock:
    """Anchors of one block, grouped by the length of their vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]):
        self.ids, self.labels = ids, labels
        dims = np.array([len(v) for v in vectors], dtype=np.int64)
        self.by_dim = {int(d): np.flatnonzero(dims == d) for d in np.unique(dims)}
        self.vectors = {d: np.array([vectors[i] for i in at]).reshape(len(at), d) for d, at in self.by_dim.items()}

    def start(self):
        self.planes = {d: Planes(v, rotation(d)) for d, v in self.vectors.items()}

    def scan(self, batches, k: int, bounds):
        """Best rows by the lists that ``bounds`` gives: for a step of anchors, (list number, eligible, low, high)."""
        self.start()
        best: dict[tuple[int, int], Best] = {}
        for batch in batches:
            for d, at in self.by_dim.items():
                for ids, labels, v, code, norm, align in _rows(batch, d):
                    for s in range(0, len(at), ANCHOR_STEP):
                        part = slice(s, min(s + ANCHOR_STEP, len(at)))
                        lower, upper = self.planes[d].interval(part, code, norm, align)
                        lists = []
                        for number, eligible, low, high in bounds(at[part], ids, labels):
                            kept = best.setdefault((d, number), Best(len(at), k))
                            # scores are held at the limits of a long, their intervals are not
                            reach = np.maximum(np.where(low <= -_LONG, -np.inf, low), kept.least[part])
                            reach = np.where(reach >= _LONG, float(1 << 62), reach)
                            limit = np.where(high >= _LONG, np.inf, high)
                            lists.append((kept, eligible & (upper >= reach[:, None]) & (lower <= limit[:, None]), low, high))
                        wanted = np.logical_or.reduce([x[1] for x in lists])
                        scores = integer_scores(self.vectors[d][part], v, wanted)
                        for kept, open_, low, high in lists:
                            kept.add(s, scores, open_ & (scores >= low[:, None]) & (scores <= high[:, None]), ids)
        for (d, number), kept in best.items():
            yield pd.DataFrame({"a": self.by_dim[d][kept.a], "list": np.int32(number), "id": kept.id, "score": kept.score})


def index(df: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """The index rows of ``df`` (see ``INDEX``)."""
    ship_package(df.sparkSession)

    def build(batches):
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                v = np.array(part["v"].tolist(), dtype=np.float64).reshape(len(part), dim)
                v = np.floor(scale * v) + 0.0
                code, norm, align = encode(v, rotation(dim))
                yield pd.DataFrame({"vec_id": part["i"], "label": part["l"], "dim": np.int32(dim),
                                    "v": [r.tobytes() for r in v], "code": [r.tobytes() for r in code],
                                    "norm": norm, "align": align})

    rows = df.select(F.col(vec_id).cast("bigint").alias("i"), F.col(label).cast("bigint").alias("l"),
                     F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("i").isNotNull() & F.col("l").isNotNull() & F.col("v").isNotNull() & finite) \
        .mapInPandas(build, INDEX)


def _limits(positive: np.ndarray, low_pct: int, high_pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest negative score for each positive score (nothing fits where there is no positive)."""
    low, high = np.full(positive.shape, _LONG), np.full(positive.shape, -_LONG)
    for at, p in np.ndenumerate(positive):
        if p is not None:
            low[at] = max(-_LONG, min(_LONG, -((-low_pct * int(p)) // 100)))
            high[at] = max(-_LONG, min(_LONG, (high_pct * int(p)) // 100))
    return low, high


def mine(df: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 10, low_pct: int = 30, high_pct: int = 90, scale: int = 256,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` (a condition over ``vec_id``) names.

    An anchor's positives are its ``positives`` best other rows of the same label;
    for each, the ``negatives`` best rows of other labels with
    ``low_pct * positive_score <= 100 * negative_score <= high_pct * positive_score``.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/hard-negatives-{uuid.uuid4().hex}"
    index(df, vec_id, vector, label, scale).write.parquet(f"{folder}/index")
    rows = spark.read.schema(INDEX).parquet(f"{folder}/index")
    asked = rows.select("vec_id", "label", "dim", "v").withColumnRenamed("vec_id", vec_id).filter(anchors) \
        .withColumnRenamed(vec_id, "vec_id").distinct()
    n, widest = asked.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(0))).first()
    blocks = max(1, -(-n * 8 * max(widest, 1) // block_bytes))
    out = None
    for b in range(blocks):
        held = asked.filter(F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)) == b).toPandas()
        block = AnchorBlock(held["vec_id"].to_numpy(np.int64), held["label"].to_numpy(np.int64),
                            [np.frombuffer(v, dtype=np.float64) for v in held["v"]])
        found = _mine_block(rows, block, positives, negatives, low_pct, high_pct, f"{folder}/{b}")
        out = found if out is None else out.union(found)
    return out


def _mine_block(rows: DataFrame, block: AnchorBlock, positives: int, negatives: int, low_pct: int, high_pct: int,
                path: str) -> DataFrame:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(block)

    def same_label(batches):
        own = shared.value

        def bounds(at, ids, labels):
            eligible = (own.labels[at][:, None] == labels[None]) & (own.ids[at][:, None] != ids[None])
            return [(0, eligible, np.full(len(at), -_LONG), np.full(len(at), _LONG))]

        yield from own.scan(batches, positives, bounds)

    def ranked(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("a", "list").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    best = ranked(rows.mapInPandas(same_label, FOUND), positives).toPandas()
    score = np.full((len(block.ids), positives), None, dtype=object)
    for a, rank, s in zip(best["a"], best["rank"], best["score"], strict=True):
        score[a, rank - 1] = s
    limits = spark.sparkContext.broadcast(_limits(score, low_pct, high_pct))

    def other_label(batches):
        own, (low, high) = shared.value, limits.value

        def bounds(at, ids, labels):
            other = own.labels[at][:, None] != labels[None]
            return [(p, other, low[at, p], high[at, p]) for p in range(positives)]

        yield from own.scan(batches, negatives, bounds)

    # at most BLOCK_BYTES of anchors, so a bounded number of their positives
    names = pd.DataFrame({"a": best["a"].astype("int64"), "list": (best["rank"] - 1).astype("int32"),
                          "anchor_id": block.ids[best["a"].to_numpy(np.int64)],
                          "positive_id": best["id"].astype("int64"), "positive_score": best["score"].astype("int64")})
    names = spark.createDataFrame(names, "a bigint, list int, anchor_id bigint, positive_id bigint, positive_score bigint")
    mined = ranked(rows.mapInPandas(other_label, FOUND), negatives)
    mined.join(F.broadcast(names), ["a", "list"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score")).write.parquet(path)
    return spark.read.parquet(path)


def op12(spark, sf_dir) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE = """
with kept as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same,
         list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2]))::bigint as score
  from kept a join kept r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
), mined as (
  select anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by score desc, id) as rank
  from positives join scored using (anchor_id)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from mined where rank <= 10
"""
