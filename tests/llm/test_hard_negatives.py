"""Hard negatives against plain integer scores; intervals that always hold the score."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_inputs import hard_dir  # noqa: F401
from shelfcast.llm import hard_negatives as hn
from shelfcast.llm.common import read_table
from shelfcast.llm.queries import QUERIES

LONG = (1 << 63) - 1


def plain(rows, anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    """``rows``: (id, vector, label)."""
    kept = [(i, [math.floor(scale * float(x)) for x in v], int(t)) for i, v, t in rows
            if i is not None and v is not None and t is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {(i, tuple(v), t) for i, v, t in kept if anchor(i)}
    out = []
    for i, v, t in anchors:
        scored = [(-max(-LONG, min(LONG, sum(x * y for x, y in zip(v, w, strict=True)))), j, u) for j, w, u in kept
                  if len(w) == len(v)]
        best = sorted((s, j) for s, j, u in scored if u == t and j != i)[:positives]
        for p, pid in best:
            fits = sorted((s, j) for s, j, u in scored if u != t and low * -p <= 100 * -s <= high * -p)[:negatives]
            out += [(i, pid, k, j, -p, -s) for k, (s, j) in enumerate(fits, 1)]
    return sorted(out)


def mined(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                       "negative_score").collect()))


@pytest.fixture(scope="module")
def vectors():
    rnd = random.Random(8)
    centres = [[rnd.gauss(0, 1) for _ in range(20)] for _ in range(4)]
    rows = []
    for i in range(500):
        c = rnd.choice(centres)
        rows.append((i, [x + rnd.gauss(0, 0.7) for x in c], rnd.randint(0, 3)))
    hot = rows[5][1]
    rows += [(600 + i, hot, i % 4) for i in range(120)]                # one common vector: ties go by id
    rows += [rows[7], rows[7], rows[10], rows[10]]                     # repeated rows, one an anchor
    rows += [(None, hot, 1), (700, None, 1), (710, hot, None), (720, [float("nan")] * 20, 1), (730, [1.0, None] * 10, 1),
             (740, [float("-inf")] * 20, 1), (750, [0.0] * 20, 1), (760, [1.0] * 3, 1), (761, [1.0] * 3, 2), (762, [1.0] * 3, 1),
             (770, [], 1), (771, [], 1), (772, [], 2)]
    return rows


@pytest.mark.parametrize("block_bytes", [16 << 20, 700])
def test_like_plain_scores(spark, vectors, block_bytes):
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>, label int").repartition(5) \
        .withColumn("code", F.lit("x")).withColumn("score", F.lit(1)).withColumn("v", F.lit(None).cast("string"))
    got = hn.mine(df, F.col("vec_id") % 10 == 0, block_bytes=block_bytes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mined(got) == plain(vectors, lambda i: i % 10 == 0)


def test_other_parameters_and_names(spark, vectors):
    df = spark.createDataFrame(vectors, "key bigint, x array<double>, kind int")
    got = hn.mine(df, F.col("key") < 20, "key", "x", "kind", positives=2, negatives=3, low_pct=10, high_pct=60, scale=16)
    assert mined(got) == plain(vectors, lambda i: i < 20, 2, 3, 10, 60, 16)


@pytest.mark.parametrize("dim", [1, 3, 20, 64, 65, 130])
def test_intervals_hold_the_score(dim):
    rng = np.random.default_rng(dim)
    v = np.floor(rng.standard_normal((200, dim)) * rng.choice([1, 50, 5000], (200, 1)))
    v[:3] = 0
    v[3:6] = v[6:9]
    turn = hn.rotation(dim)
    assert np.allclose(turn @ turn.T, np.eye(dim), atol=1e-9)
    code, norm, align = hn.encode(v, turn)
    low, high = hn.Planes(v[:50], turn).interval(slice(0, 50), code, norm, align)
    exact = v[:50] @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    # intervals are no empty promise: they are narrower than Cauchy-Schwarz of the whole vectors
    if dim >= 20:
        assert np.median((high - low) / (2 * norm[:50, None] * norm[None] + 3)) < 0.75


def test_integer_scores_of_any_size():
    for scale in (1.0, 2.0**40, 2.0**80):
        a = np.floor(np.random.default_rng(1).standard_normal((5, 7)) * 100) * scale
        b = np.floor(np.random.default_rng(2).standard_normal((9, 7)) * 100) * scale
        wanted = np.ones((5, 9), bool)
        wanted[2, 3] = False
        got = hn.integer_scores(a, b, wanted)
        for i in range(5):
            for j in range(9):
                exact = sum(int(x) * int(y) for x, y in zip(a[i], b[j], strict=True))
                assert not wanted[i, j] or got[i, j] == max(-LONG, min(LONG, exact))


def test_query_on_whole_and_hard_tables(spark, hard_dir):
    for d in ("/root/testdata/sf0.001", hard_dir):
        rows = []
        for r in read_table(spark, d, "embeddings").collect():
            label = r["label"]
            if label is not None and r["vec_id"] is not None and r["vec_id"] % 7 == 0:
                label = (label + 1) % 10
            rows.append((r["vec_id"], r["embedding"], label))
        assert mined(QUERIES["op12_hard_negatives"](spark, d)) == plain(rows, lambda i: i % 100 == 0)
