"""Phrase collocations against a plain count of every phrase."""

import collections
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_inputs import hard_dir  # noqa: F401
from shelfcast.llm import collocations
from shelfcast.llm.common import read_table
from shelfcast.llm.queries import QUERIES

SMOKE = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, min_count=100, top=2000):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        own = counts["und" if lang is None else lang]
        for piece in re.split(r"[.,;:!?\n\x0b\f\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            for k in range(1, 6):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        equal = set()
        for p, c in own.items():
            if len(p) > 2:
                equal.update(q for q in (p[1:], p[:-1]) if own[q] == c)
        found = []
        for p, a in own.items():
            if len(p) > 1 and a >= min_count and p not in equal:
                score, _, l, r = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]])
                                     for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def mined(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(40)] + ["État", "naïve", "中文", "Mixed"]
    fixed = ["alpha beta gamma delta epsilon", "state of the art", "x x x x", "new york", "ad hoc"]
    rows = []
    for i in range(400):
        words = []
        while len(words) < rnd.randint(0, 60):
            words += rnd.choice(fixed).split() if rnd.random() < 0.2 else [vocabulary[min(int(rnd.expovariate(0.12)), 43)]]
        text = " ".join(w + rnd.choice(["", "", "", ",", ".", "\n", "\t", "  "]) for w in words)
        rows.append((rnd.choice(["en", "en", "de", None, "und"]), text))
    rows += [("en", rows[3][1])] * 60 + [("fr", None), ("fr", ""), (None, " .,; ")]
    return rows


@pytest.mark.parametrize("min_count, top, shares", [(5, 2000, (1 / 16, 1 / 2, 1.0)), (5, 10, (1 / 16, 1 / 2, 1.0)),
                                                    (3, 25, (0.001, 1.0)), (20, 5, (1.0,))])
def test_like_a_plain_count(spark, corpus, min_count, top, shares):
    docs = spark.createDataFrame(corpus, "lang string, text string").repartition(4)
    docs = docs.withColumn("a", F.lit("x")).withColumn("gram", F.lit("y"))       # names that the operator uses itself
    assert mined(collocations.mine(docs, min_count, top, shares)) == plain(corpus, min_count, top)


def test_best_first_leaves_common_words_unexpanded(spark, corpus, monkeypatch):
    """The frontier stops at the bound: common words, whose phrases can't reach the last wanted score, are never expanded."""
    rows = [r for r in corpus if r[0] == "en"]
    limits = []
    real = collocations._limits

    def watched(*args):
        out = real(*args)
        limits.append(out.first()["limit"])
        return out

    monkeypatch.setattr(collocations, "_limits", watched)
    got = mined(collocations.mine(spark.createDataFrame(rows, "lang string, text string"), 5, 3, (0.6, 1.0)))
    assert got == plain(rows, 5, 3)
    counts = collections.Counter(w for _, t in rows for w in re.split(r"[ \t.,\n]+", t or "") if w)
    assert limits == sorted(limits) and limits[-1] < counts.most_common(1)[0][1]
    # every word whose bound reaches the last score was expanded
    assert limits[-1] >= 1000 * got[0][6] // got[-1][7]


def test_query_on_whole_table(spark):
    rows = [(r["lang"], r["text"]) for r in read_table(spark, SMOKE, "documents").select("lang", "text").collect()]
    assert mined(QUERIES["op11_collocations"](spark, SMOKE)) == plain(rows)


def test_hard_rows(spark, hard_dir):
    rows = [(r["lang"], r["text"]) for r in read_table(spark, hard_dir, "documents").collect()]
    assert mined(QUERIES["op11_collocations"](spark, hard_dir)) == plain(rows)
    docs = read_table(spark, hard_dir, "documents")
    assert mined(collocations.mine(docs, 2, 50)) == plain(rows, 2, 50)


def test_scores_beyond_64_bits(spark):
    cases = [(10**13, 10**15, 10**13 + 7, 10**14), (1, 1, 1, 1), (100, 3, 7, 11), (10**16, 10**16, 10**16, 10**16),
             (99_999_999_999, 10**15, 100_000_000_003, 123_456_789_012_345)]
    df = spark.createDataFrame(cases, "a bigint, n bigint, l bigint, r bigint")
    got = df.select("a", "n", "l", "r", collocations.score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r["s"] == 1000 * r["a"] * r["n"] // (r["l"] * r["r"]) for r in got)


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "p q p q p q . r s r s r s")] * 3, "lang string, text string")
    seeds = []
    real = collocations._pack

    def clashing(seed):
        seeds.append(seed)
        if seed:
            return real(seed)

        def pack(batches):
            for out in real(seed)(batches):
                if out["kind"][0].as_py() == "words":
                    out = out.set_column(3, "gram", pa.array([b"12345678"] * len(out), pa.binary()))
                yield out
        return pack

    monkeypatch.setattr(collocations, "_pack", clashing)
    assert mined(collocations.mine(docs, 2, 10)) == plain([("en", "p q p q p q . r s r s r s")] * 3, 2, 10)
    assert seeds == [0, 1]


def test_bitmap_has_no_misses(spark):
    grams = [random.Random(4).randbytes(16) for _ in range(3000)]
    found = collocations.bitmap(spark.createDataFrame([("en", g) for g in grams], "lang string, gram binary"), 3000)
    import numpy as np
    columns = list(np.frombuffer(b"".join(grams), np.uint64).reshape(-1, 2).T)
    assert found.has(collocations._sequence_hash(columns, "en")).all()
    assert found.has(collocations._sequence_hash(columns, "de")).mean() < 0.2
