"""Removal of long repeats against plain window sets; the transform against sorted suffixes."""

import hashlib
import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_inputs import hard_dir  # noqa: F401
from shelfcast.llm import suffix_dedup as sd
from shelfcast.llm.common import read_table
from shelfcast.llm.queries import QUERIES


def plain(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of what is left) of every (doc_id, text)."""
    first = {}
    order = lambda i: sd.NO_ID if i is None else i
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for at in range(len(b) - length + 1):
            w = b[at:at + length]
            first[w] = min(first.get(w, sd.NO_ID), order(i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for at in range(len(b) - length + 1):
            if first[b[at:at + length]] < order(i):
                gone[at:at + length] = b"\1" * length
        spans = sum(1 for at in range(len(b)) if gone[at] and not (at and gone[at - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["starts"]), hashlib.sha256(r["kept"]).hexdigest())
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("alphabet", [b"ab", b"abcxyz\x00\xf4"])
def test_transform_sorts_the_suffixes(alphabet):
    rnd = random.Random(len(alphabet))
    for trial in range(150):
        strings = [bytes(rnd.choice(alphabet) for _ in range(rnd.randint(trial % 2, 40))) for _ in range(rnd.randint(1, 12))]
        bwt, lcp = sd.collection_transform(strings)
        string, offset = sd.suffix_places(bwt, np.array([len(s) for s in strings]))
        # ends of strings come first, in the order of the strings: equal suffixes go by their string
        want = sorted((tuple(s[i:]), n) for n, s in enumerate(strings) for i in range(len(s) + 1))
        got = [(tuple(strings[n][i:]), n) for n, i in zip(string, offset, strict=True)]
        assert got == want
        assert [strings[n][i - 1] if i else sd.START for n, i in zip(string, offset, strict=True)] == bwt.tolist()
        common = [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                  for (a, _), (b, _) in zip(got, got[1:])]
        assert common == lcp[1:-1].tolist()


def test_runs_hold_each_window_once():
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"abcd ") for _ in range(n)) for n in (0, 49, 50, 51, 300, 4000)] + [b"x" * 5000, b"ab" * 900]
    windows = {}
    for data, text, place, start, n, key, _ in sd.batch_runs(texts, 50):
        assert (n <= 35).all()
        for t, p, s, k, c in zip(text, place, start, n, key, strict=True):
            assert data[s:s + k + 49] == texts[t][p:p + k + 49]
            for j in range(k):
                assert (t, p + j) not in windows
                windows[t, p + j] = c
    assert set(windows) == {(t, p) for t, x in enumerate(texts) for p in range(len(x) - 49)}
    by_content = {}
    for (t, p), key in windows.items():                               # equal windows have equal keys
        assert by_content.setdefault(texts[t][p:p + 50], key) == key


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (9, 12, 40, 200)] + ["é" * 40, "na na " * 30]
    out = []
    for i in range(160):
        parts = [prose(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            cut = rnd.randint(0, len(p) // 2) if rnd.random() < 0.3 else 0
            parts += [p[cut:], prose(rnd.randint(0, 30))]
        out.append((i * 3 % 160, " ".join(parts)))
    hot = prose(25)
    out += [(200 + i, f"{word()} {hot} {prose(6)}") for i in range(80)]          # a passage in a third of the rows
    out += [(400, out[3][1]), (401, out[3][1]), (402, out[3][1] + " x"), out[5], out[5], (out[6][0], out[7][1])]
    out += [(None, out[8][1]), (None, passages[3]), (500, None), (501, ""), (502, "short"), (503, "y" * 200_000),
            (504, "y" * 60), (-5, hot)]
    return out


@pytest.mark.parametrize("length", [17, 50, 77])
def test_like_plain_windows_on_repeated_content(spark, length):
    """Few letters, periods and shifted pieces: smallest strings that are twice in a window, runs cut in the middle."""
    rnd = random.Random(length)
    units = ["na ", "abcabd", "x", "lorem ipsum dolor sit amet "]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            unit = rnd.choice(units)
            parts.append((unit * 40)[rnd.randint(0, 9):rnd.randint(60, 160)] if rnd.random() < 0.6
                         else "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 90))))
        rows.append((rnd.randint(0, 100), "".join(parts)))
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), length=length)
    assert found(got) == plain(rows, length)


@pytest.mark.parametrize("length, hot_runs, collection", [(50, sd.HOT_RUNS, sd.COLLECTION), (50, 2, 3), (20, 5, 40), (78, 1, 1)])
def test_like_plain_windows(spark, rows, monkeypatch, length, hot_runs, collection):
    monkeypatch.setattr(sd, "COLLECTION", collection)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6) \
        .withColumn("ord", F.lit("x")).withColumn("kept", F.lit("y")).withColumn("text_hash", F.lit(1))
    got = sd.remove_repeats(df, length=length, hot_runs=hot_runs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "starts", "ends", "kept"]
    assert found(got) == plain(rows, length)


def test_texts_hashed_in_steps(spark, rows, monkeypatch):
    """A long text is hashed piece by piece: its windows are the same."""
    monkeypatch.setattr(sd, "STEP", 64)
    texts = [(t or "").encode() for _, t in rows if t and len(t) < 3000]
    small = {(t, p + j): k for _, text, place, _, n, key, _ in sd.batch_runs(texts, 50)
             for t, p, m, k in zip(text.tolist(), place.tolist(), n.tolist(), key.tolist(), strict=True) for j in range(m)}
    monkeypatch.setattr(sd, "STEP", 1 << 20)
    large = {(t, p + j): k for _, text, place, _, n, key, _ in sd.batch_runs(texts, 50)
             for t, p, m, k in zip(text.tolist(), place.tolist(), n.tolist(), key.tolist(), strict=True) for j in range(m)}
    assert small == large


def test_keys_fill_ranges_and_bitmaps_evenly():
    """A key comes of the smallest of many hashes, and its leading bits tell its range and its place in the bitmaps."""
    rnd = random.Random(4)
    texts = [bytes(rnd.choice(b"abcdefghij ") for _ in range(3000)) for _ in range(20)]
    lead = np.concatenate([key >> np.uint64(61) for *_, key, _ in sd.batch_runs(texts, 50)]).astype(np.int64)
    share = np.bincount(lead, minlength=8) / len(lead)
    assert share.min() > 0.08 and share.max() < 0.17, share


def test_contents_are_those_of_the_strings():
    rnd = random.Random(5)
    texts = [bytes(rnd.choice(b"ab") for _ in range(n)) for n in (400, 90, 60)] + [b"x" * 300]
    by_string = {}
    for data, _, _, start, windows, _, content in sd.batch_runs(texts * 2, 50):
        strings = [data[a:a + n + 49] for a, n in zip(start.tolist(), windows.tolist(), strict=True)]
        assert sd.string_contents(strings).tolist() == content.tolist()
        for string, c in zip(strings, content.tolist(), strict=True):
            assert by_string.setdefault(string, c) == c
    assert len(set(by_string.values())) == len(by_string)


def test_only_keys_of_different_strings_send_them(spark):
    rnd = random.Random(6)
    prose = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = prose(600)
    df = spark.createDataFrame([(i, prose(200) + passage + prose(200)) for i in range(6)], "ord bigint, text string") \
        .select("ord", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    firsts = spark.sparkContext.broadcast(sd.first_copies(df.withColumnRenamed("ord", "least")))
    keys = sd.shared_keys(df, 50, firsts)
    keys = pickle.loads(pickle.dumps(keys))
    sent = {}
    for r in df.collect():
        for *_, key, content, varied in sd._shared_runs([bytes(r["text"])], 50, keys):
            for k, c, v in zip(key.tolist(), content.tolist(), varied.tolist(), strict=True):
                sent.setdefault(k, []).append((c, v))
    whole = {k: v for k, v in sent.items() if len(v) == 6}
    assert len(whole) > 20
    for found in whole.values():                                       # edges of the passage differ, its inside does not
        assert {v for _, v in found} == {len({c for c, _ in found}) > 1}
    assert 0 < sum(v[0][1] for v in whole.values()) <= 4


def test_runs_with_only_a_key_in_common_are_not_sent(spark):
    """Texts that quote phrases shorter than a window share keys, and nothing that could be removed."""
    rnd = random.Random(8)
    prose = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    phrases = [prose(26) for _ in range(5)]
    passage = prose(300)
    texts = [" ".join(f"{prose(40)}{rnd.choice(phrases)}{prose(40)}" for _ in range(12)) for _ in range(30)]
    texts = [t + passage if i % 10 == 0 else t for i, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "ord bigint, text string") \
        .select("ord", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    firsts = spark.sparkContext.broadcast(sd.first_copies(df.withColumnRenamed("ord", "least")))
    keys = sd.shared_keys(df, 50, firsts)
    quoted = by_text = 0
    for i, t in enumerate(texts):
        runs = sum(len(text) for _, text, *_ in sd._shared_runs([t.encode()], 50, keys))
        if i % 10:
            quoted, by_text = quoted + runs, by_text + 1
        else:
            assert runs >= 250 // 35
    assert quoted < by_text / 2                                        # each text quotes a dozen phrases


@pytest.mark.parametrize("length", [17, 20, 50, 78])
def test_strings_with_a_window_in_common_have_a_side_in_common(length):
    rnd = random.Random(length)
    passages = ["".join(rnd.choice("abc") for _ in range(n)) for n in (60, 90, 200)] + ["na " * 60, "x" * 150]
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 50))) + rnd.choice(passages)[rnd.randint(0, 30):]
             + "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 50))) for _ in range(120)]
    runs, by_window = {}, {}
    for data, _, _, start, windows, key, content in sd.batch_runs([t.encode() for t in texts], length):
        left, right = sd.run_sides(data, start, windows, length)
        for a, n, k, c, x, y in zip(start.tolist(), windows.tolist(), key.tolist(), content.tolist(), left.tolist(),
                                    right.tolist(), strict=True):
            runs[c] = (k, x, y)
            for j in range(n):
                by_window.setdefault(data[a + j:a + j + length], set()).add(c)
    twice = {k for k, x, _ in runs.values() if x == 1}
    told = 0
    for contents in by_window.values():
        for a in contents:
            for b in contents - {a}:
                (k, x, y), (other, v, w) = runs[a], runs[b]
                assert k == other and (k in twice or x == v > 1 or y == w > 1)
                told += k not in twice
    assert told


def test_sides_packed_in_three_bytes():
    left, right = np.array([0, 1, 2, 0xFFFFFF], np.uint32), np.array([5, 0x010203, 0, 7], np.uint32)
    packed = [sd._packed_sides(left[:1], right[:1]), sd._packed_sides(left[1:], right[1:])]
    assert sd._sides_of(packed).tolist() == np.stack([left, right], axis=1).tolist()


def test_decisions_that_remove_nothing_are_not_sent():
    import pandas as pd

    rnd = random.Random(9)
    own = ["".join(rnd.choice("abcdefgh ") for _ in range(60)).encode() for _ in range(4)]
    shift = own[0][5:] + b"zzzzz"                                       # windows of the first string, in a larger id
    rows = [(1, 0, own[0], 10, 0), (1, 0, shift, 11, 0), (1, 0, own[1], 12, 0), (1, 0, own[2], 13, 2), (2, 77, None, 3, 0),
            (2, 78, None, 3, 4)]
    batch = pd.DataFrame(rows, columns=["key", "content", "string", "low", "span"])
    got = pd.concat(sd._resolve(50)(iter([batch])))
    content = dict(zip(own + [shift], sd.string_contents(own + [shift]).view(np.int64).tolist(), strict=True))
    assert sorted(zip(got["key"].tolist(), got["content"].tolist(), got["low"].tolist(), got["earlier"].tolist(), strict=True)) \
        == sorted([(1, content[shift], 11, 0b111111), (1, content[own[2]], 13, 0), (2, 78, 3, 0)])


def test_a_task_sends_few_rows_of_keys():
    """The number of hash ranges does not follow the input until the ranges are large."""
    assert sd.range_bits_for(1) == 1 and sd.range_bits_for(10 ** 6) == 5
    assert sd.range_bits_for(10 ** 8) == 9 and sd.range_bits_for(3 * 10 ** 9) == 11
    rnd = random.Random(10)
    key = np.sort(np.array([rnd.getrandbits(64) for _ in range(sd.HELD // 8)], np.uint64))
    assert len(list(sd._ranges(key, sd.range_bits_for(5 * 10 ** 7)))) <= 512


def test_counts_of_a_key_in_seven_bits():
    n = np.array([1, 2, 95, 96, 100, 127, 128, 5000, 10 ** 6])
    code = sd._counted(n)
    assert (code <= 127).all() and sd._count_of(code)[:4].tolist() == [1, 2, 95, 96]
    assert (sd._count_of(code) <= n).all() and (sd._count_of(code)[:8] * 1.2 > n[:8]).all()


def test_bitmaps_are_sent_compressed():
    keys = sd.Keys(20)
    keys.shared[5] = 3
    assert len(pickle.dumps(keys)) < 10_000 and (pickle.loads(pickle.dumps(keys)).shared == keys.shared).all()


def test_spans_are_what_is_removed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append((t or "").encode())
    for r in sd.remove_repeats(df).collect():
        left = 0
        for a, b in zip(r["starts"], r["ends"], strict=True):
            assert a < b and a >= left
            left = b + 1                                               # maximal: never adjacent
        for text in by_id[r["doc_id"]]:
            kept, at = b"", 0
            for a, b in zip(r["starts"], r["ends"], strict=True):
                kept, at = kept + text[at:a], b
            if kept + text[at:] == r["kept"]:
                break
        else:
            raise AssertionError(r["doc_id"])


def test_query_on_whole_and_hard_tables(spark, hard_dir):
    for d in ("/root/testdata/sf0.001", hard_dir):
        rows = [(r["doc_id"], r["text"]) for r in read_table(spark, d, "documents").collect()]
        got = sorted(map(tuple, QUERIES["op13_suffix_dedup"](spark, d).collect()), key=str)
        assert got == plain(rows)


def test_length_must_fit(spark):
    with pytest.raises(ValueError, match="17 to 78"):
        sd.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string"), length=100)
