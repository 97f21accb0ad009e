"""Removal of long repeats by the Burrows-Wheeler transform of a collection, built column by column.

Every byte covered by a ``length``-byte window that also starts in a document of a
smaller id goes.  The work is dealt out by content, so that equal windows meet:

* *Copies.*  Equal texts are one text with its smallest id; its other copies lose every byte.
  Copies are found by a strong digest, and what tells the tasks which rows are first copies is a bitmap
  of bounded size (a false hit costs work, never a result).
* *Runs.*  The key of a window is the smallest hash of the 16-byte strings inside it.
  Neighbouring windows of one key are one run, a string of at most 84 bytes for
  windows of 50.  Each window lies in one run, equal windows have equal keys.
* *Shared keys.*  Sorted, packed keys of all runs are merged by hash range.  Keys that
  may occur in two documents become a bitmap of bounded size (a false hit costs work,
  never a result), and so do keys with many different runs (the edges of a passage that
  a large part of the documents quote): their windows are dealt out one by one, each by
  its own hash.
* *Sides.*  Many runs share a key, 16 bytes, and nothing more.  A window's smallest 16-byte string has, in the
  window, either ``side`` bytes before it or as many behind it, so two different runs with a window in common
  also have the string that begins ``side`` bytes earlier, or that which begins as many later, in common.  Runs whose
  sides no other string of their key has are sent only if two documents may have the very run, and as a hash;
  runs of a single document are not sent.  Two more bitmaps, by key and string, tell which is which.
* *Collections.*  Strings with a side in common, with the smallest and largest id that has
  them, come together by key.  Where a run is the same in all documents (the inside of a repeat) there is
  nothing to sort: only its hash and ids are sent.  Of the others some thousand strings at a time form a
  collection.  Its transform is built from the right: each round inserts one more symbol
  of every string; where the longer suffix goes is the rank of its symbol in the transform so
  far, and its common prefix with its neighbours is one more than the least common
  prefix between its symbol's occurrences.  Transform and prefixes are read and
  written front to back each round, as the sequential files of the external
  algorithm are; a collection is bounded, so its files stay in the task's memory and
  only its strings and its results are tables.  Neighbouring suffixes with a common
  prefix of ``length`` start with equal windows, and such a group's smallest id decides.
* *Documents.*  Decisions that remove something are joined to the runs of the documents (a key of any size is
  split by the skew join), gathered per text and applied to the whole text of its first copy.  Texts
  go to that join compressed; of a later copy only the size goes, as all its bytes are removed.

Defined cases: null and empty texts have no bytes; a missing doc_id counts as larger than
every id, and rows of the same doc_id are one document, so they remove nothing from
each other; copies of a text lose all bytes but in the smallest id; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read_table, ship_package

LENGTH, GRAM = 50, 16
#: bytes of text hashed at a time (arrays that stay in the cache)
STEP = 1 << 15
#: runs that a task holds before it sends them on
HELD = 1 << 18
#: bits of a bitmap at most (16 MB)
BITMAP_BITS = 1 << 27
#: runs of one hash range; beyond so many ranges they hold more runs, to a limit, as a task sends a row for every range
RANGE_RUNS, RANGES, RANGE_LIMIT = 1 << 15, 1 << 9, 1 << 21
#: keys with more different runs are dealt out window by window
HOT_RUNS = 20000
#: strings of one collection, about
COLLECTION = 3000
#: different runs of a key in one task are counted to here, then by quarters of a power of two
COUNTED = 96
NO_ID = (1 << 63) - 1
START = 0xFF                                           # before a string's first symbol; no byte of UTF-8

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- runs

def _gram_hashes(data: bytes) -> np.ndarray:
    """Hash of the 16 bytes at every place."""
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))     # the 8 bytes at every place
    h = word[:-8] * _A
    h += word[8:] * _B
    h ^= h >> np.uint64(32)
    h *= _C
    h ^= h >> np.uint64(29)
    return h


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """Smallest of every ``span`` neighbours."""
    k = 1
    while 2 * k <= span:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    return np.minimum(h[:k - span], h[span - k:]) if k < span else h


class Firsts:
    """Rows that may be the first copy of their text, as bits of a hash: no first copy is missed."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.bits, self.packed = bits, packed

    @staticmethod
    def place(text_hash: np.ndarray, own: np.ndarray, bits: int) -> np.ndarray:
        h = (text_hash.view(np.uint64) * _A) ^ (own.view(np.uint64) * _B)
        return ((h ^ (h >> np.uint64(32))) * _C) >> np.uint64(64 - bits)

    def may_be(self, batch: pd.DataFrame) -> np.ndarray:
        at = self.place(batch["text_hash"].to_numpy(np.int64), batch["ord"].to_numpy(np.int64), self.bits)
        return (self.packed[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def pick(self, batch: pd.DataFrame) -> pd.DataFrame:
        return batch[self.may_be(batch)]


def first_copies(least: DataFrame) -> Firsts:
    """Bitmap of (``text_hash``, ``least``): at most 16 MB, whatever the number of texts."""
    bits = max(16, min(BITMAP_BITS.bit_length() - 1, (16 * least.count()).bit_length()))

    def places(batches):
        for batch in batches:
            at = Firsts.place(batch["text_hash"].to_numpy(np.int64), batch["least"].to_numpy(np.int64), bits)
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int32),
                                "bits": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    words = least.select("text_hash", "least").mapInPandas(places, "word int, bits bigint").groupBy("word") \
        .agg(F.bit_or("bits").alias("bits")).toPandas()
    packed = np.zeros(1 << bits - 6, np.int64)
    packed[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return Firsts(bits, packed.view(np.uint8))


def _contents(grams: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hash of the strings that ``count`` neighbouring grams from ``start`` cover: of the grams and their order."""
    none = np.zeros(1, np.uint64)
    total = np.concatenate([none, np.cumsum(grams)])
    by_place = np.concatenate([none, np.cumsum(grams * np.arange(len(grams), dtype=np.uint64))])
    plain = total[start + count] - total[start]
    h = plain * _A + (by_place[start + count] - by_place[start] - start.astype(np.uint64) * plain) * _B
    h += count.astype(np.uint64) * _C
    h ^= h >> np.uint64(32)
    h *= _C
    return h ^ (h >> np.uint64(29))


def string_contents(strings: list[bytes]) -> np.ndarray:
    sizes = np.array([len(s) for s in strings], np.int64)
    return _contents(_gram_hashes(b"".join(strings)), np.cumsum(sizes) - sizes, sizes - GRAM + 1)


def find_runs(data: bytes, bounds: np.ndarray, length: int):
    """Runs of the windows of the texts between ``bounds``: start, number of windows, key, and a hash of the string."""
    grams = _gram_hashes(data)
    span = length - GRAM + 1
    key = _least(grams, span)
    n = len(key)
    mark = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=mark[1:])
    mark[bounds[:-1][bounds[:-1] < n]] = True
    start = np.flatnonzero(mark)
    text = np.searchsorted(bounds, start, side="right") - 1
    end = np.minimum(np.append(start[1:], n), bounds[text + 1] - length + 1)
    kept = end > start
    start, end = start[kept], end[kept]
    if len(start) and (end - start).max() > span:                      # repeated content: one key for long
        parts = -(-(end - start) // span)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, end = np.repeat(start, parts) + nth * span, np.repeat(end, parts)
        end = np.minimum(end, start + span)
    # smallest hashes crowd at zero: mixed again, they fill the hash ranges and bitmaps evenly
    key = key[start] * _A
    key ^= key >> np.uint64(32)
    key *= _C
    return start, end - start, key, _contents(grams, start, end - start + span - 1)


def _steps(texts: list[bytes], length: int):
    """Texts put together in steps: (joined bytes, bounds, number of each text, its offset); long texts in pieces."""
    joined, sizes, number, offset, total = [], [], [], [], 0

    def step():
        return b"".join(joined), np.concatenate([[0], np.cumsum(sizes)]), np.array(number), np.array(offset)

    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, STEP):
            piece = text[at:at + STEP + length - 1]
            joined.append(piece), sizes.append(len(piece)), number.append(i), offset.append(at)
            total += len(piece)
            if total >= STEP:
                yield step()
                joined, sizes, number, offset, total = [], [], [], [], 0
    if joined:
        yield step()


def batch_runs(texts: list[bytes], length: int):
    """(bytes, text of each run, place in that text, place in the bytes, windows, key, content) of every step."""
    for data, bounds, number, offset in _steps(texts, length):
        start, windows, key, content = find_runs(data, bounds, length)
        piece = np.searchsorted(bounds, start, side="right") - 1
        yield data, number[piece], start - bounds[piece] + offset[piece], start, windows, key, content


def run_sides(data: bytes, start: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """24 bits of the 16-byte strings half a window before and behind the smallest one of every run.

    A side is 0 where no window of the run needs it.  Left is 1 where the smallest string is there twice: windows have
    it at different places, and any other string of the key may share one.
    """
    grams = _gram_hashes(data)
    span = length - GRAM + 1
    side = span // 2
    nth = np.arange(2 * span - 1)
    near = grams[np.minimum(start[:, None] + nth, len(grams) - 1)]
    near[nth >= (windows + span - 1)[:, None]] = ~np.uint64(0)
    least = near.argmin(axis=1)
    twice = (near == near[np.arange(len(near)), least][:, None]).sum(axis=1) > 1

    def bits(at, needed):
        value = (grams[np.clip(at, 0, len(grams) - 1)] >> np.uint64(40)).astype(np.uint32)
        return np.where(needed, np.maximum(value, np.uint32(2)), np.uint32(0))

    left = bits(start + least - side, least >= side)
    left[twice] = 1
    return left, bits(start + least + side, windows - 1 > least - side)


# ---------------------------------------------------------------- shared keys

def _ranges(key: np.ndarray, range_bits: int):
    """Sorted keys -> (hash range, from, to, low 32 bits as byte planes of their differences)."""
    at = (key >> np.uint64(64 - range_bits)).astype(np.int64)
    low = (key >> np.uint64(32 - range_bits)).astype(np.uint32)
    cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(at)).tolist(), strict=True):
        yield at[a], a, b, np.diff(low[a:b], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _lows(packed) -> np.ndarray:
    """The low 32 bits of the keys of ``_ranges``."""
    return np.concatenate([np.cumsum(np.frombuffer(k, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.uint32)
                           for k in packed])


def _counted(n: np.ndarray) -> np.ndarray:
    """Numbers from 1 in 7 bits: exact below ``COUNTED``, then rounded down to quarters of a power of two."""
    steps = np.floor(4 * np.log2(np.maximum(n, COUNTED) / COUNTED) + 1e-9).astype(np.int64)
    return np.where(n < COUNTED, n, COUNTED + np.minimum(steps, 127 - COUNTED))


def _count_of(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.int64)
    return np.where(code < COUNTED, code, (COUNTED * 2.0 ** ((code - COUNTED) / 4)).astype(np.int64))


def _packed_keys(length: int, range_bits: int, firsts):
    """Keys of a task's runs, sorted, by hash range, and weights: number of different runs, whether of several ids."""
    def pack(keys, ids, contents):
        key, own, content = np.concatenate(keys), np.concatenate(ids), np.concatenate(contents)
        order = np.lexsort((content, key))
        key, own, content = key[order], own[order], content[order]
        new = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(new)
        several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
        different = np.add.reduceat((new | np.append(True, content[1:] != content[:-1])).astype(np.int64), first)
        weight = (_counted(different) | (several << 7)).astype(np.uint8)
        return pd.DataFrame([(at, low, weight[a:b].tobytes()) for at, a, b, low in _ranges(key[first], range_bits)],
                            columns=["range", "keys", "weights"])

    def scan(batches):
        keys, ids, contents, held = [], [], [], 0
        for batch in batches:
            batch = firsts.value.pick(batch)
            own = batch["ord"].to_numpy(np.int64)
            for _, text, _, _, _, key, content in batch_runs(list(batch["text"]), length):
                if len(key):
                    keys.append(key), ids.append(own[text]), contents.append(content)
                    held += len(key)
                if held >= HELD:
                    yield pack(keys, ids, contents)
                    keys, ids, contents, held = [], [], [], 0
        if held:
            yield pack(keys, ids, contents)

    return scan


def _slice_of(low: np.ndarray, bits: int) -> bytes:
    """Compressed bitmap of one hash range."""
    flags = np.zeros(1 << bits, np.uint8)
    flags[low >> np.uint32(32 - bits)] = 1
    return zlib.compress(np.packbits(flags, bitorder="little").tobytes(), 1)


def _merged_range(bits: int, hot_runs: int):
    """Bitmaps of one hash range: keys that may be in two documents, and those of many different runs."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        low = _lows(rows["keys"])
        weight = np.frombuffer(b"".join(rows["weights"]), np.uint8)
        order = np.argsort(low, kind="stable")
        low, weight = low[order], weight[order]
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        times = np.diff(np.append(first, len(low)))
        shared = (times > 1) | (np.maximum.reduceat(weight, first) > 127)
        hot = shared & (np.add.reduceat(_count_of(weight & 127), first) > hot_runs)
        return pd.DataFrame({"range": [rows["range"].iloc[0]], "shared": [_slice_of(low[first[shared]], bits)],
                             "hot": [_slice_of(low[first[hot]], bits) if hot.any() else None]})

    return merge


def _packed_sides(left: np.ndarray, right: np.ndarray) -> bytes:
    return np.stack([left, right], axis=1).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _sides_of(packed) -> np.ndarray:
    """Left and right of ``_packed_sides``, as columns."""
    bytes_ = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 3)
    return np.pad(bytes_, ((0, 0), (0, 1))).view(np.uint32).reshape(-1, 2)


def _packed_contents(length: int, range_bits: int, firsts, keys):
    """Shared keys of a task's runs, sorted, by hash range, and of their different strings the hash, the sides and
    whether several ids have it."""
    def pack(held):
        key, content, own, left, right = (np.concatenate(h) for h in zip(*held, strict=True))
        order = np.lexsort((content, key))
        key, content, own = key[order], content[order], own[order]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])))
        several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
        key, content, left, right = key[first], content[first], left[order[first]], right[order[first]]
        return pd.DataFrame([(at, low, content[a:b].tobytes(), _packed_sides(left[a:b], right[a:b]),
                              np.packbits(several[a:b]).tobytes()) for at, a, b, low in _ranges(key, range_bits)],
                            columns=["range", "keys", "contents", "sides", "several"])

    def scan(batches):
        held, total = [], 0
        for batch in batches:
            batch = firsts.value.pick(batch)
            own = batch["ord"].to_numpy(np.int64)
            for data, text, _, start, windows, key, content in batch_runs(list(batch["text"]), length):
                one = np.flatnonzero(keys.value.in_shared(key) & ~keys.value.in_hot(key))
                if len(one):
                    held.append((key[one], content[one], own[text[one]], *run_sides(data, start[one], windows[one], length)))
                    total += len(one)
                if total >= HELD:
                    yield pack(held)
                    held, total = [], 0
        if held:
            yield pack(held)

    return scan


def _contents_range(bits: int):
    """Bitmaps of one hash range: strings with a side that another string of their key has, and other strings that
    several ids may have."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        low, content = _lows(rows["keys"]), np.frombuffer(b"".join(rows["contents"]), np.uint64)
        sides = _sides_of(rows["sides"])
        several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=len(c) // 8)
                                  for s, c in zip(rows["several"], rows["contents"], strict=True)])
        order = np.lexsort((content, low))
        low, content = low[order], content[order]
        first = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (content[1:] != content[:-1])))
        several = (np.diff(np.append(first, len(low))) > 1) | (np.maximum.reduceat(several[order], first) > 0)
        low, content, sides = low[first], content[first], sides[order[first]]
        key = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        strings = np.diff(np.append(key, len(low)))
        varied = np.repeat(np.maximum.reduceat(sides[:, 0] == 1, key) & (strings > 1), strings)
        for side in sides.T:
            there = np.flatnonzero(side > 1)
            by_side = low[there].astype(np.uint64) << np.uint64(24) | side[there]
            order = np.argsort(by_side)
            same = by_side[order[1:]] == by_side[order[:-1]]
            varied[there[order[1:][same]]] = varied[there[order[:-1][same]]] = True
        lead = (content >> np.uint64(32)).astype(np.uint32)
        return pd.DataFrame({"range": [rows["range"].iloc[0]], "varied": [_slice_of(lead[varied], bits)],
                             "alike": [_slice_of(lead[several & ~varied], bits)]})

    return merge


class Keys:
    """The bitmaps: of keys, addressed by their leading bits, and of strings, by those of the key's range and of the string's hash."""

    FLAGS = "shared", "hot", "varied", "alike"

    def __init__(self, bits: int, range_bits: int = 0):
        self.bits, self.range_bits = bits, range_bits
        self.shared, self.hot, self.varied, self.alike = (np.zeros(1 << bits - 3, np.uint8) for _ in self.FLAGS)

    def __getstate__(self):
        """Sent compressed: few bits are set, and every executor keeps a copy on its disk."""
        return self.bits, self.range_bits, [zlib.compress(getattr(self, name).tobytes(), 1) for name in self.FLAGS]

    def __setstate__(self, state):
        self.bits, self.range_bits, packed = state
        for name, flags in zip(self.FLAGS, packed, strict=True):
            setattr(self, name, np.frombuffer(zlib.decompress(flags), np.uint8))

    def only(self, *names: str) -> Keys:
        """These bitmaps and no others."""
        out = Keys(self.bits, self.range_bits)
        for name in self.FLAGS:
            setattr(out, name, getattr(self, name) if name in names else np.zeros(0, np.uint8))
        return out

    @staticmethod
    def _at(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def _of_string(self, key, content):
        rest = self.bits - self.range_bits
        return (key >> np.uint64(64 - self.range_bits)) << np.uint64(rest) | content >> np.uint64(64 - rest)

    def in_shared(self, key):
        return self._at(self.shared, key >> np.uint64(64 - self.bits))

    def in_hot(self, key):
        return self._at(self.hot, key >> np.uint64(64 - self.bits))

    def in_varied(self, key, content):
        return self._at(self.varied, self._of_string(key, content))

    def in_alike(self, key, content):
        return self._at(self.alike, self._of_string(key, content))


def range_bits_for(runs: int) -> int:
    return max(1, min((runs // RANGE_RUNS).bit_length(), RANGES.bit_length() - 1), (runs // RANGE_LIMIT).bit_length())


def shared_keys(docs: DataFrame, length: int, firsts, hot_runs: int = HOT_RUNS) -> Keys:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = max(1, 2 * size // (length - GRAM + 1))                 # runs, about
    range_bits = range_bits_for(expected)
    bits = max(range_bits + 6, min(BITMAP_BITS.bit_length() - 1, (8 * expected).bit_length()))
    out, step = Keys(bits, range_bits), 1 << bits - range_bits - 3

    def put(flags, row, name):                                         # the bitmaps, of bounded size
        if row[name] is not None:
            flags[row["range"] * step:(row["range"] + 1) * step] = np.frombuffer(zlib.decompress(row[name]), np.uint8)

    for row in docs.mapInPandas(_packed_keys(length, range_bits, firsts), "range int, keys binary, weights binary") \
            .groupBy("range").applyInPandas(_merged_range(bits - range_bits, hot_runs), "range int, shared binary, hot binary") \
            .collect():
        put(out.shared, row, "shared")
        put(out.hot, row, "hot")
    so_far = docs.sparkSession.sparkContext.broadcast(out.only("shared", "hot"))
    for row in docs.mapInPandas(_packed_contents(length, range_bits, firsts, so_far),
                                "range int, keys binary, contents binary, sides binary, several binary") \
            .groupBy("range").applyInPandas(_contents_range(bits - range_bits), "range int, varied binary, alike binary").collect():
        put(out.varied, row, "varied")
        put(out.alike, row, "alike")
    so_far.unpersist()
    return out.only("hot", "varied", "alike")


def _shared_runs(texts: list[bytes], length: int, keys: Keys):
    """(bytes, text, place, place in the bytes, windows, leading half of the key, content, whether it has a side of another
    string) of the runs that may have something in common; a hot key's windows one by one, each a key of its own."""
    half = np.uint64(32)
    for data, text, place, start, windows, key, content in batch_runs(texts, length):
        hot, varied = keys.in_hot(key), keys.in_varied(key, content)
        one = np.flatnonzero((varied | keys.in_alike(key, content)) & ~hot)
        yield (data, text[one], place[one], start[one], windows[one], (key[one] >> half).astype(np.uint32).view(np.int32),
               content[one].view(np.int64), varied[one])
        many = np.flatnonzero(hot)
        if len(many):
            n = windows[many]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(start[many], n) + nth
            own = _contents(_gram_hashes(data), at, np.full(len(at), length - GRAM + 1))
            yield (data, np.repeat(text[many], n), np.repeat(place[many], n) + nth, at, np.ones(len(at), np.int64),
                   ((own * _A) >> half).astype(np.uint32).view(np.int32), own.view(np.int64), np.zeros(len(at), bool))


# ---------------------------------------------------------------- the collection's transform

def collection_transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common prefixes of all suffixes of ``strings`` (each shorter than 255 bytes).

    Ends of strings sort first, in the order of the strings.  Entry i of the second
    array is the common prefix of suffixes i - 1 and i; it has one entry more.
    """
    k = len(strings)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings])
    ends = np.cumsum(sizes)
    before = np.full(k, START, np.uint8)
    before[sizes > 0] = flat[ends[sizes > 0] - 1]
    bwt, lcp = before, np.zeros(k + 1, np.uint8)
    place = np.arange(k)                                               # of the longest suffix of each string so far
    owner = np.zeros(0, np.int32)
    live = np.flatnonzero(sizes > 0)
    place = place[live]
    done = 0
    while len(live):
        done += 1
        size = len(bwt)
        order = pc.array_sort_indices(pa.array(bwt)).to_numpy(zero_copy_only=True).view(np.int64)
        active = np.zeros(size, bool)
        active[place] = True
        if len(owner) < size:
            owner = np.empty(2 * size, np.int32)
        owner[place] = np.arange(len(live), dtype=np.int32)
        rank = np.flatnonzero(active[order])                           # of the active symbols among all, front to back
        at = order[rank]
        live = live[owner[at]]
        symbol = bwt[at]
        ahead = order[np.maximum(rank - 1, 0)]
        behind = order[np.minimum(rank + 1, size - 1)]
        has_ahead = (rank > 0) & (bwt[ahead] == symbol)
        has_behind = (rank + 1 < size) & (bwt[behind] == symbol)
        # least common prefixes between neighbouring occurrences of a symbol; places descend, so that no gap is read
        by_place = np.argsort(at)[::-1]
        low = np.where(has_ahead, ahead + 1, at)[by_place]
        high = np.where(has_behind, behind + 1, at + 1)[by_place]
        edges = np.stack([low, at[by_place] + 1, high], axis=1).ravel()
        least = np.minimum.reduceat(lcp, np.minimum(edges, size)).reshape(-1, 3)
        with_ahead, with_behind = np.empty(len(at), np.uint8), np.empty(len(at), np.uint8)
        with_ahead[by_place], with_behind[by_place] = least[:, 0], least[:, 1]
        new = k + rank
        old = np.ones(size + len(new), bool)
        old[new] = False
        longer, common = np.empty(size + len(new), np.uint8), np.empty(size + len(new) + 1, np.uint8)
        longer[old] = bwt
        left = ends[live] - done - 1                                   # the next symbol, if there is one
        more = sizes[live] > done
        longer[new] = np.where(more, flat[np.maximum(left, 0)], START)
        common[:-1][old] = lcp[:-1]
        common[-1] = 0
        common[new] = np.where(has_ahead, with_ahead + 1, 0)
        common[new[has_behind] + 1] = with_behind[has_behind] + 1
        bwt, lcp = longer, common
        live, place = live[more], new[more]
    return bwt, lcp


def suffix_places(bwt: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """String and offset of every suffix, by walking each string through the transform from its end."""
    k = len(sizes)
    order = pc.array_sort_indices(pa.array(bwt)).to_numpy(zero_copy_only=True).view(np.int64)
    step = np.empty(len(bwt), np.int64)
    step[order] = k + np.arange(len(bwt))
    string, offset = np.empty(len(bwt), np.int64), np.empty(len(bwt), np.int64)
    live, at = np.arange(k), np.arange(k)
    string[at], offset[at] = live, sizes
    for done in range(1, int(sizes.max(initial=0)) + 1):
        more = sizes[live] >= done
        live = live[more]
        at = step[at[more]]
        string[at], offset[at] = live, sizes[live] - done
    return string, offset


def earlier_windows(strings: list[bytes], least: np.ndarray, length: int) -> np.ndarray:
    """Bit j of entry i: window j of string i is also in a string with a smaller id."""
    bwt, lcp = collection_transform(strings)
    sizes = np.array([len(s) for s in strings])
    string, offset = suffix_places(bwt, sizes)
    whole = np.flatnonzero(sizes[string] - offset >= length)
    masks = np.zeros(len(strings), np.int64)
    if len(whole):
        # between two whole windows of one group lie no shorter suffixes, as those share less than a window
        first = np.flatnonzero(lcp[whole] < length)
        smallest = np.minimum.reduceat(least[string[whole]], first)
        smallest = np.repeat(smallest, np.diff(np.append(first, len(whole))))
        later = smallest < least[string[whole]]
        np.bitwise_or.at(masks, string[whole][later], np.int64(1) << offset[whole][later])
    return masks


def _resolve(length: int):
    """Strings sorted by key -> decision of every string: smallest id that has it, windows that an earlier one has."""
    def decide(strings: list[bytes], keys: list[int], lows: list[int], several: list[bool]):
        least = np.array(lows, np.int64)
        earlier = earlier_windows(strings, least, length)
        told = np.flatnonzero((earlier != 0) | np.array(several))      # the others remove nothing
        content = string_contents([strings[i] for i in told.tolist()]).view(np.int64) if len(told) else earlier[told]
        return pd.DataFrame({"key": np.array(keys)[told], "content": content, "low": least[told], "earlier": earlier[told]})

    def scan(batches):
        strings, keys, lows, several, alone = [], [], [], [], []
        open_key, held, single = None, {}, {}

        def close():
            """The open key is whole: its strings join the collection if two documents have it."""
            alone.extend((open_key, c, low, 0) for c, (low, high) in single.items() if low != high)
            single.clear()
            if held and min(v[0] for v in held.values()) != max(v[1] for v in held.values()):
                strings.extend(held)
                keys.extend([open_key] * len(held))
                lows.extend(v[0] for v in held.values())
                several.extend(v[0] != v[1] for v in held.values())
            held.clear()

        for batch in batches:
            low_ids = batch["low"].to_numpy(np.int64)
            high_ids = low_ids + batch["span"].to_numpy(np.int64)      # wraps as the difference did
            for key, content, string, low, high in zip(batch["key"].tolist(), batch["content"].tolist(), batch["string"],
                                                       low_ids.tolist(), high_ids.tolist(), strict=True):
                if key != open_key:
                    close()
                    open_key = key
                    if len(strings) >= COLLECTION:
                        yield decide(strings, keys, lows, several)
                        strings, keys, lows, several = [], [], [], []
                    if len(alone) >= HELD // 8:
                        yield pd.DataFrame(alone, columns=DECISION)
                        alone.clear()
                into, what = (single, content) if string is None else (held, string)
                was = into.get(what)
                into[what] = (low, high) if was is None else (min(low, was[0]), max(high, was[1]))
        close()
        if strings:
            yield decide(strings, keys, lows, several)
        if alone:
            yield pd.DataFrame(alone, columns=DECISION)

    return scan


OCCURRENCE = ["key", "content", "ord", "text_hash", "run"]
DECISION = ["key", "content", "low", "earlier"]


# ---------------------------------------------------------------- documents

def _apply(length: int):
    def removed(batches):
        for batch in batches:
            rows = {"doc_id": batch["doc_id"], "n_bytes": batch["size"], "n_removed": [], "starts": [], "ends": [], "kept": []}
            for size, packed, copy, places, masks in zip(batch["size"].tolist(), batch["packed"], batch["copy"], batch["places"],
                                                         batch["masks"], strict=True):
                starts = ends = np.zeros(0, np.int64)
                copied = copy and size >= length                       # all of it goes
                if copied:
                    starts, ends = np.zeros(1, np.int64), np.full(1, size)
                else:
                    text = zlib.decompress(packed)
                if not copied and places is not None and len(places):
                    bits = np.unpackbits(np.asarray(masks, np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    run, j = np.nonzero(bits)
                    at = np.unique(np.asarray(places, np.int64)[run] + j)
                    gap = np.flatnonzero(np.diff(at) > length)
                    starts, ends = at[np.append(0, gap + 1)], at[np.append(gap, len(at) - 1)] + length
                kept = b"" if copied else b"".join(text[a:b] for a, b in zip(
                    np.append(0, ends).tolist(), np.append(starts, size).tolist(), strict=True))
                rows["n_removed"].append(int((ends - starts).sum()))
                rows["starts"].append(starts)
                rows["ends"].append(ends)
                rows["kept"].append(kept)
            yield pd.DataFrame(rows)

    return removed


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   hot_runs: int = HOT_RUNS) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, ``starts`` and ``ends`` of the removed bytes, ``kept`` (binary)."""
    if not GRAM < length <= 78:
        raise ValueError("length must be 17 to 78: a run's windows are bits of a long")
    spark = df.sparkSession
    ship_package(spark)
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("ord"), F.xxhash64("t").alias("text_hash"),
                       F.col("t").cast("binary").alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    least = cut(docs.select("ord", "text_hash", digest).groupBy("digest").agg(
        F.min("ord").alias("least"), F.min("text_hash").alias("text_hash")).select("least", "text_hash"))
    firsts = spark.sparkContext.broadcast(first_copies(least))
    long_enough = docs.filter(F.octet_length("text") >= length).select("ord", "text_hash", "text")
    shared = spark.sparkContext.broadcast(shared_keys(long_enough, length, firsts, hot_runs))

    def strings(batches):
        held = []

        def flush():
            key, content, own, varied = (np.concatenate([h[i] for h in held]) for i in range(4))
            string = np.concatenate([h[4] for h in held])
            order = np.lexsort((content, key))
            key, content, own = key[order], content[order], own[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])))
            low = np.minimum.reduceat(own, first)
            return pd.DataFrame({"key": key[first], "content": np.where(varied[order[first]], 0, content[first]),
                                 "string": string[order[first]], "low": low, "span": np.maximum.reduceat(own, first) - low})

        for batch in batches:
            batch = firsts.value.pick(batch)
            own = batch["ord"].to_numpy(np.int64)
            for data, text, _, start, windows, key, content, varied in _shared_runs(list(batch["text"]), length, shared.value):
                string = np.full(len(key), None, object)
                ends = start + windows + length - 1
                for i in np.flatnonzero(varied).tolist():
                    string[i] = data[start[i]:ends[i]]
                if len(key):
                    held.append((key, content, own[text], varied, string))
                if sum(len(h[0]) for h in held) >= HELD // 4:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    def occurrences(batches):
        held = []

        def flush():
            return pd.DataFrame({name: np.concatenate([h[i] for h in held]) for i, name in enumerate(OCCURRENCE)})

        for batch in batches:
            batch = firsts.value.pick(batch)
            own, hashes = batch["ord"].to_numpy(np.int64), batch["text_hash"].to_numpy(np.int64)
            for _, text, place, _, windows, key, content, _ in _shared_runs(list(batch["text"]), length, shared.value):
                held.append((key, content, own[text], hashes[text], place << 8 | windows))
                if sum(len(h[0]) for h in held) >= HELD // 8:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    def packed(batches):
        """Texts compressed; of a row that is no first copy the size is enough."""
        for batch in batches:
            whole = firsts.value.may_be(batch) | (batch["size"].to_numpy(np.int64) < length)
            small = [zlib.compress(t, 1) if w else None for t, w in zip(batch["text"], whole.tolist(), strict=True)]
            yield batch[["doc_id", "ord", "text_hash", "size"]].assign(packed=small)

    decided = long_enough.mapInPandas(strings, "key int, content bigint, string binary, low bigint, span bigint") \
        .repartition("key").sortWithinPartitions("key") \
        .mapInPandas(_resolve(length), "key int, content bigint, low bigint, earlier bigint")
    found = long_enough.mapInPandas(occurrences, "key int, content bigint, ord bigint, text_hash bigint, run bigint")
    windows = found.join(decided, ["key", "content"]).select(
        "ord", "text_hash", F.shiftright("run", 8).alias("place"),
        F.when(F.col("ord") > F.col("low"), F.expr("shiftleft(1L, cast(run & 255 as int)) - 1")).otherwise(F.col("earlier"))
        .alias("mask")) \
        .filter("mask <> 0")
    # sent as rows: the windows of a text come from many tasks, so lists of them would not be shorter
    by_text = windows.repartition("ord", "text_hash").groupBy("ord", "text_hash").agg(
        F.collect_set(F.struct("place", "mask")).alias("cuts"))
    of_text = least.select(F.col("least").alias("ord"), "text_hash", F.lit(True).alias("first")) \
        .join(by_text, ["ord", "text_hash"], "left")
    # a row that has no first copy's id and text is a later copy
    sent = docs.select("doc_id", "ord", "text_hash", F.octet_length("text").cast("bigint").alias("size"), "text") \
        .mapInPandas(packed, "doc_id bigint, ord bigint, text_hash bigint, size bigint, packed binary")
    return sent.join(of_text, ["ord", "text_hash"], "left").select(
        "doc_id", "size", "packed", F.col("first").isNull().alias("copy"), F.col("cuts.place").alias("places"),
        F.col("cuts.mask").alias("masks")) \
        .mapInPandas(_apply(length), "doc_id bigint, n_bytes bigint, n_removed bigint, starts array<bigint>, "
                                     "ends array<bigint>, kept binary")


def op13(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("bigint").alias("n_spans"),
                                       F.sha2("kept", 256).alias("kept_sha256"))


# windows are read from blocks of 500 bytes and the 49 after them: a place in a long string is dear to find
ORACLE = """
with docs as (
  select row_number() over () as rid, doc_id, coalesce(doc_id, 9223372036854775807) as ord, hex(encode(coalesce(text, ''))) as x
  from documents
), blocks as (
  select rid, ord, 500 * nr as start, substr(x, 1000 * nr + 1, 1098) as part
  from (select *, unnest(range(0, length(x) // 1000 + 1)) as nr from docs where length(x) >= 100)
), windows as (
  select rid, ord, start + k as pos, substr(part, 2 * k + 1, 100) as w
  from (select *, unnest(range(0, least(500, length(part) // 2 - 49))) as k from blocks)
), least as (
  select w, min(ord) as low from windows group by w having min(ord) <> max(ord)
), gone as (
  select rid, pos, case when pos <= lag(pos) over o + 50 then 0 else 1 end as fresh
  from windows join least using (w) where ord > low window o as (partition by rid order by pos)
), spans as (
  select rid, min(pos) as a, max(pos) + 50 as b from (
    select *, sum(fresh) over (partition by rid order by pos) as span from gone) g
  group by rid, span
), cuts as (
  select rid, sum(b - a) as removed, count(*) as n, list(struct_pack(a := a, b := b) order by a) as s from spans group by rid
)
select doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(n, 0)::bigint as n_spans,
  sha256(unhex(case when n is null then x else
    array_to_string(list_transform(range(0, n + 1), lambda i: substr(x, case when i = 0 then 1 else 2 * s[i].b + 1 end,
      case when i < n then 2 * s[i + 1].a else length(x) end - case when i = 0 then 0 else 2 * s[i].b end)), '') end)) as kept_sha256
from docs left join cuts using (rid)
"""
