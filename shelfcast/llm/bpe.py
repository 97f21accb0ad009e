"""BPE encoding and decoding with a public vocabulary file.

A word's symbols are merged with a segment tree over the ranks of adjacent
pairs: its root is the lowest rank, a walk down to the left gives the leftmost
pair of that rank, and a merge changes at most three leaves, each updated in
logarithmic time, until no pair can merge.  A word of a million letters
therefore costs n log n.

Texts are cut at the vocabulary's special tokens, normalised (NFC, lower case;
white space only separates words) and cut into words.  Every distinct word
is merged once while a bounded cache of the Python worker holds it: the new
words of a block of texts run through their segment trees side by side, one
merge of each word at a time, as rows of numpy arrays; long words have a tree
of their own.  The vocabulary is read by each worker from ``path``; it must be at
the same place on every machine.

Defined cases: null is encoded as the empty text: no ids, empty decoded text;
repeated rows are encoded each; an empty table gives an empty result; other
columns are carried along by ``encode`` and ``decode``.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, ship_package

#: distinct words kept per worker; older ones are forgotten
CACHED_WORDS = 300_000
#: words of up to so many symbols are merged side by side
SIDE_BY_SIDE = 65
#: texts are cut into words in blocks of about so many characters
BLOCK_CHARS = 2_000_000
_NONE = 1 << 62


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def merge_word(symbols: list[int], merges: dict[int, int]) -> list[int]:
    """Merge a word's symbol ids; ``merges`` maps ``a << 20 | b`` to ``rank << 20 | merged id``."""
    n = len(symbols)
    if n < 2:
        return symbols
    get = merges.get
    leaves = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [_NONE] * (2 * leaves)
    for i in range(n - 1):
        tree[leaves + i] = get(symbols[i] << 20 | symbols[i + 1], _NONE)
    for k in range(leaves - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols = list(symbols)

    def put(i: int, value: int) -> None:
        k = leaves + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a <= b else b
            if tree[k] == least:
                break
            tree[k] = least
            k >>= 1

    while tree[1] != _NONE:
        lowest, k = tree[1], 1
        while k < leaves:                                  # leftmost leaf of the lowest rank
            k *= 2
            if tree[k] != lowest:
                k += 1
        i = k - leaves
        j = after[i]
        symbols[i] = lowest & 0xFFFFF
        symbols[j] = -1
        end = after[j]
        after[i] = end
        if j < n - 1:
            put(j, _NONE)
        if end < n:
            before[end] = i
            put(i, get(symbols[i] << 20 | symbols[end], _NONE))
        else:
            put(i, _NONE)
        if before[i] >= 0:
            put(before[i], get(symbols[before[i]] << 20 | symbols[i], _NONE))
    return [s for s in symbols if s >= 0]


def merge_side_by_side(words: list[list[int]], keys: np.ndarray, values: np.ndarray) -> list[list[int]]:
    """``merge_word`` for many words of at most ``SIDE_BY_SIDE`` symbols: row r of ``tree`` is the tree of word r.

    ``keys`` (sorted) and ``values`` are the merge table as arrays.
    """
    out: list = [None] * len(words)
    by_leaves: dict[int, list[int]] = {}
    for r, w in enumerate(words):
        if len(w) < 2:
            out[r] = w
        else:
            by_leaves.setdefault(1 << (len(w) - 2).bit_length() if len(w) > 2 else 1, []).append(r)

    def ranks(a, b):
        key = a << 20 | b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, values[at], _NONE)

    for leaves, members in by_leaves.items():
        k, width = len(members), leaves + 1
        lengths = np.array([len(words[r]) for r in members])
        filled = np.arange(width) < lengths[:, None]
        symbols = np.full((k, width), -1, dtype=np.int64)
        symbols[filled] = [x for r in members for x in words[r]]
        tree = np.full((k, 2 * leaves), _NONE, dtype=np.int64)
        paired = filled[:, 1:]
        tree[:, leaves:][paired] = ranks(symbols[:, :-1][paired], symbols[:, 1:][paired])
        level = leaves
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        after = np.tile(np.arange(1, width + 1), (k, 1))
        before = np.tile(np.arange(-1, width - 1), (k, 1))
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            lowest = tree[rows, 1]
            node = np.ones(len(rows), dtype=np.int64)
            while node[0] < leaves:                        # all rows walk down one level at a time
                node *= 2
                node += tree[rows, node] != lowest
            i = node - leaves
            j = after[rows, i]
            merged = lowest & 0xFFFFF
            symbols[rows, i] = merged
            symbols[rows, j] = -1
            end = after[rows, j]
            after[rows, i] = end
            inside = j < leaves
            tree[rows[inside], leaves + j[inside]] = _NONE
            more = end < lengths[rows]
            tree[rows[~more], leaves + i[~more]] = _NONE
            before[rows[more], end[more]] = i[more]
            tree[rows[more], leaves + i[more]] = ranks(merged[more], symbols[rows[more], end[more]])
            left = before[rows, i]
            has_left = left >= 0
            tree[rows[has_left], leaves + left[has_left]] = ranks(symbols[rows[has_left], left[has_left]], merged[has_left])
            paths = [leaves + i, leaves + np.minimum(j, leaves - 1), leaves + np.maximum(left, 0)]
            level = leaves
            while level > 1:                               # the three changed paths, level by level up to the root
                level //= 2
                for n, path in enumerate(paths):
                    path = path >> 1
                    paths[n] = path
                    tree[rows, path] = np.minimum(tree[rows, 2 * path], tree[rows, 2 * path + 1])
            rows = rows[tree[rows, 1] != _NONE]
        kept = symbols >= 0
        ends = np.cumsum(kept.sum(axis=1))
        flat = symbols[kept].tolist()
        start = 0
        for r, end in zip(members, ends.tolist(), strict=True):
            out[r] = flat[start:end]
            start = end
    return out


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


#: Unicode's White_Space (fixed values)
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: letters and numbers that Unicode 16 added to 15.1 (fixed values); Python's own tables may be older
_UNICODE_16 = {
    "L": [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
          (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
          (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
          (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
          (0x1E5F0, 0x1E5F0)],
    "N": [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
          (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)],
}

#: capital letters of Unicode 16 and 17 and the distance to their small letters (fixed values)
_NEW_CAPITALS = {0x1C89: 1, 0xA7CB: 0x264 - 0xA7CB, 0xA7CC: 1, 0xA7CE: 1, 0xA7D2: 1, 0xA7D4: 1, 0xA7DA: 1,
                 0xA7DC: 0x19B - 0xA7DC, **dict.fromkeys(range(0x10D50, 0x10D66), 0x20),
                 **dict.fromkeys(range(0x16EA0, 0x16EB9), 0x1B)}
_NEW_CAPITAL = re.compile("[" + "".join(map(chr, _NEW_CAPITALS)) + "]")


@lru_cache(maxsize=4)
def _class(kind: str, top: int) -> str:
    """Ranges of the characters up to ``top`` whose category starts with ``kind``, for a character class."""
    out, start = [], None
    added = {c for a, b in _UNICODE_16[kind] for c in range(a, b + 1)}
    for c in range(top + 2):
        inside = c <= top and (c in added or unicodedata.category(chr(c))[0] == kind)
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


class Vocabulary:
    """One vocabulary file: word cutting, merges, special tokens and token strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            # only the last symbol of a word carries the suffix
            self.merges.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        self.keys = np.array(sorted(self.merges), dtype=np.int64)
        self.values = np.array([self.merges[k] for k in self.keys.tolist()], dtype=np.int64)
        letters = _byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + suffix] for x in letters]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.latin_words = self._words(0xFF)
        self._all_words = None
        top = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [""] * top
        for token, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = token
        self.cache: dict[str, bytes] = {}

    def _words(self, top: int) -> re.Pattern:
        """The file's word pattern with its classes spelled out up to character ``top``."""
        letter, number = _class("L", top), _class("N", top)
        pattern = self.pattern.replace(r"[\p{L}]", f"[{letter}]").replace(r"[\p{N}]", f"[{number}]")
        return re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_WHITE}{letter}{number}]"))

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        try:
            text.encode("latin-1")
            return self.latin_words.findall(text.lower())
        except UnicodeEncodeError:
            pass
        if self._all_words is None:
            self._all_words = self._words(sys.maxunicode)
        # lower case letter by letter, without the rule for a final sigma
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = _NEW_CAPITAL.sub(lambda m: chr(ord(m[0]) + _NEW_CAPITALS[ord(m[0])]), text)
        return self._all_words.findall(text.lower())

    def _symbols(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        out = [self.inner[b] for b in raw]
        out[-1] = self.last[raw[-1]]
        return out

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids (little-endian 32-bit integers) of the words that the cache does not hold yet."""
        fresh = list(words)
        symbols = [self._symbols(w) for w in fresh]
        short = [r for r, x in enumerate(symbols) if len(x) <= SIDE_BY_SIDE]
        merged = dict(zip(short, merge_side_by_side([symbols[r] for r in short], self.keys, self.values), strict=True))
        out = {}
        for r, w in enumerate(fresh):
            ids = merged[r] if r in merged else merge_word(symbols[r], self.merges)
            out[w] = np.array(ids, dtype="<u4").tobytes()
        return out

    def pieces(self, text: str | None) -> list:
        """Words of a text, and ids for special tokens."""
        if not text:
            return []
        out: list = []
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                out += self.words(piece)
        return out

    def encode_block(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.pieces(t) for t in texts]
        wanted = {w for words in cut for w in words}
        special = {w: np.array([w], dtype="<u4").tobytes() for w in wanted if isinstance(w, int)}
        missing = {w for w in wanted if w not in special and w not in self.cache}
        if len(self.cache) + len(missing) > CACHED_WORDS:
            self.cache.clear()
            missing = wanted - special.keys()
        table = self.cache
        fresh = self.learn(missing)
        if len(fresh) > CACHED_WORDS:
            table = fresh
        else:
            # very long words are not worth remembering
            table.update((w, ids) for w, ids in fresh.items() if len(w) <= 64)
        special.update((w, ids) for w, ids in fresh.items() if len(w) > 64)
        if not special:
            return [b"".join([table[w] for w in words]) for words in cut]
        return [b"".join([table[w] if w in table else special[w] for w in words]) for words in cut]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        block, size = [], 0
        for t in texts:
            block.append(t)
            size += len(t or "")
            if size >= BLOCK_CHARS:
                yield from self.encode_block(block)
                block, size = [], 0
        yield from self.encode_block(block)

    def encode(self, text: str | None) -> bytes:
        return self.encode_block([text])[0]

    def decode(self, ids: bytes | None) -> str:
        """Token strings joined by blanks, as a vocabulary without a decoder does."""
        strings = self.strings
        return " ".join([strings[i] for i in np.frombuffer(ids or b"", dtype="<u4").tolist()])


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(df: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """Input columns plus ``ids``: binary, little-endian unsigned 32-bit integers."""
    path = path or default_vocabulary()
    ship_package(df.sparkSession)

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(list(load(path).encode_all(texts)), dtype=object)

    return df.withColumn("ids", ids(F.col(text)))


def decode(df: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """Input columns plus ``decoded``: string."""
    path = path or default_vocabulary()
    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def decoded(batch: pd.Series) -> pd.Series:
        vocabulary = load(path)
        return pd.Series([vocabulary.decode(x) for x in batch], dtype=object)

    return df.withColumn("decoded", decoded(F.col(ids)))


def encode_decode(df: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """Input columns plus ``ids`` and ``decoded`` in one pass over the texts."""
    path = path or default_vocabulary()
    ship_package(df.sparkSession)

    @F.pandas_udf("ids binary, decoded string")
    def both(texts: pd.Series) -> pd.DataFrame:
        vocabulary = load(path)
        ids = list(vocabulary.encode_all(texts))
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                             "decoded": pd.Series([vocabulary.decode(x) for x in ids], dtype=object)})

    return df.withColumn("_both", both(F.col(text))).select(*[F.col(f"`{c}`") for c in df.columns], "_both.*")


def digests(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    coded = encode_decode(df.select("doc_id", "text"), path)
    return coded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1(spark, sf_dir) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))
