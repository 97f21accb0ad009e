"""Secret scan: a linear-chain conditional random field over tokens, beside an exact base grammar.

Base spans (assign, access, hex) come from fixed patterns and always stay.
The field tags every token of every text as secret-begin, secret-inside or
outside from its shape, its identity, its neighbours and features of the
whole file, and is decoded by Viterbi.  It is trained in numpy on windows of a
bounded sample (labels: the values of base spans, plus the same contexts with
other key words and values of other shapes).

Decoding is exact: a token whose best secret score lies further below its
outside score than twice the range of the transitions is outside on the best
path in any case, so the chain is cut there and only the pieces between are
decoded, many at once.

Defined cases: null and empty texts have no spans; repeated rows are scanned
each; an empty table (or a sample without secrets) trains no model and the base
grammar stands alone; other columns are carried along by ``find_secrets``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, ship_package
from .crf import crf_gradient, viterbi

#: kinds of spans in order; ``other`` are those that the field adds
KINDS = ("assign", "access", "hex", "other")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_KEY = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)

#: documents that give training windows, windows at most, tokens of a window, rounds of training
SAMPLE_DOCS, SAMPLE_WINDOWS, WINDOW, ROUNDS = 6000, 2000, 24, 60
#: an added span has this many characters at least; its score must exceed a margin learned on every HELD_OUTth window,
#: at which this share of the spans is false at most
MIN_LENGTH, HELD_OUT, FALSE_SHARE = 6, 5, 0.05
#: texts are tokenised together up to about so many characters
BLOCK_CHARS = 500_000
_IDENTITIES = 1 << 12
TAGS = 3                                        # outside, begin, inside


# ---------------------------------------------------------------- base grammar

def base_matches(text: str | None) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the value) of the fixed patterns, by start, then kind."""
    if not text:
        return []
    folded, out = text.lower(), []
    if any(key in folded for key in _KEY_WORDS):           # cheap test first
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    out.sort()
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---------------------------------------------------------------- tokens and features

def _classes() -> np.ndarray:
    """0 space, 1 digit, 2 a-f, 3 g-z, 4 A-Z, 5 other letter and joiners of a token, 6 sign of its own."""
    table = np.full(0x81, 6, dtype=np.int8)
    for c in range(0x80):
        ch = chr(c)
        if ch.isspace():
            table[c] = 0
        elif "0" <= ch <= "9":
            table[c] = 1
        elif "a" <= ch <= "f":
            table[c] = 2
        elif "g" <= ch <= "z":
            table[c] = 3
        elif "A" <= ch <= "Z":
            table[c] = 4
        elif ch in "_+/-":
            table[c] = 5
    table[0x80] = 5
    return table


_TABLE = _classes()
#: feature blocks: own identity, shape, length, then neighbours' identity and shape, then file
_SHAPES = 4 * 4 * 4 * 2 * 4
_LENGTHS = 12
_NEIGHBOURS = (-3, -2, -1, 1, 2)
_FILE = 16
_WIDTHS = [_IDENTITIES, _SHAPES, _LENGTHS, *[_IDENTITIES, _SHAPES] * len(_NEIGHBOURS), _FILE, 1]
_OFFSETS = np.concatenate(([0], np.cumsum(_WIDTHS)[:-1]))
N_FEATURES = int(sum(_WIDTHS))


def tokenise(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over all texts: document number, start, end (in the text) and features (token x block) of every token."""
    lengths = np.array([len(t) + 1 for t in texts])
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    classes = _TABLE[np.minimum(points, 0x80)]
    word = (classes > 0) & (classes < 6)
    before = np.concatenate(([False], word[:-1]))
    starts = np.flatnonzero((word & ~before) | (classes == 6))
    if not len(starts):
        return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros((0, len(_WIDTHS)), np.int64)
    after = np.concatenate((word[1:], [False]))
    ends = np.flatnonzero((word & ~after) | (classes == 6)) + 1
    bounds = np.ravel(np.column_stack((starts, ends)))
    if bounds[-1] == len(points):
        bounds = bounds[:-1]

    def count(flags):
        return np.add.reduceat(flags.astype(np.int32), bounds)[::2]

    size = ends - starts
    digit, af, lower, upper = (count(classes == c) for c in (1, 2, 3, 4))
    switch = np.concatenate(([0], (classes[1:] != classes[:-1]).astype(np.int32)))
    switch[starts] = 0
    switches = np.add.reduceat(switch, bounds)[::2]
    # identity without case: position-weighted sum, spread by a multiplier
    folded = np.where((points >= 65) & (points <= 90), points + 32, points).astype(np.uint64)
    owner = np.repeat(np.arange(len(starts)), size)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    flat = np.repeat(starts, size) + inside
    weight = (inside.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
    mixed = folded[flat] * weight
    mixed ^= mixed >> np.uint64(29)
    first = np.cumsum(size) - size
    identity = np.add.reduceat(mixed, first) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(52)
    identity = identity.astype(np.int64)

    def quarter(part):
        """0 none, 1 some, 2 over a third, 3 all."""
        return np.where(part == 0, 0, np.where(part == size, 3, np.where(3 * part > size, 2, 1)))

    mix = np.minimum(switches // 2, 3)
    hexlike = ((digit + af == size) & (digit > 0)).astype(np.int64)
    shape = (((quarter(digit) * 4 + quarter(af + lower)) * 4 + quarter(upper)) * 2 + hexlike) * 4 + mix
    steps = np.array([1, 2, 3, 4, 6, 8, 12, 16, 20, 24, 32])
    length = np.searchsorted(steps, size, side="right")
    offsets = np.cumsum(lengths) - lengths
    doc = np.searchsorted(offsets, starts, side="right") - 1
    # file features: how much of its tokens are signs, and how many carry digits
    tokens_of = np.bincount(doc, minlength=len(texts))
    signs = np.bincount(doc, weights=classes[starts] == 6, minlength=len(texts)) / np.maximum(tokens_of, 1)
    digits = np.bincount(doc, weights=digit > 0, minlength=len(texts)) / np.maximum(tokens_of, 1)
    file = np.digitize(signs, [0.1, 0.2, 0.4]) * 4 + np.digitize(digits, [0.002, 0.02, 0.1])
    blocks = [identity, shape, length]
    n = len(starts)
    for d in _NEIGHBOURS:
        at = np.arange(n) + d
        known = (at >= 0) & (at < n)
        at = np.clip(at, 0, n - 1)
        known &= doc[at] == doc
        blocks += [np.where(known, identity[at], 0), np.where(known, shape[at], 0)]
    blocks += [file[doc], np.zeros(n, np.int64)]
    features = np.column_stack(blocks) + _OFFSETS
    return doc, starts - offsets[doc], ends - offsets[doc], features


# ---------------------------------------------------------------- the field

def train(features: np.ndarray, tags: np.ndarray, real: np.ndarray, rounds: int = ROUNDS) -> dict | None:
    """Weights from windows: ``features`` (window, time, block), ``tags`` and ``real`` (window, time)."""
    if not len(features) or not (tags > 0).any():
        return None
    weights = np.zeros((N_FEATURES, TAGS))
    trans = np.zeros((TAGS, TAGS))
    squares, trans_squares = np.zeros_like(weights), np.zeros_like(trans)
    flat = features.reshape(-1, features.shape[2])
    gone = ~real.reshape(-1)
    y = np.ascontiguousarray(tags.T)
    for _ in range(rounds):
        scores = weights[flat].sum(axis=1)
        scores[gone] = (0.0, -30.0, -30.0)
        shaped = scores.reshape(*tags.shape, TAGS).transpose(1, 2, 0)
        _, d_scores, d_trans = crf_gradient(shaped, trans, y)
        d = d_scores.transpose(2, 0, 1).reshape(-1, TAGS) * len(tags)
        d[gone] = 0
        grad = np.column_stack([np.bincount(flat.ravel(), weights=np.repeat(d[:, k], flat.shape[1]), minlength=N_FEATURES)
                                for k in range(TAGS)]) + 0.005 * weights
        squares = 0.9 * squares + 0.1 * grad * grad
        weights -= 0.08 * grad / np.sqrt(squares + 1e-8)
        step = d_trans * len(tags)
        trans_squares = 0.9 * trans_squares + 0.1 * step * step
        trans = np.clip(trans - 0.04 * step / np.sqrt(trans_squares + 1e-8), -1.5, 1.5)
    return {"weights": weights.astype(np.float32), "trans": trans.astype(np.float32)}


def decode(model: dict, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Tag of every token; chains are the documents."""
    weights, trans = model["weights"], model["trans"]
    scores = np.zeros((len(features), TAGS), np.float32)
    for column in features.T:
        scores += weights[column]
    out = np.zeros(len(features), np.int8)
    reach = 2 * float(trans.max() - trans.min())
    open_ = scores[:, 1:].max(axis=1) - scores[:, 0] >= -reach
    at = np.flatnonzero(open_)
    if not len(at):
        return out
    breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(doc[at]) != 0)) + 1
    firsts, lasts = at[np.concatenate(([0], breaks))], at[np.concatenate((breaks - 1, [len(at) - 1]))]
    sizes = lasts - firsts + 1
    # an outside token stands before and after each piece
    for bits in np.unique(np.ceil(np.log2(sizes + 2)).astype(int)):
        pick = np.flatnonzero(np.ceil(np.log2(sizes + 2)).astype(int) == bits)
        width = 1 << int(bits)
        per = max(1, 2_000_000 // width)
        for some in range(0, len(pick), per):
            chosen = pick[some:some + per]
            index = firsts[chosen][None, :] + np.arange(width)[:, None] - 1
            inside = (np.arange(width)[:, None] >= 1) & (np.arange(width)[:, None] <= sizes[chosen][None, :])
            piece = scores[np.where(inside, index, 0)]
            piece[~inside] = (0.0, -1e4, -1e4)
            found = viterbi(np.ascontiguousarray(piece.transpose(0, 2, 1)), trans)
            out[index[inside]] = found[inside]
    return out


def runs(model: dict, features: np.ndarray, doc: np.ndarray, tags: np.ndarray) -> list[tuple[int, int, float]]:
    """(first token, last token, mean lead over ``outside``) of every secret among ``tags``."""
    hits = np.flatnonzero(tags > 0)
    scores = model["weights"][features[hits]].sum(axis=1)
    leads = (scores[np.arange(len(hits)), tags[hits]] - scores[:, 0]).tolist()
    hits, out, at = hits.tolist(), [], 0
    while at < len(hits):
        start, first, last = at, hits[at], hits[at]
        while at + 1 < len(hits) and hits[at + 1] == last + 1 and tags[last + 1] == 2 and doc[last + 1] == doc[first]:
            at += 1
            last = hits[at]
        at += 1
        out.append((first, last, sum(leads[start:at]) / (at - start)))
    return out


def learn_margin(model: dict, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> float:
    """Least lead at which at most FALSE_SHARE of the spans in held-out windows are false."""
    doc, features, truth = np.nonzero(real)[0], x[real], y[real]
    found = runs(model, features, doc, decode(model, features, doc)) if len(doc) else []
    judged = [(lead, not (truth[a:b + 1] > 0).any()) for a, b, lead in found]
    for margin in [0.0, *sorted(lead for lead, false in judged if false)]:
        kept = [false for lead, false in judged if lead > margin]
        if sum(kept) <= FALSE_SHARE * len(kept):
            return margin
    return 0.0


def _plausible(piece: str) -> bool:
    """Contract's least length of an added span."""
    return len(piece) >= MIN_LENGTH


def scan(model: dict | None, texts: list[str | None]) -> list[tuple[list, list]]:
    """(base spans, all spans) of every text, as (start, kind number, end)."""
    texts = [t or "" for t in texts]
    bases = [[(a, k, b) for a, k, b, _ in base_matches(t)] for t in texts]
    if model is None:
        return [(b, b) for b in bases]
    out: list = []
    block, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size < BLOCK_CHARS and i < len(texts) - 1:
            continue
        some = texts[block:i + 1]
        doc, starts, ends, features = tokenise(some)
        tags = decode(model, features, doc) if len(doc) else np.zeros(0, np.int8)
        added: dict[int, list] = {}
        for first, last, lead in runs(model, features, doc, tags):
            if lead > model.get("margin", 0.0):
                added.setdefault(int(doc[first]), []).append((int(starts[first]), 3, int(ends[last])))
        for d, text in enumerate(some):
            base = bases[block + d]
            extra = [s for s in added.get(d, []) if all(s[2] <= a or s[0] >= b for a, _, b in base)
                     and _plausible(text[s[0]:s[2]])]
            out.append((base, sorted(base + extra)))
        block, size = i + 1, 0
    return out


# ---------------------------------------------------------------- training windows

_OTHER_KEYS = ("pwd", "pass", "auth", "credential", "bearer", "access_key", "client_key", "private")
_PLAIN_KEYS = ("name", "user", "city", "title", "path", "date", "note", "color")
_BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def _weak_value(rng) -> str:
    """A short, letters-only or digits-only value."""
    letters, low, high = [(_BASE62, 6, 12), (_BASE62[26:52], 6, 21), (_BASE62[52:], 6, 13)][rng.integers(3)]
    return "".join(letters[i] for i in rng.integers(0, len(letters), int(rng.integers(low, high))))


def training_pieces(text: str, rng) -> list[tuple[str, str]]:
    """(piece of text, value ranges as ``start:end``): around up to 3 secrets, as found and changed, and plain pieces."""
    found, out = base_matches(text), []
    for a, kind, b, value in found[:3]:
        left, right = text[max(0, a - 60):a], text[b:b + 60]
        if base_matches(left) or base_matches(right):
            continue
        key = text[a:value]
        out.append((left + text[a:b] + right, f"{len(left) + len(key)}:{len(left) + b - a}"))
        if kind == 0:
            key = _KEY.sub(_OTHER_KEYS[rng.integers(len(_OTHER_KEYS))], key)
        fresh = "".join(_BASE62[i] for i in rng.integers(0, 62, int(rng.integers(16, 41))))
        out.append((left + key + fresh + right, f"{len(left) + len(key)}:{len(left) + len(key) + len(fresh)}"))
        for other in rng.choice(_OTHER_KEYS, 4, replace=False) if kind == 0 else ():
            key, weak = _KEY.sub(str(other), text[a:value]), _weak_value(rng)
            out.append((left + key + weak + right, f"{len(left) + len(key)}:{len(left) + len(key) + len(weak)}"))
        if kind == 0:
            key = _KEY.sub(_PLAIN_KEYS[rng.integers(len(_PLAIN_KEYS))], text[a:value])
            out.append((left + key + _weak_value(rng) + right, ""))
    start = int(rng.integers(0, max(1, len(text) - 150)))
    plain = text[start:start + 150]
    if not base_matches(text[max(0, start - 60):start + 210]):
        out.append((plain, ""))
    return out


def fit(df: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS) -> dict | None:
    """Field from at most ``windows`` windows of about ``sample_docs`` documents chosen by hash."""
    ship_package(df.sparkSession)
    n = df.count()
    share = max(1, int(min(1.0, sample_docs / max(n, 1)) * (1 << 20)))
    sample = df.filter(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share).select(F.col(text).alias("text"))

    def cut_out(batches):
        for batch in batches:
            rows = [r for t in batch["text"] if t for r in training_pieces(t, np.random.default_rng(len(t)))]
            yield pd.DataFrame(rows, columns=["piece", "spans"], dtype=str)

    pieces = sample.mapInPandas(cut_out, "piece string, spans string")
    order = (F.xxhash64("piece"), F.col("piece"))
    rows = (pieces.filter("spans <> ''").orderBy(*order).limit(windows // 2).collect()
            + pieces.filter("spans = ''").orderBy(*order).limit(windows // 2).collect())     # bounded by ``windows``
    if not rows:
        return None
    doc, starts, ends, features = tokenise([r["piece"] for r in rows])
    x = np.zeros((len(rows), WINDOW * 2, features.shape[1]), np.int64)
    y = np.zeros((len(rows), WINDOW * 2), np.int64)
    real = np.zeros((len(rows), WINDOW * 2), bool)
    for i, r in enumerate(rows):
        at = np.flatnonzero(doc == i)
        if not len(at):
            continue
        tags = np.zeros(len(at), np.int64)
        if r["spans"]:
            a, b = map(int, r["spans"].split(":"))
            inside = np.flatnonzero((starts[at] < b) & (ends[at] > a))
            tags[inside] = 2
            tags[inside[:1]] = 1
            middle = int(inside[0]) if len(inside) else 0
            first = max(0, min(middle - WINDOW, len(at) - 2 * WINDOW))
            at, tags = at[first:first + 2 * WINDOW], tags[first:first + 2 * WINDOW]
        at, tags = at[:2 * WINDOW], tags[:2 * WINDOW]
        x[i, :len(at)], y[i, :len(at)], real[i, :len(at)] = features[at], tags, True
    held = np.arange(len(rows)) % HELD_OUT == HELD_OUT - 1
    model = train(x[~held], y[~held], real[~held])
    if model is not None:
        model["margin"] = learn_margin(model, x[held], y[held], real[held])
    return model


# ---------------------------------------------------------------- operators

def find_secrets(df: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """Input columns plus ``n_assign n_access n_hex base_spans spans`` (spans as text ``kind:start:end,...``)."""
    ship_package(df.sparkSession)

    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string")
    def spans(texts: pd.Series) -> pd.DataFrame:
        rows = [(*(sum(k == i for _, k, _ in base) for i in range(3)), written(base), written(both))
                for base, both in scan(model, list(texts))]
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_spans", "spans"])

    return df.withColumn("_s", spans(F.col(text))).select(*[F.col(f"`{c}`") for c in df.columns], "_s.*")


def op5(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs, fit(docs)).select("doc_id", "n_assign", "n_access", "n_hex",
                                                F.sha2("base_spans", 256).alias("base_sha256"), "spans")
