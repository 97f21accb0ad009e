"""PII: a character-level bidirectional LSTM with CRF transitions, beside an exact base grammar.

Base spans (email, ip, card, phone) come from fixed patterns and always stay.
The model adds spans: it is trained in numpy on windows around labelled spans
of a bounded sample of documents (labels: the base grammar, plus variants of
phones and emails written in ways that the grammar does not cover), and
decodes every character of every text.  A text is cut into overlapping
windows; each is decoded by Viterbi, every character takes the tag of the
window in whose core it lies, and runs of tags are joined over window borders
in the coordinates of the whole text.

Gates and outputs use piecewise linear activations.  A window in which no
tag comes near to ``outside`` at any position is outside throughout: the bound
uses the largest transition, so leaving Viterbi out there changes nothing.

Defined cases: null and empty texts have no spans; repeated rows are scanned
each; an empty table (or a sample without spans) trains no model and the base
grammar stands alone; other columns are carried along by ``find_spans``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, ship_package
from .crf import crf_gradient, viterbi

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

#: documents that give training windows, windows at most, and weight updates of the training
SAMPLE_DOCS, SAMPLE_WINDOWS, UPDATES = 6000, 2400, 170
HIDDEN = 8
#: a window has CORE characters of its own and EDGE of context at either side
CORE, EDGE = 96, 16
WINDOW = CORE + 2 * EDGE
#: windows that are computed together
WINDOWS_AT_ONCE = 2048


# ---------------------------------------------------------------- base grammar

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start, then kind."""
    if not text:
        return []
    out = []
    if "@" in text:
        out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---------------------------------------------------------------- characters

_SINGLE = "@.+-()_%:/ ,\n\"'=[]*#&"
_CLASSES = 6 + len(_SINGLE)           # padding, lower, upper, digit, other letter, other sign, single signs


def _class_table() -> np.ndarray:
    table = np.full(0x250, 5, dtype=np.int64)
    for c in range(0x250):
        ch = chr(c)
        if "a" <= ch <= "z":
            table[c] = 1
        elif "A" <= ch <= "Z":
            table[c] = 2
        elif "0" <= ch <= "9":
            table[c] = 3
        elif ch.isalpha():
            table[c] = 4
        elif ch in _SINGLE:
            table[c] = 6 + _SINGLE.index(ch)
    return table


_TABLE = _class_table()


def char_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], 4)


# ---------------------------------------------------------------- the network

TAGS = 1 + len(KINDS)


def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h = HIDDEN

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    model = {"out": normal(TAGS, 2 * h, scale=0.3), "out_b": np.zeros(TAGS, np.float32),
             "trans": np.zeros((TAGS, TAGS), np.float32)}
    for side in ("f", "b"):
        model[f"x_{side}"] = normal(4 * h, _CLASSES, scale=0.4)
        model[f"h_{side}"] = normal(4 * h, h, scale=0.25)
        model[f"x_{side}"][h:2 * h] += 0.6                 # gates that forget start half open
    return model


def _run(model, side, classes, keep=False):
    """Hidden states (time, hidden, window) of one direction; rows of gates: input, forget, output, candidate."""
    h, (steps, n) = HIDDEN, classes.shape
    inputs, recurrent = model[f"x_{side}"], model[f"h_{side}"]
    states = np.empty((steps, h, n), np.float32)
    state, cell = np.zeros((h, n), np.float32), np.zeros((h, n), np.float32)
    z, x = np.empty((4 * h, n), np.float32), np.empty((4 * h, n), np.float32)
    trace = []
    order = range(steps) if side == "f" else range(steps - 1, -1, -1)
    for t in order:
        np.take(inputs, classes[t], axis=1, out=x, mode="clip")
        np.dot(recurrent, state, out=z)
        z += x
        gates = np.clip(z, -1, 1, out=None if keep else z)
        sig = gates[:3 * h]
        sig *= 0.5
        sig += 0.5
        if keep:
            previous = cell
            cell = cell * gates[h:2 * h] + gates[:h] * gates[3 * h:]
            shown = np.clip(cell, -1, 1)
            trace.append((t, z.copy(), gates, previous, cell, shown, state))
            state = gates[2 * h:3 * h] * shown
        else:
            cell *= gates[h:2 * h]
            np.multiply(gates[:h], gates[3 * h:], out=x[:h])
            cell += x[:h]
            np.clip(cell, -1, 1, out=x[:h])
            state = np.multiply(gates[2 * h:3 * h], x[:h], out=states[t])
        if keep:
            states[t] = state
    return states, trace


def _back(model, side, classes, trace, d_states, grads):
    """Adds the gradients of one direction."""
    h, n = HIDDEN, classes.shape[1]
    recurrent = model[f"h_{side}"]
    d_state, d_cell = np.zeros((h, n), np.float32), np.zeros((h, n), np.float32)
    for t, z, gates, previous, cell, shown, before in reversed(trace):
        d_state = d_state + d_states[t]
        d_cell = d_cell + d_state * gates[2 * h:3 * h] * (np.abs(cell) < 1)
        dz = np.concatenate([d_cell * gates[3 * h:], d_cell * previous, d_state * shown, d_cell * gates[:h]])
        dz[:3 * h] *= 0.5
        dz *= np.abs(z) < 1.5                              # a little past the bend, so that gates can come back
        grads[f"h_{side}"] += dz @ before.T
        summed = np.zeros((4 * h, _CLASSES), np.float32)
        onehot = np.zeros((n, _CLASSES), np.float32)
        onehot[np.arange(n), classes[t]] = 1
        np.dot(dz, onehot, out=summed)
        grads[f"x_{side}"] += summed
        d_state = recurrent.T @ dz
        d_cell = d_cell * gates[h:2 * h]


def emissions(model, classes, keep=False):
    forward, trace_f = _run(model, "f", classes, keep)
    backward, trace_b = _run(model, "b", classes, keep)
    h = HIDDEN
    scores = np.einsum("kh,thn->tkn", model["out"][:, :h], forward, optimize=True)
    scores += np.einsum("kh,thn->tkn", model["out"][:, h:], backward, optimize=True)
    scores += model["out_b"][None, :, None]
    return (scores, forward, backward, trace_f, trace_b) if keep else scores


def train(classes: np.ndarray, tags: np.ndarray, updates: int = UPDATES, batch: int = 200, rate: float = 0.02,
          seed: int = 7) -> dict[str, np.ndarray] | None:
    """Model from windows: ``classes`` and ``tags`` are (window, time) arrays.  None without any labelled span."""
    if not len(classes) or not (tags > 0).any():
        return None
    rng = np.random.default_rng(seed)
    model = new_model(seed)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    step, h = 0, HIDDEN
    epochs = -(-updates // -(-len(classes) // batch))
    for epoch in range(epochs):
        order = rng.permutation(len(classes))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            x, y = np.ascontiguousarray(classes[pick].T), np.ascontiguousarray(tags[pick].T)
            scores, forward, backward, trace_f, trace_b = emissions(model, x, keep=True)
            _, d_scores, d_trans = crf_gradient(scores, model["trans"], y)
            grads = {k: np.zeros_like(v) for k, v in model.items()}
            grads["trans"] += d_trans
            grads["out_b"] += d_scores.sum(axis=(0, 2))
            grads["out"][:, :h] += np.einsum("tkn,thn->kh", d_scores, forward, optimize=True)
            grads["out"][:, h:] += np.einsum("tkn,thn->kh", d_scores, backward, optimize=True)
            _back(model, "f", x, trace_f, np.einsum("kh,tkn->thn", model["out"][:, :h], d_scores, optimize=True), grads)
            _back(model, "b", x, trace_b, np.einsum("kh,tkn->thn", model["out"][:, h:], d_scores, optimize=True), grads)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            pace = rate * (1 - 0.8 * epoch / epochs)
            for k in model:
                g = grads[k] * min(1.0, 5.0 / (norm + 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                model[k] = (model[k] - pace * (mean[k] / (1 - 0.9 ** step))
                            / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return model


def decode_windows(model, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tags of windows given as (time, window), exact Viterbi wherever a span is possible at all; and by how much the
    score of each tag exceeds that of ``outside``."""
    scores = emissions(model, classes)
    trans = model["trans"]
    slack = 2 * max(0.0, float(trans.max() - trans[0, 0]))
    possible = np.flatnonzero((scores[:, 1:].max(axis=1) - scores[:, 0]).max(axis=0) >= -slack)
    out, lead = np.zeros(classes.shape, np.int8), np.zeros(classes.shape, np.float32)
    if len(possible):
        some = scores[:, :, possible]
        out[:, possible] = found = viterbi(some, trans)
        lead[:, possible] = np.take_along_axis(some, found[:, None, :].astype(np.int64), axis=1)[:, 0] - some[:, 0]
    return out, lead


def tag_texts(model, texts: list[str]) -> list[np.ndarray]:
    """Tags of every character of every text."""
    return [tags for tags, _ in tags_and_leads(model, texts)]


def tags_and_leads(model, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tags of every character of every text, and by how much their scores exceed those of ``outside``."""
    sizes = [-(-(len(t) + EDGE) // CORE) for t in texts]              # windows; at least EDGE padding after each text
    whole = np.zeros(EDGE + sum(sizes) * CORE + EDGE, dtype=np.int64)
    at = EDGE
    places = []
    for t, windows in zip(texts, sizes, strict=True):
        whole[at:at + len(t)] = char_classes(t)
        places.append(at)
        at += windows * CORE
    count = sum(sizes)
    tags, leads = np.zeros(len(whole), np.int8), np.zeros(len(whole), np.float32)
    for first in range(0, count, WINDOWS_AT_ONCE):
        n = min(WINDOWS_AT_ONCE, count - first)
        view = np.lib.stride_tricks.as_strided(whole[first * CORE:], (WINDOW, n), (whole.itemsize, CORE * whole.itemsize))
        found, lead = decode_windows(model, np.ascontiguousarray(view))
        tags[EDGE + first * CORE:EDGE + (first + n) * CORE] = found[EDGE:EDGE + CORE].T.ravel()
        leads[EDGE + first * CORE:EDGE + (first + n) * CORE] = lead[EDGE:EDGE + CORE].T.ravel()
    return [(tags[p:p + len(t)], leads[p:p + len(t)]) for p, t in zip(places, texts, strict=True)]


_AT = re.compile(r"@|[\[(]at[\])]|\x20at\x20", re.I)


#: a phone without country code, in separated groups of North America: taken at any score
_GROUPED = re.compile(r"(\+?[0-9]{1,3}[\x20.-])?(\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}")


#: any other number: only characters of phones, 7 to 15 digits, and this mean lead over ``outside`` of the tagged run
_NUMBER = re.compile(r"[+(]?[0-9][0-9\x20().\-/]*")
PHONE_DIGITS, PHONE_LEAD = (7, 15), 1.0


def _plausible(kind: int, piece: str, lead: float) -> bool:
    """Check of an added span whose tags lead ``outside`` by so much."""
    digits = sum(c in "0123456789" for c in piece)
    if kind == 0:
        return len(piece) >= 6 and bool(_AT.search(piece)) and sum(c.isalnum() for c in piece) >= 5
    if kind == 1:
        return 4 <= digits <= 12 and piece.count(".") == 3 and all(p.isdigit() and int(p) <= 255 for p in piece.split("."))
    if kind == 2:
        return 12 <= digits <= 19 and luhn("".join(c for c in piece if c in "0123456789"))
    loose = _NUMBER.fullmatch(piece) and PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1] and lead >= PHONE_LEAD
    return bool(loose or _GROUPED.fullmatch(piece))


def added_spans(text: str, tags: np.ndarray, leads: np.ndarray,
                base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of equal tags over the whole text, trimmed and checked, that touch no base span."""
    if not tags.any():
        return []
    runs = np.where(tags == 2, 4, tags)                    # numbers with dots: ip and phone tags are one run
    edges = np.flatnonzero(np.diff(np.concatenate(([0], runs, [0]))))
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        kind = int(runs[a]) - 1
        if kind < 0:
            continue
        lead, dotted = float(leads[a:b].mean()), bool((tags[a:b] == 2).any())
        while a < b and text[a] in " .,;:\n\"'-":
            a += 1
        while b > a and text[b - 1] in " .,;:(\n\"'-":
            b -= 1
        if kind == 3 and b > a:                            # a phone holds whole numbers
            while a and text[a] in "0123456789" and text[a - 1] in "0123456789":
                a -= 1
            while b < len(text) and text[b - 1] in "0123456789" and text[b] in "0123456789":
                b += 1
            if dotted and _plausible(1, text[a:b], lead):
                kind = 1
        if b > a and all(b <= s or a >= e for s, _, e in base) and _plausible(kind, text[a:b], lead):
            out.append((a, kind, b))
    return out


def scan(model, texts: list[str | None]) -> list[tuple[list, list]]:
    """(base spans, all spans) of every text."""
    texts = [t or "" for t in texts]
    bases = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in bases]
    out: list = []
    block, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= 400_000 or i == len(texts) - 1:
            tagged = tags_and_leads(model, texts[block:i + 1])
            for text, (tags, leads), base in zip(texts[block:i + 1], tagged, bases[block:i + 1], strict=True):
                out.append((base, sorted(base + added_spans(text, tags, leads, base))))
            block, size = i + 1, 0
    return out


# ---------------------------------------------------------------- training windows

def _variant(rng, kind: int, piece: str) -> str:
    """The same datum in another spelling, for kinds that have one."""
    digits = [c for c in piece if c in "0123456789"]
    if kind == 3 and len(digits) >= 10:
        a, b, c = "".join(digits[-10:-7]), "".join(digits[-7:-4]), "".join(digits[-4:])
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}"][rng.integers(5)]
    if kind == 0:
        name, _, host = piece.partition("@")
        return f"{name}{[' at ', '(at)', ' [at] ', ' @ '][rng.integers(4)]}{host}"
    return piece


#: national numbers: digits as 9, other signs as they are (France, Germany, Spain, Britain, unseparated, local)
_NATIONAL = ("09 99 99 99 99", "09.99.99.99.99", "09-99-99-99-99", "0999999999", "099 999999", "0999-9999999",
             "0999/9999999", "0999 999 99 99", "(0999) 999999", "099 9999 9999", "999 999 999", "99 999 99 99",
             "999999999", "9999999999", "999-9999", "999 99 99 99")


def _national(rng, piece: str) -> str:
    """The digits of a phone in the grouping of some country."""
    digits = [c for c in piece if c in "0123456789"]
    form = _NATIONAL[rng.integers(len(_NATIONAL))]
    left = digits[-form.count("9"):]
    return "".join(left.pop(0) if c == "9" and left else c for c in form)


def training_windows(text: str, rng) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Pieces of WINDOW characters at most: around up to 3 spans (as found and as variants), and one anywhere."""
    spans, out = base_spans(text), []
    for a, kind, b in spans[:3]:
        pieces = [text[a:b], _variant(rng, kind, text[a:b])]
        if kind == 3:
            pieces += [_national(rng, text[a:b]) for _ in range(2)]
        for change, piece in enumerate(pieces):
            if (change and piece == text[a:b]) or len(piece) > WINDOW - 8:
                continue
            left = int(rng.integers(4, max(5, WINDOW - len(piece) - 3)))
            before = text[max(0, a - left):a]
            after = text[b:b + WINDOW - len(before) - len(piece)]
            inside = [(s - (a - len(before)), k, e - (a - len(before))) for s, k, e in spans
                      if s >= a - len(before) and e <= a]
            shift = len(before) + len(piece) - b
            inside += [(s + shift, k, e + shift) for s, k, e in spans if s >= b and e + shift <= WINDOW]
            out.append((before + piece + after, [*inside, (len(before), kind, len(before) + len(piece))]))
    start = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
    out.append((text[start:start + WINDOW], [(s - start, k, e - start) for s, k, e in spans
                                             if s >= start and e <= start + WINDOW]))
    return out


def fit(df: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS):
    """Model from at most ``windows`` windows of about ``sample_docs`` documents chosen by hash.

    Windows with spans that are fewer than the others are repeated, so training sees at most
    twice ``windows``; the number of weight updates stays the same.
    """
    ship_package(df.sparkSession)
    n = df.count()
    share = max(1, int(min(1.0, sample_docs / max(n, 1)) * (1 << 20)))
    sample = df.filter(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share).select(F.col(text).alias("text"))

    def cut_out(batches):
        for batch in batches:
            rows = []
            for t in batch["text"]:
                if t:
                    rng = np.random.default_rng(len(t))
                    rows += [(w, written_spans) for w, s in training_windows(t, rng)
                             for written_spans in [",".join(f"{a}:{k}:{b}" for a, k, b in s)]]
            yield pd.DataFrame(rows, columns=["piece", "spans"], dtype=str)

    pieces = (sample.mapInPandas(cut_out, "piece string, spans string")
              .orderBy(F.length("spans") == 0, F.xxhash64("piece"), "piece").limit(3 * windows // 4))
    plain = (sample.mapInPandas(cut_out, "piece string, spans string").filter("spans = ''")
             .orderBy(F.xxhash64("piece"), "piece").limit(windows // 4))
    rows = pieces.collect() + plain.collect()              # bounded by ``windows``
    classes = np.zeros((len(rows), WINDOW), np.int64)
    tags = np.zeros((len(rows), WINDOW), np.int64)
    for i, r in enumerate(rows):
        found = char_classes(r["piece"])[:WINDOW]
        classes[i, :len(found)] = found
        for s in filter(None, r["spans"].split(",")):
            a, k, b = map(int, s.split(":"))
            tags[i, a:b] = 1 + k
    # where spans are rare, windows with spans are repeated until they are about half of all
    labelled = np.flatnonzero((tags > 0).any(axis=1))
    if len(labelled):
        times = -(-(len(rows) - len(labelled)) // len(labelled))
        picked = np.concatenate([np.arange(len(rows)), np.tile(labelled, max(0, times - 1))])
        classes, tags = classes[picked], tags[picked]
    return train(classes, tags)


# ---------------------------------------------------------------- operators

def find_spans(df: DataFrame, model, text: str = "text") -> DataFrame:
    """Input columns plus ``n_email n_ip n_card n_phone base_spans spans`` (spans as text ``kind:start:end,...``)."""
    ship_package(df.sparkSession)

    @F.pandas_udf("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, spans string")
    def spans(texts: pd.Series) -> pd.DataFrame:
        rows = [(*(sum(k == i for _, k, _ in base) for i in range(4)), written(base), written(both))
                for base, both in scan(model, list(texts))]
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans"])

    return df.withColumn("_p", spans(F.col(text))).select(*[F.col(f"`{c}`") for c in df.columns], "_p.*")


def redact(df: DataFrame, model, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``df`` with every span replaced by ``<KIND>`` and ``length`` set to the new number of characters."""
    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for t, (_, both) in zip(texts, scan(model, list(texts)), strict=True):
            if both:
                parts, at = [], 0
                for a, k, b in both:
                    if a >= at:
                        parts += [t[at:a], f"<{KINDS[k].upper()}>"]
                    at = max(at, b)
                t = "".join(parts) + t[at:]
            out.append(t)
        return pd.Series(out, dtype=object)

    out = df.withColumn(text, clean(F.col(text)))
    return out.withColumn(length, F.length(text).cast(df.schema[length].dataType)) if length in df.columns else out


def op9(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"),
                        "spans")
