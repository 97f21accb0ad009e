"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context-window scores.

The lexicon is learned from labelled documents: whole words and word stems
(prefixes) that are much more frequent in toxic documents.  Its trie is
intersected with the Levenshtein automaton of distance 1: a state is the set of
(trie node, errors so far) that a word read so far can be in; states are built
when first reached.  So misspelled terms are found in one pass over a word's
letters, without comparing it with every term.

Each hit weighs as its term does, less if misspelled.  A window of words around
it separates quotation (between quote marks, or next to a word of
reporting) from abuse (addressed to someone, or together with other hits).
Document features of these scores go through a logistic regression trained in
numpy on the same labelled rows.

Only rows of ``labels`` whose ``crc32(doc_id as text) mod 3`` is not 1 are learned
from; labels, lang, source and doc_id are never inputs of a score.

Defined cases: null and empty texts have no hits and get the score of a text
without hits; null labels and labels of unknown documents are not learned
from; a document labelled twice counts as often; without labelled toxic rows
every score is the share of toxic rows among the learned (0.5 if there are none,
below the threshold); an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read_table, ship_package

#: labelled rows that the lexicon and the weights are fitted on at most (half of them toxic if there are enough)
SAMPLE_ROWS = 6_000
#: words of the lexicon: share of toxic documents with it at least, share of its documents that are toxic at least, number
MIN_SHARE, MIN_PRECISION, MAX_TERMS = 0.008, 0.9, 600
#: stems: uses per toxic document at least, times as frequent as in clean documents at least, number
STEM_SHARE, STEM_LIFT, MAX_STEMS = 0.03, 5.0, 60
#: only words of this weight also match misspelled; a word's weight is the log of its share of toxic documents over its
#: share of clean ones, the latter raised by CLEAN_SHARE, so neither depends on the number of labelled rows
FUZZY_WEIGHT, CLEAN_SHARE = 1.4, 0.001
STEMS = (4, 5, 6, 7)
#: words near to a term that clean documents use (no misspellings), at most; the most frequent come first
MAX_EXCEPTIONS = 20_000
#: words of up to this length must match exactly, and so must stems; a stem stands for any word that starts with it
EXACT_LENGTH = 4
WINDOW = 8
THRESHOLD = 0.7
#: distinct words kept per worker
CACHED_WORDS = 400_000

WORD = re.compile(r"[^\W\d_]+|[\"“”„«»]")
QUOTES = frozenset("\"“”„«»")
#: words of reporting and of address (fixed values)
REPORTING = frozenset("said says called calls wrote quoted quote word term sagte nannte schrieb wort "
                      "dit disait appelle mot dijo llamó palabra".split())
ADDRESS = frozenset("you your youre du dich dein ihr tu toi vous tú usted eres".split())


class FuzzyLexicon:
    """Trie of terms run together with a Levenshtein automaton of distance 1, determinised on demand."""

    def __init__(self, terms: list[tuple[str, bool, float]], exceptions: list[str] = ()):
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.stem: dict[int, int] = {}
        self.terms = terms
        for t, (word, is_stem, _) in enumerate(terms):
            node = 0
            for c in word:
                if c not in self.children[node]:
                    self.children.append({})
                    self.children[node][c] = len(self.children) - 1
                node = self.children[node][c]
            (self.stem if is_stem else self.whole)[node] = t
        self.letters = {c for kids in self.children for c in kids}
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple | None] = []             # (term, errors) if a word may end here
        self.stops: list[tuple | None] = []               # (term, errors) if any word that gets here matches
        self.start = self._state(frozenset({(0, 0)}))
        self.exceptions = frozenset(exceptions)           # ordinary words: only an exact match counts
        self.cache: dict[str, tuple | None] = {}

    def _state(self, members: frozenset) -> int:
        if members not in self.numbers:
            self.numbers[members] = len(self.states)
            self.states.append(members)
            self.steps.append({})
            accept = stop = None
            for node, errors in members:
                ends = [(node, errors)]
                if errors == 0:                            # the term's last letter may be missing
                    ends += [(kid, 1) for kid in self.children[node].values()]
                for at, e in ends:
                    if at in self.whole and (e == 0 or self._fuzzy(self.whole[at])):
                        accept = min(accept or (9, 0), (e, self.whole[at]))
                if node in self.stem and errors == 0:
                    stop = min(stop or (9, 0), (0, self.stem[node]))
            self.accepts.append(accept)
            self.stops.append(stop)
        return self.numbers[members]

    def _fuzzy(self, term: int) -> bool:
        word, _, weight = self.terms[term]
        return len(word) > EXACT_LENGTH and weight >= FUZZY_WEIGHT

    def _next(self, state: int, c: str) -> int:
        out = set()
        for node, errors in self.states[state]:
            kids = self.children[node]
            if c in kids:
                out.add((kids[c], errors))
            if errors == 0:
                out.add((node, 1))                         # c is one letter too many
                for kid in kids.values():
                    out.add((kid, 1))                      # c stands for another letter
                    if c in self.children[kid]:
                        out.add((self.children[kid][c], 1))    # a letter is missing before c
        out -= {(n, 1) for n, e in out if e == 0}
        return self._state(frozenset(out))

    def match(self, word: str) -> tuple | None:
        """(errors, term) of the best match of a word, or None; whole words come before stems among ``terms``."""
        if word in self.cache:
            return self.cache[word]
        state, found = self.start, None
        for c in word:
            key = c if c in self.letters else ""
            following = self.steps[state].get(key)
            if following is None:
                following = self.steps[state][key] = self._next(state, key)
            state = following
            if self.stops[state]:
                found = min(found or (9, 0), self.stops[state])
            if not self.states[state]:
                break
        else:
            if self.accepts[state]:
                found = min(found or (9, 0), self.accepts[state])
        if found and found[0] and word in self.exceptions:
            found = None
        if len(self.cache) >= CACHED_WORDS:
            self.cache.clear()
        self.cache[word] = found
        return found


def features(lexicon: FuzzyLexicon, text: str | None) -> list[float]:
    """Context-scored hits of one text: sum, densest window, distinct terms, misspelled share, density, length; stems."""
    words = WORD.findall((text or "").lower())
    cache, match = lexicon.cache, lexicon.match
    hits = []
    for i, w in enumerate(words):
        m = cache[w] if w in cache else match(w)
        if m is not None:
            hits.append((i, m))
    n = max(1, len(words))
    if not hits:
        return [0.0, 0.0, 0.0, 0.0, 0.0, np.log(n), 0.0, 0.0]
    quotes = np.cumsum([w in QUOTES for w in words])
    total, stems, best, terms, fuzzy = 0.0, 0.0, 0.0, set(), 0
    scored = []
    for i, (errors, term) in hits:
        _, is_stem, weight = lexicon.terms[term]
        if is_stem:
            stems += weight
            continue
        weight *= 0.6 if errors else 1.0
        near = words[max(0, i - WINDOW):i + WINDOW + 1]
        open_quote = quotes[i] % 2 == 1 and any(w in QUOTES for w in words[i + 1:i + 4 * WINDOW])
        reported = any(w in REPORTING for w in near)
        if (open_quote or reported) and not any(w in ADDRESS for w in near):
            weight *= 0.4
        scored.append((i, weight))
        total += weight
        terms.add(term)
        fuzzy += errors
    first = 0
    running = 0.0
    for i, weight in scored:
        running += weight
        while scored[first][0] < i - 2 * WINDOW:
            running -= scored[first][1]
            first += 1
        best = max(best, running)
    return [np.log1p(total), best, float(min(len(terms), 5)), fuzzy / len(hits), np.log1p(total / n * 100), np.log(n),
            np.log1p(stems), np.log1p(stems / n * 100)]


def _fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, penalty: float = 1.0):
    """Newton steps; returns (mean, scale, weights with the constant last)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text and y of at most ``rows`` labelled rows to learn from, chosen by hash, toxic ones first up to half."""
    known = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select("doc_id", F.col("toxic").cast("int").alias("y")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = known.filter("y = 1").orderBy(*order).limit(rows // 2)
    clean = known.filter("y = 0").orderBy(*order).limit(rows // 2)
    chosen = cut(toxic.union(clean))                      # at most ``rows`` rows
    return cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y"))


def _stems(k: int):
    """Prefix of k letters, marked, of each longer word."""
    cut_off = F.transform("words", lambda w: F.when(F.length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*"))))
    return F.filter(cut_off, lambda x: x.isNotNull())


def learn_lexicon(sample: DataFrame) -> tuple[list[tuple[str, bool, float]], list[str]]:
    """(term, is stem, weight) of words and stems far more frequent in toxic documents; and words of clean ones near them."""
    n_toxic = sample.filter("y = 1").count()
    if not n_toxic:
        return [], []
    words = F.array_distinct(F.expr(r"regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}]+', 0)"))
    listed = cut(sample.dropDuplicates(["text"]).select("y", words.alias("words")))
    counted = cut(listed.select("y", F.explode(F.concat("words", *[_stems(k) for k in STEMS])).alias("term"))
                  .groupBy("term").agg(F.sum("y").cast("double").alias("t"), F.count("*").cast("double").alias("n")))
    sums = listed.groupBy("y").agg(F.count("*").alias("texts"), F.sum(F.size("words")).alias("n")).collect()
    used, texts = {r["y"]: float(r["n"] or 0) for r in sums}, {r["y"]: r["texts"] for r in sums}
    is_stem, t, c = F.col("term").endswith("*"), F.col("t"), F.col("n") - F.col("t")
    pure = ~is_stem & (t >= max(3.0, MIN_SHARE * n_toxic)) & (t / F.col("n") >= MIN_PRECISION) & (F.length("term") >= 3)
    rows = counted.filter(pure).orderBy(F.desc("t"), "term").limit(MAX_TERMS).collect()     # bounded reports
    terms = [(r["term"], False, float(np.log(r["t"] / texts.get(1, n_toxic)
                                             / ((r["n"] - r["t"]) / max(texts.get(0, 0), 1) + CLEAN_SHARE))))
             for r in rows]
    lift = (t / max(used.get(1, 1.0), 1.0)) / ((c + 0.5) / max(used.get(0, 1.0), 1.0))
    frequent = is_stem & (t >= max(5.0, STEM_SHARE * n_toxic)) & (lift >= STEM_LIFT)
    rows = (counted.filter(frequent).select("term", "t", F.log(lift).alias("w"))
            .orderBy(F.desc(t * F.log(lift)), "term").limit(20 * MAX_STEMS).collect())
    stems: list[str] = []
    for r in rows:
        body = r["term"].rstrip("*")
        if len(stems) < MAX_STEMS and not any(body.startswith(x) or x.startswith(body) for x in stems):
            stems.append(body)
            terms.append((body, True, float(r["w"])))

    def near(batches):
        lexicon = FuzzyLexicon(terms)
        for batch in batches:
            hit = [(lexicon.match(w) or (0, 0))[0] == 1 for w in batch["term"]]
            yield batch[np.array(hit, dtype=bool)]

    known = counted.filter((F.col("n") > F.col("t")) & ~F.col("term").endswith("*"))
    exceptions = known.mapInPandas(near, counted.schema).orderBy(F.desc("n"), "term").limit(MAX_EXCEPTIONS)
    return terms, [r["term"] for r in exceptions.collect()]


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """Lexicon and weights from labelled rows."""
    ship_package(docs.sparkSession)
    sample = _sample(docs, labels, rows)
    terms, exceptions = learn_lexicon(sample)
    shares = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n, toxic = sum(shares.values()), shares.get(1, 0)
    if not terms or not shares.get(0):
        return {"terms": [], "prior": toxic / n if n and not terms else (1.0 if toxic else 0.5)}

    def measure(batches):
        lexicon = FuzzyLexicon(terms, exceptions)
        for batch in batches:
            x = [features(lexicon, t) for t in batch["text"]]
            yield pd.DataFrame({"x": x, "y": batch["y"]})

    rows_ = sample.mapInPandas(measure, "x array<double>, y int").collect()            # bounded by ``rows``
    x = np.array([r["x"] for r in rows_])
    y = np.array([r["y"] for r in rows_], dtype=float)
    order = np.lexsort([*x.T, y])                          # sums do not depend on the order of arrival
    mean, scale, w = _fit_logistic(x[order], y[order])
    return {"terms": terms, "exceptions": exceptions, "mean": mean, "scale": scale, "w": w}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Input columns plus ``score`` (0 to 1)."""
    ship_package(docs.sparkSession)
    if not model["terms"]:
        return docs.withColumn("score", F.lit(float(min(model["prior"], 0.5))))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        lexicon = model.get("_lexicon")
        if lexicon is None:
            lexicon = model["_lexicon"] = FuzzyLexicon(model["terms"], model["exceptions"])
        x = np.array([features(lexicon, t) for t in texts]).reshape(len(texts), -1)
        z = (x - model["mean"]) / model["scale"] @ model["w"][:-1] + model["w"][-1] if len(x) else np.zeros(0)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn("score", scored(F.col(text)))


def op10(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
