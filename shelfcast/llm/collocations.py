"""Phrase collocations by best-first branch-and-bound growth of word sequences.

A phrase's score is the least, over its cuts, of ``floor(1000 a n / (l r))``: a is its
count, l and r are the counts of its two parts, n all words of the language.  As
a part occurs at least as often as the phrase, no phrase that starts with the
prefix p, or ends with the suffix p, scores more than ``1000 n / f(first word of p)`` or
``1000 n / f(last word of p)``: counts of prefixes bound whatever grows from them, and
a phrase below ``min_count`` has no extension above it.

The frontier holds single words in the order of their bounds, rarest first.  A round
takes the best part of it (``SHARES`` of a language's text), and grows phrases from both
ends word by word, only from prefixes and suffixes that are frequent themselves.  Scored
phrases then give the language's ``top``-th surviving score; every word whose bound
reaches that score, ties included, is expanded in the next round, after which the
language is settled.

Texts are read once: words become 64-bit hashes (seeds are tried until no two words
share one) in packed arrays, written to the shared folder with each block's word
counts.  Growth reads the arrays; counts of word sequences are summed by their
exact keys.  What is frequent is told to the tasks as a bitmap of bounded size; a false hit
counts a few sequences too many and changes no result.  A phrase that is always preceded (or
always followed) by one and the same word lies in a longer phrase of equal count and
is dropped: the smallest and largest neighbour are aggregated with the count.

Defined cases: null and empty texts have no words; a null language is ``und``; copies
and repeated rows count as often as they occur; equal scores go by count, then by the
phrase's bytes; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, ensure_checkpoint_dir, read_table, ship_package

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
#: shares of a language's words whose rarest words are expanded, round by round, until it is settled
SHARES = (1 / 4, 1.0)
#: bits of a bitmap, at most (16 MB)
BITMAP_BITS = 1 << 27
#: words of one packed array, words that are counted together, distinct words held by a task
ARRAY_WORDS, COUNT_WORDS, HELD_WORDS = 1 << 16, 1 << 18, 200_000
#: rows sent to Spark at a time
SENT_ROWS = 1 << 15
BREAK = np.uint64(0)
PACKED = "kind string, lang string, word binary, gram binary, c bigint, ids binary"

_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Language:
    """Words of one language in a task: those read since the last array, and counts of all held words."""

    def __init__(self, lang: str, seed: int):
        self.lang, self.seed = lang, seed
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers({b"": 0, b"\n": 1})
        self.known = np.zeros(2, np.uint64)                            # hashes of the numbered words, BREAK for "\n"
        self.counts = np.zeros(2, np.int64)
        self.read: list[np.ndarray] = []
        self.length = 0

    def add(self, text: bytes) -> None:
        tokens = text.lower().translate(_PIECES).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
        self.read.append(found[found > 0])
        self.read.append(np.ones(1, np.int32))                         # a document ends a piece
        self.length += len(found) + 1

    def array(self) -> pa.RecordBatch:
        """The packed array of what was read; the counts stay."""
        found = np.concatenate(self.read)
        fresh = [xxhash.xxh3_64_intdigest(w, self.seed) for w in islice(self.numbers, len(self.known), None)]
        self.known = np.concatenate([self.known, np.array(fresh, np.uint64)])
        self.counts = np.concatenate([self.counts, np.zeros(len(fresh), np.int64)])
        self.counts += np.bincount(found, minlength=len(self.known))
        self.read, self.length = [], 0
        return _rows("ids", self.lang, [None], [None], [len(found)], [self.known[found].tobytes()])

    def words(self):
        """Held words with their counts, which are held no longer."""
        words = list(self.numbers)
        for at in range(2, len(words), ARRAY_WORDS):
            to = min(at + ARRAY_WORDS, len(words))
            yield _rows("words", self.lang, words[at:to], _grams(self.known[at:to, None]), self.counts[at:to],
                        pa.nulls(to - at, pa.binary()))
        self.clear()


def _grams(columns: np.ndarray) -> pa.Array:
    """Rows of word hashes as binary values."""
    n, width = columns.shape
    offsets = np.arange(0, 8 * width * (n + 1), 8 * width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(columns))])


def _rows(kind: str, lang: str, word, gram, c, ids) -> pa.RecordBatch:
    n = len(c)
    return pa.record_batch([pa.repeat(kind, n), pa.repeat(lang, n), pa.array(word, pa.binary()), pa.array(gram, pa.binary()),
                            pa.array(c, pa.int64()), pa.array(ids, pa.binary())],
                           names=["kind", "lang", "word", "gram", "c", "ids"])


def _pack(seed: int):
    def pack(batches):
        held: dict[str, _Language] = {}

        def flush():
            for own in held.values():
                if own.length:
                    yield own.array()
                yield from own.words()
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                own = held.get(lang) or held.setdefault(lang, _Language(lang, seed))
                own.add(text.as_py())
                if own.length >= ARRAY_WORDS:
                    yield own.array()
                    if sum(len(x.numbers) for x in held.values()) > HELD_WORDS:
                        yield from flush()
            if len(held) > 1000:
                yield from flush()
        yield from flush()

    return pack


# ---------------------------------------------------------------- sequences and bitmaps

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _sequence_hash(columns: list[np.ndarray], lang: str) -> np.ndarray:
    """One hash of each sequence of words, given by columns."""
    out = np.full(len(columns[0]), xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")), np.uint64)
    for c in columns:
        out = _mixed(out * _MULTIPLY + c)
    return out


class Bitmap:
    """A set of sequences as bits of their hashes: false hits are possible, misses are not."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.shift, self.packed = np.uint64(64 - (bits.bit_length() - 1)), packed

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.packed[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(sequences: DataFrame, n: int) -> Bitmap:
    """Bitmap of ``n`` sequences (``lang``, ``gram``), of bounded size whatever ``n`` is."""
    bits = min(BITMAP_BITS, max(1 << 16, 1 << (16 * max(n, 1)).bit_length()))
    shift = 64 - (bits.bit_length() - 1)

    def places(batches):
        for batch in batches:
            for (lang, _), part in batch.groupby(["lang", batch["gram"].map(len)]):
                grams = np.frombuffer(b"".join(part["gram"]), np.uint64).reshape(len(part), -1)
                at = _sequence_hash(list(grams.T), lang) >> np.uint64(shift)
                yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int32),
                                    "bits": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    words = sequences.mapInPandas(places, "word int, bits bigint").groupBy("word") \
        .agg(F.bit_or("bits").alias("bits")).toPandas()
    packed = np.zeros(bits // 64, np.int64)
    packed[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return Bitmap(bits, packed.view(np.uint8))


COUNTED_NAMES = ["lang", "gram", "a", "left_min", "left_max", "right_min", "right_max"]
COUNTED = "lang string, gram binary, a bigint, left_min bigint, left_max bigint, right_min bigint, right_max bigint"


def _summed(partial: DataFrame) -> DataFrame:
    # tasks have summed what they read; a second sum before the exchange would hold much and save little
    return partial.repartition("lang", "gram").groupBy("lang", "gram").agg(
        F.sum("a").alias("a"), F.min("left_min").alias("left_min"), F.max("left_max").alias("left_max"),
        F.min("right_min").alias("right_min"), F.max("right_max").alias("right_max"))


def count_sequences(arrays: DataFrame, m: int, shared, min_count: int) -> DataFrame:
    """Counts of the sequences of ``m`` words that have a word of ``ends`` first or last and grow from a ``shorter`` one.

    ``shared``: broadcast (frequent, shorter, ends, done); ``frequent`` has the frequent words, ``done`` the end
    words of every earlier round, whose sequences are counted already.  A sequence is taken or left by its words
    alone, so that a count is always whole.  The neighbours are the hashes of the words
    before and after, 0 where there is none.
    """
    def grown(lang: str, w: np.ndarray):
        frequent, shorter, ends, done = shared.value
        if len(w) < m:
            return
        one = _sequence_hash([w], lang)
        usable = (w != BREAK) & frequent.has(one)
        run = usable[:len(w) - m + 1].copy()
        for j in range(1, m):
            run &= usable[j:len(w) - m + 1 + j]
        end = ends.has(one)
        at = np.flatnonzero(run & (end[:len(run)] | end[m - 1:]))
        for earlier in done:
            old = earlier.has(one)
            at = at[~(old[at] | old[at + m - 1])]
        if m > 2:
            head = shorter.has(_sequence_hash([w[at + j] for j in range(m - 1)], lang))
            tail = shorter.has(_sequence_hash([w[at + j] for j in range(1, m)], lang))
            at = at[(end[at] & head) | (end[at + m - 1] & tail)]
        if not len(at):
            return
        at = at[np.argsort(_sequence_hash([w[at + j] for j in range(m)], lang))]
        columns = np.stack([w[at + j] for j in range(m)], axis=1)
        new = np.ones(len(at), bool)
        new[1:] = (columns[1:] != columns[:-1]).any(axis=1)            # equal hashes of different words start anew
        first = np.flatnonzero(new)
        left = np.where(at > 0, w[np.maximum(at - 1, 0)], BREAK).view(np.int64)
        right = np.where(at + m < len(w), w[np.minimum(at + m, len(w) - 1)], BREAK).view(np.int64)
        out = pa.record_batch([
            pa.repeat(lang, len(first)), _grams(columns[first]), np.diff(np.append(first, len(at))),
            np.minimum.reduceat(left, first), np.maximum.reduceat(left, first),
            np.minimum.reduceat(right, first), np.maximum.reduceat(right, first)], names=COUNTED_NAMES)
        for start in range(0, len(out), SENT_ROWS):
            yield out.slice(start, SENT_ROWS)

    def counted(batches):
        held: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for lang, ids in zip(batch["lang"].to_pylist(), batch["ids"], strict=True):
                own = held.setdefault(lang, [])                        # an array ends with a BREAK
                own.append(np.frombuffer(ids.as_py(), np.uint64))
                if sum(map(len, own)) >= COUNT_WORDS:
                    yield from grown(lang, np.concatenate(held.pop(lang)))
        for lang, own in held.items():
            yield from grown(lang, np.concatenate(own))

    return _summed(arrays.select("lang", "ids").mapInArrow(counted, COUNTED)).filter(F.col("a") >= min_count)


# ---------------------------------------------------------------- scores

def score(a, n, left, right):
    """``floor(1000 a n / (l r))`` exactly: products of longs in 38 digits."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    over = (wide(a, 17) * F.lit(1000).cast("decimal(4,0)")).cast("decimal(20,0)") * wide(n, 17)
    under = wide(left, 18) * wide(right, 18)
    return F.call_function("div", over, under)


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Least score, its cut and the counts of its parts of every phrase all of whose parts are counted."""
    words = (F.length("gram") / 8).cast("int")
    alike = [(F.col(f"{side}_min") == F.col(f"{side}_max")) & (F.col(f"{side}_min") != 0) for side in ("left", "right")]
    phrases = counts.filter(words > 1).select(
        "lang", F.col("gram").alias("phrase"), "a", words.alias("words"),
        (~((words < MAX_WORDS) & (alike[0] | alike[1]))).alias("survives"))
    parts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).withColumn("part", F.explode(F.array(
        F.struct(F.lit("l").alias("side"), F.expr("substring(phrase, 1, 8 * k)").alias("gram")),
        F.struct(F.lit("r").alias("side"), F.expr("substring(phrase, 8 * k + 1)").alias("gram")))))
    known = parts.select("lang", "phrase", "a", "words", "survives", "k", "part.side", "part.gram") \
        .join(counts.select("lang", "gram", F.col("a").alias("f")), ["lang", "gram"])
    cuts = range(1, MAX_WORDS)
    both = known.groupBy("lang", "phrase", "a", "words", "survives").agg(
        F.count("*").alias("have"),
        *[F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("f"))).alias(f"{side}{k}")
          for side in "lr" for k in cuts]).filter("have = 2 * (words - 1)").join(totals, "lang")
    each = [F.struct(score(F.col("a"), F.col("n"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                     F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in cuts]
    return both.withColumn("cut", F.array_min(F.filter(F.array(*each), lambda x: x["score"].isNotNull()))) \
        .select("lang", "phrase", "a", "n", "survives", "cut.l", "cut.r", "cut.score")


def _leading(phrases: DataFrame, top: int) -> DataFrame:
    """The ``top`` best of every language by score and count, with all that are equal to the last."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    return phrases.withColumn("at", F.rank().over(order)).filter(F.col("at") <= top).drop("at")


def _limits(single: DataFrame, state: DataFrame, share: float) -> DataFrame:
    """Next limit of every language: all words whose bound reaches the ``top``-th score, or a share of the text."""
    sizes = single.groupBy("lang", "a").agg(F.sum("a").alias("size"))   # one row for each count, not for each word
    order = Window.partitionBy("lang").orderBy("a")
    upto = sizes.withColumn("before", F.sum("size").over(order) - F.col("size"))
    by_share = upto.join(state, "lang").filter((F.col("before") <= F.lit(share) * F.col("n"))) \
        .groupBy("lang").agg(F.max("a").alias("by_share"))
    reach = F.call_function("div", F.col("n").cast("decimal(20,0)") * F.lit(1000).cast("decimal(4,0)"),
                            F.greatest("edge", F.lit(1)).cast("decimal(20,0)"))
    limit = F.when(F.col("settled"), F.col("limit")).when(F.col("edge").isNotNull(), F.greatest("limit", reach)) \
        .otherwise(F.coalesce("by_share", F.lit(0)))
    return state.join(by_share, "lang", "left").select("lang", "n", limit.alias("limit"), "edge", "settled")


def _named(best: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """Phrases as text, ranked."""
    def spell(batches):
        for batch in batches:
            for lang, phrase in zip(batch["lang"], batch["phrase"], strict=True):
                yield pd.DataFrame({"lang": lang, "phrase": [phrase] * (len(phrase) // 8), "at": range(len(phrase) // 8),
                                    "gram": [phrase[i:i + 8] for i in range(0, len(phrase), 8)]})

    spelled = best.select("lang", "phrase").mapInPandas(spell, "lang string, phrase binary, at int, gram binary") \
        .join(words.select("lang", "gram", "word"), ["lang", "gram"]).groupBy("lang", "phrase").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))),
                                     lambda x: x["word"].cast("string")), " ").alias("spelled"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("spelled"))
    return best.join(spelled, ["lang", "phrase"]).withColumn("rank", F.row_number().over(order).cast("bigint")) \
        .filter(F.col("rank") <= top).select("lang", "rank", F.col("spelled").alias("phrase"), "a", "l", "r", "n", "score")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, shares: tuple = SHARES) -> DataFrame:
    """The ``top`` phrases of 2 to ``MAX_WORDS`` words of every language: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/collocations-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = docs.filter(F.col("text").isNotNull()).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    seed = 0
    while True:
        with arrow_rows(spark, 1000):
            packed = stored(rows.mapInArrow(_pack(seed), PACKED), f"packed-{seed}")
        words = stored(packed.filter("kind = 'words'").groupBy("lang", "word", "gram").agg(F.sum("c").alias("a")),
                       f"words-{seed}")
        clash = words.groupBy("gram").agg(F.count_distinct("word").alias("n")) \
            .filter((F.col("n") > 1) | (F.col("gram") == F.lit(bytes(8))))
        if clash.isEmpty():
            break
        seed += 1
    arrays = packed.filter("kind = 'ids'")
    totals = stored(words.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
    none = [F.lit(0).cast("bigint").alias(c) for c in ("left_min", "left_max", "right_min", "right_max")]
    single = stored(words.filter(F.col("a") >= min_count).select("lang", "gram", "a", *none), "single")
    frequent = bitmap(single, single.count())

    counts, done = single, []
    state = totals.select("lang", "n", F.lit(0).cast("bigint").alias("limit"), F.lit(None).cast("bigint").alias("edge"),
                          F.lit(False).alias("settled"))
    for number in count():
        state = stored(_limits(single, state, shares[min(number, len(shares) - 1)]), f"limits-{number}")
        ends = single.join(state, "lang").filter(F.col("a") <= F.col("limit")).select("lang", "gram")
        ends, shorter = bitmap(ends, ends.count()), None
        for m in range(2, MAX_WORDS + 1):
            shared = spark.sparkContext.broadcast((frequent, shorter, ends, done))
            with arrow_rows(spark, 4):
                found = stored(count_sequences(arrays, m, shared, min_count), f"counts-{number}-{m}")
            shared.destroy()                                           # the counts are a written table now
            counts = counts.union(found)
            if m < MAX_WORDS:
                level = counts.filter(F.length("gram") == 8 * m).select("lang", "gram")
                known = level.count()
                if not known:
                    break
                shorter = bitmap(level, known)
        done.append(ends)
        best = stored(_leading(scored(counts, totals).filter("survives"), top), f"best-{number}")
        edge = best.groupBy("lang").agg(F.count("*").alias("found"), F.min("score").alias("least"))
        rarest = single.join(state, "lang").filter(F.col("a") > F.col("limit")).groupBy("lang") \
            .agg(F.min("a").alias("rarest"))
        bound = score(F.col("rarest"), F.col("n"), F.col("rarest"), F.col("rarest"))
        full = F.col("found") >= top
        state = stored(state.select("lang", "n", "limit").join(rarest, "lang", "left").join(edge, "lang", "left").select(
            "lang", "n", "limit", F.when(full, F.col("least")).alias("edge"),
            F.coalesce(F.col("rarest").isNull() | (full & (bound < F.col("least"))), F.lit(False)).alias("settled")),
            f"state-{number}")
        if state.filter("not settled").isEmpty():
            return _named(best, words, top)


def op11(spark, sf_dir) -> DataFrame:
    return mine(read_table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE = """
with pieces as (
  select lang, piece, unnest(ws) as w, generate_subscripts(ws, 1) as i from (
    select lang, row_number() over () as piece,
           list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda w: w <> '') as ws
    from (select coalesce(lang, 'und') as lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) as p
          from documents))
), runs as (
  select lang, w as w1, lead(w, 1) over s as w2, lead(w, 2) over s as w3, lead(w, 3) over s as w4, lead(w, 4) over s as w5
  from pieces window s as (partition by lang, piece order by i)
), grams as (
  select lang, [w1] as g, count(*) as f from runs group by all
  union all select lang, [w1, w2], count(*) from runs where w2 is not null group by all having count(*) >= 100
  union all select lang, [w1, w2, w3], count(*) from runs where w3 is not null group by all having count(*) >= 100
  union all select lang, [w1, w2, w3, w4], count(*) from runs where w4 is not null group by all having count(*) >= 100
  union all select lang, [w1, w2, w3, w4, w5], count(*) from runs where w5 is not null group by all having count(*) >= 100
), totals as (
  select lang, sum(f) as n from grams where len(g) = 1 group by lang
), phrases as (
  select p.lang, p.g, p.f as a, not exists (
      select 1 from grams q where q.lang = p.lang and len(q.g) = len(p.g) + 1 and q.f = p.f
        and (q.g[1:len(p.g)] = p.g or q.g[2:] = p.g)) as survives
  from grams p where len(p.g) > 1 and p.f >= 100
), cuts as (
  select p.lang, p.g, p.a, t.n, k, l.f as l, r.f as r,
         ((1000 * p.a::hugeint * t.n::hugeint) // (l.f::hugeint * r.f::hugeint))::bigint as score
  from (select *, unnest(range(1, len(g))) as k from phrases where survives) p join totals t on t.lang = p.lang
  join grams l on l.lang = p.lang and l.g = p.g[1:k] join grams r on r.lang = p.lang and r.g = p.g[k + 1:]
), least as (
  select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1
), ranked as (
  select lang, array_to_string(g, ' ') as phrase, a, l, r, n, score from least
)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a::bigint as a,
       l::bigint as l, r::bigint as r, n::bigint as n, score
from ranked qualify rank <= 2000
"""
