"""Quality rules: a threshold table compiled into one Spark projection.

Every rule is a row of ``RULES``: a measure, a comparison and a bound.
``measures`` computes the counts of one text with built-in functions only
(no user functions, no shuffle), ``compile_rules`` turns the table into one
boolean expression, and ``score`` puts both into a single projection.

Defined cases: a null or empty text has no words, zero counts and fails the
base test.  Lines are split at ``\\n`` and compared whole.  Repeated rows are
judged one by one, an empty table gives an empty result, and other columns of
the input are carried along untouched (working names start with ``_q_``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, read_table

#: characters counted as symbols (fixed by the contract)
SYMBOLS = "#*$%&|<>"

#: frequent short words of English, German, French and Spanish (fixed values)
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "as", "with", "be", "at", "by",
    "der", "die", "das", "und", "ist", "von", "den", "mit", "zu", "ein", "sich", "nicht", "für", "auf",
    "le", "la", "les", "des", "et", "en", "un", "une", "du", "que", "est", "pour", "dans", "pas", "sur", "qui",
    "el", "los", "las", "y", "de", "del", "no", "se", "con", "por", "su", "para", "al", "lo",
)

#: threshold table: (measure, comparison, bound).  A text is kept if it passes every row.
RULES = (
    ("n_words", ">=", 50),
    ("mean_word_chars", ">=", 2.0),
    ("mean_word_chars", "<=", 15.0),
    ("symbol_ratio", "<=", 0.10),
    ("stop_word_ratio", ">=", 0.05),
    ("dup_line_ratio", "<=", 0.30),
    ("repeat_word_ratio", "<=", 0.50),
)

_COMPARE = {
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
}


#: low bits of a sort key hold the window's position; longer texts take the exact form at once
_POSITION_BITS = 20


def _repeated_exact() -> Column:
    """Positions of repeated windows: windows sorted as (word, word, word, position), equal ones are neighbours."""
    same = ("(x.a = get(s, {j}).a and x.b = get(s, {j}).b and x.c = get(s, {j}).c)")
    return F.expr(
        "flatten(transform(array(sort_array(transform(slice(_q_words, 1, greatest(size(_q_words) - 2, 0)), "
        "(w, i) -> struct(w as a, _q_words[i + 1] as b, _q_words[i + 2] as c, i as i)))), s -> "
        f"transform(filter(s, (x, j) -> (j > 0 and {same.format(j='greatest(j - 1, 0)')}) "
        f"or coalesce({same.format(j='j + 1')}, false)), x -> x.i)))")


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Input columns plus the counts ``n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words``.

    Words covered by a 3-word window that occurs at least twice: each window
    gives a long key, 44 bits of its hash above its position.  Sorted, equal
    windows are neighbours (n log n for one text).  The words of every pair
    of neighbours with equal hash bits are compared; if any differ (two
    windows that share 44 bits), or the text has 2**20 words or more, the
    windows themselves are sorted instead, so the count is always exact.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bits, mask = _POSITION_BITS, (1 << _POSITION_BITS) - 1
    # spaces at both ends would give empty words
    body = F.regexp_replace(t, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    d = df.withColumn("_q_body", body)
    d = d.withColumn("_q_words", F.when(F.col("_q_body") == "", F.array().cast("array<string>"))
                     .otherwise(F.split("_q_body", WORD_GAP, -1)))
    d = d.withColumn("_q_lines", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("_q_keys", F.expr(
        "sort_array(transform(slice(_q_words, 1, greatest(size(_q_words) - 2, 0)), (w, i) -> "
        f"(xxhash64(w, _q_words[i + 1], _q_words[i + 2]) & {~mask}L) | (i & {mask})))"))
    # positions (first, second) of neighbours with equal hash bits
    d = d.withColumn("_q_pairs", F.expr(
        "transform(filter(sequence(0, greatest(size(_q_keys) - 2, 0)), "
        f"j -> ((get(_q_keys, j) ^ get(_q_keys, j + 1)) & {~mask}L) = 0), "
        f"j -> array(cast(_q_keys[j] & {mask} as int), cast(_q_keys[j + 1] & {mask} as int)))"))
    unsure = (F.size("_q_words") >= (1 << bits)) | F.expr(
        "exists(_q_pairs, p -> _q_words[p[0]] <> _q_words[p[1]] or _q_words[p[0] + 1] <> _q_words[p[1] + 1] "
        "or _q_words[p[0] + 2] <> _q_words[p[1] + 2])")
    d = d.withColumn("_q_repeated", F.when(F.size("_q_pairs") == 0, F.array().cast("array<int>"))
                     .when(unsure, _repeated_exact())
                     .otherwise(F.array_distinct(F.flatten("_q_pairs"))))

    def without(column: Column, characters: str) -> Column:
        for c in characters:
            column = F.replace(column, F.lit(c), F.lit(""))
        return column

    stop = [w for s in STOP_WORDS for w in (s, s.capitalize())]
    counts = F.struct(
        F.size("_q_words").cast("bigint").alias("n_words"),
        F.length(without(t, "\t\n\x0b\f\r ")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(without(t, SYMBOLS))).cast("bigint").alias("n_symbols"),
        F.size("_q_lines").cast("bigint").alias("n_lines"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr("size(array_distinct(flatten(transform(_q_repeated, i -> array(i, i + 1, i + 2)))))")
        .cast("bigint").alias("n_repeat_words"),
        F.size(F.filter("_q_words", lambda w: w.isin(stop))).cast("bigint").alias("n_stop_words"))
    # the counts pass through a generator: a filter on them stays above it, and is not pushed into the projections
    # below, where every mention of a count would repeat its computation
    return d.select(*[F.col(f"`{c}`") for c in df.columns], F.inline_outer(F.array(counts)))


def ratios() -> dict[str, Column]:
    """Measures that the threshold table may name, as expressions over the counts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words"),
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "stop_word_ratio": F.col("n_stop_words") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_word_ratio": F.col("n_repeat_words") / words,
    }


def compile_rules(rules=RULES) -> Column:
    """The threshold table as one boolean expression."""
    named = ratios()
    verdict = F.lit(True)
    for measure, compare, bound in rules:
        verdict = verdict & _COMPARE[compare](named[measure], F.lit(bound))
    return verdict


def base_failed() -> Column:
    """Fewer than 50 words, or over half of the words inside repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def score(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Input columns, the counts, ``base_failed`` and ``kept`` (false if ``base_failed``, else the table's verdict)."""
    return (measures(df, text)
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & compile_rules(rules)))


def keep_good(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``df`` whose text passes, with the columns of ``df``."""
    cols = df.columns
    renamed = df.select(*[F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(cols)])
    kept = score(renamed, f"_in_{cols.index(text)}", rules).filter("kept")
    return kept.select(*[F.col(f"_in_{i}").alias(c) for i, c in enumerate(cols)])


def op6(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", "n_lines", "n_stop_words")


def _sql_rules() -> str:
    named = {
        "n_words": "n_words",
        "mean_word_chars": "word_chars / greatest(n_words, 1)",
        "symbol_ratio": "n_symbols / greatest(word_chars, 1)",
        "stop_word_ratio": "n_stop_words / greatest(n_words, 1)",
        "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
        "repeat_word_ratio": "n_repeat_words / greatest(n_words, 1)",
    }
    return " and ".join(f"({named[m]}) {c} {b}" for m, c, b in RULES)


def _sql_stop_words() -> str:
    return ", ".join(f"'{w}', '{w.capitalize()}'" for w in STOP_WORDS)


ORACLE = f"""
with words as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents
), split as (
  select rid, doc_id, t,
         list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) as ls
  from words
), windows as (
  select rid, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
  from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from split)
), found as (
  select rid, i, count(*) over (partition by rid, a, b, c) as n from windows
), covered as (
  select rid, count(distinct p) as n_repeat_words
  from (select rid, unnest([i, i + 1, i + 2]) as p from found where n > 1) group by rid
), counts as (
  select doc_id, len(ws)::bigint as n_words,
         coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         len(ls)::bigint as n_lines,
         len(list_filter(ws, lambda w: list_contains([{_sql_stop_words()}], w)))::bigint
           as n_stop_words
  from split left join covered using (rid)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts
)
select *, not base_failed and ({_sql_rules()}) as kept from judged
"""
