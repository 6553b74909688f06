"""Quality rules: how far a text's distributions are from those of a language.

Base rules count words, symbols, repeated lines and repeated three-word windows. The method then compares two histograms of the
text, over character classes and over common words, with each language's reference by the Jensen-Shannon distance (base 2,
0 to 1). References are sums over all documents of a language that pass the base rules. Built-in expressions only: a text is
counted where it is read, and what is shuffled are four rows of sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.sources.storage import materialise

LEAST_WORDS = 50
REPEATED_PERCENT = 50
#: A histogram with fewer characters, or fewer common words, says too little and is not compared.
LEAST_CHARS, LEAST_COMMON = 200, 20
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.27, 0.75

# Frequent words of each language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "on", "for", "was", "as", "be", "with"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no"],
}
WORDS = sorted({w for words in COMMON.values() for w in words})
CLASSES = ("lower", "upper", "digit", "space", "symbol", "point", "other")

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_DIGIT = "0123456789"
_SPACE = "\\t\\n\\u000b\\u000c\\r "
_SYMBOL = "#*$%&|<>"
_POINT = ".,;:!?()[]{}/@^_`~+=-\\'\"\\\\"


def _without(text: str, members: str) -> str:
    return f"translate({text}, '{members}', '')"


def counts(docs: DataFrame) -> DataFrame:
    """The counts of each text: base columns, ``chars`` (one number for each of CLASSES) and ``common`` (for each of WORDS)."""
    listed = ", ".join(f"'{w}'" for w in WORDS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"),
                        (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang"))
    # the characters other than a-z are few, so the classes are counted on what is left of the text
    split = texts.selectExpr("doc_id", "lang", "t", f"{_without('t', _LOWER)} AS r", r"regexp_extract_all(t, '[^ \\t\\n\\x0B\\f\\r]+', 0) AS w",
                             r"filter(split(t, '\n', -1), x -> x RLIKE '[^ \\t\\n\\x0B\\f\\r]') AS l")
    # hashes of three-word windows; those found twice, once each
    windows = split.selectExpr(
        "*", f"filter(w, x -> length(x) <= {max(map(len, WORDS))} AND array_contains(array({listed}), lower(x))) AS known",
        "IF(size(w) >= 3, transform(slice(w, 1, size(w) - 2), (x, i) -> xxhash64(x, w[i + 1], w[i + 2])), array()) AS h")
    windows = windows.selectExpr("*", "sort_array(h) AS s", "transform(known, x -> lower(x)) AS k")
    windows = windows.selectExpr("*", "array_distinct(filter(s, (x, i) -> i > 0 AND x = s[i - 1])) AS twice")
    # where they stand: few are looked up, many are found by sorting windows with their places
    many = "sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))"
    placed = windows.selectExpr(
        "*", "CASE WHEN size(twice) = 0 THEN array() WHEN size(twice) <= 48 THEN filter(transform(h, (x, i) -> IF(array_contains(twice, x), i, -1)), i -> i >= 0) END AS few",
        f"CASE WHEN size(twice) > 48 THEN {many} END AS pairs")
    placed = placed.selectExpr(
        "*", "coalesce(few, sort_array(transform(filter(pairs, (y, j) -> (j > 0 AND pairs[j - 1].x = y.x) OR (j < size(pairs) - 1 AND pairs[j + 1].x = y.x)), y -> y.i))) AS at")
    length = "CAST(char_length({}) AS BIGINT)".format
    less = lambda members: f"CAST(char_length(r) - char_length({_without('r', members)}) AS BIGINT)"
    counted = placed.selectExpr(
        "doc_id", "lang", "CAST(size(w) AS BIGINT) AS n_words", f"{length('t')} AS n_all", f"{length('r')} AS n_rest", f"{less(_SPACE)} AS n_space", f"{less(_SYMBOL)} AS n_symbols",
        f"{less(_LOWER.upper())} AS n_upper", f"{less(_DIGIT)} AS n_digit", f"{less(_POINT)} AS n_point", "CAST(size(l) - size(array_distinct(l)) AS BIGINT) AS n_dup_lines",
        "aggregate(at, struct(0L AS n, -3 AS last), (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last)).n AS n_repeat_words",
        f"transform(array({listed}), c -> CAST(size(k) - size(array_remove(k, c)) AS BIGINT)) AS common")
    return counted.selectExpr(
        "doc_id", "lang", "n_words", "n_all - n_space AS word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed",
        "array(n_all - n_rest, n_upper, n_digit, n_space, n_symbols, n_point, n_rest - n_upper - n_digit - n_space - n_symbols - n_point) AS chars", "common")


def language_references(docs: DataFrame) -> DataFrame:
    """References from all of ``docs`` (doc_id, text, lang), to judge other documents by."""
    return references(materialise(counts(docs), "counts"))


def references(counted: DataFrame, languages=tuple(COMMON)) -> DataFrame:
    """(lang, ref_chars, ref_common): sums over all documents of a language that pass the base rules, from stored counts."""
    passed = counted.filter(F.col("lang").isin(*languages) & ~F.col("base_failed"))
    sums = passed.groupBy("lang").agg(*[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(CLASSES))],
                                      *[F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(len(WORDS))])
    return sums.select("lang", F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("ref_chars"), F.array(*[f"w{i}" for i in range(len(WORDS))]).alias("ref_common"))


def _total(array: str) -> str:
    return f"aggregate({array}, 0L, (a, x) -> a + x)"


def _distance(p: str, n: str, q: str, m: str) -> str:
    """Jensen-Shannon distance of two count arrays with totals n and m; null where a total is 0."""
    term = "IF(x.{0} > 0, x.{0} * log2(2 * x.{0} / (x.p + x.q)), 0D)".format
    shares = f"zip_with({p}, {q}, (a, b) -> struct(a / {n} AS p, b / {m} AS q))"
    return f"IF({n} > 0 AND {m} > 0, sqrt(greatest(0D, aggregate({shares}, 0D, (s, x) -> s + 0.5D * ({term('p')} + {term('q')})))), NULL)"


def judged(docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """The base columns, ``base_failed``, ``kept``, and the distances to the nearest language of each row of ``docs`` (doc_id, text, lang).

    ``refs`` as ``references`` gives them; by default they are taken from ``docs``. A text that passes the base rules is kept
    if for some language neither distance is too large; a histogram below its least length is not compared, and without any
    reference nothing is. A null text has no words and fails. A row gives a row, repeated or not; null ids stay null; without a
    ``lang`` column there are no references; other columns are ignored; an empty table gives no rows.
    """
    counted = materialise(counts(docs), "counts")
    refs = references(counted) if refs is None else refs
    listed = refs.filter(F.col("lang").isin(*COMMON)).selectExpr("lang", "ref_chars", "ref_common", f"{_total('ref_chars')} AS m_chars", f"{_total('ref_common')} AS m_common")
    listed = listed.agg(F.array_sort(F.collect_list(F.struct("lang", "ref_chars", "ref_common", "m_chars", "m_common"))).alias("refs"))  # four rows at most
    both = counted.withColumns({"n_chars": F.expr(_total("chars")), "n_common": F.expr(_total("common"))}).crossJoin(F.broadcast(listed))
    near = both.selectExpr(
        "*", f"transform(refs, f -> struct(IF(n_chars >= {LEAST_CHARS}, {_distance('chars', 'n_chars', 'f.ref_chars', 'f.m_chars')}, NULL) AS chars, "
        f"IF(n_common >= {LEAST_COMMON}, {_distance('common', 'n_common', 'f.ref_common', 'f.m_common')}, NULL) AS words, f.lang AS lang)) AS d")
    fits = f"exists(d, x -> coalesce(x.chars <= {MOST_CHAR_DISTANCE}D, true) AND coalesce(x.words <= {MOST_WORD_DISTANCE}D, true))"
    return near.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", f"NOT base_failed AND (size(d) = 0 OR {fits}) AS kept",
        "array_min(transform(d, x -> x.chars)) AS char_distance", "array_min(transform(d, x -> x.words)) AS word_distance")
