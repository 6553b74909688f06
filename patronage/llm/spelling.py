"""Spelling variants: words one edit apart, found through a reduced alphabet.

Each letter is hashed to one of a few symbols. Words one edit apart have reduced words at most one edit apart, and a reduced word has
few neighbours: its full one-edit neighbourhood (a symbol replaced, deleted or inserted, and the word itself) is generated and joined to the
reduced vocabulary. Words of the reduced pairs that exist are then compared as they are. Reduced words are known by 64-bit hashes
whose neighbours follow from prefix sums, so a long word costs its length times the number of symbols.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.wordarrays import BASE, BASE_INVERSE, mix, powers, slices
from patronage.sources.storage import materialise

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_SEEN = 2
DROPPED = 31
SYMBOLS = 8
#: A form occurs at least so many times as often as its variant.
RATIO = 10
#: Bytes of words whose neighbourhoods are held at once.
PART_BYTES = 1 << 18

_UPPER, _LOWER = (("".join(map(chr, range(a, a + 26)))) for a in (65, 97))


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_seen: int = LEAST_SEEN, dropped: int = DROPPED) -> DataFrame:
    """``word`` and ``n`` of the words of ``docs`` (doc_id, text): runs of letters, A-Z lower-cased, of at least ``least_letters`` code
    points and ``least_seen`` occurrences. A run whose checksum with the id is divisible by ``dropped`` loses one code point.

    Runs are counted in their tasks before they are shuffled. Null texts have no runs; a null id counts as an empty string.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0))).alias("run"))
    hashed = runs.selectExpr("d", f"translate(run, '{_UPPER}', '{_LOWER}') AS run").selectExpr("run", "crc32(concat(d, ':', run)) AS h")
    words = hashed.selectExpr(f"IF(h % {dropped} = 0, overlay(run PLACING '' FROM CAST(h % length(run) AS INT) + 1 FOR 1), run) AS word")
    return words.filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_seen)


class _Reduced:
    """Reduced words of a column, as hashes: the sum of a symbol's value times a power of its place."""

    def __init__(self, words: pa.Array, symbols: int):
        code = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.value = mix(np.arange(1, symbols + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.symbol = (mix(code) % np.uint64(symbols)).astype(np.int64)
        self.size = pa.compute.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.end = np.cumsum(self.size)
        self.owner = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(code)) - np.repeat(self.end - self.size, self.size)
        at = powers(BASE, int(self.size.max(initial=0)) + 2)
        self.power = at[self.place]
        own = self.value[self.symbol] * self.power
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own)])
        start = sums[self.end - self.size]
        self.whole = sums[self.end] - start
        self.before = sums[:-1] - np.repeat(start, self.size)
        self.own = own
        self.at_end = at[self.size]

    def keys(self) -> np.ndarray:
        return mix(self.whole).view(np.int64)

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of the word and key of each of its neighbours, every different reduced word once, itself included."""
        base, inverse = np.uint64(BASE), np.uint64(BASE_INVERSE)
        whole, after = self.whole[self.owner], self.whole[self.owner] - self.before  # ``after``: from this place on
        previous = np.where(self.place > 0, np.concatenate([[-1], self.symbol[:-1]])[:len(self.symbol)], -1)
        first = previous != self.symbol  # in a run of one symbol, deleting any gives the same, and so does inserting it
        rows = [np.arange(len(self.size)), self.owner[first]]
        found = [self.whole, (self.before + (after - self.own) * inverse)[first]]
        for symbol, value in enumerate(self.value):
            other = self.symbol != symbol
            rows.append(self.owner[other])
            found.append((whole + value * self.power - self.own)[other])
            other = previous != symbol
            rows.append(self.owner[other])
            found.append((self.before + value * self.power + after * base)[other])
            last = self.symbol[self.end - 1] != symbol
            rows.append(np.flatnonzero(last))
            found.append((self.whole + value * self.at_end)[last])
        return np.concatenate(rows), mix(np.concatenate(found)).view(np.int64)


def neighbourhoods(words: DataFrame, symbols: int = SYMBOLS) -> tuple[DataFrame, DataFrame]:
    """Of words (``word``, not empty): their reduced key, and of each reduced word the keys ``near`` of its neighbourhood up to itself.

    Neighbourhoods are symmetric, so each pair of reduced words is generated from both and kept at the larger key.
    """
    def keyed(batches):
        for part in slices((b.rename_columns(["text", "n"]) for b in batches), PART_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("text"), part.column("n"), pa.array(_Reduced(part.column("text"), symbols).keys())], names=["word", "n", "reduced"])

    def around(batches):
        for part in slices((b.rename_columns(["reduced", "text"]) for b in batches), PART_BYTES):
            if not len(part):
                continue
            rows, near = _Reduced(part.column("text"), symbols).neighbours()
            own = part.column("reduced").to_numpy()[rows]
            kept = near <= own
            yield pa.RecordBatch.from_arrays([pa.array(own[kept]), pa.array(near[kept])], names=["reduced", "near"])

    known = words.select("word", "n").mapInArrow(keyed, "word string, n long, reduced long")
    one_each = known.groupBy("reduced").agg(F.min("word").alias("word"))
    return known, one_each.mapInArrow(around, "reduced long, near long")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Each pair of words (``word``, ``n``; each word once) that differ by exactly one inserted, deleted or replaced code point, once:
    ``word``, ``n``, ``other``, ``other_n``."""
    known, around = neighbourhoods(words, symbols)
    exists = around.join(known.select(F.col("reduced").alias("near")).distinct(), "near")
    left, right = known.alias("l"), known.select(F.col("reduced").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n")).alias("r")
    return exists.join(left, "reduced").join(right, "near").filter(
        "(reduced <> near OR word < other) AND levenshtein(word, other, 1) = 1").select("word", "n", "other", "other_n")


def variants(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of each row of ``words`` (``word``, ``n``; each word once).

    The form is the near word of largest n, the smallest in code-point order on ties, if its n is at least ``ratio`` (more than 1) times
    the word's; else null. The root is where the forms lead. A form's n grows by the ratio with each step, which bounds the rounds of
    joining forms to forms, each of which doubles the steps taken.
    """
    pairs = near_pairs(words, symbols)
    both = pairs.select("word", "n", F.expr("explode(array(struct(word, n, other, other_n), struct(other AS word, other_n AS n, word AS other, n AS other_n)))").alias("p")).select("p.*")
    every = words.selectExpr("word", "n", "CAST(NULL AS STRING) AS other", "CAST(NULL AS BIGINT) AS other_n").unionByName(both)
    grouped = every.groupBy("word", "n").agg(F.count("other").alias("n_near"), F.min(F.expr("IF(other IS NULL, NULL, struct(-other_n AS least, other AS other))")).alias("best"))
    formed = materialise(grouped.selectExpr(
        "word", "n", "n_near", f"IF(-best.least >= {ratio} * n, best.other, NULL) AS form", f"IF(-best.least >= {ratio} * n, -best.least, NULL) AS form_n"), "variants")
    most = formed.agg(F.max("form_n")).first()[0] or 0
    steps = math.ceil(math.log(max(most, 1), ratio)) + 1
    roots = formed.filter("form IS NOT NULL").selectExpr("word", "form AS root")
    for _ in range(math.ceil(math.log2(steps))):
        further = roots.selectExpr("word AS root", "root AS next")
        roots = materialise(roots.join(further, "root", "left").selectExpr("word", "coalesce(next, root) AS root"), "roots")
    return formed.join(roots, "word", "left").selectExpr("word", "n", "n_near", "form", "form_n", "coalesce(root, word) AS root")


def variant_groups(docs: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``variants`` of the ``vocabulary`` of ``docs`` (doc_id, text; other columns are ignored).

    Null and empty texts and ids: see there. A repeated row counts again; a table without words gives no rows.
    """
    return variants(materialise(vocabulary(docs), "vocabulary"), symbols=symbols)
