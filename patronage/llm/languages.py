"""Language identification by n-gram filters whose rows are masks of languages.

A text's n-grams are runs of two to four code points of its lower-cased words, word ends included. An n-gram belongs to a language
in whose learned texts it is frequent enough, and not far rarer than in the language where it is most frequent. All languages share one
bit-sliced Bloom filter: row r holds bit l if an n-gram of language l hashes to r, so that the rows of an n-gram's few hashes, ANDed, are the mask of
all languages that contain it. Per language, a text's n-grams with the bit are counted, less those that the language's false positives
explain; the largest count decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.wordarrays import BASE, BASE_INVERSE, mix, powers, ranges, slices

ORDERS = (2, 3, 4)
HASHES = 4
#: An n-gram belongs to a language if it is at least so much of its n-grams, and of its share in any other.
LEAST_SHARE = 2e-5
LEAST_CONTRAST = 0.2
#: Rows of the filter for each n-gram of the language that has most; at most 1 / LEAST_SHARE n-grams of an order can be that frequent.
ROWS_PER_GRAM = 16
PART_BYTES = 2 << 20
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """The lower-case letter of each code point that is a letter, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


class Words:
    """Distinct words of some texts: ``row`` of each word met in its texts, ``first`` of each text (one more at the end); n-grams of the distinct ones."""

    def __init__(self, texts: list[str]):
        sizes = np.array([len(t) for t in texts], np.int64)
        code = _letters()[np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        at = np.concatenate([[0], np.cumsum(sizes + 1)])  # texts, with a line end between
        inside = np.concatenate([[False], code > 0, [False]])
        start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        self.first = np.searchsorted(start, at)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(code) * powers(BASE, len(code))[:len(code)])])
        name = (sums[end] - sums[start]) * powers(BASE_INVERSE, len(code) + 1)[start]
        _, one, self.row = np.unique(name, return_index=True, return_inverse=True)
        length = end[one] - start[one]
        self.n = len(one)
        self.code = np.zeros(int((length + 1).sum()) + 1, np.uint64)  # words with a boundary before, between and after
        begin = np.cumsum(length + 1) - length
        self.code[ranges(begin, length)] = code[ranges(start[one], length)]
        self.begin, self.length = begin, length

    def grams(self):
        """Of each order: the word of each n-gram, and its 64-bit hash."""
        for order in ORDERS:
            count = np.maximum(self.length + 3 - order, 0)  # windows of the word with both boundaries
            at = ranges(self.begin - 1, count)
            key = np.full(len(at), order, np.uint64)
            for i in range(order):
                key = mix(key * np.uint64(BASE) + self.code[at + i])
            yield np.repeat(np.arange(self.n), count), key


@dataclass
class Filters:
    """A bit-sliced filter: ``rows`` of masks (bytes of eight languages each), the learned languages, and the one to fall back on."""

    languages: list[str]
    rows: np.ndarray
    common: str | None

    @property
    def false_positives(self) -> np.ndarray:
        """How likely an n-gram that no language has is answered with each language."""
        return self.bits(self.rows).mean(axis=0) ** HASHES

    def bits(self, masks: np.ndarray) -> np.ndarray:
        return np.unpackbits(masks, axis=1, bitorder="little")[:, :len(self.languages)]

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """The mask of all languages that contain each n-gram."""
        low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
        last = np.uint64(len(self.rows) - 1)
        out = self.rows[(low & last).astype(np.int64)]
        for i in range(1, HASHES):
            out = out & self.rows[((low + np.uint64(i) * high) & last).astype(np.int64)]
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: its words, its n-grams, and per language those that contain them, corrected for false positives."""
        words = Words(texts)
        hits, total = np.zeros((words.n, len(self.languages))), np.zeros(words.n)
        for owner, keys in words.grams():
            total += np.bincount(owner, minlength=words.n)
            bits = self.bits(self.masks(keys))
            for i in range(len(self.languages)):
                hits[:, i] += np.bincount(owner, bits[:, i], words.n)
        total, hits = total[words.row], hits[words.row]
        sums = lambda v: np.diff(np.concatenate([np.zeros((1, *v.shape[1:])), np.cumsum(v, axis=0)])[words.first], axis=0)
        total, hits, wrong = sums(total), sums(hits), self.false_positives
        corrected = (hits - total[:, None] * wrong) / np.where(wrong < 1, 1 - wrong, 1)
        return np.diff(words.first), total, np.clip(np.round(corrected, 6), 0, None)


def _held_out_filter(held_out: str | None) -> str:
    return f"NOT coalesce({held_out}, false)" if held_out else "true"


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram`` (64-bit hash) and ``n`` over all rows of ``docs`` with a language; tasks count their parts first."""
    def run(batches):
        for part in slices(batches, PART_BYTES):
            langs = np.array(part.column("lang").to_pylist(), object)
            texts = np.array(pc.fill_null(part.column("text"), "").to_pylist(), object)
            for lang in sorted(set(langs)):
                words = Words(texts[langs == lang].tolist())
                seen = np.bincount(words.row, minlength=words.n)
                grams = [(k, seen[owner]) for owner, k in words.grams()]
                keys, at = np.unique(np.concatenate([k for k, _ in grams]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n for _, n in grams]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").selectExpr("CAST(lang AS STRING) AS lang", "CAST(text AS STRING) AS text")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, held_out: str | None = None, least_share: float = LEAST_SHARE, least_contrast: float = LEAST_CONTRAST) -> Filters:
    """Filters learned from the rows of ``docs`` (doc_id, text, lang) for which the SQL condition ``held_out`` is not true.

    N-grams of all those rows are counted. The filter has a size that ``least_share`` bounds; it comes to the driver as positions
    that are set. Rows without a text or a language teach nothing; without any there are no languages.
    """
    from patronage.sources.storage import materialise

    counts = materialise(gram_counts(docs.filter(_held_out_filter(held_out)).select("text", "lang")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = totals.orderBy("lang").collect()  # a row per language
    languages = [r["lang"] for r in known]
    if not languages:
        return Filters([], np.zeros((1, 1), np.uint8), None)
    common = min(known, key=lambda r: (-r["total"], r["lang"]))["lang"]
    number = totals.selectExpr("lang", "total", f"array_position(array({', '.join(_quoted(x) for x in languages)}), lang) - 1 AS l")
    shares = counts.join(F.broadcast(number), "lang").selectExpr("gram", "l", "n / total AS share").filter(F.col("share") >= least_share)
    kept = materialise(shares.withColumn("most", F.expr("max(share) OVER (PARTITION BY gram)")).filter(f"share >= {least_contrast}D * most").select("gram", "l"), "grams")
    size = kept.groupBy("l").count().agg(F.max("count")).first()[0] or 1
    rows = 1 << math.ceil(math.log2(ROWS_PER_GRAM * size))
    places = kept.selectExpr("l", f"explode(transform(sequence(0, {HASHES - 1}), i -> ((gram & 4294967295L) + i * (shiftrightunsigned(gram, 32) | 1L)) & {rows - 1}L)) AS place")
    set_bits = places.groupBy("place", F.expr("l div 8").alias("byte")).agg(F.expr("bit_or(shiftleft(1, CAST(l % 8 AS INT)))").alias("mask")).toArrow()
    table = np.zeros((rows, (len(languages) + 7) // 8), np.uint8)
    table[set_bits["place"].to_numpy(), set_bits["byte"].to_numpy()] = set_bits["mask"].to_numpy()
    return Filters(languages, table, common)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def predicted(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of each row of ``docs`` (doc_id, text; other columns are ignored).

    The score is the share of the text's n-grams that the language contains, corrected for false positives. On ties the first language in
    the order of names; a text none of whose n-grams any language contains gets the language of most n-grams learned, and 0. A null
    text, one without a letter, and every text if there are no languages get ``und`` and 0. A row gives a row; null ids stay null; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(filters)  # of a size that the least share of an n-gram bounds

    def run(batches):
        known = model.value
        for part in slices(batches, PART_BYTES):
            texts = pc.fill_null(part.column("text"), "").to_pylist()
            if known.languages:
                words, total, found = known.counts(texts)
                best = found.argmax(axis=1)
                score = np.clip(found[np.arange(len(texts)), best] / np.maximum(total, 1), 0, 1)
                named = [UNKNOWN if not w else known.languages[b] if s > 0 else known.common for w, b, s in zip(words, best, score)]
            else:
                named, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(named, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
