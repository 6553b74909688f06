"""Secrets in texts: fixed patterns, and strings that a character Markov model finds random.

Two first-order Markov models, one of random strings and one of ordinary identifiers, are trained from labelled
samples. A token of ``TOKEN`` characters or more, or what the patterns leave of one, is a secret when the log-likelihood ratio
of the two models is at least ``LEAST_RATIO``. Spans are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.wordarrays import buffer, slices

# The patterns of the three kinds and their least lengths.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the least length can stand in the pattern
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

KEYWORDS = "(?i)password|passwd|secret|token|api_?key"
TOKEN = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % TOKEN)
LEAST_RATIO = 18.0
MASK = "[SECRET]"

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATE = np.full(128, len(SYMBOLS), np.int64)
STATE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
STATES = len(SYMBOLS) + 1

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*range(48, 58), *range(97, 103)]] = True
_TOKEN_BYTE = np.zeros(256, bool)
_TOKEN_BYTE[[ord(c) for c in SYMBOLS]] = True


def _states(token: str) -> np.ndarray:
    code = np.frombuffer(token.encode("utf-32-le"), np.uint32)
    return STATE[np.where(code < 128, code, 0)]


# ---------------------------------------------------------------- the two models

def sample(docs: DataFrame) -> DataFrame:
    """Labelled strings (text, random, n): words of all documents joined as identifiers are written, ``n`` times as the word
    occurs, and once each as many strings made of the digests of the same words, in base 64 and hexadecimal.

    Occurrences count, as the distinct words of a growing corpus are more and more fragments of random strings.
    """
    words = docs.select(F.explode(F.expr("filter(split(CAST(text AS STRING), '[^A-Za-z]+'), w -> length(w) BETWEEN 3 AND 24)")).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    words = words.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, but much to do for each
    ordinary = "array(w, upper(w), concat_ws('_', lower(w), substring(lower(w), 1, 4)), concat(w, initcap(w)), concat_ws('-', lower(w), length(w)), concat_ws('/', lower(w), lower(w)))"
    random = "array(base64(unhex(sha2(w, 256))), base64(unhex(sha1(w))), sha2(w, 224), upper(conv(substring(sha2(w, 384), 1, 15), 16, 36)))"
    return words.selectExpr(f"inline(concat(transform({ordinary}, t -> struct(t AS text, 0 AS random, n AS n)), transform({random}, t -> struct(t AS text, 1 AS random, 1L AS n))))")


def train(samples: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each transition, from counts over all ``samples`` (text, random, and ``n`` where a text counts
    more than once); half a count is added.

    Null texts and labels other than 0 and 1 count nothing; without samples every ratio is 0.
    """
    def count(frames):
        for pdf in frames:
            for label, part in pdf.groupby("random"):
                chains = [_states(t) for t in part["text"]]
                pairs = np.concatenate([c[:-1] * STATES + c[1:] for c in chains])
                times = np.repeat(part["n"].to_numpy(np.int64), [max(0, len(c) - 1) for c in chains])
                pair, at = np.unique(pairs, return_inverse=True)
                n = np.zeros(len(pair), np.int64)
                np.add.at(n, at, times)
                yield pd.DataFrame({"random": int(label), "pair": pair, "n": n})

    n = F.col("n").cast("long") if "n" in samples.columns else F.lit(1).cast("long")
    known = samples.select(F.col("text").cast("string").alias("text"), F.col("random").cast("int").alias("random"), n.alias("n")).filter("text IS NOT NULL AND random IN (0, 1) AND n > 0")
    rows = known.mapInPandas(count, "random int, pair long, n long").groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()  # 2 * STATES**2 rows at most
    counts = np.full((2, STATES, STATES), 0.5)
    for r in rows:
        counts[r["random"]].reshape(-1)[r["pair"]] += r["n"]
    share = counts / counts.sum(2, keepdims=True)
    return np.log(share[1] / share[0])


def ratio(token: str, model: np.ndarray) -> float:
    """Sum of the log-likelihood ratios of the token's transitions."""
    s = _states(token)
    return float(model[s[:-1], s[1:]].sum())


# ---------------------------------------------------------------- spans of one text

def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the patterns, leftmost and without overlap for each kind, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def remainders(start: int, end: int, base: list[tuple[int, int, int]]):
    """(start, end) of what the base spans leave of a token, where it is ``TOKEN`` characters or more."""
    for a, _, b in base:
        if start < b and a < end:
            if a - start >= TOKEN:
                yield start, a
            start = b
    if end - start >= TOKEN:
        yield start, end


def random_spans(text: str, base: list[tuple[int, int, int]], model: np.ndarray, least: float = LEAST_RATIO) -> list[tuple[int, int, int]]:
    return [(a, 3, b) for m in CANDIDATE.finditer(text) for a, b in remainders(m.start(), m.end(), base) if ratio(text[a:b], model) >= least]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or chain of overlapping spans, replaced by a mark."""
    out, at, end = [], 0, -1
    for a, _, b in spans:
        if a >= end:
            out += [text[at:a], MASK]
        at = end = max(end, b)
    return "".join(out) + text[at:]


def _long_runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> np.ndarray:
    """Which texts hold a run of ``least`` member bytes."""
    inside = np.concatenate([[0], np.cumsum(member[data])])
    full = np.flatnonzero(inside[least:] - inside[:-least] == least) if len(data) >= least else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, full, "right") - 1
    within = full + least <= offsets[text + 1]
    out = np.zeros(len(offsets) - 1, bool)
    out[text[within]] = True
    return out


def scan(texts: pa.Array, model: np.ndarray, least: float = LEAST_RATIO) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text. Cheap tests on whole columns say which patterns a text can hold."""
    texts = pc.fill_null(texts, "")
    data, offsets = buffer(texts)
    word = pc.match_substring_regex(texts, KEYWORDS).to_numpy(zero_copy_only=False)
    key = pc.match_substring(texts, "AKIA").to_numpy(zero_copy_only=False)
    digits = _long_runs(data, offsets, _HEX_BYTE, HEX_LENGTH)
    token = _long_runs(data, offsets, _TOKEN_BYTE, TOKEN)
    out: list[tuple[list, list]] = [([], [])] * len(texts)
    for i in np.flatnonzero(word | key | digits | token):
        text = texts[i].as_py()
        base = base_spans(text) if word[i] or key[i] or digits[i] else []
        more = random_spans(text, base, model, least) if token[i] else []
        out[i] = (base, sorted(base + more))
    return out


# ---------------------------------------------------------------- tables

def secrets(docs: DataFrame, model: np.ndarray, least: float = LEAST_RATIO) -> DataFrame:
    """Counts, digest of the pattern spans, and all spans of each row of ``docs`` (doc_id, text; other columns are ignored).

    A null text is empty. A row gives a row, repeated or not; null ids stay null; an empty table gives no rows.
    """
    def run(batches):
        for part in slices(batches):
            found = scan(part.column("text"), model, least)
            counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(3)]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found], pa.string()),
                pa.array([written(spans) for _, spans in found], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(docs: DataFrame, model: np.ndarray, least: float = LEAST_RATIO) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; ``n_chars``, where there is one, follows the new text.

    Every row stays. A null text stays null and an empty one empty; rows that repeat a text are masked alike; null ids stay null, an empty table
    stays empty, and other columns are carried along whatever their names.
    """
    names = docs.columns

    def run(batches):
        for part in slices(batches):
            found = scan(part.column("text"), model, least)
            rows = [i for i, (_, spans) in enumerate(found) if spans]
            if rows:
                texts = part.column("text").to_pylist()
                for i in rows:
                    texts[i] = masked(texts[i], found[i][1])
                columns = list(part.columns)
                columns[names.index("text")] = pa.array(texts, part.column("text").type)
                if "n_chars" in names:
                    kept = part.column("n_chars").to_pylist()
                    for i in rows:
                        kept[i] = None if kept[i] is None else len(texts[i])
                    columns[names.index("n_chars")] = pa.array(kept, part.column("n_chars").type)
                part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
            yield part

    return docs.mapInArrow(run, docs.schema)
