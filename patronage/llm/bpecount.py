"""Token counts by rank-synchronous merging.

The tokenizer's own normaliser and pre-tokenizer give pre-tokens. A batch of them is held as one ragged NumPy array of symbols.
Each round finds, for every sequence, the pair of neighbours of lowest rank, and joins all its occurrences in all sequences
at once; sequences without a pair that can be joined drop out. What counts is how many symbols survive.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm import units
from patronage.llm.wordarrays import slices

LIMIT = 2048
CHUNK = 4 << 20
BATCH = 20_000


class Merger:
    """Counts of a byte-level BPE model with word ends, from its tokenizer file."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(content)
        self.normalizer, self.splitter = t.normalizer, t.pre_tokenizer
        spec = json.loads(content)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self.size = max(self.vocab.values()) + 1
        key = left * self.size + right
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        born = np.full(self.size, -1, np.int64)
        born[made[::-1]] = np.arange(len(made))[::-1]
        if (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a pair is ranked before its parts are made; joining all occurrences at once would not be the same")
        special = [a["content"] for a in spec["added_tokens"] if a["special"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        byte = [c for c in self.vocab if len(c) == 1]
        self.symbol = np.zeros(1024, np.int64)
        self.last = np.zeros(1024, np.int64)
        for c in byte:
            self.symbol[ord(c)] = self.vocab[c]
            self.last[ord(c)] = self.vocab[c + self.suffix]
        # joins as a direct table would take size**2 entries; most pairs are answered by a small filter first
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.key)] = True

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (the largest number if it is not joined) and what it makes."""
        key = left * self.size + right
        rank, made = np.full(len(key), np.iinfo(np.int64).max), np.zeros(len(key), np.int64)
        some = np.flatnonzero(self.maybe[self._slot(key)])
        at = np.minimum(np.searchsorted(self.key, key[some]), len(self.key) - 1)
        hit = self.key[at] == key[some]
        rank[some[hit]], made[some[hit]] = self.rank[at[hit]], self.made[at[hit]]
        return rank, made

    def survivors(self, symbols: np.ndarray, sequence: np.ndarray, n: int) -> np.ndarray:
        """Symbols left of each of ``n`` sequences; ``sequence`` says where each symbol belongs, in order."""
        out = np.zeros(n, np.int64)
        none = np.iinfo(np.int64).max
        while len(symbols):
            inside = sequence[1:] == sequence[:-1]
            rank = np.full(len(symbols), none)
            rank[:-1], made = self.ranks(symbols[:-1], symbols[1:])
            rank[:-1][~inside] = none
            head = np.flatnonzero(np.concatenate([[True], ~inside]))
            least = np.minimum.reduceat(rank, head)
            sizes = np.diff(np.append(head, len(symbols)))
            done = least == none
            out[sequence[head[done]]] = sizes[done]
            best = np.repeat(least, sizes)
            join = (rank == best) & (best != none)
            # of overlapping occurrences (a pair of equal symbols) every other one is joined, from the left
            at = np.flatnonzero(join)
            if len(at):
                fresh = np.concatenate([[True], np.diff(at) > 1])
                run = at[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
                at = at[(at - run) % 2 == 0]
            symbols = symbols.copy()
            symbols[at] = made[at]
            keep = np.repeat(~done, sizes)
            keep[at + 1] = False
            symbols, sequence = symbols[keep], sequence[keep]
        return out

    def pretokens(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """Pre-tokens of texts without white space, and the number of the text of each."""
        # the texts go through the library in one string, a line each; a text with white space of its own goes alone
        alone = [i for i, t in enumerate(texts) if re.search(r"\s", t) or not t]
        lone = set(alone)
        rest = [i for i in range(len(texts)) if i not in lone]
        pieces, owner = [], []
        if rest:
            normal = self.normalizer.normalize_str("\n".join(texts[i] for i in rest))
            cuts = np.flatnonzero(np.frombuffer(normal.encode("utf-32-le"), np.uint32) == 32)
            if len(cuts) != len(rest) - 1:
                alone, rest = list(range(len(texts))), []
            else:
                found = self.splitter.pre_tokenize_str(normal)
                pieces = [p for p, _ in found]
                owner = np.array(rest)[np.searchsorted(cuts, [a for _, (a, _) in found], "right")].tolist()
        for i in alone:
            own = [p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(texts[i]))]
            pieces += own
            owner += [i] * len(own)
        return pieces, owner

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each text."""
        parts, of, out = [], [], np.zeros(len(words), np.int64)
        for i, word in enumerate(words):
            if self.special and "<" in word and self.special.search(word):
                out[i] += len(self.special.findall(word))
                for part in self.special.split(word):
                    parts.append(part)
                    of.append(i)
            else:
                parts.append(word)
                of.append(i)
        of = np.array(of, np.int64)
        for a in range(0, len(parts), BATCH):
            pieces, owner = self.pretokens(parts[a:a + BATCH])
            if not pieces:
                continue
            code = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32).astype(np.int64)
            sizes = np.array([len(p) for p in pieces])
            symbols = self.symbol[code]
            ends = np.cumsum(sizes) - 1
            symbols[ends] = self.last[code[ends]]
            left = self.survivors(symbols, np.repeat(np.arange(len(pieces)), sizes), len(pieces))
            np.add.at(out, of[a + np.array(owner, np.int64)], left)
        return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of each row of ``docs`` (doc_id, text; other columns are ignored).

    Counts are those of the tokenizers library without added tokens; special strings inside texts count as one token. A null text is
    empty and has 0 tokens. A row gives a row; null ids stay null; an empty table gives no rows.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, of a size apart from the corpus

    def run(batches):
        merger = Merger(content.value)
        lookup = units.Lookup(lambda words: (merger.counts(words), np.ones(len(words), np.int64)))
        for part in slices(batches, CHUNK):
            texts = pc.fill_null(part.column("text"), "")
            spans = units.words(texts)
            sums = np.concatenate([[0], np.cumsum(lookup.flat_of(spans))])
            tokens = np.diff(sums[spans.first])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pc.binary_length(texts).cast(pa.int64())), pa.array(tokens.astype(np.int64)), pa.array(tokens > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
