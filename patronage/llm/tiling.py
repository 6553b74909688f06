"""Benchmark decontamination by greedy string tiling.

Documents and test items are sequences of words (runs of letters and digits, lower case). Shared five-word seeds say
which document meets which item (a shorter item is one seed). For such a pair, running Karp-Rabin finds the longest common runs of words that no tile
covers yet, marks them as tiles, and goes on with shorter runs down to the seed length. Tiles may lie in any order,
so passages whose sentences were moved are met too. A document is contaminated by an item if its tiles cover
at least ``coverage`` of the item's words.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.wordarrays import BASE, BASE_INVERSE, SPACE, Words, blob, powers, ranges, slices, unblob

SEED = 5
COVERAGE = 0.5
#: Words of test items that go to the executors at once (8 bytes each); a larger benchmark takes several passes.
SLICE_WORDS = 2_000_000

GAPS = SPACE.copy()
GAPS[:128] = True
GAPS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

PAIR = "doc_id long, item_id long, coverage double, n_tiles long, matched_words long, tiles string"


def words(texts: pa.Array) -> Words:
    return Words(pc.utf8_lower(pc.fill_null(texts, "")), lower=False, gaps=GAPS)


class _Side:
    """One of the two sequences: its words, which of them are marked, prefix sums for the hash of any run."""

    def __init__(self, tokens: np.ndarray):
        self.tokens, self.free = tokens, np.ones(len(tokens), bool)
        self.sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tokens * powers(BASE, len(tokens))[:len(tokens)], out=self.sums[1:])
        self.inverse = powers(BASE_INVERSE, len(tokens) + 1)

    def hashes(self, at: np.ndarray, sizes) -> np.ndarray:
        return (self.sums[at + sizes] - self.sums[at]) * self.inverse[at]

    def open_runs(self, s: int) -> np.ndarray:
        """Where windows of s words without a marked one start."""
        marked = np.concatenate([[0], np.cumsum(~self.free)])
        return np.flatnonzero(marked[s:] == marked[:-s]) if s <= len(self.tokens) else np.zeros(0, np.int64)

    def room(self) -> np.ndarray:
        """Words from each place to the next marked one or the end."""
        stops = np.append(np.flatnonzero(~self.free), len(self.tokens))
        places = np.arange(len(self.tokens))
        return stops[np.searchsorted(stops, places)] - places

    def before(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The word before each place, and whether there is one that a run could begin with."""
        led = (at > 0) & self.free[at - 1]
        return np.where(led, self.tokens[at - 1], np.uint64(0)), led


def _maximal(item: _Side, doc: _Side, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common unmarked runs of s words or more that go no further either way: words, start in item, start in document.

    Windows of the document are ordered by hash and by the word before, so pairs that a common word precedes, which are parts of
    runs that begin earlier, are stepped over as ranges. Lengths come from halving steps on prefix hashes.
    """
    none = np.zeros(0, np.int64)
    at_a, at_b = item.open_runs(s), doc.open_runs(s)
    if not len(at_a) or not len(at_b):
        return none, none, none
    hash_a, hash_b = item.hashes(at_a, s), doc.hashes(at_b, s)
    known = np.unique(hash_a)
    place = np.minimum(np.searchsorted(known, hash_b), len(known) - 1)
    met = known[place] == hash_b
    at_b, group_b = at_b[met], place[met]
    if not len(at_b):
        return none, none, none
    word_a, led_a = item.before(at_a)
    word_b, led_b = doc.before(at_b)
    words_b = np.unique(word_b[led_b])
    kinds = len(words_b) + 2  # 0: nothing before; the last: a word that the document has before no window
    kind_b = np.where(led_b, np.searchsorted(words_b, word_b) + 1, 0)
    order = np.lexsort((at_b, kind_b, group_b))
    at_b, key_b = at_b[order], (group_b * kinds + kind_b)[order]
    group_a = np.searchsorted(known, hash_a) * kinds
    kind_a = np.searchsorted(words_b, word_a)
    same = led_a & (np.append(words_b, np.uint64(0))[kind_a] == word_a) & (kind_a < len(words_b))
    kind_a = np.where(same, kind_a + 1, kinds - 1)
    low, high = np.searchsorted(key_b, group_a), np.searchsorted(key_b, group_a + kinds)
    from_, to = np.searchsorted(key_b, group_a + kind_a), np.searchsorted(key_b, group_a + kind_a, "right")
    i = np.concatenate([np.repeat(at_a, from_ - low), np.repeat(at_a, high - to)])
    j = at_b[np.concatenate([ranges(low, from_ - low), ranges(to, high - to)])]
    least, most = np.full(len(i), s), np.minimum(item.room()[i], doc.room()[j])
    while (open_ := np.flatnonzero(least < most)).size:
        middle = (least[open_] + most[open_] + 1) // 2
        equal = item.hashes(i[open_], middle) == doc.hashes(j[open_], middle)
        least[open_[equal]] = middle[equal]
        most[open_[~equal]] = middle[~equal] - 1
    return least, i, j


def tile(item: np.ndarray, doc: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in document, words), longest first; ties by item start, then document start.

    Empty sequences have none; an item shorter than ``least`` can only be covered whole.
    """
    a, b = _Side(item), _Side(doc)
    least = min(least, len(item))
    tiles: list[tuple[int, int, int]] = []
    s = max(least, min(20, len(item), len(doc)))
    while least and s >= least:
        sizes, at_a, at_b = _maximal(a, b, s)
        longest = int(sizes.max()) if len(sizes) else 0
        if longest > 2 * s:
            s = longest
            continue
        order = np.lexsort((at_b, at_a, -sizes))
        todo = list(zip((-sizes[order]).tolist(), at_a[order].tolist(), at_b[order].tolist()))  # in order, so a heap
        while todo:
            n, i, j = heapq.heappop(todo)
            n = -n
            open_ = a.free[i:i + n] & b.free[j:j + n] & (item[i:i + n] == doc[j:j + n])
            if open_.all():
                a.free[i:i + n] = b.free[j:j + n] = False
                tiles.append((i, j, n))
                if not len(a.open_runs(s)):
                    break
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], open_.astype(np.int8), [0]])))
            for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if y - x >= s:
                    heapq.heappush(todo, (x - y, i + x, j + x))
        s = least if least < s < 2 * least else s // 2 if s > least else 0
    return sorted(tiles, key=lambda x: (-x[2], x[0], x[1]))


class Index:
    """Test items as word arrays with an index of their seeds."""

    def __init__(self, items: list[tuple[int, bytes, bytes]]):
        self.ids = [i for i, _, _ in items]
        self.tokens = [unblob(t) for _, t, _ in items]
        seeds = [np.unique(unblob(s)) for _, _, s in items]
        #: Items with a seed that stands twice in them: their seeds don't bound what tiles can cover.
        self.repeats = [len(u) < max(1, len(t) - SEED + 1) for t, u in zip(self.tokens, seeds)]
        #: (words of a seed, seeds in order, their items): items of fewer words than a seed are one of their own length.
        self.tables = []
        sizes = np.array([min(len(t), SEED) for t in self.tokens], np.int64)
        for size in np.unique(sizes).tolist():
            some = np.flatnonzero(sizes == size)
            seed = np.concatenate([seeds[i] for i in some])
            of = np.repeat(some, [len(seeds[i]) for i in some])
            order = np.argsort(seed, kind="stable")
            maybe = np.zeros(1 << 20, bool)
            maybe[(seed & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.tables.append((size, seed[order], of[order], maybe))

    def hits(self, texts: pa.Array, coverage: float) -> list[tuple]:
        """(row, item, share covered, tiles) of the pairs that reach ``coverage``."""
        if not self.tables:
            return []
        w = words(texts)
        pairs: dict[tuple[int, int], set[int]] = {}
        for size, seed, of, maybe in self.tables:
            windows, begin = w.windows(size)
            at = np.flatnonzero(maybe[(windows & np.uint64((1 << 20) - 1)).astype(np.int64)])
            low = np.searchsorted(seed, windows[at], "left")
            high = np.searchsorted(seed, windows[at], "right")
            at, low, high = at[high > low], low[high > low], high[high > low]
            rows = np.searchsorted(begin, at, "right") - 1
            # a seed counts once for a document, however often it stands there
            order = np.lexsort((windows[at], rows))
            first = order[np.append(True, (np.diff(rows[order]) != 0) | (np.diff(windows[at[order]]) != 0))[:len(order)]]
            for row, window, x, y in zip(rows[first].tolist(), windows[at[first]].tolist(), low[first].tolist(), high[first].tolist()):
                for item in of[x:y].tolist():
                    pairs.setdefault((row, item), set()).add(window)
        out = []
        for (row, item), seen in sorted(pairs.items()):
            tokens = self.tokens[item]
            if len(seen) * SEED < coverage * len(tokens) and not self.repeats[item]:
                continue  # each seed covers SEED words of the item at most
            tiles = tile(tokens, w.hash[w.first[row]:w.first[row + 1]])
            share = sum(n for _, _, n in tiles) / len(tokens)
            if share >= coverage:
                out.append((row, item, share, tiles))
        return out


def _seeds(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Windows of SEED words; of a text of fewer words, its one window of as many words."""
    windows, begin = w.windows(SEED)
    for size in range(1, SEED):
        own, first = w.windows(size)
        some = np.flatnonzero(w.counts == size)
        windows[begin[some]] = own[first[some]]
    return windows, begin


def indexed(benchmark: DataFrame, slice_words: int = SLICE_WORDS):
    """Indexes over all of ``benchmark`` (item_id, text), each of about ``slice_words`` words at most."""
    schema = pa.schema([("item_id", pa.int64()), ("tokens", pa.binary()), ("seeds", pa.binary())])

    def pack(batches):
        for part in slices(batches):
            w = words(part.column("text"))
            windows, begin = _seeds(w)
            yield pa.RecordBatch.from_arrays([
                part.column("item_id"),
                pa.array([blob(w.hash[a:b]) for a, b in zip(w.first[:-1], w.first[1:])], pa.binary()),
                pa.array([blob(windows[a:b]) for a, b in zip(begin[:-1], begin[1:])], pa.binary())], schema=schema)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    packed = items.mapInArrow(pack, "item_id long, tokens binary, seeds binary").filter("octet_length(tokens) > 0")
    total = packed.agg(F.sum(F.expr("octet_length(tokens) div 8"))).first()[0] or 0
    count = max(1, -(-2 * total // slice_words))
    for k in range(count):
        rows = packed.filter(F.expr(f"pmod(xxhash64(tokens), {count}) = {k}")).collect()
        yield Index(sorted(((r[0], bytes(r[1]), bytes(r[2])) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, slice_words: int = SLICE_WORDS) -> DataFrame:
    """A row for each document and item whose tiles cover ``coverage`` of the item: ids, share covered, number of tiles,
    words covered, tiles as ``item start:document start:words`` (in words), longest first.

    Documents are not shuffled. Null or wordless texts and items match nothing; an item of fewer than five words matches the
    documents that hold its words side by side, so very short items belong out of a benchmark. Repeated documents give a row each, repeated items (id and text) count once.
    Null ids stay null. Empty tables give no rows. Other columns are ignored. Items are sent to the tasks
    in slices of bounded size, one pass over the documents for each.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for index in indexed(benchmark, slice_words):
        def run(batches, index=index):
            for part in slices(batches):
                ids = part.column("doc_id").to_pylist()
                rows = [(ids[row], index.ids[item], share, len(tiles), sum(n for _, _, n in tiles), ",".join(f"{i}:{j}:{n}" for i, j, n in tiles))
                        for row, item, share, tiles in index.hits(part.column("text"), coverage)]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "item_id", "coverage", "n_tiles", "matched_words", "tiles"])

        part = texts.mapInArrow(run, PAIR)
        found = part if found is None else found.union(part)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, slice_words: int = SLICE_WORDS) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns; texts are not shuffled.

    Null and empty texts stay, repeated rows stay or go together, null ids stay null, and an empty table stays empty; an empty
    benchmark takes nothing away. Other columns are carried along whatever their names.
    """
    for index in indexed(benchmark, slice_words):
        def run(batches, index=index):
            for part in slices(batches):
                keep = np.ones(part.num_rows, bool)
                keep[[row for row, *_ in index.hits(part.column("text"), coverage)]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
