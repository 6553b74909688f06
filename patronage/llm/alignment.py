"""Which tokens of one tokenizer cover which tokens of another, on the same bytes.

Both encode the same text with a space before it. The ends of their tokens are two increasing arrays of byte offsets. While
tokens run one to one, the two arrays agree at a fixed index shift: blocks of doubling length are compared at that shift, and the
stretch that agrees is jumped. Where it stops, the irregular group is closed locally and the shift updated.

Texts are cut where neither tokenizer joins across: at a space after a character that is neither white space nor the space marker.
A task aligns each distinct unit once; a unit's end is an end of both tokenizers, so no group crosses from one unit to the next.
How often two ids are linked anywhere in the corpus is counted by documents: a task folds its documents to chunks with one row per
pair, the chunks' rows are summed and ranked as a table, and each chunk gets the sums of its own pairs back.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm import units
from patronage.llm.pieces import BYTE, CONTROL, MARK, THREADS, PieceModel
from patronage.llm.units import Spans
from patronage.llm.wordarrays import blob, buffer, ranges, slices, unblob
from patronage.sources.storage import materialise

#: Bytes of text that are cut into units at once, and of a chunk, whose documents share one list of pairs.
PART_BYTES = 1 << 20
CHUNK_BYTES = 8 << 20
#: Tokens that are compared one by one before blocks of arrays are.
SINGLE = 8
#: Units that are encoded as one line, and the end of a unit that another one can follow.
PER_LINE = 256
PLAIN_END = re.compile(r"[!-~]\Z")
#: Distinct units that a task remembers with their groups and links.
REMEMBERED = 250_000


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two tokenizations of the same bytes are cut alike: of each group, the number of its last token on either side.

    ``a`` and ``b`` are increasing ends; the last of both is the same. Diagonal runs are skipped by exponential probing.
    """
    listed_a, listed_b = a.tolist(), b.tolist()
    n, m = len(listed_a), len(listed_b)
    if (listed_a[-1:] or [0]) != (listed_b[-1:] or [0]):
        raise ValueError("the tokens do not cover the same bytes")
    runs, i, j = [], 0, 0  # (first token of a, first of b, one-to-one groups) of each stretch
    while i < n:
        begin, step = i, 1
        shift = j - i
        while True:
            step = min(step, n - i, m - j)
            if step <= SINGLE:
                stop = i + step
                while i < stop and listed_a[i] == listed_b[i + shift]:
                    i += 1
                jumped = i == stop
            else:
                same = a[i:i + step] == b[i + shift:i + shift + step]
                jumped = bool(same.all())
                i += step if jumped else int(same.argmin())
            j = i + shift
            if not jumped or i == n:
                break
            step *= 2
        if i > begin:
            runs.append((begin, begin + shift, i - begin))
        if i == n:
            break
        x, y = listed_a[i], listed_b[j]
        while x != y:  # the irregular group ends at the next offset that both have
            if x < y:
                i += 1
                x = listed_a[i]
            else:
                j += 1
                y = listed_b[j]
        runs.append((i, j, 1))
        i, j = i + 1, j + 1
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first_a, first_b, length = (np.array(x, np.int64) for x in zip(*runs))
    return ranges(first_a, length), ranges(first_b, length)


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token numbers of every overlapping pair: between two neighbouring ends of either side lies one pair."""
    ends = np.union1d(a, b)
    return np.searchsorted(a, ends), np.searchsorted(b, ends)


def cut(texts: pa.Array) -> Spans:
    """Units of texts that begin with a space or are empty; each begins with the spaces before a word."""
    data, offsets = buffer(texts)
    n = len(data)
    plain = np.zeros(n, bool)  # the last byte of a character that is surely no white space and no marker
    plain[:] = (data > 0x20) & (data < 0x7F)
    plain[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    plain[2:] |= (data[2:] >= 0x80) & (data[1:-1] >= 0x80) & (data[:-2] >= 0xE4) & (data[:-2] < 0xF0)
    plain[3:] |= (data[3:] >= 0x80) & (data[2:-1] >= 0x80) & (data[1:-2] >= 0x80) & (data[:-3] >= 0xF0)
    start = np.zeros(n, bool)
    start[1:] = (data[1:] == 0x20) & plain[:-1]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(start)
    end = np.append(start[1:], n) if len(start) else start
    return Spans(data, start, end, units._names(data, start, end, False), np.searchsorted(start, offsets))


def _byte_values() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = count(256)
    return {chr(v if v in kept else next(spare)): v for v in range(256)}


class _Table:
    """Bytes of the tokens of a vocabulary, by id."""

    def __init__(self, parts: list[bytes]):
        self.size = np.array([len(p) for p in parts], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.begin[ids], self.size[ids])]


class Pair(units.Lookup):
    """The two tokenizers, and what is known of the units met: ids, groups, links.

    Of a unit, ``facts`` holds whether both token sequences give its bytes, tokens of A, tokens of B and groups, ``groups`` the text of its
    groups, and the flat ids its links, two numbers each.
    """

    def __init__(self, json_content: str, model: bytes, limit: int = REMEMBERED):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_content)
        self.a.encode_special_tokens = True
        values = _byte_values()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        parts = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            parts[number] = bytes(values[c] for c in token)
        self.bytes_a = _Table(parts)
        self.model = PieceModel(model)
        if not self.model.by_word:
            raise ValueError("the pieces may hold the space marker at their beginning only, without other normalisation")
        self.bytes_b = _Table([
            bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode()
            for p, kind in zip(self.model.pieces, self.model.kinds)])
        self.said_a, self.said_b = [f"{i}|" for i in range(len(parts))], [str(i) for i in range(len(self.model.pieces))]
        super().__init__(self.align, limit)

    def forget(self) -> None:
        super().forget()
        self.facts, self.groups = np.zeros((0, 4), np.int64), []

    def make_room(self) -> None:
        self.forget()  # all at once: a chunk ends whenever rows are numbered anew

    def encoded(self, texts: list[str]):
        """Ids and their number of each unit, on either side; units go through the libraries in lines, as they would stand in a text."""
        ends = np.array([-1, *(i for i, t in enumerate(texts) if i % PER_LINE == PER_LINE - 1 or not PLAIN_END.search(t) or MARK in t), len(texts) - 1])
        cuts = np.unique(ends) + 1
        alone = np.array([MARK in t for t in texts], bool)
        cuts = np.union1d(cuts, np.flatnonzero(alone))  # such a unit is a line of its own
        lines = ["".join(texts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        sizes = np.array([len(t.encode()) for t in texts], np.int64)
        whole = lambda lines: [e.ids for e in self.a.encode_batch_fast(lines, add_special_tokens=False)]
        for encode, table in ((whole, self.bytes_a), (self.model.reference_lines, self.bytes_b)):
            found = encode(lines)
            ids = np.fromiter(chain.from_iterable(found), np.int64)
            per_line = np.fromiter(map(len, found), np.int64, len(found))
            at, of_line = np.cumsum(table.size[ids]), np.concatenate([[0], np.cumsum(per_line)])
            begun = np.concatenate([[0], at])[of_line[:-1]]  # bytes before each line's tokens
            number = np.repeat(np.arange(len(lines)), np.diff(cuts))
            stood = np.cumsum(sizes) - (np.cumsum(sizes) - sizes)[cuts[:-1]][number]  # where a unit ends in its line
            last = np.searchsorted(at, begun[number] + stood)
            last = np.where(np.append(np.diff(number) > 0, True), of_line[1:][number] - 1, last)
            ended = np.append(at, -1)[last] == begun[number] + stood
            if (~ended & ~alone).any():  # a unit that no token ends with: all go alone
                found = encode(texts)
                yield np.fromiter(chain.from_iterable(found), np.int64), np.fromiter(map(len, found), np.int64, len(texts))
            else:
                yield ids, np.diff(np.concatenate([[-1], last]))

    def align(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Links of units that were not met before, two numbers each, and how many numbers each unit has."""
        (ids_a, n_a), (ids_b, n_b) = self.encoded(texts)
        raw = [t.encode() for t in texts]
        whole = np.frombuffer(b"".join(raw), np.uint8)
        sizes = np.array([len(r) for r in raw], np.int64)
        covered = [_same(whole, sizes, ids, n, table) for ids, n, table in ((ids_a, n_a, self.bytes_a), (ids_b, n_b, self.bytes_b))]
        good = covered[0] & covered[1]
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        ends_a, ends_b = np.cumsum(self.bytes_a.size[ids_a]), np.cumsum(self.bytes_b.size[ids_b])
        last_a, last_b = common_ends(ends_a, ends_b)
        self.groups += _spelled(ids_a, ids_b, last_a, last_b, np.cumsum(n_a), self.said_a, self.said_b)
        n_groups = np.diff(np.searchsorted(last_a, np.concatenate([[0], np.cumsum(n_a)])))
        self.facts = np.concatenate([self.facts, np.stack([good, n_a, n_b, n_groups], 1)])
        left, right = overlaps(ends_a, ends_b)
        return np.stack([ids_a[left], ids_b[right]], 1).ravel(), 2 * (n_a + n_b - n_groups)


def _same(whole: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray, table: _Table) -> np.ndarray:
    """Whether the tokens of each unit give its bytes."""
    lengths = np.add.reduceat(np.append(table.size[ids], 0), np.minimum(np.cumsum(counts) - counts, len(ids))) * (counts > 0)
    good = lengths == sizes
    mine, theirs = table.joined(ids[np.repeat(good, counts)]), whole[np.repeat(good, sizes)]
    wrong = np.concatenate([[0], np.cumsum(mine != theirs)])
    ends = np.cumsum(sizes * good)
    good[good] = (wrong[ends] == wrong[ends - sizes * good])[good]
    return good


def _spelled(ids_a, ids_b, last_a, last_b, ends, said_a, said_b) -> list[str]:
    """The groups of each unit as text: ids joined by commas, sides by a bar, groups by a semicolon."""
    first_a, first_b = (np.concatenate([[0], last[:-1] + 1])[:len(last)] for last in (last_a, last_b))
    said = [said_a[x] + said_b[y] for x, y in zip(ids_a[last_a].tolist(), ids_b[last_b].tolist())]  # right where one meets one
    several = np.flatnonzero((first_a < last_a) | (first_b < last_b))
    a, b = ids_a.tolist(), ids_b.tolist()
    sides = (x[several].tolist() for x in (first_a, last_a + 1, first_b, last_b + 1))
    for at, i, x, j, y in zip(several.tolist(), *sides):
        said[at] = f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}"
    at = np.searchsorted(last_a, ends).tolist()
    return [";".join(said[x:y]) for x, y in zip([0, *at], at)]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


class _Chunk:
    """Documents that share one list of pairs."""

    def __init__(self, pair: Pair):
        self.pair, self.parts, self.pairs, self.bytes = pair, [], [], 0

    def add(self, part: pa.RecordBatch, said: bool) -> None:
        texts = pc.fill_null(part.column("text"), "")
        led = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(" ", texts, ""))
        spans = cut(led)
        row = self.pair.rows(spans)
        facts = self.pair.facts[row]
        whole = _sums(1 - facts[:, 0], spans.first) == 0
        owner = np.repeat(np.arange(len(texts)), np.diff(spans.first))
        row = np.where(whole[owner], row, -1)
        sums = [np.where(whole, _sums(facts[:, i], spans.first), 0) for i in (1, 2, 3)]
        groups = self.pair.groups
        spelled = [";".join([groups[r] for r in row[a:b].tolist()]) if ok and b > a else "" for a, b, ok in zip(spans.first[:-1], spans.first[1:], whole)]
        digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled]
        kept = row >= 0
        first = np.concatenate([[0], np.cumsum(kept)])[spans.first]
        row = row[kept]
        self.parts.append((part.column("doc_id"), *sums, digests, spelled if said else [None] * len(digests), row.astype(np.uint32), first))
        self.bytes += len(spans.data)
        # in how many of these documents is each pair linked?
        each = np.unique(owner[kept] * len(self.pair.facts) + row)
        owner, row = each // max(1, len(self.pair.facts)), each % max(1, len(self.pair.facts))
        held, sizes = self.links(row)
        width = len(self.pair.bytes_a.size) * len(self.pair.bytes_b.size)
        once = np.unique(np.repeat(owner, sizes) * width + held) % width
        self.pairs.append(np.unique(once, return_counts=True))

    def links(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs linked in units, as one number each, and how many each unit has."""
        begin = self.pair.begin // 2
        sizes = begin[row + 1] - begin[row]
        both = self.pair.flat.reshape(-1, 2)[ranges(begin[row], sizes)].astype(np.int64)
        return both[:, 0] * len(self.pair.bytes_b.size) + both[:, 1], sizes

    def batches(self, number: int):
        """A row per document, and one with the pairs of the chunk and the places of each unit's pairs among them."""
        flat = np.concatenate([p for p, _ in self.pairs])
        pairs, at = np.unique(flat, return_inverse=True)
        docs = np.bincount(at, np.concatenate([c for _, c in self.pairs]), len(pairs)).astype(np.int64)
        rows = np.unique(np.concatenate([p[6] for p in self.parts])).astype(np.int64)
        held, sizes = self.links(rows)
        yield _rows([number], units=[blob(sizes, np.uint32)], links=[blob(np.searchsorted(pairs, held), np.uint32)], pairs=[pairs], docs=[docs])
        for ids, n_a, n_b, n_groups, digests, spelled, row, first in self.parts:
            place = np.searchsorted(rows, row).astype(np.uint32)
            yield _rows([number] * len(ids), doc_id=ids, n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_a + n_b - n_groups, groups_sha256=digests, groups=spelled,
                        units=[place[a:b].tobytes() for a, b in zip(first[:-1], first[1:])])


COLUMNS = {"chunk": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
           "groups": pa.string(), "units": pa.binary(), "links": pa.binary(), "pairs": pa.list_(pa.int64()), "docs": pa.list_(pa.int64())}
SCHEMA = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, units binary, links binary, "
          "pairs array<long>, docs array<long>")


def _rows(numbers: list[int], **given) -> pa.RecordBatch:
    given["chunk"] = numbers
    return pa.RecordBatch.from_arrays(
        [pa.array(given[c], t) if c in given and not isinstance(given[c], pa.Array) else given.get(c, pa.nulls(len(numbers), t)) for c, t in COLUMNS.items()], names=list(COLUMNS))


def packed(docs: DataFrame, tokenizer_path: str, model_path: str, spelled: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The stored alignment of ``docs`` (doc_id, text; other columns are ignored), in chunks of ``chunk_bytes`` of text of one task.

    A row per document with its counts, digest and units, and one row per chunk (``links`` is not null) with its pairs. With ``spelled``, documents
    hold the text of their groups. A longer text is a chunk of its own. The chunks' numbers are those of this table.
    """
    context = docs.sparkSession.sparkContext
    with open(tokenizer_path, encoding="utf-8") as file, open(model_path, "rb") as other:
        content = context.broadcast((file.read(), other.read()))  # vocabulary files, of a size apart from the corpus

    def run(batches):
        pair = Pair(*content.value)
        numbers = (TaskContext.get().partitionId() * (1 << 32) + i for i in count())
        chunk = _Chunk(pair)
        for part in slices(batches, PART_BYTES):
            if chunk.parts and (chunk.bytes >= chunk_bytes or len(pair.place) > pair.limit):  # rows of units hold until they are forgotten
                yield from chunk.batches(next(numbers))
                chunk = _Chunk(pair)
            chunk.add(part, spelled)
        if chunk.parts:
            yield from chunk.batches(next(numbers))

    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA), "alignment")


def vocabulary_size(model_path: str) -> int:
    with open(model_path, "rb") as file:
        return len(PieceModel(file.read()).pieces)


def _chunk_pairs(table: DataFrame) -> DataFrame:
    return table.filter("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p")).select(
        "chunk", "place", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))


def _ranked(pairs: DataFrame, size_b: int) -> DataFrame:
    counted = pairs.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.expr(f"pair div {size_b}"))
    return counted.withColumn("best", F.expr("n = max(n) OVER (PARTITION BY a)"))  # at most a vocabulary of ids meets one id


def link_counts(table: DataFrame, model_path: str) -> DataFrame:
    """``a``, ``b``, ``n`` (documents that hold the two ids linked) and ``best`` (no id of B is linked to ``a`` in more) of a ``packed`` table."""
    size_b = vocabulary_size(model_path)
    return _ranked(_chunk_pairs(table), size_b).selectExpr("a", f"pair % {size_b} AS b", "n", "best")


def _weighed(key, documents: pa.Table, sums: pa.Table) -> pa.Table:
    """Documents of a chunk with the sums over their links."""
    documents, sums = documents.combine_chunks(), sums.sort_by("place")
    head = documents.filter(pc.is_valid(documents["links"]))
    rows = documents.filter(pc.is_null(documents["links"]))
    sizes, links = (unblob(head[c][0].as_py(), np.uint32).astype(np.int64) for c in ("units", "links"))
    n, best = sums["n"].to_numpy(), sums["best"].to_numpy().astype(np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    of_unit = [_sums(v[links], first) for v in (n, best)]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    held = [unblob(u, np.uint32) for u in rows["units"].to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(u) for u in held])]).astype(np.int64)
    every = np.concatenate(held) if held else np.zeros(0, np.uint32)
    counts, bests = (_sums(v[every], first) for v in of_unit)
    return rows.select(names).append_column("n_best", pa.array(bests.astype(np.int64))).append_column("count_sum", pa.array(counts.astype(np.int64)))


def aligned(docs: DataFrame, tokenizer_path: str, model_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of each row of ``docs``
    (doc_id, text; other columns are ignored): tokens of either side, groups, links, links whose count is the highest of their id of A,
    and the sum of the counts of all links. A pair of ids counts the rows that hold it linked, a repeated row each time.

    A null or empty text, and one that the tokens of a side do not spell (a literal space marker), has no tokens: zeros and an empty
    digest. A row gives a row; null ids stay null; an empty table gives no rows.
    """
    table = packed(docs, tokenizer_path, model_path, chunk_bytes=chunk_bytes)
    pairs = _chunk_pairs(table)
    sums = pairs.join(_ranked(pairs, vocabulary_size(model_path)), "pair").selectExpr("chunk AS of_chunk", "place", "n", "best")
    rows = table.select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "units", "links")
    return rows.groupBy("chunk").cogroup(sums.groupBy("of_chunk")).applyInArrow(
        _weighed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def groups(docs: DataFrame, tokenizer_path: str, model_path: str) -> DataFrame:
    """``doc_id``, ``n_groups`` and ``groups``, the text ``a1,a2|b1;a3|b2,b3`` of the groups, of each row; empty for a text without tokens."""
    return packed(docs, tokenizer_path, model_path, spelled=True).filter("links IS NULL").select("doc_id", "n_groups", "groups")
