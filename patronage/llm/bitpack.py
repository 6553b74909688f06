"""Token ids in fixed-width bit-packed files.

A file holds a range of documents in ascending doc_id order::

    magic 'IDB2', width in bits (u8), 3 zero bytes, number of documents (u64), number of ids (u64), ids in a block (u32), number of blocks (u32),
    number of documents without doc_id (u64), which come first
    doc_id of each document (i64; 0 where there is none), end of each document in ids (u64)
    byte offset of each block in the payload (u64)
    payload: blocks of ids, each id in ``width`` bits, lowest bit first; a block begins on a byte

All numbers are little-endian. ``width`` is the least that holds the vocabulary. As the width is fixed and blocks have
offsets, any id can be read alone, and a block is unpacked by NumPy at once.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm import units
from patronage.llm.wordarrays import blob, ranges, slices, unblob
from patronage.sources.storage import materialise

MAGIC = b"IDB2"
HEAD = "<4sB3xQQIIQ"
HEAD_BYTES = struct.calcsize(HEAD)
BLOCK = 4096
CHUNK = 1 << 19
#: A sign that stands between words that are encoded in one line.
JOINER = "\x01"
#: Distinct words that a Python worker remembers, about.
REMEMBERED = 500_000
#: Bytes of text in a part, which one task arranges; a part of one very long document may hold more.
PART_BYTES = 2 << 20
#: Ranges of doc_id that are cut at quantiles; beyond them each range is divided evenly by value.
RANGES = 16_384
#: Ids in a file, about; a file of one very long document may hold more.
FILE_IDS = 4_000_000


def width_of(vocabulary: int) -> int:
    """The least number of bits for ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """One block of ids, ``width`` bits each, lowest bit first."""
    if width == 16:
        return ids.astype("<u2").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width == 16:
        return np.frombuffer(data, "<u2", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(1, dtype=np.uint32)


def to_file(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, width: int, block: int = BLOCK, unnamed: int = 0) -> bytes:
    """A whole file, the first ``unnamed`` documents of which have no doc_id; ids that do not fit the width are refused."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    blocks = [pack(ids[a:a + block], width) for a in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])[:len(blocks)]
    return b"".join([struct.pack(HEAD, MAGIC, width, len(doc_ids), len(ids), block, len(blocks), unnamed), blob(doc_ids, "<i8"), blob(np.cumsum(sizes), "<u8"),
                     blob(offsets, "<u8"), *blocks])


class IdFile:
    """Reads a file: ``doc_ids`` (the first ``unnamed`` stand for none), ``ends``, and ids of any range or document."""

    def __init__(self, content: bytes):
        magic, self.width, docs, self.n_ids, self.block, blocks, self.unnamed = struct.unpack_from(HEAD, content)
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        at = HEAD_BYTES
        self.doc_ids = np.frombuffer(content, "<i8", docs, at)
        self.ends = np.frombuffer(content, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.offsets = np.frombuffer(content, "<u8", blocks, at + 16 * docs).astype(np.int64)
        self.payload = memoryview(content)[at + 16 * docs + 8 * blocks:]

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids start..end, from the blocks that hold them."""
        end = self.n_ids if end is None else end
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        parts = [unpack(self.payload[int(self.offsets[b]):], min(self.block, self.n_ids - b * self.block), self.width) for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block:end - first * self.block]

    @property
    def named(self) -> pa.Array:
        """The doc_ids, null where there is none."""
        return pa.array(self.doc_ids, mask=np.arange(len(self.doc_ids)) < self.unnamed)

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.ends[place - 1]) if place else 0, int(self.ends[place]))


def _part_of(doc: np.ndarray, edges: np.ndarray, fine: int) -> np.ndarray:
    """The part of each doc_id: its range between ``edges``, and which of ``fine`` even pieces of the range; parts ascend with ids."""
    at = np.clip(np.searchsorted(edges, doc, "right") - 1, 0, max(0, len(edges) - 2))
    low, high = edges[at].astype(float), edges[np.minimum(at + 1, len(edges) - 1)].astype(float)
    piece = np.clip((doc - low) / np.maximum(high - low, 1) * fine, 0, fine - 1).astype(np.int64)
    return at * fine + piece


_lookups: dict[str, units.Lookup] = {}


def shared_lookup(job: str, tokenizer: str) -> units.Lookup:
    """The tokenizer (the content of its file) and the words met: of each Python worker, whose tasks of a job go on with what its earlier ones have encoded."""
    if job not in _lookups:
        _lookups.clear()  # a worker that comes to another job starts anew
        pa.set_memory_pool(pa.system_memory_pool())  # of which what is freed can be given back
        os.environ.setdefault("RAYON_NUM_THREADS", "1")  # a task has a core; more threads only hold memory
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(tokenizer)
        ids_of = lambda lines: [e.ids for e in library.encode_batch_fast(lines, add_special_tokens=False)]
        mark = ids_of([JOINER])[0]
        encode = units.joined(ids_of, f" {JOINER} ", mark[0] if len(mark) == 1 else None)
        suffix, vocabulary = getattr(library.model, "end_of_word_suffix", None), library.get_vocab()
        if suffix:
            final = np.zeros(max(vocabulary.values()) + 1, bool)
            final[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
            encode = units.by_ends(ids_of, final, encode)
        del vocabulary
        give_back()  # what the file's content took while it was read
        _lookups[job] = units.Lookup(encode, REMEMBERED)
    return _lookups[job]


def give_back() -> None:
    """Return freed memory to the system: a Python worker stays when its task has ended, and others may run beside it."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def forget_lookups() -> None:
    if _lookups:
        _lookups.clear()
        give_back()


FILES = "part int, file int, content binary"


def write(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, file_ids: int = FILE_IDS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Files with the ids of each text and ``end_id`` after it, in ascending doc_id order over (part, file).

    The texts' bytes are counted, and ranges of doc_id with about ``part_bytes`` each are cut at quantiles of the ids (beyond ``RANGES``, at even steps between
    quantiles), so that a part does not grow with the data; tasks encode, and only packed ids are shuffled, to the part of their range, which sorts them and cuts files of about ``file_ids`` ids.
    A null text is empty. Rows that repeat a doc_id are all written, ordered by their ids. Rows without doc_id come first: they are spread over parts
    of their own by a checksum of their ids, and ordered by their ids inside. An empty table gives no files.
    Rows of (part, file, content) are written by Spark to the shared folder, so any store that Spark writes will do;
    ``content`` is a file as ``IdFile`` reads it.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    length = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    named, unnamed = texts.agg(F.sum(F.when(F.col("doc_id").isNotNull(), length)), F.sum(F.when(F.col("doc_id").isNull(), length))).first()
    parts, slots = (-(-(n or 0) // part_bytes) for n in (named, unnamed))
    coarse = min(parts, RANGES)
    fine = -(-parts // max(coarse, 1))
    shares = [k / coarse for k in range(coarse + 1)] if coarse else [0.5]
    edges = texts.agg(F.percentile_approx("doc_id", shares, 10 * RANGES)).first()[0] or [0]
    edges = np.unique(np.array(edges, np.int64))
    width, job = width_of(vocabulary), uuid.uuid4().hex
    with open(tokenizer_path, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())  # a vocabulary file, of a size apart from the corpus

    def fragments(batches):
        lookup = shared_lookup(job, content.value)
        for rows in slices(batches, CHUNK):
            ids, begin = lookup.ids(units.words(rows.column("text")))
            bare = pc.is_null(rows.column("doc_id")).to_numpy(zero_copy_only=False)
            doc = pc.fill_null(rows.column("doc_id"), 0).to_numpy()
            sizes = np.diff(begin) + 1
            whole = np.full(len(ids) + len(doc), end_id, np.uint32)
            whole[ranges(begin[:-1] + np.arange(len(doc)), sizes - 1)] = ids
            starts = np.concatenate([[0], np.cumsum(sizes)])
            part = slots + _part_of(doc, edges, fine)
            for i in np.flatnonzero(bare):
                part[i] = zlib.crc32(whole[starts[i]:starts[i + 1]].tobytes()) % slots
            order = np.lexsort((doc, part))
            cut = np.concatenate([[0], np.flatnonzero(np.diff(part[order])) + 1, [len(order)]])
            out = []
            for a, b in zip(cut[:-1], cut[1:]):
                some = order[a:b]
                chosen = whole[ranges(starts[some], sizes[some])]
                out.append((int(part[some[0]]), to_file(doc[some], sizes[some], chosen, width)))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([c for _, c in out], pa.binary())], names=["part", "content"])

    def encode(batches):
        yield from fragments(batches)
        give_back()

    def arrange(table: pa.Table) -> pa.Table:
        forget_lookups()  # all texts are encoded when parts are arranged
        part = table.column("part")[0].as_py()
        files = [IdFile(c) for c in table.column("content").to_pylist()]
        doc = np.concatenate([f.doc_ids for f in files])
        sizes = np.concatenate([np.diff(np.concatenate([[0], f.ends])) for f in files])
        ids = np.concatenate([f.ids() for f in files])
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(doc, kind="stable")
        edge = np.concatenate([[0], np.flatnonzero(np.diff(doc[order])) + 1, [len(order)]])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if b - a > 1:  # rows that repeat a doc_id, or have none: by their ids
                order[a:b] = sorted(order[a:b].tolist(), key=lambda i: ids[starts[i]:starts[i] + sizes[i]].astype(">u4").tobytes())
        ends = np.cumsum(sizes[order])
        cut = [0]
        while cut[-1] < len(order):
            before = ends[cut[-1] - 1] if cut[-1] else 0
            cut.append(max(cut[-1] + 1, int(np.searchsorted(ends, before + file_ids, "right"))))
        out = [to_file(doc[order[a:b]], sizes[order[a:b]], ids[ranges(starts[order[a:b]], sizes[order[a:b]])], width, unnamed=(b - a) * (part < slots)) for a, b in zip(cut[:-1], cut[1:])]
        return pa.Table.from_arrays([pa.array([part] * len(out), pa.int32()), pa.array(range(len(out)), pa.int32()), pa.array(out, pa.binary())], names=["part", "file", "content"])

    return materialise(texts.mapInArrow(encode, "part int, content binary").groupBy("part").applyInArrow(arrange, FILES), "packed-ids")


def read(files: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` of every document, from the files alone.

    The driver sees one row of three numbers for each file; an empty table gives no rows, and documents without doc_id give null.
    """
    def sizes(batches):
        for batch in batches:
            heads = [struct.unpack_from(HEAD, h) for h in batch.column("head").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("file"), pa.array([h[3] for h in heads], pa.int64())], names=["part", "file", "n"])

    known = files.select("part", "file", F.expr(f"substring(content, 1, {HEAD_BYTES})").alias("head")).mapInArrow(sizes, "part int, file int, n long")
    base, at = {}, 0
    for r in sorted(known.collect()):
        base[r["part"], r["file"]] = at
        at += r["n"]
    base = files.sparkSession.sparkContext.broadcast(base)

    def run(batches):
        for batch in batches:
            for part, number, content in zip(*(batch.column(c).to_pylist() for c in ("part", "file", "content"))):
                f = IdFile(content)
                ids = f.ids().astype("<u4")
                starts = np.concatenate([[0], f.ends[:-1]]).astype(np.int64)[:len(f.ends)]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, f.ends)]
                yield pa.RecordBatch.from_arrays([f.named, pa.array(starts + base.value[part, number]), pa.array(f.ends - starts), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
