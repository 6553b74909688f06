"""SentencePiece models on the tokenizers library: parse the model file, rebuild it, encode, decode, check parity.

The model's protobuf is read field by field. The normaliser (dummy prefix, space marker), the unigram scores or the
merges that BPE scores imply, and byte fallback become a tokenizer of the library. Where no piece holds the space
marker after another character, pieces never cross from one word into the next, so a task encodes each
distinct word once, in multithreaded batches; texts of other models are encoded whole. Ids are those of the rebuilt tokenizer;
the sentencepiece library encodes the same words or texts beside it, and each row says for how many of them the two differ.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm import units
from patronage.llm.wordarrays import ranges, slices

MARK = "▁"
THREADS = 2
JOINER = "\x01"
#: Set in the first id of a remembered word for which the two libraries differ.
DIFFERS = np.uint32(1 << 31)
CHUNK = 2 << 20
# Field numbers and enums of the model's protobuf.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, UNIGRAM, BPE = 3, 1, 2
CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE = 2, 3, 4, 5


def fields(data: bytes):
    """(number, value) of a protobuf message: an int, or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class PieceModel:
    """A parsed model with its tokenizer, and the sentencepiece library's own as ``reference``."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.pieces, self.kinds, self.scores = [], [], []
        trainer, normalizer = {}, {DUMMY_PREFIX: 1, EXTRA_SPACES: 1, ESCAPE: 1}
        for number, value in fields(raw):
            if number == PIECES:
                piece = dict(fields(value))
                self.pieces.append(piece[PIECE].decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece[SCORE])[0] if SCORE in piece else 0.0)
                self.kinds.append(piece.get(TYPE, NORMAL))
            elif number == TRAINER:
                trainer = dict(fields(value))
            elif number == NORMALIZER:
                normalizer |= dict(fields(value))
        self.kind = trainer.get(MODEL_TYPE, UNIGRAM)
        self.charsmap = normalizer.get(CHARSMAP, b"")
        self.prefix, self.squeeze = bool(normalizer[DUMMY_PREFIX]), bool(normalizer[EXTRA_SPACES])
        self.unknown = self.kinds.index(UNKNOWN)
        self.fallback = BYTE in self.kinds
        if self.kind not in (UNIGRAM, BPE) or USER in self.kinds or not normalizer[ESCAPE]:
            raise ValueError("only unigram and BPE models without user-defined pieces are rebuilt")
        #: Whether words can be encoded one by one.
        self.by_word = not self.charsmap and not self.squeeze and self.prefix and not any(MARK in p.lstrip(MARK) for p in self.pieces)
        self._tokenizer = None
        self._reference = None

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces in the order in which BPE joins them: by the score of what they make, best first.

        Where several pairs have one score, sentencepiece joins the leftmost, while here each pair needs its own rank. Of
        pieces of one score (runs of spaces) the longer goes first, so that a run grows from the left; of pairs that make
        one piece, those go first that stand to the left where two of them share a piece (x+y = y+z).
        """
        normal = {p: s for p, s, k in zip(self.pieces, self.scores, self.kinds) if k == NORMAL}
        made = []
        for piece, score in normal.items():
            for cut in range(1, len(piece)):
                if piece[:cut] in normal and piece[cut:] in normal:
                    left = not piece.startswith(piece[cut:])
                    made.append((-score, -len(piece), left, -normal[piece[:cut]], -normal[piece[cut:]], piece[:cut], piece[cut:]))
        return [(a, b) for *_, a, b in sorted(made)]

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
            from tokenizers import Regex, Tokenizer, decoders, models, normalizers

            if self.kind == BPE:
                vocab = {p: i for i, p in enumerate(self.pieces)}
                model = models.BPE(vocab=vocab, merges=self.merges(), unk_token=self.pieces[self.unknown], fuse_unk=True, byte_fallback=self.fallback)
            else:
                model = models.Unigram(list(zip(self.pieces, self.scores)), unk_id=self.unknown, byte_fallback=self.fallback)
            t = Tokenizer(model)
            steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
            if self.squeeze:
                steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip(True, True)]
            steps += [normalizers.Prepend(MARK)] if self.prefix else []
            t.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
            ends = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
            t.decoder = decoders.Sequence(ends + [decoders.Strip(" ", 1, 0)] * self.prefix)
            self._tokenizer = t
        return self._tokenizer

    @property
    def reference(self):
        if self._reference is None:
            import sentencepiece

            self._reference = sentencepiece.SentencePieceProcessor(model_proto=self.raw)
        return self._reference

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts, in one multithreaded batch; an empty text has none."""
        return [e.ids if t else [] for e, t in zip(self.tokenizer.encode_batch(texts, add_special_tokens=False), texts)]

    def encode_lines(self, lines: list[str]) -> list[list[int]]:
        """Ids of lines that begin with the space of their prefix."""
        bare = [x[1:] for x in lines]
        return [e.ids if t else self.lone_space for e, t in zip(self.tokenizer.encode_batch_fast(bare, add_special_tokens=False), bare)]

    def reference_lines(self, lines: list[str]) -> list[list[int]]:
        """The same by the sentencepiece library."""
        return [x or self.lone_space for x in self.reference.encode([x[1:] for x in lines], num_threads=THREADS)]

    def encoder(self):
        """For ``units.Lookup``: words in lines, with a sign between them that is in no longer piece, so nothing joins across.

        Ids are the rebuilt tokenizer's; ``DIFFERS`` is set in the first id of a word to which the library gives others.
        """
        alone = not any(JOINER in p and p != JOINER for p in self.pieces)
        own = JOINER if JOINER in self.pieces else f"<0x{ord(JOINER):02X}>"
        mark = self.pieces.index(own) if alone and own in self.pieces else None
        mine, theirs = (units.joined(lines, JOINER, mark, 64) for lines in (self.encode_lines, self.reference_lines))

        def run(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids, sizes = mine(words)
            other, other_sizes = theirs(words)
            if not (np.array_equal(sizes, other_sizes) and np.array_equal(ids, other)):
                begin, other_begin = (np.cumsum(n) - n for n in (sizes, other_sizes))
                unlike = np.array([not np.array_equal(ids[a:a + n], other[b:b + m]) for a, n, b, m in zip(begin, sizes, other_begin, other_sizes)])
                ids[begin[unlike]] |= DIFFERS
            return ids, sizes

        return run

    @property
    def lone_space(self) -> list[int]:
        """Ids of a single space marker, which no text gives alone (the prefix comes with a word)."""
        if MARK in self.pieces:
            return [self.pieces.index(MARK)]
        return [self.pieces.index(f"<0x{b:02X}>") for b in MARK.encode()] if self.fallback else [self.unknown]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all pieces one after another, with spaces for markers, and where each begins."""
        parts = []
        for piece, kind in zip(self.pieces, self.kinds):
            parts.append(bytes([int(piece[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN
                         else piece.replace(MARK, " ").encode("utf-8"))
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_models: dict[int, PieceModel] = {}


def shared_model(raw: bytes) -> PieceModel:
    """One parsed model for each Python worker."""
    key = zlib.crc32(raw)
    if key not in _models:
        _models[key] = PieceModel(raw)
    return _models[key]


class Codec:
    """Encodes and decodes columns of texts."""

    def __init__(self, raw: bytes):
        self.model = shared_model(raw)
        self.lookup = units.Lookup(self.model.encoder())
        self.bytes, self.begin = self.model.table()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text's begin (one more at the end), and for how many words of each text the libraries differ
        (of a model that is not ``by_word``: 1 for a text whose ids differ)."""
        texts = pc.fill_null(texts, "")
        if not self.model.by_word:
            whole = texts.to_pylist()
            ids, theirs = self.model.encode(whole), self.model.reference.encode(whole, num_threads=THREADS)
            begin = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            return np.array([x for each in ids for x in each], np.uint32), begin, np.array([x != y for x, y in zip(ids, theirs)], np.int64)
        empty = pc.equal(pc.binary_length(texts), 0)
        led = pc.if_else(empty, texts, pc.binary_join_element_wise(" ", texts, ""))
        ids, begin = self.lookup.ids(units.marked(led))
        unlike = np.flatnonzero(ids >= DIFFERS)
        ids[unlike] -= DIFFERS
        return ids, begin, np.diff(np.searchsorted(unlike, begin))

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the texts, and where each begins: pieces one after another, without the space of the prefix."""
        sizes = self.begin[ids.astype(np.int64) + 1] - self.begin[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = self.bytes[ranges(self.begin[ids], sizes)]
        offsets = ends[begin]
        if self.model.prefix and len(out):
            led = offsets[:-1][np.diff(offsets) > 0]
            led = led[out[led] == 0x20]
            keep = np.ones(len(out), bool)
            keep[led] = False
            offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
            out = out[keep]
        return out, offsets


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers), ``n_bytes`` and
    ``round_trip`` of each row of ``docs`` (doc_id, text; other columns are ignored).

    ``round_trip``: whether decoding the ids gives the text back (a literal space marker in a text decodes as a space, as the
    model has it; the comparison counts it as equal). A null or empty text has no ids. A row gives a row; null ids stay
    null; an empty table gives no rows. ``n_differing`` is the number of the row's words, repeats counted, to which the
    sentencepiece library gives other ids; for models whose words cannot be encoded one by one it is 1 if the text's ids differ, else 0.
    """
    with open(model_path, "rb") as file:
        raw = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, of a size apart from the corpus

    def run(batches):
        codec = Codec(raw.value)
        for part in slices(batches, CHUNK):
            texts = pc.fill_null(part.column("text"), "")
            ids, begin, differing = codec.encode(texts)
            back = _texts(*codec.decode(ids, begin))
            same = pc.equal(back, pc.cast(pc.replace_substring(texts, MARK, " "), pa.large_string()))
            ids = ids.astype(np.int32)
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begin[:-1], begin[1:])]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(np.diff(begin)), pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids)),
                pa.array(crc, pa.int64()), pa.array(pc.binary_length(texts).cast(pa.int64())), same,
                pa.array(differing.astype(np.int64))],
                names=["doc_id", "n_tokens", "ids", "ids_crc32", "n_bytes", "round_trip", "n_differing"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, ids_crc32 long, n_bytes long, round_trip boolean, n_differing long")


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``text`` from rows of (doc_id, ids); null ids decode as an empty text."""
    with open(model_path, "rb") as file:
        raw = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        codec = Codec(raw.value)
        for part in batches:
            lists = part.column("ids")
            begin = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            ids = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _texts(*codec.decode(ids, begin)).cast(pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
