"""Tokenizing by distinct units: spans of text that the tokenizer never merges across are encoded once and looked up."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from patronage.llm.wordarrays import BASE, BASE_INVERSE, BYTE, BYTE_LOWER, buffer, mix, powers, ranges

#: Distinct units that are remembered, about; beyond it, those that were not met again are forgotten, which costs time only.
REMEMBERED = 300_000
#: Units that are encoded at once.
BATCH = 16_384

#: Words of letters that normalisation leaves single letters, so that no tokenizer of words splits them.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

_POINT = np.zeros(256, bool)
_POINT[list(b".,;:!?")] = True


class Spans:
    """Units of a column: byte ranges, a 64-bit name each, and where each text's units begin (one more at the end)."""

    def __init__(self, data, start, end, name, first):
        self.data, self.start, self.end, self.name, self.first = data, start, end, name, first

    def texts(self, at: np.ndarray) -> list[str]:
        """The texts of some units, decoded together."""
        if not len(at):
            return []
        sizes = self.end[at] - self.start[at]
        ends = np.cumsum(sizes + 1)
        out = np.zeros(ends[-1], np.uint8)
        out[ranges(ends - sizes - 1, sizes)] = self.data[ranges(self.start[at], sizes)]
        found = out[:-1].tobytes().decode("utf-8").split("\0")
        if len(found) != len(at):  # a unit holds the separator
            return [self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8") for i in at]
        return found


def _letter(data: np.ndarray) -> np.ndarray:
    """Whether each byte is an ASCII letter; comparisons of bytes are faster than a table."""
    return (data | np.uint8(32)) - np.uint8(97) < 26


def _names(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    n = len(data)
    value = (BYTE_LOWER if fold else BYTE).take(data)
    apart = np.uint64(0)
    if fold:  # a word with a high byte or ``<`` keeps the case of its letters
        marks = np.zeros(n + 1, np.int64)
        np.cumsum((data >= 128) | (data == ord("<")), out=marks[1:])
        high = marks[end] > marks[start]
        upper = np.flatnonzero(data - np.uint8(65) < 26)
        upper = upper[high[np.searchsorted(start, upper, "right") - 1]]
        value[upper] = BYTE[data[upper]]
        apart = (~high).astype(np.uint64)
    value *= powers(BASE, n)[:n]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(BASE_INVERSE, n + 1)[start] + apart)


def words(texts: pa.Array) -> Spans:
    """Units for a tokenizer that lower-cases, drops white space and splits letters from signs: words, and the point or
    comma after an ASCII letter on its own. Plain ASCII words of another case share a name; words with other
    characters, or with ``<`` (special strings), keep theirs."""
    data, offsets = buffer(texts)
    n = len(data)
    gap = (data == 0x20) | (data - np.uint8(9) < 5)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    final = ~gap & (after | edge[1:])
    opening = ~gap & (before | edge[:-1])
    split = np.zeros(n, bool)
    split[1:] = final[1:] & _letter(data[:-1]) & ~opening[1:]
    split[split] = _POINT[data[split]]
    start = np.flatnonzero(opening | split)
    end = np.flatnonzero(final | np.append(split[1:], False)) + 1
    return Spans(data, start, end, _names(data, start, end, True), np.searchsorted(start, offsets))


def marked(texts: pa.Array) -> Spans:
    """Units for a tokenizer whose pieces hold the space marker at their beginning only: each begins with the spaces before a
    word. ``texts`` begin with the space of the dummy prefix, or are empty."""
    data, offsets = buffer(texts)
    n = len(data)
    space = data == 0x20
    cut = np.zeros(n, bool)
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    marker = np.zeros(n + 1, bool)  # after a literal marker a space belongs to the same run
    if n > 2:
        marker[3:] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    if n:
        cut[1:] |= space[1:] & ~space[:-1] & ~marker[1:n]
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n) if len(start) else start
    return Spans(data, start, end, _names(data, start, end, False), np.searchsorted(start, offsets))


def joined(encode: Callable[[list[str]], list[list[int]]], joiner: str, mark: int | None, per_line: int = 256):
    """An encoder of many units at once: units are joined to lines by a string that always gives the one id ``mark``.

    Returns all ids in order and the number of each unit. Units with that id of their own go alone.
    """
    def run(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if mark is not None:
            lines = [joiner.join(texts[i:i + per_line]) for i in range(0, len(texts), per_line)]
            ids = np.concatenate([np.append(np.asarray(x, np.uint32), np.uint32(mark)) for x in encode(lines)])
            at = np.flatnonzero(ids == mark)
            if len(at) == len(texts):
                return ids[ids != mark], np.diff(np.concatenate([[-1], at])) - 1
            if len(texts) > per_line:
                parts = [run(texts[i:i + per_line]) for i in range(0, len(texts), per_line)]
                return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
        each = [encode([t])[0] for t in texts]
        return np.array([x for ids in each for x in ids], np.uint32), np.array([len(x) for x in each], np.int64)

    return run


def by_ends(encode: Callable[[list[str]], list[list[int]]], final: np.ndarray, other: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], per_line: int = 256):
    """An encoder of many units at once, like ``joined``, for a tokenizer that marks the last piece of a word (``final``, by id).

    Plain words stand in lines with nothing but spaces between them, each up to its final piece. ``other`` encodes the rest, and all
    units if a line has not as many final pieces as words.
    """
    def run(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((PLAIN.fullmatch(t) is not None for t in texts), bool, len(texts))
        some = [t for t, own in zip(texts, plain.tolist()) if own]
        lines = [some[i:i + per_line] for i in range(0, len(some), per_line)]
        found = [np.asarray(x, np.uint32) for x in encode([" ".join(x) for x in lines])]
        if any(not len(ids) or not final[ids[-1]] or final[ids].sum() != len(line) for ids, line in zip(found, lines)):
            return other(texts)
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        sizes = np.zeros(len(texts), np.int64)
        sizes[plain] = np.diff(np.flatnonzero(final[ids]), prepend=-1)
        if plain.all():
            return ids, sizes
        rest, sizes[~plain] = other([t for t, own in zip(texts, plain.tolist()) if not own])
        own = np.repeat(plain, sizes)
        out = np.empty(len(own), np.uint32)
        out[own], out[~own] = ids, rest
        return out, sizes

    return run


class Lookup:
    """Ids of units: encodes those it has not met, and remembers them up to a limit."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = REMEMBERED):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.names, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ascending names, and the row of each
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)  # rows met in a later column than their first

    def make_room(self) -> None:
        """Forget the units that were not met again since room was made."""
        kept = np.flatnonzero(self.again)
        number = np.full(len(self.again), -1)
        number[kept] = np.arange(len(kept))
        place = number[self.place]
        self.names, self.place = self.names[place >= 0], place[place >= 0]
        sizes = np.diff(self.begin)[kept]
        self.flat = self.flat[ranges(self.begin[kept], sizes)]
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.again = np.zeros(len(kept), bool)

    def rows(self, spans: Spans) -> np.ndarray:
        """The remembered row of each unit."""
        if len(self.names) > self.limit:
            self.make_room()
        coded = pa.array(spans.name).dictionary_encode()
        each, name = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        order = np.argsort(name)
        name = name[order]
        spot = np.searchsorted(self.names, name)
        known = spot < len(self.names)
        known[known] = self.names[spot[known]] == name[known]
        row = np.zeros(len(name), np.int64)
        row[known] = self.place[spot[known]]
        self.again[row[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            at = np.zeros(len(name), np.int64)
            at[each] = np.arange(len(each))  # any unit of the name
            at = at[order[new]]
            found = [self.encode(spans.texts(at[i:i + BATCH])) for i in range(0, len(new), BATCH)]
            row[new] = len(self.begin) - 1 + np.arange(len(new))
            self.names, self.place = np.insert(self.names, spot[new], name[new]), np.insert(self.place, spot[new], row[new])
            self.flat = np.concatenate([self.flat, *(ids.astype(np.uint32) for ids, _ in found)])
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.concatenate([sizes for _, sizes in found]))])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        back = np.empty_like(row)
        back[order] = row
        return back[each]

    def ids(self, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's ids begin (one more at the end)."""
        row = self.rows(spans)
        sizes = self.begin[row + 1] - self.begin[row]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[ranges(self.begin[row], sizes)], ends[spans.first]

    def flat_of(self, spans: Spans) -> np.ndarray:
        """The single number that ``encode`` gave for each unit."""
        row = self.rows(spans)
        return self.flat[self.begin[row]].astype(np.int64)
