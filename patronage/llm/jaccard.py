"""Documents that share most of their word n-grams: an exact self-join on Jaccard similarity by signature trees.

Steps, all on distinct shingle sets (equal texts are one set, known by its signature):

1. Tasks turn texts into shingle hashes and deal them out by hash in packed arrays. A shingle that occurs in one
   set only cannot be shared; the others go back to their sets with the number of sets that hold them.
2. A set whose shared shingles are fewer than the threshold's share of its size links with nothing. The others are
   linked through the rarest shingles of which two similar sets must share one (prefix filter). The components of
   these candidate links are blocks: sets in different blocks cannot be similar.
3. In a block, a signature tree (nodes hold OR-combined token bitmaps and size ranges) is walked against itself;
   a pair of nodes goes on only if its largest possible overlap reaches the threshold and its sets are not all
   connected yet. Pairs of sets are verified exactly.
4. Blocks over ``block_tokens`` (a set counts SET_TOKENS beside its shingles) are first thinned by pivots: what links to the pivot is one component, and by the
   triangle inequality only sets in the ring of similarity >= 2t - 1 can still link into it. What remains large is cut
   into leaves of bounded size, of which only the pairs that pass the node test are compared.

Only connectivity is asked for, so pairs inside a component are not listed.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.components import components
from patronage.llm.wordarrays import Words, blob, mix, slices, unblob
from patronage.sources.storage import materialise

THRESHOLD = Fraction(3, 4)
BITS = 4096
LEAF = 8
FAN = 8
BLOCK_TOKENS = 4_000_000
PIVOT_ROUNDS = 4
#: What a set costs in a block beside its shingles, in shingles: its bitmap, and as much for the objects around it.
SET_TOKENS = 2 * BITS // 64
#: Bytes of text whose shingles a shard answers for; a task holds one shard at a time.
SHARD_BYTES = 16 << 20
SLICE_SETS = 4096
FLUSH = 2_000_000


# ---------------------------------------------------------------- shingles out to their owners, and back

def signature(tokens: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))]))[0].astype(np.int64))


def _deal(shards: int, k: int):
    """Packed (set, shingle) pairs by shard of the shingle; rows with ``doc`` carry (doc_id, set, size) instead."""
    schema = pa.schema([("to", pa.int32()), ("key", pa.binary()), ("count", pa.binary()), ("token", pa.binary()), ("doc", pa.binary())])

    def packed(keys, tokens):
        sizes = np.array([len(t) for t in tokens])
        key = np.repeat(np.array(keys, np.int64), sizes)
        token = np.concatenate(tokens)
        shard = (token % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        key, token = key[order], token[order]
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        rows = []
        for s in range(shards):
            a, b = cut[s], cut[s + 1]
            if a < b:
                heads = np.concatenate([[0], np.flatnonzero(np.diff(key[a:b])) + 1])
                counts = np.diff(np.concatenate([heads, [b - a]]))
                rows.append((s, blob(key[a:b][heads], np.int64), blob(counts, np.int32), blob(token[a:b]), None))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches):
        seen: set[int] = set()
        keys, tokens, held = [], [], 0
        at = 0
        for part in slices(batches):
            windows, begin = Words(part.column("text")).windows(k)
            info = np.zeros((part.num_rows, 3), np.int64)
            present = np.ones(part.num_rows, bool)
            ids = part.column("doc_id")
            info[:, 0] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            if ids.null_count:
                present = ids.is_valid().to_numpy(zero_copy_only=False)
            for i in range(part.num_rows):
                own = np.unique(windows[begin[i]:begin[i + 1]])
                info[i, 2] = len(own) if present[i] else -1 - len(own)
                if len(own):
                    info[i, 1] = key = signature(own)
                    if key not in seen:
                        seen.add(key)
                        keys.append(key)
                        tokens.append(own)
                        held += len(own)
            at += 1
            where = int(mix(info[:1, 0].astype(np.uint64))[0] % np.uint64(shards)) if len(info) else 0
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((where, None, None, None, blob(info, np.int64)), schema.types)], schema=schema)
            if held >= FLUSH:
                yield packed(keys, tokens)
                keys, tokens, held = [], [], 0
        if held:
            yield packed(keys, tokens)

    return run


def _shared(homes: int):
    """Of the shingles of one shard: (set, shingle, number of sets) of those in two sets or more, by home of the set."""
    schema = pa.schema([("to", pa.int32()), ("key", pa.binary()), ("count", pa.binary()), ("token", pa.binary()), ("doc", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in ("key", "count", "token", "doc")}
        docs = [d for d in columns["doc"] if d]
        key = np.concatenate([np.zeros(0, np.int64), *[np.repeat(unblob(a, np.int64), unblob(c, np.int32)) for a, c in zip(columns["key"], columns["count"]) if a]])
        token = np.concatenate([np.zeros(0, np.uint64), *[unblob(t) for t in columns["token"] if t]])
        rows = [(0, None, None, None, d) for d in docs]
        order = np.lexsort((key, token)) if len(token) else np.zeros(0, np.int64)
        key, token = key[order], token[order]
        new = np.ones(len(token), bool)  # a set that several tasks met counts once
        new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        key, token = key[new], token[new]
        head = np.concatenate([np.zeros(0, np.int64), np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))]) if len(token) else np.zeros(0, np.int64)
        sets = np.diff(np.concatenate([head, [len(token)]])).astype(np.int64)
        count = np.repeat(sets, sets)
        keep = count > 1
        key, token, count = key[keep], token[keep], count[keep]
        to = (mix(key.astype(np.uint64)) % np.uint64(homes)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        key, token, count, to = key[order], token[order], count[order], to[order]
        cut = np.searchsorted(to, np.arange(homes + 1))
        for s in np.flatnonzero(np.diff(cut)):
            a, b = cut[s], cut[s + 1]
            rows.append((int(s), blob(key[a:b], np.int64), blob(np.minimum(count[a:b], 2**31 - 1), np.int32), blob(token[a:b]), None))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types], schema=schema)

    return run


def _gather(table: pa.Table) -> pa.Table:
    """One row for each set of this home: its shared shingles in order, and in how many sets each occurs."""
    key = np.concatenate([unblob(v, np.int64) for v in table.column("key").to_pylist()])
    token = np.concatenate([unblob(v) for v in table.column("token").to_pylist()])
    count = np.concatenate([unblob(v, np.int32) for v in table.column("count").to_pylist()])
    order = np.lexsort((token, key))
    key, token, count = key[order], token[order], count[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    rows = [(int(key[a]), blob(token[a:b]), blob(count[a:b], np.int32)) for a, b in zip(cut[:-1], cut[1:])]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], names=["set", "token", "count"])


# ---------------------------------------------------------------- tests on sizes

def enough(a, b, both, t: Fraction = THRESHOLD):
    """Whether sets of sizes a and b with ``both`` members in common reach the threshold."""
    return t.denominator * both >= t.numerator * (a + b - both)


def least_overlap(a: int, b: int, t: Fraction = THRESHOLD) -> int:
    """The smallest overlap that reaches the threshold."""
    return -(-t.numerator * (a + b) // (t.numerator + t.denominator))


# ---------------------------------------------------------------- signature trees

class Tree:
    """Sets ordered by size and by their least bit, leaves of LEAF sets, inner nodes of FAN nodes.

    A node holds the OR of its sets' bitmaps, its range of sizes, and the most members of a set that its own bitmap
    does not show (several on one bit). Two sets share at most the common bits plus that loss.
    """

    def __init__(self, sizes: np.ndarray, tokens: list[np.ndarray]):
        self.sizes, self.tokens = np.asarray(sizes, np.int64), tokens
        n = len(tokens)
        self.bits = np.zeros((n, BITS // 64), np.uint64)
        for a in range(0, n, SLICE_SETS):
            bits = np.zeros((min(SLICE_SETS, n - a), BITS), bool)
            for i, t in enumerate(tokens[a:a + SLICE_SETS]):
                bits[i, (t % np.uint64(BITS)).astype(np.int64)] = True
            self.bits[a:a + SLICE_SETS] = np.packbits(bits, axis=1).view(np.uint64)
        self.held = np.array([len(t) for t in tokens], np.int64)
        self.lost = self.held - popcount(self.bits)
        self.order = np.lexsort((np.array([int(t[0]) if len(t) else 0 for t in tokens], np.uint64), self.sizes))
        self.levels = []
        cuts = np.append(np.arange(0, n, LEAF), n) if n else np.array([0])
        while len(cuts) > 1:
            first = cuts[:-1]
            rank = self.order
            self.levels.append({
                "cut": cuts,
                "bits": np.bitwise_or.reduceat(self.bits[rank], first, axis=0),
                "low": np.minimum.reduceat(self.sizes[rank], first), "high": np.maximum.reduceat(self.sizes[rank], first),
                "held": np.maximum.reduceat(self.held[rank], first), "lost": np.maximum.reduceat(self.lost[rank], first),
            })
            if len(cuts) == 2:
                break
            cuts = np.append(cuts[:-1:FAN], n)

    def members(self, level: int, node: int) -> np.ndarray:
        cut = self.levels[level]["cut"]
        return self.order[cut[node]:cut[node + 1]]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def joined(a: Tree, b: Tree, labels_a: np.ndarray, labels_b: np.ndarray, union, t: Fraction = THRESHOLD) -> int:
    """Walk two trees (or one against itself), call ``union(i, j)`` for linked sets; the number of sets compared."""
    compared = 0
    if not a.levels or not b.levels:
        return 0
    same = a is b
    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, na, lb, nb = todo.pop()
        A, B = a.levels[la], b.levels[lb]
        low_a, low_b = int(A["low"][na]), int(B["low"][nb])
        if t.numerator * low_a > t.denominator * B["high"][nb] or t.numerator * low_b > t.denominator * A["high"][na]:
            continue
        if not (same and la == lb and na == nb):
            most = min(int(A["held"][na]), int(B["held"][nb]), int(popcount(A["bits"][na] & B["bits"][nb])) + min(int(A["lost"][na]), int(B["lost"][nb])))
            if most < least_overlap(low_a, low_b, t):
                continue
        rows_a, rows_b = a.members(la, na), b.members(lb, nb)
        one = labels_a[rows_a[0]]
        if (labels_a[rows_a] == one).all() and (labels_b[rows_b] == one).all():
            continue
        if la or lb:
            down_a = la >= lb and la > 0
            if same and la == lb and na == nb:
                kids = range(na * FAN, min((na + 1) * FAN, len(a.levels[la - 1]["cut"]) - 1))
                todo += [(la - 1, x, la - 1, y) for x in kids for y in kids if x < y]
                todo += [(la - 1, x, la - 1, x) for x in kids]
            elif down_a:
                todo += [(la - 1, x, lb, nb) for x in range(na * FAN, min((na + 1) * FAN, len(a.levels[la - 1]["cut"]) - 1))]
            else:
                todo += [(la, na, lb - 1, y) for y in range(nb * FAN, min((nb + 1) * FAN, len(b.levels[lb - 1]["cut"]) - 1))]
            continue
        for place, i in enumerate(rows_a):
            others = rows_b[place + 1:] if same and na == nb else rows_b
            others = others[labels_b[others] != labels_a[i]]
            if not len(others):
                continue
            need = -(-t.numerator * (a.sizes[i] + b.sizes[others]) // (t.numerator + t.denominator))
            most = popcount(b.bits[others] & a.bits[i]) + np.minimum(b.lost[others], a.lost[i])
            for j in others[most >= need]:
                if labels_a[i] == labels_b[j]:
                    continue
                compared += 1
                if enough(int(a.sizes[i]), int(b.sizes[j]), common(a.tokens[i], b.tokens[j]), t):
                    union(i, j)
    return compared


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ordered arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def linked(sizes, tokens, t: Fraction = THRESHOLD) -> np.ndarray:
    """For each set of a block, the first set it is connected with."""
    n = len(tokens)
    labels = np.arange(n)
    groups = {i: [i] for i in range(n)}
    tree = Tree(sizes, tokens)

    def union(i, j):
        x, y = labels[i], labels[j]
        if x == y:
            return
        if len(groups[x]) < len(groups[y]):
            x, y = y, x
        labels[groups[y]] = x
        groups[x] += groups.pop(y)

    joined(tree, tree, labels, labels, union, t)
    return labels


# ---------------------------------------------------------------- blocks

def _solve_blocks(t: Fraction):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in pdf.groupby("block", sort=False):
            keys = block["set"].to_numpy()
            labels = linked(block["n"].to_numpy(), [unblob(v) for v in block["token"]], t)
            other = keys[labels]
            for label in np.unique(labels):
                mine = labels == label
                other[mine] = keys[mine].min()
            out.append(pd.DataFrame({"a": keys, "b": other})[keys != other])
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}).astype("int64")

    return run


def _pivot_overlap(column_a, column_b):
    @F.pandas_udf("long")
    def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([common(unblob(x), unblob(y)) for x, y in zip(a, b)], dtype="int64")

    return overlap(column_a, column_b)


def _leaves(sets: DataFrame, leaf_tokens: int) -> DataFrame:
    """Cut each block into leaves of neighbouring sizes and about ``leaf_tokens`` tokens, SET_TOKENS a set included."""
    band = F.floor(F.log(F.col("n")) * 8)
    weight = sets.withColumn("band", band).groupBy("block", "band").agg(F.ceil(F.sum(F.expr(f"octet_length(token) div 8 + {SET_TOKENS}")) / leaf_tokens).alias("cuts"))
    return (sets.withColumn("band", band).join(weight, ["block", "band"])
            .withColumn("leaf", F.xxhash64("block", "band", F.expr("pmod(xxhash64(set, 7), cuts)"), "side")))


def _summaries(leaves: DataFrame) -> DataFrame:
    """OR bitmap, size range and loss of each leaf: the upper nodes of the trees."""
    def run(table: pa.Table) -> pa.Table:
        bits, lost, held = np.zeros(BITS, bool), 0, 0
        for v in table.column("token").to_pylist():
            own = np.unique((unblob(v) % np.uint64(BITS)).astype(np.int64))
            bits[own] = True
            lost, held = max(lost, len(v) // 8 - len(own)), max(held, len(v) // 8)
        sizes = table.column("n").to_numpy()
        row = (table.column("leaf")[0].as_py(), table.column("block")[0].as_py(), table.column("side")[0].as_py(), np.packbits(bits).tobytes(),
               int(sizes.min()), int(sizes.max()), held, lost)
        return pa.Table.from_arrays([pa.array([v]) for v in row], names=["leaf", "block", "side", "bits", "low", "high", "held", "lost"])

    return leaves.groupBy("leaf").applyInArrow(run, "leaf long, block long, side long, bits binary, low long, high long, held long, lost long")


def _leaf_pairs(left: DataFrame, right: DataFrame, t: Fraction, leaf_tokens: int) -> DataFrame:
    """Links (a, b) between the sets of ``left`` and ``right`` in a block, by pairs of leaves that pass the node test.

    A set may be on both sides; then each pair is met from either side, which is harmless.
    """
    leaves = materialise(_leaves(left.withColumn("side", F.lit(0).cast("long")).union(right.withColumn("side", F.lit(1).cast("long"))), leaf_tokens), "leaves")
    nodes = _summaries(leaves)

    @F.pandas_udf("boolean")
    def may(bits_a: pd.Series, bits_b: pd.Series, lost_a: pd.Series, lost_b: pd.Series, held: pd.Series, low: pd.Series) -> pd.Series:
        shared = [int(popcount(unblob(x) & unblob(y))) for x, y in zip(bits_a, bits_b)]
        return pd.Series(np.minimum(np.array(shared) + np.minimum(lost_a, lost_b), held) >= -(-t.numerator * low // (t.numerator + t.denominator)))

    a = nodes.filter("side = 0").selectExpr("block", "leaf AS leaf_a", "bits AS bits_a", "low AS low_a", "high AS high_a", "held AS held_a", "lost AS lost_a")
    b = nodes.filter("side = 1").selectExpr("block", "leaf AS leaf_b", "bits AS bits_b", "low AS low_b", "high AS high_b", "held AS held_b", "lost AS lost_b")
    pairs = (a.join(b, "block").filter(f"{t.numerator} * low_a <= {t.denominator} * high_b AND {t.numerator} * low_b <= {t.denominator} * high_a")
             .filter(may("bits_a", "bits_b", "lost_a", "lost_b", F.least("held_a", "held_b"), F.expr("low_a + low_b")))
             .select("leaf_a", "leaf_b", F.xxhash64("leaf_a", "leaf_b").alias("pair")))
    ends = pairs.selectExpr("pair", "leaf_a AS leaf").union(pairs.selectExpr("pair", "leaf_b AS leaf"))

    def run(table: pa.Table) -> pa.Table:
        sides = table.column("side").to_numpy()
        keys, sizes = table.column("set").to_numpy(), table.column("n").to_numpy()
        tokens = [unblob(v) for v in table.column("token").to_pylist()]
        places = [np.flatnonzero(sides == s) for s in (0, 1)]
        trees = [Tree(sizes[p], [tokens[i] for i in p]) for p in places]
        names = {k: i for i, k in enumerate(np.unique(keys))}
        label = np.arange(len(names))
        of = [np.array([names[k] for k in keys[p]], np.int64) for p in places]
        views = [label[o] for o in of]
        found = []

        def union(i, j):
            x, y = views[0][i], views[1][j]
            found.append((int(keys[places[0][i]]), int(keys[places[1][j]])))
            for v in views:
                v[v == y] = x

        joined(trees[0], trees[1], views[0], views[1], union, t)
        return pa.Table.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return leaves.join(ends, "leaf").groupBy("pair").applyInArrow(run, "a long, b long")


def _large_blocks(sets: DataFrame, t: Fraction, block_tokens: int, rounds: int) -> list[DataFrame]:
    """Links of blocks too large for one task: pivots thin them, leaf pairs do what remains."""
    found = []
    columns = ["set", "n", "token", "block"]
    ring_least = 2 * t - 1
    for _ in range(rounds):
        pivots = sets.groupBy("block").agg(F.min_by(F.struct("set", "n", "token"), F.xxhash64("set", F.lit(11))).alias("p"))
        near = sets.join(pivots, "block").withColumn("both", _pivot_overlap(F.col("token"), F.col("p.token")))
        over = lambda x: F.expr(f"{x.denominator} * both >= {x.numerator} * (n + p.n - both)")
        near = materialise(near.select(*columns, F.col("p.set").alias("pivot"), over(t).alias("ball"), over(ring_least).alias("ring")), "near")
        found.append(near.filter("ball AND set <> pivot").selectExpr("set AS a", "pivot AS b"))
        ball, rest = near.filter("ball").select(*columns), near.filter("NOT ball").select(*columns)
        ring = near.filter("ring AND NOT ball").select(*columns)
        if ring.head(1):
            found.append(_leaf_pairs(ring, ball, t, block_tokens // 16))
        weights = rest.groupBy("block").agg(F.sum(F.expr(f"octet_length(token) div 8 + {SET_TOKENS}")).alias("w"))
        sets = rest.join(weights, "block").select(*columns, "w")
        small = sets.filter(F.col("w") <= block_tokens).select(*columns)
        found.append(small.groupBy(F.expr("block")).applyInPandas(_solve_blocks(t), "a long, b long"))
        sets = materialise(sets.filter(F.col("w") > block_tokens).select(*columns), "large")
        if not sets.head(1):
            return found
    return [*found, _leaf_pairs(sets, sets, t, block_tokens // 16)]


# ---------------------------------------------------------------- the join

def near_duplicates(docs: DataFrame, k: int = 5, threshold: Fraction = THRESHOLD, block_tokens: int = BLOCK_TOKENS,
                    pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs`` (doc_id, text; more columns are ignored).

    Null or wordless texts have no shingles and are their own component. Rows that repeat a doc_id are compared as they
    are and each gives a row; a null doc_id stays null, and a component whose ids are all null has a null id. Equal
    texts are one set, so a group of copies of any size costs one comparison. An empty table gives no rows. Sets are known by
    64-bit signatures: two different sets among a hundred million share one with a chance below 1 in 3,000.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES)
    shards = max(2 * partitions, counted)
    homes = max(partitions // 2 + 1, -(-counted // 4))  # every shard answers every home, in packed rows
    packed = "to int, key binary, count binary, token binary, doc binary"
    dealt = texts.mapInArrow(_deal(shards, k), packed)
    back = materialise(dealt.groupBy("to").applyInArrow(_shared(homes), packed), "shared")

    def infos(batches):
        for batch in batches:
            for value in batch.column("doc").to_pylist():
                info = unblob(value, np.int64).reshape(-1, 3)
                real = info[:, 2] >= 0
                yield pa.RecordBatch.from_arrays([pa.array(info[:, 0], mask=~real), pa.array(info[:, 1], mask=(info[:, 2] == 0) | (info[:, 2] == -1)),
                                                  pa.array(np.where(real, info[:, 2], -1 - info[:, 2]))], names=["doc_id", "set", "n"])

    rows = back.filter("doc IS NOT NULL").select("doc").mapInArrow(infos, "doc_id long, set long, n long")
    shared = back.filter("doc IS NULL").groupBy("to").applyInArrow(_gather, "set long, token binary, count binary")
    sets = materialise(rows.filter("set IS NOT NULL").groupBy("set").agg(F.first("n").alias("n"), F.min("doc_id").alias("least")), "sets")
    least = f"({threshold.numerator} * n + {threshold.denominator - 1}) div {threshold.denominator}"
    live = materialise(shared.join(sets.select("set", "n"), "set").filter(f"octet_length(token) div 8 >= {least}"), "live")

    def prefix(batches):
        for batch in batches:
            sets, found = [], []
            for key, n, token, count in zip(*(batch.column(c).to_pylist() for c in ("set", "n", "token", "count"))):
                tokens, counts = unblob(token), unblob(count, np.int32)
                long = n - math.ceil(threshold * n) + 1 - (n - len(tokens))
                if long > 0:
                    order = np.lexsort((tokens, counts))[:long]
                    found.append(tokens[order].astype(np.int64))
                    sets.append(np.full(len(order), key, np.int64))
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(sets))], names=["shingle", "set"])

    rare = live.select("set", "n", "token", "count").mapInArrow(prefix, "shingle long, set long")
    leaders = rare.groupBy("shingle").agg(F.min("set").alias("leader"), F.max("set").alias("last")).filter("leader < last")
    candidate = components(rare.join(leaders, "shingle").filter("set <> leader").selectExpr("set AS a", "leader AS b").distinct())
    blocks = live.select("set", "n", "token").join(candidate.selectExpr("node AS set", "root AS block"), "set")
    weights = blocks.groupBy("block").agg(F.sum(F.expr(f"octet_length(token) div 8 + {SET_TOKENS}")).alias("w"))
    blocks = materialise(blocks.join(weights, "block").select("set", "n", "token", "block", "w"), "blocks")
    small = blocks.filter(F.col("w") <= block_tokens).drop("w")
    links = small.groupBy(F.expr(f"pmod(xxhash64(block), {shards}L)")).applyInPandas(_solve_blocks(threshold), "a long, b long")
    large = blocks.filter(F.col("w") > block_tokens).drop("w")
    if large.head(1):
        for more in _large_blocks(materialise(large, "large"), threshold, block_tokens, pivot_rounds):
            links = links.union(more)
        links = components(links).filter("node <> root").selectExpr("node AS a", "root AS b")
    label = materialise(links, "links").selectExpr("a AS set", "b AS root")
    rooted = sets.join(label, "set", "left").selectExpr("set", "least", "coalesce(root, set) AS root")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(ids, "root").select("set", "component")
    return rows.join(named, "set", "left").selectExpr("doc_id", "n AS n_shingles", "CASE WHEN set IS NULL THEN doc_id ELSE component END AS component_id")


def one_of_each(docs: DataFrame, k: int = 5, threshold: Fraction = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id; all columns stay.

    Rows that repeat the doc_id that stays are the same document and stay. Rows with a null id stay.
    """
    groups = near_duplicates(docs, k, threshold)
    gone = groups.filter("component_id < doc_id").selectExpr("doc_id AS gone_id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
