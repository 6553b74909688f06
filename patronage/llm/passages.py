"""Quality classifier: attention-based multiple-instance learning on passages.

A text is a bag of passages of ``PASSAGE`` words. Each passage is encoded (shares of byte classes, word shapes,
repeats, hashed words), a hidden layer makes its representation, gated attention weighs the passages of the bag, and a
logistic unit scores the weighted representation. Only the label of the whole document is known when it is trained.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.wordarrays import Words, blob, mix, slices, unblob

PASSAGE = 64
BUCKETS = 16
HIDDEN, ATTENTION = 16, 8
#: Labelled documents of each class that the model is fitted on, those with the least hash of the id.
SAMPLE_PER_CLASS = 1500
STEPS = 240
ACCEPT = 0.3

_UPPER, _LOWER, _DIGIT, _SYMBOL, _CALL, _STOP, _HIGH, _LINE = range(8)
CLASSES = np.zeros((8, 256), bool)
CLASSES[_UPPER, 65:91] = CLASSES[_LOWER, 97:123] = CLASSES[_DIGIT, 48:58] = CLASSES[_HIGH, 128:] = True
for _row, _members in ((_SYMBOL, b"#*$%&|<>"), (_CALL, b"!"), (_STOP, b".,;:?"), (_LINE, b"\n")):
    CLASSES[_row, list(_members)] = True
FEATURES = 8 + 11 + BUCKETS


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of all texts, and where each text's passages begin (one more at the end).

    A text without words, or null, has one passage that is all zero but for its mark.
    """
    w = Words(texts, lower=False)
    counts = w.counts
    made = np.maximum(1, -(-counts // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(made)])
    n = int(begin[-1])
    out = np.zeros((n, FEATURES), np.float32)
    empty = np.flatnonzero(counts == 0)
    out[begin[empty], 18] = 1
    if not len(w.hash):
        return out, begin
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(doc)) - w.first[doc]
    of = begin[doc] + place // PASSAGE
    heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    real = of[heads]
    words = np.diff(np.concatenate([heads, [len(of)]])).astype(np.float64)
    last = np.concatenate([heads[1:], [len(of)]]) - 1
    a, b = w.start[heads], w.end[last]
    size = (b - a).astype(np.float64)
    sums = np.zeros(len(w.data) + 1, np.int64)
    for c in range(8):
        np.cumsum(CLASSES[c][w.data], out=sums[1:])
        share = (sums[b] - sums[a]) / (words if c == _LINE else size)
        out[real, c] = share

    def per_word(values):
        return np.bincount(of, weights=values, minlength=n)[real] / words

    first, final = w.data[w.start], w.data[w.end - 1]
    second = w.data[np.minimum(w.start + 1, w.end - 1)]
    long = w.end - w.start > 1
    again = np.zeros(len(of), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
    three = np.zeros(len(of), np.uint64)
    three[:-2] = mix(w.hash[:-2] + mix(w.hash[1:-1]) * np.uint64(3) + mix(w.hash[2:]) * np.uint64(7) + mix(doc[:-2].astype(np.uint64)))
    whole = np.zeros(len(of), bool)
    whole[:-2] = doc[2:] == doc[:-2]
    order = np.argsort(three)
    ordered = three[order]
    equal = np.concatenate([[False], (ordered[1:] == ordered[:-1])])
    twice = np.zeros(len(of), bool)
    twice[order] = equal | np.concatenate([equal[1:], [False]])
    twice &= whole
    key = mix(w.hash + mix(of.astype(np.uint64)))
    order = np.argsort(key)
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    distinct = np.bincount(of[order[new]], minlength=n)[real] / words
    for at, values in enumerate((
        per_word(w.end - w.start) / 10, per_word(again), distinct, per_word(twice), per_word(CLASSES[_UPPER][first]),
        per_word(long & CLASSES[_UPPER][first] & CLASSES[_UPPER][second]), per_word(CLASSES[_SYMBOL][final]), per_word(~long),
        per_word(~long & CLASSES[_SYMBOL][first]), np.log(words) / 4,
    ), 8):
        out[real, at] = values
    bucket = (w.hash % np.uint64(BUCKETS)).astype(np.int64)
    hashed = np.bincount(of * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    out[real, 19:] = hashed[real] / words[:, None]
    return out, begin


class Model:
    """Weights by name; ``forward`` gives scores of bags and the attention of their passages."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @staticmethod
    def fresh(seed: int = 7) -> Model:
        r = np.random.default_rng(seed)
        scaled = lambda *shape: r.normal(0, shape[0] ** -0.5, shape)
        return Model({"W": scaled(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": scaled(HIDDEN, ATTENTION), "U": scaled(HIDDEN, ATTENTION),
                      "w": scaled(ATTENTION), "c": scaled(HIDDEN), "d": np.zeros(1)})

    def forward(self, x: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        bag = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        x = (x - p["mean"]) / p["scale"]
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, begin[:-1])[bag])
        a = e / np.add.reduceat(e, begin[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, begin[:-1], axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "y": y}

    def fit(self, x: np.ndarray, begin: np.ndarray, label: np.ndarray, steps: int = STEPS, rate: float = 0.02, decay: float = 1e-3) -> Model:
        """Adam on the log-loss, classes weighed alike; the same input gives the same weights."""
        p = self.weights
        p["mean"], p["scale"] = x.mean(0), x.std(0) + 1e-2
        share = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
        names = ["W", "b", "V", "U", "w", "c", "d"]
        m = {k: np.zeros_like(p[k]) for k in names}
        v = {k: np.zeros_like(p[k]) for k in names}
        for step in range(1, steps + 1):
            f = self.forward(x, begin)
            h, t, s, a, bag = f["h"], f["t"], f["s"], f["a"], f["bag"]
            dy = share * (f["y"] - label)
            dz = dy[:, None] * p["c"]
            da = (h * dz[bag]).sum(1)
            de = a * (da - np.add.reduceat(a * da, begin[:-1])[bag])
            dts = de[:, None] * p["w"]
            dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
            dh = a[:, None] * dz[bag] + dt @ p["V"].T + ds @ p["U"].T
            dpre = dh * (1 - h * h)
            g = {"W": f["x"].T @ dpre + decay * p["W"], "b": dpre.sum(0), "V": h.T @ dt + decay * p["V"], "U": h.T @ ds + decay * p["U"],
                 "w": (t * s).T @ de + decay * p["w"], "c": f["z"].T @ dy + decay * p["c"], "d": np.array([dy.sum()])}
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        return np.round(self.forward(*encode(texts))["y"].astype(np.float64), 9)


class Constant:
    """Stands in where the labels hold one class only, or none."""

    def __init__(self, value: float):
        self.value = value

    def score(self, texts: pa.Array) -> np.ndarray:
        return np.full(len(texts), self.value)


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of documents outside the held-out fifth whose labels are 0 or 1 and agree."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("quality IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 5 <> 0")
    return known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other").drop("other")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, steps: int = STEPS) -> Model | Constant:
    """Fit on at most ``per_class`` labelled documents of each class, by least hash of the id; whole texts.

    The sample's passages meet in one task, which returns the weights. Documents with a null id are not used; of rows
    that repeat an id one is used. If a class is missing, the result scores every text alike: 1 or 0 for the
    class that is there, 0.5 if there is none.
    """
    known = training_labels(labels)
    chosen = None
    for quality in (0, 1):
        part = known.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    chosen = F.broadcast(chosen.withColumnRenamed("doc_id", "label_id"))  # at most 2 * per_class rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(chosen, F.col("doc_id") == F.col("label_id")).select("doc_id", "quality", "text")

    def passages(batches):
        for part in slices(batches):
            x, begin = encode(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array([blob(x[a:b], np.float32) for a, b in zip(begin[:-1], begin[1:])], pa.binary())],
                                             names=["doc_id", "quality", "x"])

    def train(batches):
        rows = {}
        for batch in batches:
            for i, q, x in zip(*(c.to_pylist() for c in batch.columns)):
                rows[i] = min(rows.get(i, (q, x)), (q, x))
        label = np.array([rows[i][0] for i in sorted(rows)], np.float64)
        if len(set(label)) < 2:
            found = {"constant": np.array([label[0] if len(label) else 0.5])}
        else:
            bags = [unblob(rows[i][1], np.float32).reshape(-1, FEATURES) for i in sorted(rows)]
            begin = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
            found = Model.fresh().fit(np.concatenate(bags).astype(np.float64), begin, label, steps).weights
        yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([list(v.shape) for v in found.values()], pa.list_(pa.int64())),
                                          pa.array([blob(v, np.float64) for v in found.values()])], names=["name", "shape", "value"])

    encoded = sample.mapInArrow(passages, "doc_id long, quality int, x binary")
    rows = encoded.repartition(1).mapInArrow(train, "name string, shape array<long>, value binary").collect()
    weights = {r["name"]: unblob(bytes(r["value"]), np.float64).reshape(r["shape"]) for r in rows}
    return Constant(float(weights["constant"][0])) if "constant" in weights or not weights else Model(weights)


def scores(docs: DataFrame, model: Model | Constant, accept: float = ACCEPT) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs`` (doc_id, text; other columns are ignored).

    Null and empty texts get the score of an empty passage. A row gives a row, repeated or not; a null doc_id
    stays null and is not held out. An empty table gives no rows.
    """
    def run(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(part.column("text")))], names=["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return found.selectExpr("doc_id", "coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, false) AS held_out", "score",
                            f"CAST(score >= {accept}D AS INT) AS predicted")


def accepted(docs: DataFrame, model: Model | Constant, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose text is accepted, with all their columns; texts are not shuffled.

    Null and empty texts are judged as an empty passage. A row depends on its text alone, so rows that repeat a text stay or go together;
    null ids stay null, an empty table stays empty, and other columns are carried along whatever their names.
    """
    def run(batches):
        for part in slices(batches):
            yield part.filter(pa.array(model.score(part.column("text")) >= accept))

    return docs.mapInArrow(run, docs.schema)
