"""Quality by attention over passages, learned from document labels.

A document is a bag of passages of 64 words, all of its text. Every passage is encoded into shares of character
classes, repetition and word shapes, and by a hidden layer; gated attention weighs the passages, and the weighted
passage representation is scored. Only whole documents have labels; the attention weights are learned from them.

The network is fitted on a bounded sample of labelled documents (``sample``, 4096; evenly spaced passages beyond
``bag`` of one document, 256). Scoring reads every passage of every text. A null or empty text is one passage
of zeros. Without labels of both kinds each score is the share of ones among them, or 0.5. Rows without an id
are scored and never learned from; repeated rows give repeated rows; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import fold_of, labelled_sample, map_texts, texts_of

WORDS = 64
FEATURES = 13
SAMPLE, BAG = 4096, 256
HIDDEN, GATE, STEPS, RATE, DECAY = 16, 8, 400, 0.02, 1e-4
SPACE, DIGIT, UPPER, MARK, SYMBOL, HIGH, LOWER = range(7)


def byte_classes() -> np.ndarray:
    kinds = np.full(256, SYMBOL, np.uint8)
    kinds[128:] = HIGH
    for chars, kind in ((b" \t\n\r\x0b\x0c", SPACE), (b"0123456789", DIGIT), (b".,;:!?'\"-()", MARK), (bytes(range(65, 91)), UPPER), (bytes(range(97, 123)), LOWER)):
        kinds[list(chars)] = kind
    return kinds


CLASSES = byte_classes()


def encode(text: str) -> np.ndarray:
    """A row of features for each passage of 64 words."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = CLASSES[data]
    inside = kinds != SPACE
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(starts):
        return np.zeros((1, FEATURES))
    ends = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False])))
    lengths = ends - starts + 1
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))[: len(data)] if not starts[0] else np.arange(len(data)) - np.concatenate((np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, len(data))))))
    weights = (data.astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))
    words = np.add.reduceat(np.where(inside, weights ^ (weights >> np.uint64(17)), np.uint64(0)), starts)
    first = np.arange(0, len(starts), WORDS)
    count = np.diff(np.append(first, len(starts))).astype(float)
    passage = np.arange(len(starts)) // WORDS
    cuts = starts[first]
    per = [np.add.reduceat((kinds == k).astype(np.int32), cuts) for k in (DIGIT, UPPER, MARK, SYMBOL, HIGH)]
    lines = np.add.reduceat((data == 10).astype(np.int32), cuts)
    letters = np.add.reduceat(lengths, first).astype(float)
    again = np.add.reduceat(np.concatenate(([0], (words[1:] == words[:-1]) & (passage[1:] == passage[:-1]))).astype(np.int32), first)
    order = np.lexsort((words, passage))
    fresh = np.concatenate(([True], (words[order][1:] != words[order][:-1]) | (passage[order][1:] != passage[order][:-1])))
    distinct = np.bincount(passage[order][fresh], minlength=len(first))
    symbol_end = np.add.reduceat((kinds[ends] == SYMBOL).astype(np.int32), first)
    alone = np.add.reduceat(((lengths == 1) & (kinds[starts] == SYMBOL)).astype(np.int32), first)
    short = np.add.reduceat((lengths <= 3).astype(np.int32), first)
    columns = [letters / count / 10, *(p / letters for p in per), lines / count, again / count, distinct / count, symbol_end / count, alone / count, short / count, np.log1p(count) / 5]
    return np.stack(columns, 1)


class Attention:
    """Gated attention over encoded passages: h = tanh(Wx), a = softmax(g . (tanh(Vh) * sigmoid(Uh))), score = c . sum(a h)."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        shapes = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "g": (GATE,), "c": (HIDDEN,), "d": (1,)}
        self.p = {k: rng.normal(0, 0.3, s) for k, s in shapes.items()}
        self.mean, self.std, self.constant = np.zeros(FEATURES), np.ones(FEATURES), None

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        p = self.p
        x = (x - self.mean) / self.std
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        e = (t * s) @ p["g"]
        sizes = np.diff(np.append(starts, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "y": y, "sizes": sizes}

    def fit(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> Attention:
        if not len(labels) or labels.min() == labels.max():
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        p, m, v = self.p, {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}
        for step in range(1, STEPS + 1):
            f = self.forward(x, starts)
            dy = (f["y"] - labels) / len(labels)
            dz = np.repeat(dy[:, None] * p["c"], f["sizes"], axis=0)
            da = (dz * f["h"]).sum(1)
            de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), f["sizes"]))
            dgate = de[:, None] * p["g"]
            dv, du = dgate * f["s"] * (1 - f["t"] ** 2), dgate * f["t"] * f["s"] * (1 - f["s"])
            dh = (f["a"][:, None] * dz + dv @ p["V"].T + du @ p["U"].T) * (1 - f["h"] ** 2)
            grads = {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du, "g": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}
            for k, grad in grads.items():
                grad = grad + DECAY * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad**2
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out = []
        for text in texts:
            out.append(self.forward(encode(text), np.zeros(1, np.int64))["y"][0])
        return np.array(out, float)


def spaced(x: np.ndarray, most: int) -> np.ndarray:
    return x if len(x) <= most else x[np.linspace(0, len(x) - 1, most).astype(int)]


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, bag: int = BAG) -> Attention:
    """The network, fitted on a bounded sample outside the held-out fold; only encoded passages reach the driver."""
    rows = labelled_sample(docs, labels, label, sample)
    encoded = map_texts(rows, "doc_id long, label int, x binary", lambda: lambda texts: [[spaced(encode(t), bag).tobytes() for t in texts]], carry=2)
    bags = sorted((r.doc_id, r.label, bytes(r.x)) for r in encoded.toLocalIterator())
    if not bags:
        return Attention().fit(np.zeros((0, FEATURES)), np.zeros(0, int), np.zeros(0))
    parts = [np.frombuffer(x).reshape(-1, FEATURES) for _, _, x in bags]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in parts])[:-1]))
    return Attention().fit(np.concatenate(parts), starts, np.array([y for _, y, _ in bags], float))


def score_quality(docs: DataFrame, model: Attention, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row."""
    rows = texts_of(docs, id_col, text_col).select("doc_id", (fold_of() == 0).alias("held_out"), "text")
    scored = map_texts(rows, "doc_id long, held_out boolean, score double", lambda: lambda texts: [model.score(texts)], carry=2)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, model: Attention, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns; only the texts travel to Python, and scores back."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.to_list()))

    return plain.where(score(F.coalesce(f"c{names.index(text_col)}", F.lit(""))) >= threshold).toDF(*names)
