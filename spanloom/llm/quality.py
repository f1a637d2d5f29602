"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded
from counts of its own (case, digits, symbols, word lengths, repetition); a
gated attention, learned from document labels only, weighs the passages, and a
logistic layer scores the weighted representation.
Encoder, attention and scorer are trained together in numpy on a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, materialize, unit_hash

PASSAGE = 64
_SPACE, _UPPER, _LOWER, _DIGIT, _BANG, _STOP, _MARK, _HIGH, _LINE = range(9)
_CLASS = np.full(256, _MARK, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_CLASS[33], _CLASS[[46, 44, 58, 59, 63]] = _BANG, _STOP
FEATURES = 17


def passages(text: str) -> np.ndarray:
    """One row of ``FEATURES`` numbers for each passage; a text without words is one row of zeros."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kind = _CLASS[raw]
    word = kind != _SPACE
    start = np.flatnonzero(word & np.r_[True, ~word[:-1]]) if len(raw) else np.zeros(0, dtype=np.int64)
    if not len(start):
        return np.zeros((1, FEATURES), dtype=np.float32)
    end = np.flatnonzero(word & np.r_[~word[1:], True]) + 1
    n, first = len(start), np.arange(0, len(start), PASSAGE)
    size = np.diff(np.r_[first, n]).astype(np.float32)
    at = start[first]

    def share(mask: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask[at[0] :].astype(np.int32), at - at[0]) / total

    letters = np.maximum(1, np.add.reduceat(word[at[0] :].astype(np.int32), at - at[0])).astype(np.float32)
    length = (end - start).astype(np.float32)
    by = lambda x: np.add.reduceat(x.astype(np.float32), first) / size
    # a number per word from its bytes and their places: equal words have equal numbers
    place = np.arange(len(raw)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(raw)]))
    total = np.cumsum(np.r_[np.uint64(0), (raw.astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(3)) ** np.uint64(5)])
    code = (total[end] - total[start]) * np.uint64(0x9E3779B97F4A7C15)
    same_as_last = np.r_[False, code[1:] == code[:-1]]
    pair = code * np.uint64(31) + np.r_[code[1:], np.uint64(0)]
    _, back, times = np.unique(pair, return_inverse=True, return_counts=True)
    often = times[back] > 1
    _, back, times = np.unique(code, return_inverse=True, return_counts=True)
    alone = times[back] == 1
    share_of = times[back] / n
    firsts, lasts = kind[start], kind[end - 1]
    return np.stack(
        [
            share(kind == _UPPER, letters), share(kind == _DIGIT, letters), share(kind == _BANG, size), share(kind == _STOP, size),
            share(kind == _MARK, size), share(kind == _HIGH, letters), share(raw == 10, size), by(length) / 10,
            by(length > 12), by(length == 1), by(same_as_last), by(often), by(alone), by(share_of),
            by((firsts == _UPPER)), by((lasts == _MARK) | (lasts == _BANG)), np.log1p(size) / 5,
        ],
        axis=1,
    ).astype(np.float32)


def _softmax_by(x: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    top = np.full(bags, -np.inf, dtype=x.dtype)
    np.maximum.at(top, bag, x)
    e = np.exp(x - top[bag])
    return e / np.bincount(bag, e, bags)[bag]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class QualityModel:
    """Encoder (w, b), gated attention (v, u, a), scorer (c, d), and the features' mean and scale."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        weight = _softmax_by((t * g) @ p["a"], bag, bags)
        z = np.zeros((bags, h.shape[1]), dtype=h.dtype)
        np.add.at(z, bag, weight[:, None] * h)
        return {"h": h, "t": t, "g": g, "weight": weight, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}

    def scaled(self, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x = (np.concatenate(bags) - self.mean) / self.scale
        return np.clip(x, -6, 6), np.repeat(np.arange(len(bags)), [len(b) for b in bags])

    def score(self, texts: list[str]) -> np.ndarray:
        x, bag = self.scaled([passages(t) for t in texts])
        return self.forward(x, bag, len(texts))["y"]


def fit(bags: list[np.ndarray], labels: list[int], hidden: int = 16, gates: int = 8, epochs: int = 40, batch: int = 64, rate: float = 0.01, seed: int = 5) -> QualityModel:
    """Adam on the logistic loss, both classes weighted as if equally frequent in the square root."""
    rng = np.random.default_rng(seed)
    x = np.concatenate(bags) if bags else np.zeros((1, FEATURES), np.float32)
    shape = {"w": (FEATURES, hidden), "b": (hidden,), "v": (hidden, gates), "u": (hidden, gates), "a": (gates,), "c": (hidden,), "d": ()}
    p = {k: (rng.normal(0, 0.3, s) if s and k != "b" else np.zeros(s)) for k, s in shape.items()}
    model = QualityModel(x.mean(axis=0), x.std(axis=0) + 1e-3, p)
    y = np.array(labels, dtype=np.float64)
    if not bags:
        return model
    mass = np.array([max(1, (y == k).sum()) for k in (0, 1)], dtype=np.float64)
    cost = np.sqrt(len(y) / 2 / mass)
    m1, m2, step = {k: np.zeros(s) for k, s in shape.items()}, {k: np.zeros(s) for k, s in shape.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            ids = order[at : at + batch]
            xb, bag = model.scaled([bags[i] for i in ids])
            f, n = model.forward(xb, bag, len(ids)), len(ids)
            dy = (f["y"] - y[ids]) * cost[y[ids].astype(int)] / n
            grad = {"c": f["z"].T @ dy, "d": dy.sum()}
            dz = dy[:, None] * p["c"]
            dweight = (dz[bag] * f["h"]).sum(axis=1)
            dh = dz[bag] * f["weight"][:, None]
            dlogit = f["weight"] * (dweight - np.bincount(bag, f["weight"] * dweight, n)[bag])
            grad["a"] = (f["t"] * f["g"]).T @ dlogit
            dt, dg = dlogit[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2), dlogit[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
            grad["v"], grad["u"] = f["h"].T @ dt, f["h"].T @ dg
            dh = (dh + dt @ p["v"].T + dg @ p["u"].T) * (1 - f["h"] ** 2)
            grad["w"], grad["b"] = xb.T @ dh, dh.sum(axis=0)
            step += 1
            for k, g in grad.items():
                g = g + 1e-4 * p[k]
                m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.999 * m2[k] + 0.001 * g * g
                p[k] = p[k] - rate * (1 - epoch / epochs) * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit_quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 2000, most_passages: int = 1_600_000, **how) -> QualityModel:
    """Fit on about ``per_class`` labelled documents of each class (the documented bound), drawn by a hash of the id.

    The executors turn the drawn documents into passage features, every passage
    of a document.  Where the draw has more than ``most_passages`` in all, whole
    documents are left out of it, so that each class has half of that at most.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter("y in (0, 1)")
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.coalesce(*[F.when(F.col("y") == k, F.lit(per_class / n)) for k, n in sizes.items()], F.lit(0.0))
    drawn = known.filter(unit_hash("__id", F.lit(23)) < share)
    # the draw is bounded by per_class: with it on every executor no text is shuffled
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")).join(F.broadcast(drawn), "__id")

    def make():
        def run(texts: list[str]) -> list[list]:
            return [[passages(t).astype("<f4").tobytes() for t in texts]]

        return run

    sample = materialize(append_columns(rows, "__text", [("x", "binary")], make).select("__id", "y", "x", unit_hash("__id", F.lit(29)).alias("u")), "quality-sample")
    sample = sample.withColumn("h", F.xxhash64("x"))
    room, taken, left_out = {0: most_passages // 2, 1: most_passages // 2}, [], False
    for r in sorted(sample.select("u", "h", "y", (F.length("x") / (4 * FEATURES)).cast("long").alias("n")).collect()):
        if r["n"] <= room[r["y"]]:
            room[r["y"]] -= r["n"]
            taken.append((r["u"], r["h"]))
        else:
            left_out = True
    if left_out:
        chosen = docs.sparkSession.createDataFrame(sorted(set(taken)), "u double, h long")
        sample = sample.join(F.broadcast(chosen), ["u", "h"], "left_semi")
    found = sample.select("__id", "y", "x").collect()
    found.sort(key=lambda r: (str(r["__id"]), r["x"]))
    return fit([np.frombuffer(r["x"], "<f4").reshape(-1, FEATURES) for r in found], [r["y"] for r in found], **how)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1, higher: better) and ``predicted``.

    All passages of the whole text are read.  Null and empty texts are one empty
    passage and get its score.  Input columns keep their values; ones
    named like an output are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def run(texts: list[str]) -> list[list]:
            y = m.score(texts) if texts else np.zeros(0)
            return [y.tolist(), (y >= threshold).astype(int).tolist()]

        return run

    return append_columns(docs, text_col, [("score", "double"), ("predicted", "int")], make)
