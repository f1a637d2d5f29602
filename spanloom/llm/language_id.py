"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's features are the 3- and 4-byte substrings of its words (with the word
boundary), hashed into a table of embeddings whose mean goes through a linear
softmax.  Embeddings and softmax are trained together by stochastic gradient
descent in numpy on a bounded sample.  On the part of the sample that training
didn't see, and on as many texts of random subwords, which no language should be
sure of, a temperature and a rejection threshold are set.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_columns, materialize, unit_hash

BUCKETS = 1 << 14
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> str:
    """Lower-cased words of letters between single spaces; empty if there is no letter."""
    out = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {out} " if any(map(str.isalpha, out)) else ""


def subwords(cleaned: str) -> np.ndarray:
    """Counts of the hashed 3- and 4-byte substrings, one per bucket."""
    b = np.frombuffer(cleaned.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    three = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)) if len(b) > 2 else b
    four = three[:-1] * np.uint32(0x27D4EB2F) + b[3:] * np.uint32(0x165667B1) if len(b) > 3 else three[:0]
    mixed = np.concatenate([three, four])
    return np.bincount((mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1), minlength=BUCKETS)


@dataclass
class LanguageModel:
    """``table``: embeddings times softmax weights, one row per bucket; ``reject_below``: calibrated confidence."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def score(self, text: str | None) -> tuple[str, float]:
        cleaned = letters_only(text) if text else ""
        if not cleaned or not self.langs:
            return "und", 0.0
        counts = subwords(cleaned)
        z = (counts @ self.table / max(1, counts.sum()) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def sample_features(docs: DataFrame, label: Column, text_col: str, id_col: str, per_class: int) -> list:
    """At most about ``per_class`` rows of each label (drawn by a hash of the id), as sparse features made on the executors."""
    labelled = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"), label.alias("__label")).filter("__label is not null and __text is not null")
    sizes = {r["__label"]: r["n"] for r in labelled.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    if not sizes:
        return []
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(per_class / n))])
    drawn = labelled.filter(unit_hash("__id", F.lit(17)) < share[F.col("__label")])

    def make():
        def run(texts: list[str]) -> list[list]:
            idx, weight = [], []
            for t in texts:
                cleaned = letters_only(t)
                counts = subwords(cleaned) if cleaned else np.zeros(BUCKETS, dtype=np.int64)
                at = np.flatnonzero(counts)
                idx.append(at.astype("<u4").tobytes())
                weight.append((counts[at] / max(1, counts.sum())).astype("<f4").tobytes())
            return [idx, weight]

        return run

    rows = materialize(append_columns(drawn, "__text", [("idx", "binary"), ("weight", "binary")], make).drop("__text"), "lang-sample").collect()
    rows.sort(key=lambda r: (str(r["__label"]), str(r["__id"])))
    return [(r["__label"], np.frombuffer(r.idx, "<u4"), np.frombuffer(r.weight, "<f4")) for r in rows if r.idx]


def fit(rows: list, dim: int = 16, epochs: int = 6, rate: float = 8.0, seed: int = 7, most_rejected: float = 0.002) -> LanguageModel:
    """Train on three quarters of ``rows`` (label, buckets, weights); calibrate on the rest."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    train, rest = [rows[i] for i in order if i % 4], [rows[i] for i in order if not i % 4]
    train = train or rest
    of = {k: i for i, k in enumerate(langs)}
    freq = np.bincount([of[r[0]] for r in train], minlength=len(langs))
    e = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    w = rng.normal(0, 0.1, (dim, len(langs))).astype(np.float32)
    b = np.zeros(len(langs), np.float32)
    steps, t = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            label, idx, weight = train[i]
            h = weight @ e[idx]
            z = h @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[of[label]] -= 1
            step = rate * (1 - t / steps) * min(2.0, len(train) / len(langs) / max(1, freq[of[label]]))
            g = w @ p
            w -= step * 0.1 * np.outer(h, p)
            b -= step * 0.01 * p
            e[idx] -= step * np.outer(weight, g)
            t += 1
    table = (e @ w).astype(np.float32)
    z = np.array([weight @ table[idx] + b for _, idx, weight in (rest or train)])
    y = np.array([of[r[0]] for r in (rest or train)])

    # texts of unknown subwords: as many buckets as the held-back rows have, drawn at random
    strange = np.array([weight @ table[rng.integers(0, BUCKETS, len(idx))] + b for _, idx, weight in (rest or train)])

    def probabilities(z: np.ndarray, temperature: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return p / p.sum(axis=1, keepdims=True)

    def loss(temperature: float) -> float:
        """Known rows should be sure of their language, strange ones of none."""
        known = np.log(probabilities(z, temperature)[np.arange(len(y)), y] + 1e-9).mean()
        return float(-known - np.log(probabilities(strange, temperature) + 1e-9).mean())

    temperature = float(min(np.geomspace(0.05, 50, 60), key=loss))
    p = probabilities(z, temperature)
    confidence, right = p.max(axis=1), p.argmax(axis=1) == y
    # between all but a few of the strange rows and all but a few of the right ones, nearer to the former; where these overlap, the right ones decide
    least = float(np.quantile(confidence[right], most_rejected)) if right.any() else 0.0
    most = float(np.quantile(probabilities(strange, temperature).max(axis=1), 0.99))
    return LanguageModel(langs, table, b, temperature, min(least, most + (least - most) / 4))


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = 600, **how) -> LanguageModel:
    """Fit on about ``per_class`` labelled rows of each language (the documented bound of the sample)."""
    return fit(sample_features(docs, F.col(f"`{lang_col}`").cast("string"), text_col, id_col, per_class), **how)


def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (calibrated probability) and ``lang_accepted``.

    Whole texts are read.  A text that is null or has no letter is ``und`` with
    score 0, not accepted; others are accepted at or above the model's
    calibrated threshold.  A model without languages calls every text ``und``.
    Input columns keep their values; ones named like an output are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def run(texts: list) -> list[list]:
            found = [m.score(t) for t in texts]
            return [[x for x, _ in found], [p for _, p in found], [x != "und" and p >= m.reject_below for x, p in found]]

        return run

    return append_columns(docs, text_col, [("lang_pred", "string"), ("score", "double"), ("lang_accepted", "boolean")], make, nulls=True)
