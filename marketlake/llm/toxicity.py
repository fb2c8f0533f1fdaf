"""Operator 3: toxicity severity by cumulative-link ordinal regression.

Features are the distinct words of a text (lower-cased runs of letters and
digits) and their prefixes of 4 to 6 characters, hashed into 2^18 slots; a
prefix counts once per distinct word that has it. The grades are 0 (not toxic)
and, for toxic rows, 1 to 3 by how many words carry features that mark toxic
rows. One weight vector is shared by all ordered thresholds:
``P(grade >= k) = sigmoid(w.x - theta_k)``; expected severity is the sum of
these over k. Because the score adds up over distinct words, each worker caches
the weight of a word.

Fitting: on the driver in numpy, on a bounded hash sample of labelled rows
(about ``per_class`` of each label, never the held-out fold), by Newton-like
gradient steps on the selected features only.

Defined cases: NULL or empty text has no features (grade by the thresholds
alone); repeated rows give a row each; NULL ids are not held out; with no
labelled toxic row every severity is 0.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import BoundedCache, fold, labelled, map_batches, texts_of

SLOTS = 1 << 18
GRADES = 3
WORDS = re.compile(r"[^\W_]+").findall


def word_features(word: str) -> list[int]:
    """Slots of a word and of its proper prefixes of 4 to 6 characters."""
    keys = [word, *("^" + word[:k] for k in (4, 5, 6) if len(word) > k)]
    return [zlib.crc32(k.encode()) % SLOTS for k in keys]


def text_features(text: str) -> list[int]:
    return [i for w in set(WORDS(text.lower())) for i in word_features(w)]


@dataclass
class Ordinal:
    weights: np.ndarray     # (SLOTS,), zero where not selected
    theta: np.ndarray       # ascending thresholds; +inf: never

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.., one column per threshold."""
        return 1 / (1 + np.exp(np.clip(self.theta - score[:, None], -30, 30)))


def select(rows: list[np.ndarray], y: np.ndarray, least: int = 5, z: float = 4.0) -> np.ndarray:
    """Slots whose document rate differs between the labels by ``z`` standard errors."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    c1, c0 = np.zeros(SLOTS), np.zeros(SLOTS)
    for r, t in zip(rows, y):
        (c1 if t else c0)[np.unique(r)] += 1
    p = (c1 + c0) / (n1 + n0)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    return np.flatnonzero((c1 + c0 >= least) & (np.abs(c1 / n1 - c0 / n0) > z * spread))


def fit(rows: list[np.ndarray], y: np.ndarray, steps: int = 400, rate: float = 0.05,
        ridge: float = 1e-3) -> Ordinal:
    if not 0 < y.mean() < 1:
        return Ordinal(np.zeros(SLOTS, np.float32), np.full(GRADES, np.inf))
    chosen = select(rows, y)
    slot = np.full(SLOTS, -1)
    slot[chosen] = np.arange(len(chosen))
    kept = [slot[r] for r in rows]
    kept = [k[k >= 0] for k in kept]
    rates = np.zeros((2, len(chosen)))
    for k, t in zip(kept, y.astype(int)):
        rates[t, np.unique(k)] += 1
    marks = rates[1] / y.sum() > 4 * (rates[0] + 0.5) / (len(y) - y.sum())
    hits = np.array([marks[k].sum() for k in kept])
    cuts = np.quantile(hits[y == 1], [1 / 3, 2 / 3])
    grade = np.where(y == 1, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0)

    size = np.array([len(k) for k in kept])
    flat = np.concatenate(kept).astype(np.int64)
    row = np.repeat(np.arange(len(kept)), size)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    goal = (grade[:, None] >= np.arange(1, GRADES + 1)).astype(float)
    w, first, gaps = np.zeros(len(chosen)), 0.0, np.full(GRADES - 1, 1.0)
    # Adam on the weights, the first threshold and the logs of the gaps
    x = np.concatenate([w, [first], np.log(gaps)])
    m, v = np.zeros_like(x), np.zeros_like(x)
    n = len(chosen)
    for t in range(1, steps + 1):
        theta = x[n] + np.concatenate([[0], np.cumsum(np.exp(x[n + 1:]))])
        score = np.bincount(row, x[:n][flat], len(kept))
        p = 1 / (1 + np.exp(np.clip(theta - score[:, None], -30, 30)))
        # cumulative link: thresholds are separate logistic questions that
        # share the weights (summed log likelihood of all of them)
        err = (p - goal) * weight[:, None]
        g = np.empty_like(x)
        g[:n] = np.bincount(flat, err.sum(1)[row], n) + ridge * x[:n]
        d_theta = -err.sum(0)
        g[n] = d_theta.sum()
        g[n + 1:] = np.cumsum(d_theta[::-1])[::-1][1:] * np.exp(x[n + 1:])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights = np.zeros(SLOTS, np.float32)
    weights[chosen] = x[:n]
    theta = x[n] + np.concatenate([[0], np.cumsum(np.exp(x[n + 1:]))])
    return Ordinal(weights, theta)


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = 5000,
                    threshold: float = 0.5, label: str = "toxic", id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, severity, grade, predicted) for every row:
    score = P(grade >= 1), severity = expected grade, grade = severity rounded,
    predicted = 1 where score >= threshold."""
    spark = docs.sparkSession
    rows = docs.select(id_col, text_col)
    sample = labelled(rows, labels, label, per_class, id_col).select(text_col, "_y")

    def sampled():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch.column("_y"), pa.array([text_features(t) for t in
                                               texts_of(batch, text_col)],
                                              pa.list_(pa.int32()))], names=["y", "slots"])
        return run

    known = map_batches(sample, sampled, "y int, slots array<int>").toArrow()
    y = known["y"].to_numpy().astype(int)
    lists = known["slots"].combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    fitted = fit([flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])], y) if len(y) \
        else Ordinal(np.zeros(SLOTS, np.float32), np.full(GRADES, np.inf))
    model = spark.sparkContext.broadcast(fitted)     # 2^18 slots: a fixed size
    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("severity", T.DoubleType()),
                           T.StructField("grade", T.IntegerType()),
                           T.StructField("predicted", T.IntegerType())])

    def make():
        m = model.value
        cache = BoundedCache(lambda w: float(m.weights[word_features(w)].sum()))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            score = np.array([sum(map(cache.__getitem__, set(WORDS(t.lower()))))
                              for t in texts_of(batch, text_col)], float)
            p = m.at_least(score)
            severity = p.sum(1)
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("_held"), pa.array(p[:, 0]),
                 pa.array(severity), pa.array(np.rint(severity).astype(np.int32)),
                 pa.array((p[:, 0] >= threshold).astype(np.int32))], names=schema.names)
        return run

    held = F.coalesce(fold(id_col, 5) == 0, F.lit(False))
    return map_batches(rows.withColumn("_held", held), make, schema)
