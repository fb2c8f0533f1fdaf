"""Operator 1: quality classifier, a factorisation machine.

A text becomes sparse features: its distinct words hashed into 2^16 slots
(value 1/sqrt(number of distinct words)), structure statistics (length, word
length, shares of capitals, digits, symbols, line feeds, repeated words and
lines) and the metadata column n_chars. The score is
``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairwise sum takes
linear time as ``(|sum v_i x_i|^2 - sum |v_i|^2 x_i^2) / 2``.

Fitting: on the driver in numpy, on a bounded hash sample of labelled rows
(about ``per_class`` of each label, never the held-out fold). lang, source,
doc_id and labels are never inputs. Scoring covers every whole text in one pass.

Defined cases: NULL text is empty; an empty text is scored by its statistics;
NULL n_chars is read as the text's own length; NULL ids are not held out;
repeated rows give a row each; with no labelled rows every score is 0.5.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import fold, labelled, map_batches, texts_of

SLOTS = 1 << 16
STATS = 12
CAPITALS = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def word_slots(text: str) -> list[int]:
    """Slots of the distinct lower-cased words, ascending."""
    return sorted({zlib.crc32(w) % SLOTS for w in set(text.encode().lower().split())})


def statistics(text: str, n_chars: int | None) -> list[float]:
    data = text.encode()
    size = len(data)
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x]
    share = lambda drop: 1 - len(data.translate(None, drop)) / size if size else 0.0
    distinct = len(set(words))
    return [math.log1p(len(text)) / 5 - 1, math.log1p(n) / 4 - 1,
            size / n / 10 if n else 0.0, 4 * share(CAPITALS), 8 * share(DIGITS),
            6 * share(SYMBOLS), 8 * (len(lines) / size if size else 0.0),
            distinct / n if n else 0.0, math.log1p(n - distinct) / 5,
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            max(map(len, words)) / 50 if n else 0.0,
            math.log1p(max(0, len(text) if n_chars is None else n_chars)) / 5 - 1]


@dataclass
class Machine:
    """``table`` holds per slot (linear weight, factors, |factors|^2)."""
    bias: float
    table: np.ndarray      # (SLOTS, factors + 2)
    stats: np.ndarray      # (STATS, factors + 2)

    def score(self, slots: list[list[int]], stats: np.ndarray) -> np.ndarray:
        n = np.array([len(s) for s in slots])
        flat = np.fromiter((i for s in slots for i in s), np.int64, int(n.sum()))
        value = 1 / np.sqrt(np.maximum(n, 1))
        sums = np.zeros((len(slots), self.table.shape[1]))
        some = np.flatnonzero(n)
        if len(flat):
            starts = np.concatenate([[0], np.cumsum(n)[:-1]])[some]
            sums[some] = np.add.reduceat(self.table[flat], starts, axis=0)
        linear = sums[:, 0] * value + stats @ self.stats[:, 0]
        total = sums[:, 1:-1] * value[:, None] + stats @ self.stats[:, 1:-1]
        squares = sums[:, -1] * value ** 2 + stats ** 2 @ self.stats[:, -1]
        raw = self.bias + linear + (np.square(total).sum(1) - squares) / 2
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(slots: list[np.ndarray], stats: np.ndarray, y: np.ndarray, factors: int = 6,
        epochs: int = 8, rate: float = 0.08, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss, one document batch at a time."""
    rng = np.random.default_rng(seed)
    width = factors + 1
    table = np.zeros((SLOTS, width), np.float32)
    table[:, 1:] = rng.normal(0, 0.02, (SLOTS, factors))
    dense = np.zeros((STATS, width))
    dense[:, 1:] = rng.normal(0, 0.05, (STATS, factors))
    bias, g_bias = 0.0, 1e-8
    g_table, g_dense = np.full(table.shape, 1e-6, np.float32), np.full(dense.shape, 1e-6)
    # both classes weigh the same in the loss
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for epoch in range(epochs if 0 < y.mean() < 1 else 0):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 64):
            b = order[at:at + 64]
            n = np.array([len(slots[i]) for i in b])
            flat = np.concatenate([slots[i] for i in b])
            row = np.repeat(np.arange(len(b)), n)
            value = (1 / np.sqrt(np.maximum(n, 1)))[:, None]
            z = stats[b]
            part = table[flat]
            sums = np.zeros((len(b), width))
            np.add.at(sums, row, part)
            total = sums[:, 1:] * value + z @ dense[:, 1:]
            sq = np.zeros(len(b))
            np.add.at(sq, row, np.square(part[:, 1:]).sum(1))
            sq = sq * value[:, 0] ** 2 + z ** 2 @ np.square(dense[:, 1:]).sum(1)
            raw = bias + sums[:, 0] * value[:, 0] + z @ dense[:, 0] \
                + (np.square(total).sum(1) - sq) / 2
            err = weight[b] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[b]) / len(b)
            v = value[row]
            grad = np.empty(part.shape, np.float32)
            grad[:, :1] = err[row, None] * v
            grad[:, 1:] = err[row, None] * v * (total[row] - v * part[:, 1:])
            used, where = np.unique(flat, return_inverse=True)
            step = np.zeros((len(used), width), np.float32)
            np.add.at(step, where, grad)
            step += decay * table[used]
            g_table[used] += step ** 2
            table[used] -= rate * step / np.sqrt(g_table[used])
            d_step = np.empty_like(dense)
            d_step[:, 0] = err @ z
            d_step[:, 1:] = (err[:, None] * z).T @ total \
                - (err @ z ** 2)[:, None] * dense[:, 1:]
            g_dense += d_step ** 2
            dense -= rate * d_step / np.sqrt(g_dense)
            g_bias += err.sum() ** 2
            bias -= rate * err.sum() / math.sqrt(g_bias)
    close = lambda t: np.concatenate([t, np.square(t[:, 1:]).sum(1, keepdims=True)], 1)
    return Machine(bias, close(table).astype(np.float32), close(dense))


def features(rows: DataFrame, text_col: str) -> DataFrame:
    """(y, slots, stats) of sampled rows."""
    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch, text_col)
            chars = batch.column("_chars").to_pylist()
            return pa.RecordBatch.from_arrays(
                [batch.column("_y"),
                 pa.array([word_slots(t) for t in texts], pa.list_(pa.int32())),
                 pa.array([statistics(t, c) for t, c in zip(texts, chars)],
                          pa.list_(pa.float64()))], names=["y", "slots", "stats"])
        return run
    return map_batches(rows, make, "y int, slots array<int>, stats array<double>")


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = 4000,
                   threshold: float = 0.3, label: str = "quality", id_col: str = "doc_id",
                   text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    spark = docs.sparkSession
    chars = F.col(chars_col).cast("bigint") if chars_col in docs.columns \
        else F.lit(None).cast("bigint")
    rows = docs.select(F.col(id_col), F.col(text_col), chars.alias("_chars"))
    sample = labelled(rows, labels, label, per_class, id_col).select(text_col, "_chars", "_y")
    known = features(sample, text_col).orderBy("y", F.xxhash64("slots")).toArrow()
    y = known["y"].to_numpy().astype(float)
    stats = np.array(known["stats"].to_pylist()).reshape(-1, STATS)
    machine = spark.sparkContext.broadcast(   # 2^16 slots: a fixed size
        fit([np.asarray(s, np.int64) for s in known["slots"].to_pylist()], stats, y)
        if len(y) else Machine(0.0, np.zeros((SLOTS, 3), np.float32), np.zeros((STATS, 3))))
    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def make():
        model = machine.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch, text_col)
            chars = batch.column("_chars").to_pylist()
            score = model.score([word_slots(t) for t in texts],
                                np.array([statistics(t, c) for t, c in zip(texts, chars)]))
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("_held"), pa.array(score),
                 pa.array((score >= threshold).astype(np.int32))],
                names=[id_col, "held_out", "score", "predicted"])
        return run

    held = F.coalesce(fold(id_col, 5) == 0, F.lit(False))
    return map_batches(rows.withColumn("_held", held), make, schema)
