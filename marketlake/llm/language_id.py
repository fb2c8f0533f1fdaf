"""Operator 9: language identification by a byte convolutional network.

The whole text (UTF-8, A-Z folded) is cut into windows of 256 bytes. Bytes are
embedded; filters of widths 2, 3 and 4 slide over the window, each is pooled by
its maximum, and a softmax layer over the pooled values gives the window's
language probabilities. The text's probabilities are those of its windows,
averaged with the number of letter bytes as weight. Narrow filters are stored
as wide ones with zeros, so a batch of windows is one matrix product.

Fitting: numpy on the driver, on windows of a bounded hash sample (about
``per_class`` documents of each language, evenly spaced windows of each, upper-
cased copies of some); never rows whose crc32(doc_id) mod 4 is 2. Prediction
reads every byte of every text.

Defined cases: text that is NULL or has no letter gives ``und`` with score 0;
NULL lang teaches nothing; NULL ids are neither held out nor learned from;
repeated rows give a row each; with no labelled rows every text is ``und``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import class_sample, fold, map_batches, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16         # of each width
EMBED = 8
UNKNOWN = "und"
BLOCK = 48           # windows per matrix product: the products stay in cache
LETTER = re.compile(r"[^\W\d_]").search
_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[128:] = True
_SPAN = max(WIDTHS)


def windows_of(text: str) -> np.ndarray:
    """(n, WINDOW) bytes; the last window is padded with zeros."""
    data = np.frombuffer(text.encode().lower(), np.uint8)
    out = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[:len(data)] = data
    return out


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray     # (256, EMBED); byte 0 is padding and stays zero
    conv: np.ndarray      # (_SPAN * EMBED, filters)
    bias: np.ndarray
    dense: np.ndarray     # (filters, languages)
    out: np.ndarray

    def unfold(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, _SPAN * EMBED): each position's next bytes."""
        padded = np.pad(x, ((0, 0), (0, _SPAN - 1)))
        e = self.embed[padded]
        n = x.shape[1]
        return np.concatenate([e[:, o:o + n] for o in range(_SPAN)], axis=2)

    def pooled(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = (u.reshape(-1, u.shape[2]) @ self.conv).reshape(u.shape[0], u.shape[1], -1)
        at = z.argmax(1)
        top = np.take_along_axis(z, at[:, None], 1)[:, 0] + self.bias
        return np.maximum(top, 0), at

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(x), BLOCK):
            u = self.unfold(x[i:i + BLOCK])
            z = u.reshape(-1, u.shape[2]) @ self.conv
            top = z.reshape(u.shape[0], u.shape[1], -1).max(1) + self.bias
            out.append(softmax(np.maximum(top, 0) @ self.dense + self.out))
        return np.concatenate(out)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 1500,
        batch: int = 48, rate: float = 0.004, seed: int = 5) -> Network:
    """Adam on the cross entropy; languages weigh the same."""
    rng = np.random.default_rng(seed)
    filters = FILTERS * len(WIDTHS)
    mask = np.zeros((_SPAN * EMBED, filters), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
    f = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
    net = Network(languages, f(256, EMBED, scale=0.5), f(*mask.shape, scale=0.25) * mask,
                  np.zeros(filters, np.float32), f(filters, len(languages), scale=0.2),
                  np.zeros(len(languages), np.float32))
    net.embed[0] = 0
    names = ("embed", "conv", "bias", "dense", "out")
    m = {k: np.zeros_like(getattr(net, k)) for k in names}
    v = {k: np.zeros_like(getattr(net, k)) for k in names}
    by = [np.flatnonzero(y == k) for k in range(len(languages))]
    for t in range(1, steps + 1):
        pick = np.concatenate([rng.choice(by[k], -(-batch // len(by))) for k in range(len(by))])
        xb, yb = x[pick], y[pick]
        n = len(pick)
        u = net.unfold(xb)
        top, at = net.pooled(u)
        p = softmax(top @ net.dense + net.out)
        p[np.arange(n), yb] -= 1
        p /= n
        g = {"dense": top.T @ p, "out": p.sum(0)}
        d = (p @ net.dense.T) * (top > 0)                       # (n, filters)
        seen = u[np.arange(n)[:, None], at]                     # (n, filters, span * embed)
        g["conv"] = np.einsum("nf,nfk->kf", d, seen) * mask
        g["bias"] = d.sum(0)
        back = d[:, :, None] * net.conv.T[None]                 # (n, filters, span * embed)
        padded = np.pad(xb, ((0, 0), (0, _SPAN - 1)))
        g["embed"] = np.zeros_like(net.embed)
        for o in range(_SPAN):
            byte = padded[np.arange(n)[:, None], at + o]
            np.add.at(g["embed"], byte.reshape(-1),
                      back[:, :, o * EMBED:(o + 1) * EMBED].reshape(-1, EMBED))
        g["embed"][0] = 0
        for k in names:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            step = rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
            setattr(net, k, (getattr(net, k) - step).astype(np.float32))
    return net


def train(docs: DataFrame, per_class: int = 600, per_text: int = 4, lang_col: str = "lang",
          id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """Fit on about ``per_class`` documents of each language."""
    ids = (docs.filter((fold(id_col, 4) != 2) & F.col(lang_col).isNotNull())
           .select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")))
    chosen = class_sample(ids, "_id", "_lang", per_class)
    sample = (docs.filter(fold(id_col, 4) != 2).select(id_col, text_col)
              .join(F.broadcast(chosen), F.col(id_col) == F.col("_id"))
              .select("_lang", text_col))

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            lang, cut = [], []
            for name, text in zip(batch.column("_lang").to_pylist(), texts_of(batch, text_col)):
                if not LETTER(text):
                    continue
                for form in (text, text.upper()):
                    x = windows_of(form)
                    few = per_text if form is text else 1
                    for i in np.unique(np.linspace(0, len(x) - 1, few).astype(int)):
                        lang.append(name)
                        cut.append(x[i].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()),
                                               pa.array(cut, pa.binary())], names=["lang", "x"])
        return run

    known = map_batches(sample, make, "lang string, x binary").orderBy("lang", "x").toArrow()
    if not known.num_rows:
        return None
    lang = np.array(known["lang"].to_pylist())
    x = np.frombuffer(b"".join(known["x"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    languages = sorted(set(lang.tolist()))
    return fit(x, np.searchsorted(languages, lang), languages)


def predictions(docs: DataFrame, network: Network | None, id_col: str = "doc_id",
                text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score"),
                keep: bool = False) -> DataFrame:
    """Predicted language and its probability; with ``keep`` all columns of
    ``docs`` stay in front of the two new ones."""
    shared = docs.sparkSession.sparkContext.broadcast(network)   # a fixed size
    rows = docs if keep else docs.select(id_col, text_col)
    front = rows.schema.fields if keep else [rows.schema[id_col]]
    schema = T.StructType([*front, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])

    def make():
        net = shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch, text_col)
            told, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            real = [i for i, t in enumerate(texts) if LETTER(t)] if net else []
            for at in range(0, len(real), 64):
                some = real[at:at + 64]
                cut = [windows_of(texts[i]) for i in some]
                x = np.concatenate(cut)
                weight = _LETTERS[x].sum(1) + 1e-6
                p = net.probabilities(x) * weight[:, None]
                starts = np.cumsum([0] + [len(w) for w in cut[:-1]])
                mean = np.add.reduceat(p, starts) / np.add.reduceat(weight, starts)[:, None]
                best = mean.argmax(1)
                for i, k, s in zip(some, best, mean.max(1)):
                    told[i], score[i] = net.languages[k], min(1.0, float(s))
            cols = [batch.column(f.name) for f in front]
            return pa.RecordBatch.from_arrays([*cols, pa.array(told, pa.string()),
                                               pa.array(score)], names=schema.names)
        return run

    return map_batches(rows, make, schema)


def identify_languages(docs: DataFrame, per_class: int = 600, id_col: str = "doc_id",
                       text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    network = train(docs, per_class, lang_col=lang_col, id_col=id_col, text_col=text_col)
    told = predictions(docs, network, id_col, text_col)
    held = F.coalesce(fold(id_col, 4) == 2, F.lit(False))
    return told.select(id_col, held.alias("held_out"), "lang_pred", "score")
