"""Operator 10: packing documents into fixed windows by non-negative least squares.

1. Each document's ids (plus one end id) are cut into full windows and a
   remainder; a remainder above half a window is cut once more at half a
   window. One pass in Arrow batches; only lengths and checksums are stored.
2. The histogram of piece lengths (at most ``window`` rows, whatever the
   corpus) goes to the driver. Shallow combinations (two or three lengths)
   that fill a window are enumerated, and non-negative least squares finds
   how often to repeat each so that the lengths used match the histogram.
3. The counts are rounded and cut to what is there; residuals are packed
   greedily, longest first with the longest that still fits.
4. The plan is a table of rank ranges per length. Pieces are ranked within
   their length (in buckets of bounded size, so a length that a third of all
   pieces share is split), and each piece looks its place up by rank.

Defined cases: NULL text is empty (its one piece is the end id); repeated rows
and NULL ids are packed like any other row; an empty table gives no rows;
columns other than the id and text are ignored. Sequences are padded to the
window unless their length is a power of two.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import BoundedCache, kept, map_batches, staged, texts_of

BUCKET_ROWS = 20_000   # ranking window size
GRID = 16              # first lengths of the enumerated triples


# ------------------------------------------------------------------ tokens

# Plain words: lower-case Latin letters that normalisation leaves as they are.
PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
TAIL = ".,!?;:"


class WordIds:
    """Ids of whole texts by a ``tokenizers`` byte-level BPE file whose words
    never span spaces or line feeds: each distinct stretch between them is
    encoded once. A plain word goes straight to the file's BPE model (its
    normalisation is lower case, its split the word itself); every other
    stretch goes through the whole tokenizer. Words and stretches share one
    cache: a plain word is its own stretch."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {x: byte_level.pre_tokenize_str(chr(x))[0][0]
                        for x in range(0xDF, 0x100)}
        self.cache = BoundedCache(self._stretch, limit)

    def _word(self, word: str) -> bytes:
        if not PLAIN(word):
            ids = self.tok.encode(word, add_special_tokens=False).ids
        else:
            if not word.isascii():
                word = word.translate(self.letters)
            ids = [t.id for t in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stretch(self, text: str) -> bytes:
        core = text.rstrip(TAIL)
        low = core.lower()
        if not PLAIN(low):
            return self._word(text)
        if low == text:
            return self._word(text)
        if core == text:
            return self.cache[low]
        return self.cache[low] + self.cache[text[len(core):]]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(map(self.cache.__getitem__, text.replace("\n", " ").split(" ")))


@kept
def word_ids(path: str) -> WordIds:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def cut_points(n: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    cuts = [(s, window) for s in range(0, n - n % window, window)]
    start, rest, half = n - n % window, n % window, window // 2
    if rest > half:
        cuts.append((start, half))
        start, rest = start + half, rest - half
    if rest:
        cuts.append((start, rest))
    return cuts


def cut_documents(docs: DataFrame, path: str, window: int, end_id: int = 1,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens), one row per piece."""
    id_type = docs.schema[id_col].dataType.simpleString()
    tail = int(end_id).to_bytes(4, "little")

    def make():
        ids = word_ids(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(texts_of(batch, text_col)):
                data = ids.encode(text) + tail
                view, n = memoryview(data), len(data) // 4
                for s, k in cut_points(n, window):
                    row.append(i)
                    start.append(s)
                    length.append(k)
                    crc.append(zlib.crc32(view[4 * s:4 * (s + k)]))
                    total.append(n)
            long = lambda x: pa.array(x, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(pa.array(row, pa.int32())),
                 long(start), long(length), long(crc), long(total)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return run

    return map_batches(docs.select(id_col, text_col), make,
                       f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, "
                       "doc_tokens bigint")


# -------------------------------------------------------------------- plan

def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Shallow combinations of present lengths that fill a window: rows of
    three lengths, 0 for none. Triples start from a grid of lengths, the
    halves or two equal lengths, so there are at most (GRID + 3) * window."""
    here = np.zeros(window + 1, bool)
    here[lengths] = True
    here[0] = False
    a = lengths[(lengths <= window - lengths)]
    rows = [np.stack([a, window - a, 0 * a], 1)[here[window - a]]]
    grid = np.unique(lengths[np.linspace(0, len(lengths) - 1, GRID).astype(int)]) \
        if len(lengths) else lengths
    firsts = set(grid.tolist()) | ({window // 2} if here[window // 2] else set())
    for g in sorted(firsts):
        b = lengths[lengths < window - g]
        c = window - g - b
        keep = (b <= c) & here[c]
        rows.append(np.stack([np.full(keep.sum(), g), b[keep], c[keep]], 1))
    twin = lengths[2 * lengths < window]
    twin = twin[here[window - 2 * twin]]
    rows.append(np.stack([twin, twin, window - 2 * twin], 1))
    return np.unique(np.sort(np.concatenate(rows), 1), axis=0)


def nnls(combos: np.ndarray, hist: np.ndarray, steps: int = 300) -> np.ndarray:
    """min |A x - hist| over x >= 0, where column j of A counts the lengths
    of combination j; multiplicative steps keep x non-negative."""
    x = np.full(len(combos), hist.sum() / max(1, 3 * len(combos)))
    real = combos > 0
    goal = (hist[combos] * real).sum(1)
    for _ in range(steps):
        y = np.zeros(len(hist))
        for k in range(combos.shape[1]):
            y += np.bincount(combos[:, k], x * real[:, k], len(hist))
        x *= goal / np.maximum((y[combos] * real).sum(1), 1e-9)
    return x


def plan(hist: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths and how often each is repeated; together they
    use every count of ``hist`` (index: length) exactly."""
    left = hist.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []

    def use(combo: tuple[int, ...], most: int) -> None:
        need: dict[int, int] = {}
        for k in combo:
            need[k] = need.get(k, 0) + 1
        times = min([most, *(int(left[k]) // n for k, n in need.items())])
        if times > 0:
            chosen.append((combo, times))
            for k, n in need.items():
                left[k] -= n * times

    combos = combinations(np.flatnonzero(hist), window)
    if len(combos):
        x = nnls(combos, hist.astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.05:
                break
            use(tuple(int(k) for k in combos[j] if k), max(1, int(round(x[j]))))
        for j in np.argsort(-x, kind="stable"):   # what rounding left over
            use(tuple(int(k) for k in combos[j] if k), window * len(hist) ** 2)
    while left.any():
        need: dict[int, int] = {}
        combo, room = [], window
        while room:
            fit = np.flatnonzero(left[:room + 1])
            fit = [k for k in fit[::-1] if need.get(int(k), 0) < left[k]]
            if not fit:
                break
            k = int(fit[0])
            combo.append(k)
            need[k] = need.get(k, 0) + 1
            room -= k
        use(tuple(combo), int(left.sum()))
    return chosen


def segments(chosen: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, int]:
    """Rank ranges sorted by (length, first rank): columns length, first
    rank, sequence of that rank, offset; and the number of sequences."""
    rows, taken, seq = [], {}, 0
    for combo, times in chosen:
        offset = 0
        for k in combo:
            first = taken.get(k, 0)
            rows.append((k, first, seq, offset))
            taken[k] = first + times
            offset += k
        seq += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table, seq


# ------------------------------------------------------------------- query

def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset (see module text)."""
    pieces = staged(cut_documents(docs, path, window, end_id, id_col, text_col)
                    .withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    part = pieces.filter(F.col("length") < window)
    hist = np.zeros(window + 1, np.int64)
    for k, n in part.groupBy("length").count().collect():   # at most window - 1 rows
        hist[k] = n
    table, planned = segments(plan(hist, window))
    buckets = docs.sparkSession.createDataFrame(
        [(int(k), int(hist[k] // BUCKET_ROWS) + 1) for k in np.flatnonzero(hist)],
        "length bigint, buckets int")
    dealt = (part.join(F.broadcast(buckets), "length")
             .withColumn("bucket", F.pmod(F.xxhash64("uid"), F.col("buckets"))))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "bucket", (F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    ranked = (dealt.withColumn("at", F.row_number().over(
                  Window.partitionBy("length", "bucket").orderBy("uid")))
              .join(before, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("at") - 1))
    keys = table[:, 0] << 40 | table[:, 1]

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            j = np.searchsorted(keys, length << 40 | rank, "right") - 1
            return pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32",
                                           "doc_tokens")]
                + [pa.array(table[j, 2] + rank - table[j, 1]), pa.array(table[j, 3])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                       "sequence_id", "offset"])
        return run

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema
                       if f.name != "uid") + ", sequence_id bigint, offset bigint"
    packed = map_batches(ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                       "rank"), make, schema)
    full = pieces.filter(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.lit(planned) + F.col("uid")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(full)
