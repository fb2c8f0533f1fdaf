"""Operator 11: alignment of two tokenizers by sparse incidence products.

Texts are cut into parts where both tokenizers end a token whatever stands
around (before a single space between two words), and each distinct part of a
block of texts is encoded twice, some parts at a time. The tokens are the rows of two 0/1 incidence
matrices over the parts' bytes, in hand-built CSR; Gustavson's row products
A * B^T give the overlap links of the tokens. A token that overlaps nothing
before it starts a group, so the products also tell the groups: the shortest
stretches that both tokenizers end alike. A second product, of the id-by-group
incidence matrices, gives the shared-group links of each part's id pairs with
their number, without listing occurrence pairs; a third, of the texts by parts
and the parts by pairs, those of each text.

Spark then counts, for each id pair, the texts that hold it: blocks emit their
distinct pairs with the number of their texts, so what is shuffled is some
texts' worth of a block's pairs, not all links. Every block asks for the counts
of its own pairs and of its A ids' best ones, gets them back ahead of its
pieces, and the last product, each piece's text-by-pair matrix with these
counts, gives the sums. Blocks hold at most ``BLOCK_ROWS`` texts and, but for
one longer text, ``BLOCK_BYTES`` characters.

Memory: a block's parts are aligned ``ALIGNED`` characters at a time, and it is
stored as pieces of at most ``PIECE`` entries of its matrix (or one text), a
row each, ``GROUP`` rows in a row group. So no row, Arrow batch or column
vector of the executors grows with a block or with the input.

Defined cases: texts that are NULL, empty, or whose joined token bytes differ
from a space and the text have no tokens (zeros and an empty digest); repeated
rows and NULL ids are texts like others; texts are never cut; other columns
are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, count, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import staged

BLOCK_ROWS = 2048
BLOCK_BYTES = 4 << 20
JOINED = 64             # parts encoded as one text
ALIGNED = 1 << 18       # characters of parts (or one longer part) aligned at a time
PRODUCTS = 1 << 18      # products expanded at a time: bounds memory inside long texts
PIECE = 1 << 15         # entries of a block's text-by-pair matrix in a stored row
GROUP = 32              # stored rows that are read at once
# Both tokenizers end a token before a single space between two characters that
# are no white space, whatever stands around them: texts are cut there.
CUT = re.compile(r"(?<=\S) (?=\S)")


# --------------------------------------------------------------- CSR products

@dataclass
class CSR:
    """A sparse matrix of whole numbers by rows."""

    start: np.ndarray     # rows + 1 offsets
    col: np.ndarray
    val: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.start) - 1

    @classmethod
    def of(cls, row: np.ndarray, col: np.ndarray, rows: int) -> CSR:
        """From coordinates; equal ones are counted."""
        width = int(col.max(initial=0)) + 1
        key, val = np.unique(row.astype(np.int64) * width + col, return_counts=True)
        at = key // width
        return cls(np.searchsorted(at, np.arange(rows + 1)), key - at * width, val)

    def transposed(self, cols: int) -> CSR:
        row = np.repeat(np.arange(self.rows), np.diff(self.start))
        order = np.argsort(self.col, kind="stable")
        return CSR(np.searchsorted(self.col[order], np.arange(cols + 1)), row[order],
                   self.val[order])


def row_products(a: CSR, b: CSR):
    """Gustavson's algorithm for a * b, some rows of ``a`` at a time: each row
    adds up the rows of ``b`` that its entries name. Yields (first row, CSR)."""
    work = np.concatenate([[0], np.cumsum(np.diff(b.start)[a.col])])[a.start]
    width = int(b.col.max(initial=0)) + 1
    lo = 0
    while lo < a.rows:
        hi = max(lo + 1, int(np.searchsorted(work, work[lo] + PRODUCTS, "right")) - 1)
        s = slice(a.start[lo], a.start[hi])
        size = np.diff(b.start)[a.col[s]]
        first = np.repeat(b.start[a.col[s]] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        at = first + np.arange(len(first))
        row = np.repeat(np.repeat(np.arange(hi - lo), np.diff(a.start[lo:hi + 1])), size)
        key = row * width + b.col[at]
        val = np.repeat(a.val[s], size) * b.val[at]
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, val = key[order], val[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        key, val = key[new], np.add.reduceat(val, new) if len(new) else val
        at = key // width
        yield lo, CSR(np.searchsorted(at, np.arange(hi - lo + 1)), key - at * width, val)
        lo = hi


def byte_incidence(ends: np.ndarray) -> CSR:
    """Consecutive tokens (rows) by the bytes that they cover."""
    n = int(ends[-1]) if len(ends) else 0
    return CSR(np.concatenate([[0], ends]), np.arange(n), np.ones(n, np.int64))


def weighted(m: CSR, vector: np.ndarray) -> np.ndarray:
    """The product of a matrix and a vector."""
    total = np.concatenate([[0], np.cumsum(m.val * vector[m.col])])
    return total[m.start[1:]] - total[m.start[:-1]]


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of two token sequences over the same bytes, from their
    overlap links."""
    if not len(a_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = byte_incidence(a_ends), byte_incidence(b_ends)
    low, high = np.zeros(a.rows, np.int64), np.zeros(a.rows, np.int64)
    for first, links in row_products(a, b.transposed(int(a_ends[-1]))):
        rows = slice(first, first + links.rows)
        low[rows], high[rows] = links.col[links.start[:-1]], links.col[links.start[1:] - 1]
    opens = np.concatenate([[True], low[1:] > high[:-1]])
    ga = np.cumsum(opens) - 1
    gb = np.searchsorted(low[opens], np.arange(b.rows), "right") - 1
    return ga, gb


# ------------------------------------------------------------------ tokenizers

def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in plain]
    return out | {chr(256 + k): b for k, b in enumerate(others)}


class Parts(NamedTuple):
    """What distinct parts of texts yield, part by part."""

    good: np.ndarray      # whether the bytes of both token sequences are the part's
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    text: list[str]       # the groups, written out
    links: CSR            # how often id pairs share a group: parts by positions in ``pairs``
    pairs: np.ndarray     # the distinct id pairs as a * ids of B + b


class Pair:
    """The two tokenizers with the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one core a task
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbol = byte_symbols()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            if all(c in symbol for c in piece):
                self.a_bytes[i] = bytes(symbol[c] for c in piece)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.a_text = [str(i) for i in range(len(self.a_bytes))]
        self.b_text = [str(i) for i in range(len(self.b_bytes))]
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(len(self.b_bytes))):
            raise ValueError("a piece has a word mark after other characters")

    def written(self, a: list[int], b: list[int], ga: np.ndarray, gb: np.ndarray) -> np.ndarray:
        """`a1,a2|b1;a3|b2,b3;` as a list: ids and marks of each group in order."""
        n = int(ga[-1]) + 1 if len(ga) else 0
        before_b = np.searchsorted(gb, np.arange(n))
        after_a = np.searchsorted(ga, np.arange(n), "right")
        out = np.empty(2 * (len(a) + len(b)), object)
        pa_, pb = np.arange(len(a)) + before_b[ga], np.arange(len(b)) + after_a[gb]
        out[2 * pa_] = list(map(self.a_text.__getitem__, a))
        out[2 * pb] = list(map(self.b_text.__getitem__, b))
        last_a = np.concatenate([ga[1:] != ga[:-1], [True]])[:len(a)]
        last_b = np.concatenate([gb[1:] != gb[:-1], [True]])[:len(b)]
        out[2 * pa_ + 1] = np.where(last_a, "|", ",")
        out[2 * pb + 1] = np.where(last_b, ";", ",")
        return out

    def encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B, a space before each text; None where the bytes of
        either are not the text's."""
        spaced = [" " + t for t in texts]
        a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        made_a, made_b = ([b"".join(map(known.__getitem__, x)) for x in ids]
                          for ids, known in ((a, self.a_bytes), (b, self.b_bytes)))
        return [(x, y) if p == q == t.encode() else None
                for x, y, p, q, t in zip(a, b, made_a, made_b, spaced)]

    def tokens(self, parts: list[str], joined: int) -> tuple[np.ndarray, ...]:
        """(good, n_a, n_b, ids of A, ids of B) of the parts. Up to ``joined``
        parts are encoded as one text, which both tokenizers cut again at
        their ends; parts with white space at an end, and those of a text
        whose bytes differ, are encoded alone."""
        edge = [i for i, p in enumerate(parts) if p[0].isspace() or p[-1].isspace()]
        bounds = sorted({*range(0, len(parts), joined), *edge, *(i + 1 for i in edge), len(parts)})
        spans = list(pairwise(bounds))
        found = self.encoded([" ".join(parts[i:j]) for i, j in spans])
        odd = [k for (i, j), f in zip(spans, found) for k in range(i, j) if not f and j > i + 1]
        alone = dict(zip(odd, self.encoded([parts[k] for k in odd])))
        got = [x for (i, j), f in zip(spans, found)
               for x in ([alone[k] for k in range(i, j)] if i in alone else [f])]
        good = np.ones(len(parts), bool)
        good[[i for (i, _), f in zip(spans, found) if not f and i not in alone]] = False
        good[[k for k, f in alone.items() if not f]] = False
        size = np.fromiter(map(len, map(str.encode, parts)), np.int64, len(parts)) + 1
        ends = np.cumsum(np.where(good, size, 0))
        out = []
        for side, known in enumerate((self.a_size, self.b_size)):
            ids = np.fromiter(chain.from_iterable(x[side] for x in got if x), np.int64)
            closed = np.concatenate([[0], np.cumsum(known[ids])])
            last = np.searchsorted(closed, ends, "right") - 1
            if (closed[last] != ends).any():       # a token runs over a part's end
                return self.tokens(parts, 1)
            out.append((np.diff(last, prepend=0), ids))
        (n_a, xa), (n_b, xb) = out
        return good, n_a, n_b, xa, xb

    def align(self, parts: list[str]) -> Parts:
        """Encodes and aligns parts of texts, a space before each, some at a time."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // ALIGNED)) + 1
        return joined_parts([self.aligned(parts[i:j])
                             for i, j in pairwise([0, *cuts.tolist(), len(parts)])])

    def aligned(self, parts: list[str]) -> Parts:
        good, n_a, n_b, xa, xb = self.tokens(parts, JOINED)
        ga, gb = groups_of(np.cumsum(self.a_size[xa]), np.cumsum(self.b_size[xb]))
        at, pair, links = shared_group_links(xa, ga, np.repeat(np.arange(len(parts)), n_a), xb, gb,
                                             len(self.b_bytes))
        pairs, column = np.unique(pair, return_inverse=True)
        start = np.searchsorted(at, np.arange(len(parts) + 1))
        closed = np.concatenate([[0], ga + 1])
        ends_a = np.concatenate([[0], np.cumsum(n_a)])
        n_groups = closed[ends_a[1:]] - closed[ends_a[:-1]]
        ends = (2 * (ends_a + np.concatenate([[0], np.cumsum(n_b)]))).tolist()
        marks = self.written(xa.tolist(), xb.tolist(), ga, gb).tolist()
        text = ["".join(marks[i:max(i, j - 1)]) for i, j in zip(ends, ends[1:])]
        return Parts(good, n_a, n_b, n_groups, text, CSR(start, column, links), pairs)


def joined_parts(some: list[Parts]) -> Parts:
    """One after the other, over the pairs of all."""
    pairs = np.unique(np.concatenate([x.pairs for x in some]))
    column = [np.searchsorted(pairs, x.pairs)[x.links.col] for x in some]
    size = np.concatenate([np.diff(x.links.start) for x in some])
    links = CSR(np.concatenate([[0], np.cumsum(size)]), np.concatenate(column),
                np.concatenate([x.links.val for x in some]))
    good, n_a, n_b, n_groups = (np.concatenate(c) for c in list(zip(*some))[:4])
    return Parts(good, n_a, n_b, n_groups, [t for x in some for t in x.text], links, pairs)


@lru_cache(maxsize=2)
def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


# -------------------------------------------------------------------- blocks

def shared_group_links(a_ids: np.ndarray, ga: np.ndarray, part: np.ndarray, b_ids: np.ndarray,
                       gb: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, pair, links) of the products of id-by-group incidences; groups
    are numbered over all parts, a pair is a * ``width`` + b."""
    if not len(a_ids):
        return (np.zeros(0, np.int64),) * 3
    ids = int(a_ids.max()) + 1
    key, row = np.unique(part * ids + a_ids, return_inverse=True)
    left, right = CSR.of(row, ga, len(key)), CSR.of(gb, b_ids, int(ga[-1]) + 1)
    out = []
    for first, links in row_products(left, right):
        at = key[first + np.repeat(np.arange(links.rows), np.diff(links.start))]
        out.append((at // ids, at % ids * width + links.col, links.val))
    return tuple(np.concatenate(c) for c in zip(*out))


def block_row(pair: Pair, block: int, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """A block's pieces, a row each: the digests of some texts, their links by
    pair, and some of the block's distinct pairs."""
    place: dict[str, int] = defaultdict(count().__next__)     # no cycle: gc is off here
    inside = [list(map(place.__getitem__, CUT.split(t))) if t else [] for t in texts]
    parts = pair.align(list(place))
    if not parts.good.all():
        ok = parts.good.tolist()
        inside = [x if all(map(ok.__getitem__, x)) else [] for x in inside]
    size = np.fromiter(map(len, inside), np.int64, len(texts))
    by_text = CSR.of(np.repeat(np.arange(len(texts)), size),
                     np.fromiter(chain.from_iterable(inside), np.int64, size.sum()), len(texts))
    n_a, n_b, n_groups = (weighted(by_text, x) for x in (parts.n_a, parts.n_b, parts.n_groups))
    sha = [hashlib.sha256(";".join(map(parts.text.__getitem__, x)).encode()).hexdigest()
           if x else "" for x in inside]
    got = [(lo + np.repeat(np.arange(m.rows), np.diff(m.start)), m.col, m.val)
           for lo, m in row_products(by_text, parts.links)]
    doc, column, links = (np.concatenate(c) for c in zip(*got))
    used, which = np.unique(column, return_inverse=True)     # not those of texts without tokens
    start = np.searchsorted(doc, np.arange(len(texts) + 1))
    held, pairs = np.bincount(which, minlength=len(used)), parts.pairs[used]
    cuts = piece_cuts(start)
    some = np.minimum(np.arange(len(cuts)) * PIECE, len(pairs))     # pairs are dealt to pieces
    some[-1] = len(pairs)
    lists = lambda x, at, t: pa.ListArray.from_arrays(
        pa.array(at, pa.int32()), pa.array(x, t))
    begins = [start[i:j + 1] - start[i] for i, j in pairwise(cuts)]
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(begins), pa.int64()), pa.array(range(len(begins)), pa.int32()),
         pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids),
         lists(n_a, cuts, pa.int64()), lists(n_b, cuts, pa.int64()),
         lists(n_groups, cuts, pa.int64()), lists(sha, cuts, pa.string()),
         pa.array(begins, pa.list_(pa.int32())), lists(which, start[cuts], pa.int32()),
         lists(links, start[cuts], pa.int64()), lists(pairs, some, pa.int64()),
         lists(held, some, pa.int32())],
        names=["block", "no", "ids", "n_a", "n_b", "n_groups", "sha", "start", "which", "links",
               "pairs", "texts"])


def piece_cuts(start: np.ndarray) -> list[int]:
    """Texts at which pieces begin, and the end: at most ``PIECE`` entries or
    one text in each."""
    cuts, last = [0], len(start) - 1
    while cuts[-1] < last:
        fits = int(np.searchsorted(start, start[cuts[-1]] + PIECE, "right")) - 1
        cuts.append(min(last, max(cuts[-1] + 1, fits)))
    return cuts


def blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """The stored pieces of the blocks of all texts."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"block bigint, no int, ids array<{id_type}>, n_a array<bigint>, "
              "n_b array<bigint>, n_groups array<bigint>, sha array<string>, start array<int>, "
              "which array<int>, links array<bigint>, pairs array<bigint>, texts array<int>")

    def pieces(block, ids, texts):
        made = block_row(tokenizer_pair(a_path, b_path), block, pa.concat_arrays(ids), texts)
        return (made.slice(i, 1) for i in range(made.num_rows))

    def run(batches):
        made = 0
        base = TaskContext.get().partitionId() << 33      # numbers of this task's blocks
        gc.disable()              # no cycles here, but millions of small lists to walk
        try:
            ids, texts, size = [], [], 0              # the open block
            for batch in batches:
                col, lo = batch.column(id_col), 0
                for i, text in enumerate(batch.column(text_col).to_pylist()):
                    n = len(text or "")
                    if texts and (len(texts) >= BLOCK_ROWS or size + n > BLOCK_BYTES):
                        yield from pieces(base + made, [*ids, col[lo:i]], texts)
                        made, lo, ids, texts, size = made + 1, i, [], [], 0
                    texts.append(text)
                    size += n
                ids.append(col[lo:])
            if texts:
                yield from pieces(base + made, ids, texts)
        finally:
            gc.enable()
    return staged(docs.select(id_col, text_col).mapInArrow(run, schema), "blocks",
                  **{"parquet.block.row.count.limit": GROUP})


# --------------------------------------------------------------- corpus counts

def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): texts that hold an id pair, and whether no other
    pair of its A id is held by more. An A id has at most ``width`` pairs."""
    held = rows.select(F.explode(F.arrays_zip("pairs", "texts")).alias("p"))
    counts = held.groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.texts").alias("count")).withColumn("a", F.floor(F.col("pair") / width))
    top = F.max("count").over(Window.partitionBy("a"))
    return staged(counts.select("pair", "count", (F.col("count") == top).alias("best")), "counts")


def told_texts(batches):
    """Texts of the pieces, a batch each: the piece's matrix of links times the
    counts. Rows come by block, what its pieces' pairs were told before the pieces."""
    block, told, counts, best = None, [], None, None
    for batch in batches:
        heard, piece = batch.column("told"), batch.column("piece")
        for k, at in enumerate(batch.column("block").to_pylist()):
            if at != block:
                block, told, counts = at, [np.zeros((2, 0), np.int64)], None
            if piece[k].is_valid:
                if counts is None:                         # in the order of the block's pairs
                    pair, value = np.concatenate(told, axis=1)
                    value = value[np.argsort(pair)]
                    counts, best, told = value >> 1, value & 1, []
                yield told_piece(piece, k, counts, best)
            else:
                told.append(np.stack([np.asarray(heard[k].values.field(f)) for f in (0, 1)]))


def told_piece(piece: pa.StructArray, k: int, counts: np.ndarray,
               best: np.ndarray) -> pa.RecordBatch:
    get = lambda name: piece.field(name)[k].values
    matrix = CSR(*(get(c).to_numpy() for c in ("start", "which", "links")))
    n_links, n_best, total = (weighted(matrix, x) for x in
                              (np.ones(len(counts), np.int64), best, counts))
    return pa.RecordBatch.from_arrays(
        [get("ids"), get("n_a"), get("n_b"), get("n_groups"), pa.array(n_links),
         pa.array(n_best), pa.array(total), get("sha")],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
               "groups_sha256"])


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    per row of ``docs``; A is a byte-level vocabulary of the tokenizers library,
    B a sentencepiece model."""
    id_type = docs.schema[id_col].dataType.simpleString()
    width = len(tokenizer_pair(a_path, b_path).b_bytes)
    rows = blocks(docs, a_path, b_path, id_col, text_col)
    asked = rows.select("block", "no", F.explode("pairs").alias("pair"))
    value = F.col("count") * 2 + F.col("best").cast("int")
    told = (asked.join(pair_counts(rows, width).hint("merge"), "pair").groupBy("block", "no")
            .agg(F.collect_list(F.struct("pair", value.alias("value"))).alias("told")).drop("no"))
    pieces = rows.select("block", F.struct("ids", "n_a", "n_b", "n_groups", "sha", "start",
                                           "which", "links").alias("piece"))
    answered = (told.unionByName(pieces, allowMissingColumns=True).repartition("block")
                .sortWithinPartitions("block", F.col("piece").isNotNull()))
    return answered.mapInArrow(told_texts, f"doc_id {id_type}, n_a bigint, n_b bigint, "
                               "n_groups bigint, n_links bigint, n_best bigint, "
                               "count_sum bigint, groups_sha256 string")
