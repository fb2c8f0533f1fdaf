"""Operator 4: token counts by heap-and-linked-list byte-pair merging.

The vocabulary of a BPE piece model is read as a table piece -> rank (0 is
merged first). A text is cut where no merge can cross (before a run of word
marks, around characters that no longer piece contains); each part starts as
one symbol per character, a heap holds the mergeable adjacent pairs by (rank,
position) and a doubly linked list the live symbols. The lowest pair is popped,
merged and its two new neighbour pairs are pushed until the heap is empty. The
count is the number of initial symbols minus the number of merges; characters
without a piece count one per UTF-8 byte (byte fallback). No ids are built.

Defined cases: NULL text is empty; an empty text has 0 tokens and 0 bytes;
texts are never cut; repeated rows and NULL ids give one row each; other
columns of the input are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import BoundedCache, map_batches, texts_of

MARK = "▁"  # the word mark that stands for a space


def merge_count(part: str, rank: dict[str, int]) -> int:
    """Number of merges that byte-pair merging performs on ``part``."""
    n = len(part)
    heap = []
    for i in range(n - 1):
        r = rank.get(part[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapify(heap)
    stop = list(range(1, n + 1))      # end of the symbol that starts here; -1: absorbed
    back = list(range(-1, n))         # start of the symbol before the one that starts here
    merges = 0
    while heap:
        _, left, mid, end = heappop(heap)
        if stop[left] != mid or stop[mid] != end:
            continue                  # one side has changed since the push
        stop[left], stop[mid] = end, -1
        back[end] = left
        merges += 1
        before = back[left]
        if before >= 0:
            r = rank.get(part[before:end])
            if r is not None:
                heappush(heap, (r, before, left, end))
        if end < n:
            after = stop[end]
            r = rank.get(part[left:after])
            if r is not None:
                heappush(heap, (r, left, end, after))
    return merges


class PieceCounter:
    """Counts for a sentencepiece BPE model with identity normalisation."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if (spec.model_type != spec.BPE or not spec.byte_fallback or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or not norm.add_dummy_prefix or spec.treat_whitespace_as_suffix
                or any(p.type in (4, 5) for p in model.pieces)):
            raise ValueError("needs a BPE model with byte fallback, identity normalisation, "
                             "a dummy prefix and no user-defined or unused pieces")
        plain = [(p.score, i, p.piece) for i, p in enumerate(model.pieces) if p.type == 1]
        order = {s: r for r, s in enumerate(sorted({s for s, _, _ in plain}, reverse=True))}
        self.rank = {piece: order[score] for score, _, piece in plain}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece has a word mark after other characters")
        if any(ch not in self.rank for p in self.rank for ch in p):
            raise ValueError("a piece holds a character that is no piece itself")
        # a line feed splits too when no longer piece contains it
        lone = "\n" if not any("\n" in p for p in self.rank if len(p) > 1) else ""
        self.parts = re.compile(f" +[^ {lone}]*|[^ {lone}]+" + (f"|{lone}" if lone else "")).findall
        self.cache = BoundedCache(self.count_part, 800_000)

    def count_part(self, part: str) -> int:
        part = part.replace(" ", MARK)
        symbols = len(part)
        for ch in part:
            if ch not in self.rank:
                symbols += len(ch.encode()) - 1
        return symbols - merge_count(part, self.rank)

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.cache.__getitem__, self.parts(" " + text.replace(MARK, " "))))


@lru_cache(maxsize=2)
def counter(model_path: str) -> PieceCounter:
    return PieceCounter(model_path)


def token_counts(docs: DataFrame, model_path: str, max_tokens: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row, one pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        c = counter(model_path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch, text_col)
            n = [c.count(t) for t in texts]
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > max_tokens for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
        return run

    return map_batches(docs.select(id_col, text_col), make,
                       f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
