"""Operator 8: repeated byte strings by distributed prefix doubling.

Positions of all texts are ranked by the strings that start there; equal
strings share a rank. The rank at twice the length is that of the pair (rank
at p, rank at p + h). Each round Spark groups the rank column and drops
positions whose rank is unique, since nothing longer at them can repeat; the
rounds end at the threshold ``length``.

Neighbouring positions travel together: a start's string of ``length`` bytes
holds a window of half strings, and the smallest rank in that window is the
same wherever the string occurs. So the first round, at half the length, lists
one row per run of starts with the same smallest rank (some 1 in 100 bytes)
and drops the runs whose rank is unique. In the second round a run whose whole
string (its starts and the ``length`` bytes after them) occurs twice is settled.
The third lists single positions, of the other runs and of one run for each
settled string that shares their rank, with the doubled pair ranks, and keeps
those that repeat.

Ranks are 64-bit hashes. Rank counts are partial aggregates, so a passage in a
third of all texts is never gathered; texts are read again only for runs that
are not settled, and to cut.

Defined cases: NULL text is empty; matches never cross texts; a text shorter
than ``length`` keeps everything; repeated rows (same id, same text) are two
places, so both lose what they share; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.byte_ranks import Ranks, doubled, occurrences, window_minima
from marketlake.llm.common import SMALL_BYTES, map_batches, sized, staged, texts_of

def _long(x) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.uint64).view(np.int64))


def runs(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, lo, hi, small, whole, times): runs of starts lo..hi
    whose strings share the smallest half rank; ``whole`` ranks all their
    bytes and ``times`` counts the rank inside the run (periodic texts)."""
    half = length // 2
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, cols = [], [[] for _ in range(5)]
            for i, text in enumerate(texts_of(batch, text_col)):
                data = text.encode()
                if len(data) < length:
                    continue
                ranks = Ranks(data)
                h = ranks.all_of(half)
                small = window_minima(h, length - half + 1)
                cut = np.flatnonzero(small[1:] != small[:-1]) + 1
                lo = np.concatenate([[0], cut])
                hi = np.concatenate([cut - 1, [len(small) - 1]])
                row.append(np.full(len(lo), i))
                for c, x in zip(cols, (lo, hi, small[lo], ranks.of(lo, hi - lo + length),
                                       occurrences(h, lo, hi + length - half, small[lo]))):
                    c.append(x)
            if not row:
                return None
            lo, hi, small, whole, times = (np.concatenate(c) for c in cols)
            at = pa.array(np.concatenate(row))
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(at), batch.column("text_key").take(at),
                 pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                 _long(small), _long(whole), pa.array(times.astype(np.int32))],
                names=["doc_id", "text_key", "lo", "hi", "small", "whole", "times"])
        return run

    return map_batches(keyed(docs, id_col, text_col), make,
                       f"doc_id {id_type}, text_key bigint, lo int, hi int, small bigint, "
                       "whole bigint, times int")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(id_col, text_col, F.xxhash64(text_col).alias("text_key"))


def pair_ranks(docs: DataFrame, listed: DataFrame, length: int, id_col: str,
               text_col: str) -> DataFrame:
    """(doc_id, text_key, pos, weight, rank): the positions of the listed runs
    with the rank of their ``length`` bytes, doubled from halves."""
    half = length // 2
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, pos, weight, rank = [], [], [], []
            for i, (text, found) in enumerate(zip(texts_of(batch, text_col),
                                                  batch.column("runs").to_pylist())):
                h = Ranks(text.encode()).all_of(half)
                for r in found:
                    p = np.arange(r["lo"], r["hi"] + 1)
                    row.append(np.full(len(p), i))
                    pos.append(p)
                    weight.append(np.full(len(p), r["weight"]))
                    rank.append(doubled(h, half, p))
            if not row:
                return None
            at = pa.array(np.concatenate(row))
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(at), batch.column("text_key").take(at),
                 pa.array(np.concatenate(pos).astype(np.int32)),
                 pa.array(np.concatenate(weight).astype(np.int32)),
                 _long(np.concatenate(rank))],
                names=["doc_id", "text_key", "pos", "weight", "rank"])
        return run

    lists = listed.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("lo", "hi", "weight")).alias("runs"))
    # one text of each (id, text) pair: its repeats would count as places
    texts = with_lists(docs, lists, id_col, text_col).dropDuplicates([id_col, "text_key"])
    return map_batches(texts.select(id_col, text_col, "text_key", "runs"), make,
                       f"doc_id {id_type}, text_key bigint, pos int, weight int, rank bigint")


def with_lists(docs: DataFrame, lists: DataFrame, id_col: str, text_col: str,
               how: str = "inner") -> DataFrame:
    lists = staged(lists.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
                                "runs"), "run-lists")
    # 16 bytes a run, and its keys
    size = lists.agg(F.sum(16 * F.size("runs") + 16 + F.coalesce(
        F.octet_length(F.col("_id").cast("string")), F.lit(0)))).first()[0] or 0
    if size <= SMALL_BYTES:
        lists = F.broadcast(lists)
    same: Column = F.col(id_col).eqNullSafe(F.col("_id")) \
        & F.col("text_key").eqNullSafe(F.col("_key"))
    return keyed(docs, id_col, text_col).join(lists, same, how).drop("_id", "_key")


def covered(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, lo, hi): runs of starts whose ``length`` bytes repeat."""
    every = staged(runs(docs, length, id_col, text_col), "runs")
    again = staged(every.groupBy("small").agg(F.sum("times").alias("n")).filter("n > 1")
                   .select("small"), "half-ranks")
    some = staged(every.join(sized(again), "small"), "half-runs")

    kinds = staged(some.groupBy("small", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.max("times").alias("times"),
        F.min(F.struct("doc_id", "text_key", "lo", "hi")).alias("one")), "run-kinds")
    settled = some.join(sized(staged(kinds.filter("n > 1").select("whole").distinct(),
                                     "settled")), "whole")
    open_ranks = kinds.groupBy("small").agg(F.sum("times").alias("places"),
                                            F.min("n").alias("least")
                                            ).filter("places > 1 AND least = 1").select("small")
    listed = kinds.join(open_ranks, "small").select(
        "one.*", F.when(F.col("n") > 1, 2).otherwise(1).alias("weight"))
    single = staged(pair_ranks(docs, listed, length, id_col, text_col), "positions")
    twice = staged(single.groupBy("rank").agg(F.sum("weight").alias("w"),
                                              F.min("weight").alias("least"))
                   .filter("w > 1 AND least = 1").select("rank"), "repeated-ranks")
    # ranks grow with the positions: shuffled alike at every size
    ones = single.filter("weight = 1").join(twice.hint("merge"), "rank").select(
        "doc_id", "text_key", F.col("pos").alias("lo"), F.col("pos").alias("hi"))
    return settled.select("doc_id", "text_key", "lo", "hi").unionByName(ones)


def joined_runs(lists: DataFrame) -> DataFrame:
    """The lists with overlapping and adjacent runs joined."""
    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, los, his = [], [], []
            for found in batch.column("runs"):
                lo, hi = (x.to_numpy() for x in found.values.flatten())
                order = np.argsort(lo, kind="stable")
                lo, reach = lo[order], np.maximum.accumulate(hi[order])
                first = np.concatenate([[True], lo[1:] > reach[:-1] + 1])
                last = np.concatenate([first[1:], [True]])
                los.append(lo[first])
                his.append(reach[last])
                sizes.append(int(first.sum()))
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(los), pa.int32()),
                                                pa.array(np.concatenate(his), pa.int32())],
                                               names=["lo", "hi"])
            runs = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pairs)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), runs],
                names=["doc_id", "text_key", "runs"])
        return run

    return map_batches(lists.select("doc_id", "text_key", "runs"), make,
                       lists.select("doc_id", "text_key", "runs").schema)


def kept_parts(data: bytes, lo: np.ndarray, hi: np.ndarray, length: int
               ) -> tuple[list[bytes], int, int]:
    """What is left of ``data``, bytes removed, maximal removed runs."""
    mark = np.zeros(len(data) + 1, np.int32)
    np.add.at(mark, lo, 1)
    np.add.at(mark, np.minimum(hi + length, len(data)), -1)
    out = np.cumsum(mark[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]])))
    starts, ends = edge[::2], edge[1::2]
    cuts = np.concatenate([[0], np.stack([starts, ends], 1).reshape(-1), [len(data)]])
    parts = [data[cuts[i]:cuts[i + 1]] for i in range(0, len(cuts), 2)]
    return parts, int(out.sum()), len(starts)


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    if length % 2:
        raise ValueError("length must be even")
    id_type = docs.schema[id_col].dataType.simpleString()
    # a set: repeated rows have the same runs, whatever their number
    lists = joined_runs(covered(docs, length, id_col, text_col).groupBy(
        "doc_id", "text_key").agg(F.collect_set(F.struct("lo", "hi")).alias("runs")))

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            size, gone, spans, sha = [], [], [], []
            for text, found in zip(texts_of(batch, text_col), batch.column("runs")):
                data = text.encode()
                parts, removed, count = [data], 0, 0
                if found.is_valid:
                    lo, hi = (x.to_numpy() for x in found.values.flatten())
                    parts, removed, count = kept_parts(data, lo, hi, length)
                digest = hashlib.sha256()
                for p in parts:
                    digest.update(p)
                size.append(len(data))
                gone.append(removed)
                spans.append(count)
                sha.append(digest.hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        return run

    texts = with_lists(docs, lists, id_col, text_col, "left").select(id_col, text_col, "runs")
    return map_batches(texts, make, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, "
                                    "n_spans bigint, kept_sha256 string")


# Every 400-byte string of every row, found block by block as hexadecimal text.
ORACLE = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h
    FROM documents),
blocks AS (
    SELECT r, b, substr(h, 800 * b + 1, 1600) AS part
    FROM (SELECT r, h, unnest(range(0, length(h) // 800 + 1)) AS b FROM texts)),
strings AS (
    SELECT r, 400 * b + i AS p, md5(substr(part, 2 * i + 1, 800)) AS k
    FROM (SELECT r, b, part, unnest(range(0, least(400, greatest(0, length(part) // 2 - 399)))) AS i
          FROM blocks)),
repeated AS (SELECT k FROM strings GROUP BY k HAVING count(*) > 1),
starts AS (SELECT r, p FROM strings SEMI JOIN repeated USING (k)),
marked AS (
    SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 400
                      THEN 0 ELSE 1 END AS opens
    FROM starts),
numbered AS (SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS span FROM marked),
spans AS (SELECT r, span, min(p) AS lo, max(p) + 400 AS hi FROM numbered GROUP BY r, span),
edges AS (
    SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since
    FROM spans),
kept AS (
    SELECT r, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last,
           string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS before
    FROM edges JOIN texts USING (r) GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""
