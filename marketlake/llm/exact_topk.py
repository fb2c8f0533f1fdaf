"""Operator 12: exact top-k inner products by term-at-a-time accumulation.

A vector is a sparse row of integer weights, floor(scale * x), whose terms are
its component numbers. Candidates are dealt into slices and queries into
groups of bounded size, and every (slice, group) cell is one run of rows of a
shuffled, sorted stream: first the slice's candidates, turned into postings
(term -> candidate, weight) of a hand-built CSR, then the group's queries. Each
query scatters its terms' weighted postings, one term after the other, into a
dense array of scores; a partition selection keeps the cell's best k, and a
second selection by query merges the cells. All queries meet all rows; a task
holds the candidates of one cell.

Scores are exact: an array of 32-bit or 64-bit floats is used only where no
partial sum can pass the integers that it holds exactly, else Python integers
(a score beyond 64 bits counts as the nearest long).

Defined cases: vectors that are NULL or hold NULL or non-finite components take
no part; an empty vector scores 0; missing components of a shorter vector are
0; a row with a NULL id is no query and, as a candidate, comes last among ties;
repeated rows are rows like others: a query leaves out its own row only, each
repeated query row returns its own results; of equal scores and ids the
first stored comes first; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import staged

SIDE = 8_192          # rows of a slice, queries of a group: what a task holds
MAX_TASKS = 50_000    # shuffle partitions; more cells than that share tasks
SCALE = 256

HIT = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


class Postings:
    """Candidates of a cell: rows, ids and postings by term."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, known: np.ndarray,
                 sizes: np.ndarray, weights: np.ndarray):
        self.rows, self.ids, self.known = rows, ids, known
        self.place = {r: i for i, r in enumerate(rows.tolist())}
        cand = np.repeat(np.arange(len(rows)), sizes)
        term = np.arange(len(weights)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        some = weights != 0
        cand, term, weights = cand[some], term[some], weights[some]
        order = np.argsort(term, kind="stable")
        self.cand, self.weight = cand[order], weights[order]
        self.start = np.searchsorted(term[order], np.arange(int(sizes.max(initial=0)) + 1))
        self.largest = float(np.abs(weights).max(initial=0))
        self.typed = {t: self.weight.astype(t) for t in (np.float32, np.float64)}

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Dense scores of all candidates, one term of the query at a time."""
        bound = float(np.abs(query).sum()) * self.largest
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object
        if kind is object:
            weight = np.array([int(w) for w in self.weight], object)
            query = np.array([int(w) for w in query], object)
        else:
            weight, query = self.typed[kind], query.astype(kind)
        n = len(self.rows)
        out = np.zeros(n, kind)
        for term in np.flatnonzero(query[:len(self.start) - 1] != 0):
            lo, hi = self.start[term], self.start[term + 1]
            if hi - lo == n:                       # the term is in every candidate
                out += query[term] * weight[lo:hi]
            else:
                out[self.cand[lo:hi]] += query[term] * weight[lo:hi]
        return long_of(out) if kind is object else out

    def best(self, row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best k candidates other than ``row``."""
        score = self.scores(query)
        own = self.place.get(row)
        take = k if own is None else k + 1
        if take < len(score):
            at = np.flatnonzero(score >= np.partition(score, -take)[-take])
        else:
            at = np.arange(len(score))
        at = at[at != own] if own is not None else at
        order = np.lexsort((self.rows[at], self.ids[at], ~self.known[at], -score[at]))[:k]
        return at[order], score[at[order]]


def long_of(scores: np.ndarray) -> np.ndarray:
    top = (1 << 63) - 1
    return np.array([max(-top, min(top, int(x))) for x in scores], np.int64)


def search_cells(k: int, scale: int):
    """Streams sorted (slice, grp, side, row, vec_id, vector) rows to hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, built = None, [], None
        for batch in batches:
            slot, grp, side, row = (batch.column(c).to_numpy()
                                    for c in ("slice", "grp", "side", "row"))
            ids = batch.column("vec_id")
            known = np.asarray(ids.is_valid())
            ids = ids.fill_null(0).to_numpy()
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy()
            flat = np.floor(scale * vectors.flatten().to_numpy().astype(np.float64))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            turn = np.flatnonzero((slot[1:] != slot[:-1]) | (grp[1:] != grp[:-1])
                                  | (side[1:] != side[:-1])) + 1
            for lo, hi in zip(np.concatenate([[0], turn]),
                              np.concatenate([turn, [batch.num_rows]])):
                if lo == hi:
                    continue
                if cell != (slot[lo], grp[lo]):
                    cell, parts, built = (slot[lo], grp[lo]), [], None
                if side[lo] == 0:
                    parts.append((row[lo:hi], ids[lo:hi], known[lo:hi], sizes[lo:hi],
                                  flat[ends[lo]:ends[hi]]))
                    continue
                if not parts:
                    continue                       # no candidate was dealt to this cell
                if built is None:
                    built = Postings(*(np.concatenate(c) for c in zip(*parts)))
                found = [(q, *built.best(row[q], flat[ends[q]:ends[q + 1]], k))
                         for q in range(lo, hi)]
                at = np.concatenate([f[1] for f in found]).astype(np.int64)
                own = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
                score = np.concatenate([f[2].astype(np.int64) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[own]), pa.array(ids[own]), pa.array(built.rows[at]),
                     pa.array(built.ids[at], mask=~built.known[at]), pa.array(score)],
                    names=["query_row", "query_id", "row", "vec_id", "score"])
    return run


def usable_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, vector) of the vectors that take part, stored."""
    odd = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return staged(table.filter(F.col(vector_col).isNotNull() & ~odd).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).alias("vector")), "vectors")


def exact_top_k(table: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE,
                id_col: str = "vec_id", vector_col: str = "embedding",
                side: int = SIDE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``every``, the ``k`` other rows of highest integer inner product."""
    vectors = usable_vectors(table, id_col, vector_col)
    asked = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    n, q = vectors.agg(F.count(F.lit(1)), F.count_if(asked)).first()
    slices, groups = max(1, -(-n // side)), max(1, -(-q // side))
    deal = lambda parts, salt: F.pmod(
        F.xxhash64("row", F.lit(salt)), F.lit(parts)).cast("int")
    copies = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    candidates = vectors.select(deal(slices, 1).alias("slice"), copies(groups).alias("grp"),
                                F.lit(0).alias("side"), "row", "vec_id", "vector")
    queries = vectors.filter(asked).select(copies(slices).alias("slice"),
                                           deal(groups, 2).alias("grp"),
                                           F.lit(1).alias("side"), "row", "vec_id", "vector")
    # the number of cells, not of bytes, sets the tasks: a cell is work, not data
    cells = (candidates.unionByName(queries)
             .repartition(min(slices * groups, MAX_TASKS), "slice", "grp")
             .sortWithinPartitions("slice", "grp", "side", "row"))
    hits = cells.mapInArrow(search_cells(k, scale), HIT)
    order = Window.partitionBy("query_row").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH vec AS (SELECT row_number() OVER () u, vec_id,
                    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) w
             FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT q.u, q.vec_id query_id, c.u row_no, c.vec_id,
                CAST(list_inner_product(q.w, c.w) AS BIGINT) score
         FROM vec q JOIN vec c ON q.u <> c.u WHERE q.vec_id % 50 = 0),
ranked AS (SELECT query_id, vec_id, score, row_number() OVER (
                      PARTITION BY u ORDER BY score DESC, vec_id NULLS LAST, row_no) AS place
           FROM pair)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""
