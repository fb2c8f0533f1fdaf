"""Operator 2: embedding near-duplicates by NN-descent.

Equal vectors of a label are one node. Every node keeps a list of its ``k``
nearest known neighbours. In each part (label and size), lists start from
hyperplane buckets (several tables of sign bits, as many as the part's own rows
ask for, cut into chunks of bounded size) and from random chunks of the part,
so that a node alone in its buckets has neighbours to walk from. Then each
round joins neighbours of neighbours: around every node, its list and the nodes
that list it are compared with each other where one of the two entries is new,
and better neighbours replace worse ones. Rounds end when few lists change.
Recall is audited against brute force on a bounded sample: below the target,
the lists are enlarged and more tables and rounds follow. The audit sets the
effort only.

A list is saturated when all its k entries reach the threshold. An exact check
follows at every size of the input: all nodes whose lists are not saturated are
compared with all nodes of their part, block by block, and what the lists miss
is added. Saturated lists are enlarged to completeness: saturated nodes are cut
into blocks (by their component, so near neighbours share blocks), and each
pair of blocks whose angular balls come within the threshold is compared once.
A group of thousands of near copies thus costs block products and per-node
counts, never a row for each pair. The links of every node are so the true
ones, whatever the lists held; the exact check's products grow with the square
of a part.

Cosine is computed in double precision. Defined cases: vectors that are NULL,
empty, zero or hold NULL or non-finite components, rows with a NULL label and
rows with a NULL id link with nothing; vectors of different sizes never link;
repeated rows are copies and link with each other; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import map_batches, sized, staged
from marketlake.llm.components import components, spanning

CHUNK = 256          # nodes compared with each other when lists start
BLOCK = 512          # nodes of a block of saturated lists
SLICE = 8192         # nodes that the audit compares with all rows
CELL = 4096          # nodes of a side of the exact check's cells
STEP = 512           # nodes whose products a cell holds at a time
PIVOTS = 1500        # nodes whose neighbourhoods one task group compares


def matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows in double precision (all vectors of one size)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    # scaled first, so that squares of extreme components stay finite
    x = x / np.abs(x).max(1, keepdims=True, initial=1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid(vectors: DataFrame) -> DataFrame:
    """Rows that can link: (vec_id, part, embedding); part = label and size."""
    e = F.col("embedding")
    return (vectors.filter(_sound())
            .select("vec_id", F.struct(F.col("label"), F.size(e).alias("size")).alias("part"),
                    F.transform(e, lambda x: x + F.lit(0.0).cast("float")).alias("embedding")))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(node, part, copies, embedding): distinct vectors; node = smallest id."""
    return vectors.groupBy("part", "embedding").agg(F.min("vec_id").alias("node"),
                                                    F.count(F.lit(1)).alias("copies"))


# ------------------------------------------------------------- first lists

def bucketed(nodes: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """(table, code, node, part, embedding): sign codes of each table, of as
    many bits as the node's column ``bits`` says (``bits`` at most), and a
    last table with one code for all."""
    schema = nodes.select("node", "part", "embedding").schema

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            col = batch.column("embedding")
            sizes = np.diff(col.offsets.to_numpy())
            codes = np.zeros((batch.num_rows, tables + 1), np.int64)
            mask = (1 << batch.column("bits").to_numpy().astype(np.int64)) - 1
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = matrix(col.take(pa.array(at)))
                planes = np.random.default_rng([seed, int(size)]).normal(
                    size=(int(size), tables * bits))
                signs = (x @ planes > 0).reshape(len(at), tables, bits)
                codes[at, :tables] = signs @ (1 << np.arange(bits)) & mask[at, None]
            at = pa.array(np.repeat(np.arange(batch.num_rows), tables + 1))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(tables + 1), batch.num_rows)),
                 pa.array(codes.reshape(-1)), *[batch.column(c).take(at) for c in schema.names]],
                names=["table", "code", *schema.names])
        return run

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return map_batches(nodes.select(*schema.names, "bits"), make, f"table bigint, code bigint, {fields}")


def _best(u: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> pa.Table:
    """The k best entries of each list."""
    order = np.lexsort((v, -s, u))
    u, v, s = u[order], v[order], s[order]
    first = np.concatenate([[True], (u[1:] != u[:-1])]) if len(u) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(u)), 0))
    keep = np.arange(len(u)) - start < k
    return pa.table({"u": u[keep], "v": v[keep], "s": s[keep]})


def _nearest(t: pa.Table, k: int) -> pa.Table:
    """(u, v, s): the k nearest neighbours of each node among the others."""
    ids, x = t["node"].to_numpy(), matrix(t["embedding"])
    s = x @ x.T
    np.fill_diagonal(s, -2)
    few = min(k, len(ids) - 1)
    if few < 1:
        return pa.table({"u": ids[:0], "v": ids[:0], "s": s[:0, 0]})
    at = np.argpartition(-s, few - 1, axis=1)[:, :few]
    u = np.repeat(np.arange(len(ids)), few)
    return pa.table({"u": ids[u], "v": ids[at.reshape(-1)], "s": s[u, at.reshape(-1)]})


def first_lists(nodes: DataFrame, k: int, tables: int, bits: int, seed: int) -> DataFrame:
    """(u, v, s): the k best neighbours of each node within its chunks."""
    def compare(t: pa.Table) -> pa.Table:
        return _nearest(t, k)

    rows = bucketed(nodes, tables, bits, seed)
    sizes = rows.groupBy("part", "table", "code").agg(F.count(F.lit(1)).alias("n"))
    dealt = rows.join(sizes, ["part", "table", "code"]).withColumn(
        "deal", F.pmod(F.xxhash64("node", "table", F.lit(seed)), F.ceil(F.col("n") / CHUNK)))
    found = dealt.select("part", "table", "code", "deal", "node", "embedding").groupBy(
        "part", "table", "code", "deal").applyInArrow(compare, "u bigint, v bigint, s double")
    return found


def trimmed(entries: DataFrame, k: int) -> DataFrame:
    """The k best distinct entries of each list."""
    one = entries.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return one.withColumn("r", rank).filter(F.col("r") <= k).drop("r")


# ----------------------------------------------------------------- descent

def around(lists: DataFrame, k: int) -> DataFrame:
    """(pivot, x, new): each node's list and up to k of the nodes listing it
    (the nearest ones), with the node itself as an old entry."""
    back = lists.select(F.col("v").alias("pivot"), F.col("u").alias("x"), "s", "new")
    rank = F.row_number().over(Window.partitionBy("pivot").orderBy(F.desc("s"), "x"))
    back = back.withColumn("r", rank).filter(F.col("r") <= k).select("pivot", "x", "new")
    ahead = lists.select(F.col("u").alias("pivot"), F.col("v").alias("x"), "new")
    return ahead.union(back).groupBy("pivot", "x").agg(F.max("new").alias("new"))


def joined(nodes: DataFrame, lists: DataFrame, k: int, n: int) -> DataFrame:
    """(u, v, s): pairs around a pivot that beat the worst entry of u's list."""
    worst = lists.groupBy("u").agg(F.when(F.count(F.lit(1)) >= k, F.min("s"))
                                   .otherwise(-2.0).alias("worst"))
    rows = (around(lists, k).join(nodes.select(F.col("node").alias("x"), "embedding"), "x")
            .join(worst.withColumnRenamed("u", "x"), "x", "left")
            .withColumn("deal", F.pmod(F.xxhash64("pivot"), F.lit(n // PIVOTS + 1))))

    def compare(t: pa.Table) -> pa.Table:
        pivot = t["pivot"].to_numpy()
        order = np.argsort(pivot, kind="stable")
        cuts = np.flatnonzero(np.diff(pivot[order])) + 1
        ids, new = t["x"].to_numpy(), t["new"].to_numpy(zero_copy_only=False).astype(bool)
        worst = t["worst"].fill_null(-2.0).to_numpy()
        col = t["embedding"].combine_chunks()
        sizes = np.diff(col.offsets.to_numpy())
        u, v, s = [], [], []
        for size in np.unique(sizes):
            some = np.flatnonzero(sizes == size)
            x = np.zeros((len(sizes), int(size)))
            x[some] = matrix(col.take(pa.array(some)))
            for g in np.split(order, cuts):
                if sizes[g[0]] != size or not new[g].any():
                    continue
                c = x[g] @ x[g].T
                np.fill_diagonal(c, -2)
                good = (c > worst[g][:, None]) & (new[g][:, None] | new[g][None])
                a, b = np.nonzero(good)
                u.append(ids[g[a]])
                v.append(ids[g[b]])
                s.append(c[a, b])
        if not u:
            return pa.table({"u": ids[:0], "v": ids[:0], "s": worst[:0]})
        return pa.table({"u": np.concatenate(u), "v": np.concatenate(v), "s": np.concatenate(s)})

    return rows.select("deal", "pivot", "x", "new", "worst", "embedding").groupBy(
        "deal").applyInArrow(compare, "u bigint, v bigint, s double")


def descend(nodes: DataFrame, lists: DataFrame, k: int, n: int, rounds: int,
            settle: float) -> DataFrame:
    """Rounds of neighbours-of-neighbours joins until few entries are new."""
    for _ in range(rounds):
        better = joined(nodes, lists, k, n).withColumn("new", F.lit(True))
        old = lists.withColumn("new", F.lit(False))
        lists = staged(trimmed(old.unionByName(better), k), "neighbours")
        if lists.filter("new").count() <= settle * n * k:
            break
    return lists


def links_of(nodes: DataFrame, some: DataFrame, threshold: float, k: int) -> DataFrame:
    """(u, v): links of the nodes ``some`` (at most about SLICE) with all
    ``nodes``, in blocks of Arrow batches. Of a node with more than k links in
    a batch, the k best: it is saturated."""
    sample = some.select("node", "part", "embedding").toArrow()
    ids = sample["node"].to_numpy()
    by: dict[tuple, list[int]] = {}
    for i, p in enumerate(sample["part"].to_pylist()):
        by.setdefault((p["label"], p["size"]), []).append(i)
    queries = {p: (ids[at], pa.concat_arrays(sample["embedding"].take(pa.array(at)).chunks))
               for p, at in by.items()}

    def make():
        unit = {p: (q, matrix(y)) for p, (q, y) in queries.items()}

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            node = batch.column("node").to_numpy()
            rows: dict[tuple, list[int]] = {}
            for i, p in enumerate(batch.column("part").to_pylist()):
                rows.setdefault((p["label"], p["size"]), []).append(i)
            u, v, s = [node[:0]], [node[:0]], [np.zeros(0)]
            for p in rows.keys() & unit.keys():
                q, y = unit[p]
                at = np.array(rows[p])
                c = matrix(batch.column("embedding").take(pa.array(at))) @ y.T
                c[node[at][:, None] == q[None]] = -2
                a, b = np.nonzero(c >= threshold)
                u.append(q[b])
                v.append(node[at[a]])
                s.append(c[a, b])
            best = _best(np.concatenate(u), np.concatenate(v), np.concatenate(s), k)
            return best.select(["u", "v"]).combine_chunks().to_batches()[0] \
                if best.num_rows else None
        return run

    return staged(map_batches(nodes.select("node", "part", "embedding"), make,
                              "u bigint, v bigint"), "true-links")


def audit(nodes: DataFrame, lists: DataFrame, threshold: float, k: int, recall: float) -> bool:
    """Whether the lists hold the share ``recall`` of the true links of a
    sample of about SLICE nodes whose lists are not saturated."""
    open_ = staged(nodes.select("node", "part", "embedding").join(
        saturated(lists, threshold, k), "node", "left_anti"), "open")
    slices = max(1, math.ceil(open_.count() / SLICE))
    sample = open_.filter(F.pmod(F.xxhash64("node", F.lit(5)), F.lit(slices)) == 0)
    held = lists.filter(F.col("s") >= threshold).select("u", "v", F.lit(1).alias("held"))
    known, hits = links_of(nodes, sample, threshold, k).join(held, ["u", "v"], "left").agg(
        F.count(F.lit(1)), F.count("held")).first()
    return hits >= recall * known


def checked(nodes: DataFrame, lists: DataFrame, threshold: float, k: int) -> DataFrame:
    """(u, v): all links of the nodes whose lists are not saturated. Nodes are
    dealt to blocks within their part, and each pair of blocks is a cell whose
    nodes are compared. Of a node with more than k links in a cell, the k best:
    it is saturated."""
    full = saturated(lists, threshold, k).withColumn("full", F.lit(True))
    sizes = nodes.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("blocks"))
    dealt = (nodes.join(full, "node", "left").join(sizes, "part")
             .withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), "blocks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    sent = dealt.select("part", F.least("block", "other").alias("low"),
                        F.greatest("block", "other").alias("high"), "block", "node",
                        F.col("full").isNull().alias("open"), "embedding")

    def compare(t: pa.Table) -> pa.Table:
        low, high = t["low"][0].as_py(), t["high"][0].as_py()
        ids, x, block = t["node"].to_numpy(), matrix(t["embedding"]), t["block"].to_numpy()
        open_ = t["open"].to_numpy(zero_copy_only=False).astype(bool)
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        out = [pa.table({"u": ids[:0], "v": ids[:0], "s": np.zeros(0)})]
        for lo in range(0, len(a), STEP):
            some = a[lo:lo + STEP]
            c = x[some] @ x[b].T
            if low == high:
                c[ids[some][:, None] == ids[b][None]] = -2
            i, j = np.nonzero((c >= threshold) & (open_[some][:, None] | open_[b][None]))
            u, v, s = some[i], b[j], c[i, j]
            if low != high:                # the other side's view
                u, v, s = np.concatenate([u, v]), np.concatenate([v, u]), np.tile(s, 2)
            own = open_[u]
            out.append(_best(ids[u[own]], ids[v[own]], s[own], k))
        t = pa.concat_tables(out)
        return _best(*(t[c].to_numpy() for c in ("u", "v", "s")), k).select(["u", "v"])

    return staged(sent.groupBy("part", "low", "high").applyInArrow(
        compare, "u bigint, v bigint"), "checked")


# -------------------------------------------------------- saturated lists

def saturated(lists: DataFrame, threshold: float, k: int) -> DataFrame:
    return (lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("s"))
            .filter((F.col("n") >= k) & (F.col("s") >= threshold)).select(F.col("u").alias("node")))


def linked(lists: DataFrame, found: DataFrame, threshold: float,
           k: int) -> tuple[DataFrame, DataFrame]:
    """(a, b): the links of the lists and of the check; (node): the nodes with
    k links or more, whose links among each other are counted in blocks."""
    links = lists.filter(F.col("s") >= threshold).select("u", "v").union(found)
    near = staged(links.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
                  .distinct(), "near")
    full = staged(near.select(F.col("a").alias("node")).union(near.select("b"))
                  .groupBy("node").count().filter(F.col("count") >= k).select("node"), "full")
    return near, full


def complete(nodes: DataFrame, full: DataFrame, groups: DataFrame,
             threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links among the nodes of ``full``: (node, weight) link counts weighted
    by copies, and (a, b) links that connect what is linked."""
    rows = staged(nodes.join(full, "node").join(groups, "node")
                  .select("node", "part", "copies", "embedding", "component"), "saturated")
    sizes = rows.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    dealt = staged(rows.join(sizes, "component").withColumn("block", F.xxhash64(
        "component", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)))).drop("n"),
        "saturated-blocks")

    def ball(t: pa.Table) -> pa.Table:
        x = matrix(t["embedding"])
        centre = x.sum(0)
        norm = np.linalg.norm(centre)
        centre = centre / norm if norm > 0 else x[0]
        angle = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        return pa.table({"block": t["block"][:1], "part": t["part"][:1],
                         "centre": pa.array([centre], pa.list_(pa.float64())),
                         "angle": pa.array([angle])})

    part_type = nodes.schema["part"].dataType.simpleString()
    balls = staged(dealt.select("block", "part", "embedding").groupBy("block").applyInArrow(
        ball, f"block bigint, part {part_type}, centre array<double>, angle double"), "balls")
    reach = math.acos(threshold) + 1e-6
    other = balls.select(F.col("block").alias("block2"), F.col("part").alias("part2"),
                         F.col("centre").alias("centre2"), F.col("angle").alias("angle2"))
    cosine = F.aggregate(F.zip_with("centre", "centre2", lambda a, b: a * b), F.lit(0.0),
                         lambda a, b: a + b)
    between = F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0)))
    # blocks of saturated nodes of one label and size, near enough to link
    pairs = staged(balls.join(other, (F.col("part") == F.col("part2"))
                              & (F.col("block") <= F.col("block2")))
                   .filter(between <= F.col("angle") + F.col("angle2") + F.lit(reach))
                   .select("block", "block2"), "block-pairs")
    sides = pairs.select("block", "block2", F.lit(0).alias("side"), F.col("block").alias("own")) \
        .union(pairs.filter("block != block2")
               .select("block", "block2", F.lit(1), F.col("block2")))
    sent = sides.join(dealt.select(F.col("block").alias("own"), "node", "copies", "embedding"),
                      "own")

    def compare(t: pa.Table) -> pa.Table:
        side = t["side"].to_numpy()
        ids, copies, x = t["node"].to_numpy(), t["copies"].to_numpy(), matrix(t["embedding"])
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1) if (side == 1).any() else a
        link = x[a] @ x[b].T >= threshold
        if b is a:
            np.fill_diagonal(link, False)
        out = [(ids[a], link @ copies[b])]
        if b is not a:
            out.append((ids[b], link.T @ copies[a]))
        node = np.concatenate([o[0] for o in out])
        weight = np.concatenate([o[1] for o in out])
        ends = spanning(link, a, b, len(ids))
        p, q = ids[ends[:, 0]], ids[ends[:, 1]]
        return pa.table({
            "node": np.concatenate([node, p]),
            "weight": np.concatenate([weight, np.zeros(len(p), np.int64)]).astype(np.int64),
            "other": pa.array(np.concatenate([node, q]), mask=np.concatenate(
                [np.ones(len(node), bool), np.zeros(len(p), bool)]))})

    found = staged(sent.select("block", "block2", "side", "node", "copies", "embedding")
                   .groupBy("block", "block2").applyInArrow(
                       compare, "node bigint, weight bigint, other bigint"), "block-links")
    counts = found.filter("other IS NULL").groupBy("node").agg(F.sum("weight").alias("weight"))
    links = found.filter("other IS NOT NULL AND other != node").select(
        F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    return counts, links


# ------------------------------------------------------------------- query

def walk(nodes: DataFrame, n: int, bits: int, threshold: float, k: int, tables: int, rounds: int,
         settle: float, recall: float, attempts: int) -> tuple[DataFrame, DataFrame]:
    """What ``linked`` gives, for the n nodes."""
    lists = None
    for attempt in range(attempts):
        start = first_lists(nodes, k, tables, bits, seed=11 + attempt).withColumn(
            "new", F.lit(True))
        if lists is not None:
            start = start.unionByName(lists.withColumn("new", F.lit(True)))
        lists = staged(trimmed(start, k), "neighbours")
        lists = descend(nodes, lists, k, n, rounds, settle)
        if attempt + 1 == attempts or audit(nodes, lists, threshold, k, recall):
            break
        k, tables = 2 * k, 2 * tables
    return linked(lists, checked(nodes, lists, threshold, k), threshold, k)


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, k: int = 8, tables: int = 6,
                    rounds: int = 4, settle: float = 0.002, recall: float = 0.99,
                    attempts: int = 3) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id,
    embedding, label)."""
    sound = valid(vectors.select("vec_id", "embedding", "label"))
    nodes = staged(nodes_of(sound), "nodes")
    parts = staged(nodes.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("bits", F.greatest(F.lit(0), F.ceil(F.log2(
                       F.col("n") / (CHUNK / 2)))).cast("int")), "parts")
    n, bits = parts.agg(F.coalesce(F.sum("n"), F.lit(0)),
                        F.coalesce(F.max("bits"), F.lit(0))).first()
    dealt = staged(nodes.join(sized(parts), "part").drop("n"), "part-bits")
    near, full = walk(dealt, n, bits, threshold, k, tables, rounds, settle, recall, attempts)
    counts, links = complete(nodes, full, components(near), threshold)
    # pairs of two saturated nodes are counted by the blocks
    mark = full.select("node", F.lit(1).alias("full"))
    ends = near.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        near.select(F.col("b"), F.col("a")))
    ends = (ends.join(mark, "node", "left").withColumnRenamed("full", "full1")
            .join(mark.select(F.col("node").alias("other"), F.col("full").alias("full2")),
                  "other", "left").filter("full1 IS NULL OR full2 IS NULL"))
    listed = (ends.join(nodes.select(F.col("node").alias("other"), "copies"), "other")
              .groupBy("node").agg(F.sum("copies").alias("weight")))
    weight = listed.unionByName(counts).groupBy("node").agg(F.sum("weight").alias("weight"))
    found = components(near.union(links))
    done = (nodes.join(weight, "node", "left").join(found, "node", "left")
            .select("part", "embedding",
                    (F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("component", "node").alias("component_id")))
    member = sound.join(done, ["part", "embedding"]).select("vec_id", "n_links", "component_id")
    unsound = vectors.select("vec_id", "embedding", "label").filter(
        ~F.coalesce(_sound(), F.lit(False))).select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"),
            F.col("vec_id").alias("component_id"))
    return member.unionByName(unsound).select(
        "vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id",
        (F.col("vec_id") == F.col("component_id")).alias("kept"))


def _sound():
    e = F.col("embedding")
    return (F.col("label").isNotNull() & e.isNotNull() & F.col("vec_id").isNotNull()
            & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(e, lambda x: x != 0))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
edge AS (SELECT a.vec_id p, b.vec_id q FROM v a JOIN v b
         ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id node, vec_id seen FROM embeddings
          UNION SELECT node, q FROM reach JOIN edge ON seen = p)
SELECT node vec_id, (SELECT count(*) FROM edge WHERE p = node) n_links,
       min(seen) component_id, node = min(seen) kept
FROM reach GROUP BY node
"""
