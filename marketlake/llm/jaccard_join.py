"""Operator 7: n-gram Jaccard self join with rare-first prefix filtering.

A text's set is its distinct five-word shingles (64-bit hashes). All sets are
put in one order: shingles with a lower count first, where counts come from a
fixed-size sketch over every document (collisions cost time, never results).
Two sets with Jaccard similarity >= t share a shingle among the first
``n - ceil(t n) + 1`` of either, so only these prefixes are joined. Candidates
must pass the length filter (sizes within a factor t; bands of sizes are join
keys) and the positional filter (what is left after the shared positions must
suffice). A pair then compares parity maps: one bit per hash bucket, odd or
even, so two maps differ in no more places than the sets have unshared
shingles, and a pair with too many differences needs no whole sets. Each
remaining pair is verified once, against both whole sets, after a suffix filter
that bounds the overlap by counts over hash ranges.

Classes rather than all pairs: equal sets are one node. A first round verifies
each prefix list's members against one of them; then lists whose members are
all connected already are done, and a second round compares only members of
different components: pairs of short lists are rows, the members of long lists
are compared block by block as matrix products. So a group of thousands of
copies costs one verification per copy, and no link between different texts
is lost.

Defined cases: NULL or empty texts and texts without words have no set and
link with nothing; fewer than five words are one shingle; repeated rows are
copies; rows with a NULL id carry a component (the smallest non-NULL id) but
name none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import map_batches, sized, staged, texts_of, with_uid
from marketlake.llm.components import components, spanning
from marketlake.llm.shingles import WORDS, Shingler, mix

SKETCH_BITS = 20          # counters of the count sketch: 4 MB, whatever the corpus
CHUNK = 1 << 14           # counters in a row while partial sketches are added
SHORT = 64                # members of a list whose pairs are listed as rows
BLOCK = 256               # sets on a side of a verified group
RANGES = np.arange(1, 32, dtype=np.uint64) << np.uint64(59)   # of the suffix filter


def prefix_length(n: np.ndarray | int, percent: int):
    return n - (percent * n + 99) // 100 + 1


# ------------------------------------------------------------- count sketch

def count_sketch(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """How many documents hold a shingle of each hash bucket (all documents)."""
    def run(batches):
        shingler, counts = Shingler(words), np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for text in texts_of(batch, text_col):
                np.add.at(counts, shingler.of(text) >> np.uint64(64 - SKETCH_BITS), 1)
        grid = counts.reshape(-1, CHUNK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(grid))), pa.array(list(grid), pa.list_(pa.int64()))],
            names=["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = table["counts"].combine_chunks().flatten().to_numpy().reshape(-1, CHUNK).sum(0)
        return pa.table({"chunk": table["chunk"][:1], "counts": pa.array(
            [total], pa.list_(pa.int64()))})

    parts = docs.select(text_col).mapInArrow(run, "chunk bigint, counts array<bigint>")
    schema = "chunk bigint, counts array<bigint>"
    some = (parts.withColumn("deal", F.pmod(F.spark_partition_id(), F.lit(61)))
            .groupBy("chunk", "deal").applyInArrow(lambda t: add(t.drop(["deal"])), schema))
    total = some.groupBy("chunk").applyInArrow(add, schema)
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in total.toLocalIterator():
        out[row.chunk * CHUNK:(row.chunk + 1) * CHUNK] = row.counts
    return out.astype(np.int32 if out.max(initial=0) < 1 << 31 else np.int64)


# ------------------------------------------------------------------- heads

def parity(h: np.ndarray) -> bytes:
    """One bit per bucket of the hashes' low bits: odd or even. As many buckets
    as the next power of two of the set's size, 64 at least."""
    size = max(64, 1 << (len(h) - 1).bit_length())
    bucket = (h & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(bucket, minlength=size) & 1).astype(np.uint8)).tobytes()


def differences(x: bytes, y: bytes) -> int:
    """Places where two parity maps differ, the larger one folded to the
    smaller: never more than the shingles that only one of the sets holds."""
    x, y = sorted((x, y), key=len)
    y = np.bitwise_xor.reduce(np.frombuffer(y, np.uint8).reshape(-1, len(x)), axis=0).tobytes()
    return (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()


def heads(docs: DataFrame, sketch: np.ndarray, percent: int, words: int, id_col: str,
          text_col: str) -> DataFrame:
    """(doc_id, text_key, n, set_id, prefix, parity) per row; set_id is NULL for no set."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        counts, shingler = shared.value, Shingler(words)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids, prefix, maps = [], [], [], []
            for text in texts_of(batch, text_col):
                h = shingler.of(text)
                n.append(len(h))
                ids.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63) if len(h) else None)
                c = counts[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                k = prefix_length(len(h), percent) if len(h) else 0
                prefix.append(h[np.lexsort((h, c))[:k]].view(np.int64))
                maps.append(parity(h) if len(h) else None)
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("text_key"), pa.array(n, pa.int64()),
                 pa.array(ids, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(maps, pa.binary())],
                names=["doc_id", "text_key", "n", "set_id", "prefix", "parity"])
        return run

    keyed = docs.select(id_col, text_col, F.xxhash64(text_col).alias("text_key"))
    return map_batches(keyed, make, f"doc_id {id_type}, text_key bigint, n bigint, "
                                    "set_id bigint, prefix array<bigint>, parity binary")


# --------------------------------------------------------------- candidates

def postings(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, set_id, n, pos, band) of prefix shingles that two sets share."""
    flat = sets.select("set_id", F.col("n").cast("int").alias("n"),
                       F.posexplode("prefix").alias("pos", "shingle"))
    shared = flat.groupBy("shingle").agg(F.count(F.lit(1)).alias("len")).filter("len > 1")
    shared = sized(staged(shared.select("shingle"), "shared"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)))
                   + F.lit(1e-9)).cast("int")
    return flat.join(shared, "shingle").withColumn("band", band)


def enough(n1, p1, n2, p2, percent: int):
    """Length and positional filters as a condition on two postings."""
    most = F.least(n1 - p1, n2 - p2) + F.least(p1, p2)
    return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
            & ((100 + percent) * most >= percent * (n1 + n2)))


def turn(set_id: str):
    """The order of a pair's two sets: centres of lists come first, so that a
    centre's partners share its groups and it is not sent once for each."""
    return F.struct(F.xxhash64(set_id).alias("h"), F.col(set_id).alias("set_id"))


def star_pairs(post: DataFrame, percent: int) -> DataFrame:
    """(a, b): each list's centre, the first of ``turn``, in a band of sizes with
    a member. Lists grow with the corpus, so their joins shuffle alike at every size."""
    centre = post.groupBy("shingle", "band").agg(
        F.min(F.struct(F.xxhash64("set_id").alias("h"), "set_id", "n", "pos")).alias("c"),
        F.count(F.lit(1)).alias("k")).filter("k > 1")
    return (post.join(centre.hint("merge"), ["shingle", "band"])
            .filter((F.col("set_id") != F.col("c.set_id"))
                    & enough(F.col("n"), F.col("pos"), F.col("c.n"), F.col("c.pos"), percent))
            .select(F.col("c.set_id").alias("a"), F.col("set_id").alias("b")).distinct())


def mixed_lists(post: DataFrame, found: DataFrame) -> DataFrame:
    """Postings of lists whose members are in different components, with the
    component ``c`` and the list length ``len``."""
    known = (post.join(found, post.set_id == found.node, "left")
             .withColumn("c", F.coalesce("component", "set_id")).drop("node", "component"))
    mixed = known.groupBy("shingle").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("len")
        ).filter("lo != hi").select("shingle", "len")
    return known.join(mixed.hint("merge"), "shingle")


def short_list_pairs(known: DataFrame, percent: int) -> DataFrame:
    """Pairs of list members in different components: same band or the next."""
    left = known.select("shingle", "band", *[F.col(k).alias(f"{k}1")
                                             for k in ("set_id", "n", "pos", "c")])
    right = known.select(F.col("shingle").alias("shingle2"), F.col("band").alias("band2"),
                         F.explode(F.array("band", F.col("band") - 1)).alias("meets"),
                         *[F.col(k).alias(f"{k}2") for k in ("set_id", "n", "pos", "c")])
    pair = (F.col("shingle") == F.col("shingle2")) & (F.col("band") == F.col("meets")) \
        & (F.col("c1") != F.col("c2")) \
        & ((F.col("band2") > F.col("band")) | (F.col("set_id1") < F.col("set_id2"))) \
        & enough(F.col("n1"), F.col("pos1"), F.col("n2"), F.col("pos2"), percent)
    ends = [turn("set_id1"), turn("set_id2")]
    return left.join(right.hint("merge"), pair).select(
        F.least(*ends)["set_id"].alias("a"), F.greatest(*ends)["set_id"].alias("b")).distinct()


def long_list_groups(known: DataFrame) -> DataFrame:
    """(g, side, set_id): block pairs that cover the members of long lists.
    Lists that share members mostly share a label; the members of a label are
    cut into blocks, a large component into blocks of its own, and two blocks
    of one component are not compared."""
    least = known.groupBy("set_id").agg(F.min("shingle").alias("m"))
    label = (known.join(least, "set_id").groupBy("shingle").agg(F.min("m").alias("label")))
    members = known.join(label, "shingle").select("label", "set_id", "c").distinct()
    sizes = members.groupBy("label", "c").agg(F.count(F.lit(1)).alias("k"))
    small = sizes.filter(F.col("k") < BLOCK).groupBy("label").agg(F.sum("k").alias("rest"))
    big = F.col("k") >= BLOCK
    dealt = staged(members.join(sizes, ["label", "c"]).join(small, "label", "left").select(
        "label", "set_id", F.when(big, F.col("c")).alias("own"),
        F.when(big, F.xxhash64("c", F.pmod(F.xxhash64("set_id"), F.ceil(F.col("k") / BLOCK))))
        .otherwise(F.xxhash64(F.lit(0), F.pmod(F.xxhash64("c"), F.ceil(F.col("rest") / BLOCK))))
        .alias("block")), "blocks")
    blocks = dealt.select("label", "block", "own").distinct()
    other = blocks.select(F.col("label").alias("label2"), F.col("block").alias("block2"),
                          F.col("own").alias("own2"))
    pairs = staged(blocks.join(other, (F.col("label") == F.col("label2"))
                               & (F.col("block") <= F.col("block2"))
                               & F.coalesce(F.col("own") != F.col("own2"), F.lit(True)))
                   .select("label", "block", "block2",
                           F.xxhash64("label", "block", "block2").alias("g")), "block-pairs")
    sides = pairs.select("label", "block", "g", F.lit(0).alias("side")).union(
        pairs.filter("block != block2").select("label", "block2", "g", F.lit(1)))
    return sides.join(dealt.select("label", "block", "set_id"), ["label", "block"]).select(
        "g", "side", "set_id")


def plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The stored ``pairs`` (a, b) whose parity maps differ in no more places
    than sets of the similarity may; only maps are shuffled."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), "paired")
    maps = staged(sets.select("set_id", "n", "parity").join(sized(ids), "set_id"), "parities")
    both = (pairs.join(maps.toDF("a", "n1", "x"), "a").join(maps.toDF("b", "n2", "y"), "b")
            .select("a", "b", (F.col("n1") + F.col("n2")).alias("n"), "x", "y"))

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            differ = [differences(x, y) for x, y in zip(batch.column("x").to_pylist(),
                                                        batch.column("y").to_pylist())]
            some = (100 + percent) * np.array(differ, np.int64) \
                <= (100 - percent) * batch.column("n").to_numpy()
            return batch.select(["a", "b"]).filter(pa.array(some))
        return run

    return staged(map_batches(both, make, "a bigint, b bigint"), "plausible")


def pair_groups(pairs: DataFrame) -> DataFrame:
    """(g, side, set_id): each first set with up to about BLOCK of its partners."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("k"))
    dealt = pairs.join(many, "a").withColumn("g", F.xxhash64("a", F.pmod(F.xxhash64("b"), "k")))
    return dealt.select("g", F.lit(0).alias("side"), F.col("a").alias("set_id")).distinct().union(
        dealt.select("g", F.lit(1), "b"))


# ------------------------------------------------------------- verification

def overlaps(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted sets ``a`` (rows) and ``b`` (columns) reach the
    similarity: a suffix filter by counts over hash ranges, then the sizes of
    all intersections as products of 0/1 matrices."""
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    both = n[:, None] + m[None]
    need = -(-percent * both // (100 + percent))
    count = lambda s: np.stack([np.diff(np.searchsorted(x, RANGES), prepend=0,
                                        append=len(x)) for x in s])
    ca, cb = count(a), count(b)
    bound = sum(np.minimum(ca[:, r][:, None], cb[:, r][None]) for r in range(ca.shape[1]))
    maybe = bound >= need
    rows, cols = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    out = np.zeros(maybe.shape, bool)
    if not len(rows):
        return out
    xa, xb = np.concatenate([a[i] for i in rows]), np.concatenate([b[i] for i in cols])
    ra, rb = np.repeat(np.arange(len(rows)), n[rows]), np.repeat(np.arange(len(cols)), m[cols])
    shared = np.intersect1d(xa, xb)
    if not len(shared):
        return out
    inside = lambda x: np.minimum(np.searchsorted(shared, x), len(shared) - 1)
    ka, kb = inside(xa), inside(xb)
    ka, ra = ka[shared[ka] == xa], ra[shared[ka] == xa]
    kb, rb = kb[shared[kb] == xb], rb[shared[kb] == xb]
    oa, ob = np.argsort(ka, kind="stable"), np.argsort(kb, kind="stable")
    ka, ra, kb, rb = ka[oa], ra[oa], kb[ob], rb[ob]
    size = np.zeros((len(rows), len(cols)))
    for at in range(0, len(shared), 4096):
        grids = []
        for k, r, height in ((ka, ra, len(rows)), (kb, rb, len(cols))):
            lo, hi = np.searchsorted(k, [at, at + 4096])
            grid = np.zeros((height, 4096), np.float32)
            grid[r[lo:hi], k[lo:hi] - at] = 1
            grids.append(grid)
        size += grids[0] @ grids[1].T
    some = 100 * size >= percent * (both[np.ix_(rows, cols)] - size)
    out[np.ix_(rows, cols)] = some & maybe[np.ix_(rows, cols)]
    return out


def verified(docs: DataFrame, nodes: DataFrame, groups: DataFrame, percent: int, words: int,
             id_col: str, text_col: str, repeats: bool = False) -> DataFrame:
    """(a, b): links between the two sides of each group (inside a group of
    one side), as pairs that connect what is linked. One text of each needed
    set is read again (``repeats``: rows of one id and text stand in ``docs`` more
    than once); sets are shuffled once, to their groups."""
    groups = staged(groups, "groups")
    one = sized(staged(nodes.join(groups.select("set_id").distinct(), "set_id").select(
        "set_id", F.col("text_key").alias("_key"), F.col("first_id").alias("_id")), "needed"))
    texts = docs.select(id_col, text_col, F.xxhash64(text_col).alias("text_key")).join(
        one, (F.col("text_key") == F.col("_key")) & F.col(id_col).eqNullSafe(F.col("_id")))
    if repeats:
        texts = texts.dropDuplicates(["set_id"])

    def make():
        shingler = Shingler(words)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch.column("set_id"), pa.array([shingler.of(t).tobytes() for t in
                                                   texts_of(batch, text_col)], pa.binary())],
                names=["set_id", "items"])
        return run

    sets = staged(map_batches(texts.select("set_id", text_col), make,
                              "set_id bigint, items binary"), "sets")

    def compare(t: pa.Table) -> pa.Table:
        side, ids = t["side"].to_numpy(), t["set_id"].to_numpy()
        items = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["items"]]
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        b = b if len(b) else a
        link = overlaps([items[i] for i in a], [items[i] for i in b], percent)
        ends = spanning(link, a, b, len(ids))
        return pa.table({"a": ids[ends[:, 0]], "b": ids[ends[:, 1]]})

    return staged(sets.join(sized(groups), "set_id").select("g", "side", "set_id", "items")
                  .groupBy("g").applyInArrow(compare, "a bigint, b bigint")
                  .filter("a != b"), "links")


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = WORDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    sketch = count_sketch(docs, text_col, words)
    known = staged(heads(docs, sketch, percent, words, id_col, text_col)
                   .withColumn("row", F.monotonically_increasing_id()), "heads")
    rows = known.filter(F.col("set_id").isNotNull())
    nodes = staged(rows.groupBy("set_id").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct("row", "text_key", F.col("doc_id").alias("first_id"))).alias("first"))
        .select("set_id", "least", "first.*"), "nodes")
    firsts = rows.join(nodes.select("row"), "row")
    post = staged(postings(firsts, percent), "postings")
    repeats = not rows.groupBy("set_id", "text_key", "doc_id").agg(
        F.count(F.lit(1)).alias("k")).filter("k > 1").isEmpty()

    def links(groups: DataFrame) -> DataFrame:
        return verified(docs, nodes, groups, percent, words, id_col, text_col, repeats)

    tried = staged(star_pairs(post, percent), "stars")
    first = links(pair_groups(plausible(tried, firsts, percent)))
    mixed = staged(mixed_lists(post, components(first)), "mixed-lists")
    rest = staged(short_list_pairs(mixed.filter(F.col("len") <= SHORT), percent)
                  .join(tried, ["a", "b"], "left_anti"), "pairs")
    second = links(pair_groups(plausible(rest, firsts, percent))
                   .union(long_list_groups(mixed.filter(F.col("len") > SHORT))))
    found = components(first.union(second))
    ends = nodes.join(found, nodes.set_id == found.node, "left").select(
        "set_id", "least", F.coalesce("component", "set_id").alias("component"))
    least = ends.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = ends.join(least, "component").select("set_id", "component_id")
    return known.join(classes, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def keep_one_row_each(docs: DataFrame, percent: int = 80, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of rows: the one with the smallest
    id (NULL last), of several with that id the first stored."""
    rows, uid = with_uid(docs)
    told = near_duplicates(rows, percent, id_col=uid, text_col=text_col).select(
        F.col("doc_id").alias("_uid"), F.col("component_id").alias("_class"))
    known = staged(told.join(rows.select(F.col(uid).alias("_uid"), F.col(id_col).alias("_id")),
                             "_uid"), "classes")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_uid"))
    kept = staged(known.groupBy("_class").agg(first["_uid"].alias("_kept"),
                                              F.count(F.lit(1)).alias("n"))
                  .filter(F.col("n") > 1).drop("n"), "kept")
    gone = staged(known.join(sized(kept), "_class").filter(F.col("_uid") != F.col("_kept"))
                  .select(F.col("_uid").alias(uid)), "removed")
    return rows.join(sized(gone), uid, "left_anti").select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
  FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) s
                  FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) n FROM shingle GROUP BY doc_id),
edge AS (SELECT a, b FROM (SELECT x.doc_id a, y.doc_id b, count(*) c
                           FROM shingle x JOIN shingle y USING (g) WHERE x.doc_id <> y.doc_id
                           GROUP BY 1, 2) p
         JOIN size s ON s.doc_id = a JOIN size t ON t.doc_id = b
         WHERE 100 * c >= 80 * (s.n + t.n - c)),
reach AS (SELECT doc_id node, doc_id seen FROM doc
          UNION SELECT node, b FROM reach JOIN edge ON seen = a)
SELECT doc.doc_id, CAST(coalesce(n, 0) AS BIGINT) n_shingles, min(seen) component_id
FROM doc JOIN reach ON node = doc.doc_id LEFT JOIN size ON size.doc_id = doc.doc_id
GROUP BY doc.doc_id, n
"""
