"""Skew-safe ordered windows over per-key series.

A plain ``Window.partitionBy('ticker').orderBy('date')`` sends every row of a
ticker to one task: if one ticker holds a third of the panel, one task holds
a third of the data. Everything here keeps each task's group bounded:

1. ``index_series`` numbers the rows of each series (``_idx``) with a
   row_number per (key, chunk) — chunk = calendar year by default, at most one
   year of a key per group — plus a per-key prefix sum of the tiny chunk-count
   table.
2. ``block_windows`` cuts each series into blocks of ``block_rows`` rows and
   copies the last ``lookback`` rows of a block into the next one (halo).
   Windows run per (key, block); every ROWS frame / LAG that looks back at most
   ``lookback`` rows sees exactly the rows it would see over the whole series.
   Halo copies are dropped afterwards.
3. ``block_anchors`` carries "first value of the series / of the year" into
   every block through a join on (key, block) — the partitioning the window
   output already has, so the large side is not shuffled again.

Exactness requires (key, order) to be unique, which holds after the staging
dedup (one bar per date and ticker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.session import scratch_path

IDX = "_idx"        # 0-based position of the row inside its series
LEN = "_len"        # rows in the series
CHUNK = "_chunk"    # indexing group (calendar year by default)
CSTART = "_cstart"  # _idx of the first row of the chunk
CLEN = "_clen"      # rows in the chunk
BLK = "_blk"        # block number inside the series
OWN = "_own"        # false for halo copies

DEFAULT_BLOCK_ROWS = 2048

INTERNAL = [IDX, LEN, CHUNK, CSTART, CLEN, BLK, OWN]


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written once as a columnar table under the shared folder and read
    back: later readers prune columns and push filters into the scan, the
    lineage is cut, and lost executors read the files again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def index_series(df: DataFrame, key: str = "ticker", order: str = "date",
                 chunk: Column | None = None, cut_input: bool = True) -> DataFrame:
    """Add _idx, _len, _chunk, _cstart, _clen to each row.

    The input is read twice (chunk counts from two columns, then rows); with
    ``cut_input`` it is stored first, so the upstream plan runs once and the
    lineage — which otherwise doubles with every such step — is cut. The result
    exposes ``.base`` (stored input), ``.offsets`` (one row per key and chunk)
    and ``.order``.
    """
    chunk = F.year(order) if chunk is None else chunk
    c = df.withColumn(CHUNK, chunk)
    if cut_input:
        c = materialize(c)
    counts = c.groupBy(key, CHUNK).agg(F.count(F.lit(1)).alias(CLEN))
    by_key = Window.partitionBy(key).orderBy(CHUNK)
    offsets = counts.select(
        key, CHUNK, CLEN,
        F.coalesce(F.sum(CLEN).over(by_key.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(CSTART),
        F.sum(CLEN).over(Window.partitionBy(key)).alias(LEN),
    )
    within = Window.partitionBy(key, CHUNK).orderBy(order)
    out = (c.join(offsets, [key, CHUNK])
           .withColumn(IDX, F.col(CSTART) + F.row_number().over(within) - 1))
    out.base, out.offsets, out.order = c, offsets, order
    return out


def block_of(idx: Column, block_rows: int) -> Column:
    return F.floor(idx / F.lit(block_rows)).cast("bigint")


def block_windows(indexed: DataFrame, key: str, lookback: int,
                  build, block_rows: int = DEFAULT_BLOCK_ROWS,
                  lookahead: int = 0, frame: bool = False) -> DataFrame:
    """Apply window columns per (key, block) with halo rows on both sides.

    ``build(w)`` receives ``Window.partitionBy(key, _blk).orderBy(_idx)`` and
    returns a list of aliased columns (``frame=False``) or, with
    ``frame=True``, ``build(df, w)`` returns a new DataFrame (chained windows
    on the same partitioning, no further shuffle). Whatever is computed may
    depend on at most ``lookback`` rows before and ``lookahead`` rows after a
    row; for chained windows the halo sizes must cover the whole chain.
    """
    return over_blocks(spread_blocks(indexed, lookback, block_rows, lookahead), build, key, frame)


def spread_blocks(indexed: DataFrame, lookback: int, block_rows: int = DEFAULT_BLOCK_ROWS,
                  lookahead: int = 0) -> DataFrame:
    """Rows under their block, and as halo copies under the blocks that look
    back or ahead to them."""
    if block_rows <= max(lookback, lookahead):
        raise ValueError("block_rows must exceed the halo")
    idx = F.col(IDX)
    own = block_of(idx, block_rows)
    last_blk = block_of(F.col(LEN) - 1, block_rows)
    pos = idx % block_rows
    to_next = (pos >= (block_rows - lookback)) & (own < last_blk) if lookback > 0 \
        else F.lit(False)
    to_prev = (pos < lookahead) & (own > 0) if lookahead > 0 else F.lit(False)
    targets = F.filter(F.array(own, F.when(to_next, own + 1), F.when(to_prev, own - 1)),
                       lambda b: b.isNotNull())
    return indexed.withColumn(BLK, F.explode(targets)).withColumn(OWN, F.col(BLK) == own)


def over_blocks(spread: DataFrame, build, key: str = "ticker", frame: bool = False) -> DataFrame:
    """Window columns over spread rows, without the halo copies. On a stored
    series table (``store_series``) the windows need no exchange."""
    w = Window.partitionBy(key, BLK).orderBy(IDX)
    out = build(spread, w) if frame else spread.select("*", *build(w))
    return out.filter(F.col(OWN)).drop(OWN)


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets of a series table: enough to keep the session's shuffle width
    busy with whole blocks, never over two million rows a bucket (up to the
    100,000 buckets that Spark allows)."""
    wide = min(-(-rows // 16_384), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(max(1, wide, -(-rows // 2_000_000)), 100_000)


def store_series(df: DataFrame, lookback: int, name: str, key: str = "ticker",
                 order: str = "date", chunk: Column | None = None,
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``df`` as a catalog table bucketed by (key, block), blocks with their
    halo of ``lookback`` rows: every window that looks back no further reads it
    without an exchange, as often as needed. Exposes what ``index_series``
    does, and ``.table``, its name in the catalog."""
    spark = df.sparkSession
    indexed = index_series(df, key, order, chunk)
    n = bucket_count(spark, indexed.base.count())
    path = scratch_path(spark, name)
    table = "marketlake_" + path.rsplit("/", 1)[-1].replace("-", "_")
    (spread_blocks(indexed, lookback, block_rows).repartition(n, key, BLK)
     .write.format("parquet").option("path", path).bucketBy(n, key, BLK)
     .sortBy(key, BLK, IDX).saveAsTable(table))
    out = spark.table(table)
    out.base, out.offsets, out.order, out.table = indexed.base, indexed.offsets, order, table
    return out


def block_running_sum(blocked: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Running sum of ``value`` over the whole series (rows ordered by _idx).

    Within a block: a window over (key, _blk) — the partitioning the input
    already has. Across blocks: per-block totals (one row per block) with a
    prefix sum over the blocks of a key, joined back on (key, _blk).
    """
    totals = blocked.groupBy(key, BLK).agg(F.sum(value).alias("_bt"))
    carry = totals.select(
        key, BLK,
        F.coalesce(F.sum("_bt").over(Window.partitionBy(key).orderBy(BLK)
                                     .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0.0)).alias("_carry"))
    w = Window.partitionBy(key, BLK).orderBy(IDX).rowsBetween(Window.unboundedPreceding,
                                                              Window.currentRow)
    return (blocked.join(carry, [key, BLK], "left")
            .withColumn(out, F.col("_carry") + F.sum(value).over(w)).drop("_carry"))


def block_anchors(indexed: DataFrame, key: str, value: str,
                  block_rows: int = DEFAULT_BLOCK_ROWS,
                  by_chunk: bool = False) -> DataFrame:
    """First ``value`` of each series (or of each chunk) for every block.

    Returns (key, _blk, anchor) or, with ``by_chunk``, (key, _blk, anchors)
    where ``anchors`` maps chunk -> first value. The first values are a
    partial ``min_by`` aggregate over the stored input (NULL kept when
    the first row's value is NULL); the block range of each series / chunk
    comes from the small offsets table, so the indexing is not run again.
    """
    base, offsets, order = indexed.base, indexed.offsets, indexed.order
    if not by_chunk:
        firsts = base.groupBy(key).agg(F.min_by(value, order).alias("anchor"))
        lens = offsets.groupBy(key).agg(F.max(LEN).alias(LEN))
        return (firsts.join(lens, key)
                .select(key, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                  block_of(F.col(LEN) - 1, block_rows)))
                        .alias(BLK), "anchor"))
    firsts = base.groupBy(key, CHUNK).agg(F.min_by(value, order).alias("anchor"))
    spans = firsts.join(offsets, [key, CHUNK]).select(
        key, CHUNK, "anchor",
        F.explode(F.sequence(block_of(F.col(CSTART), block_rows),
                             block_of(F.col(CSTART) + F.col(CLEN) - 1, block_rows))).alias(BLK))
    return (spans.groupBy(key, BLK)
            .agg(F.map_from_entries(F.collect_list(F.struct(CHUNK, "anchor")))
                 .alias("anchors")))


def chunk_ends(indexed: DataFrame, key: str, value: str,
               block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """(key, _blk, ends): for every block a map chunk -> (first, last, start,
    end) of the chunks that it touches: value and order of a chunk's first and
    last row, carried back to blocks before the chunk's end as well as on to
    those after its start. One partial aggregate over the stored input."""
    base, offsets, order = indexed.base, indexed.offsets, indexed.order
    ends = base.groupBy(key, CHUNK).agg(F.struct(
        F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"),
        F.min(order).alias("start"), F.max(order).alias("end")).alias("ends"))
    spans = ends.join(offsets, [key, CHUNK]).select(
        key, CHUNK, "ends",
        F.explode(F.sequence(block_of(F.col(CSTART), block_rows),
                             block_of(F.col(CSTART) + F.col(CLEN) - 1, block_rows))).alias(BLK))
    return spans.groupBy(key, BLK).agg(
        F.map_from_entries(F.collect_list(F.struct(CHUNK, "ends"))).alias("ends"))


def series_blocks(blocked: DataFrame, key: str,
                  block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """(key, _blk) for every block of every series — one row per block,
    read from the first row of each series only."""
    return blocked.filter(F.col(IDX) == 0).select(
        key, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                  block_of(F.col(LEN) - 1, block_rows))).alias(BLK))


def join_per_key(blocked: DataFrame, consts: DataFrame, key: str, blocks: DataFrame,
                 on: tuple = (), how: str = "left") -> DataFrame:
    """Join per-key constants (optionally per key + ``on`` columns) to the
    blocked rows through (key, _blk): the constants are copied to each block
    of their series, so the large side is never keyed by ``key`` alone — a
    hot series stays split over its blocks whatever the join strategy."""
    spread = consts.join(blocks, key)
    return blocked.join(spread, [key, BLK, *on], how)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in INTERNAL if c in df.columns])
