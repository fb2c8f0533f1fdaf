"""Shared helpers: staged tables, folds, Arrow batches, bounded caches."""

from __future__ import annotations

import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import scratch_path
from marketlake.sources.tables import read_table

# Rows and bytes per Arrow batch handed to Python: a batch ends at whichever
# comes first, so a worker holds some MB or one longer row.
ARROW_ROWS = 512
ARROW_BYTES = "16m"


def tune(spark: SparkSession) -> SparkSession:
    """Arrow batch sizes, and the package on the workers' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that jobs
    do not depend on how the workers' PYTHONPATH is set."""
    sc = spark.sparkContext
    if getattr(sc, "_marketlake_shipped", False):
        return
    top = Path(__file__).resolve().parent.parent
    zipped = shutil.make_archive(f"{tempfile.mkdtemp()}/{top.name}", "zip", top.parent, top.name)
    sc.addPyFile(zipped)
    sc._marketlake_shipped = True


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", *(cols or ("doc_id", "text")))


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and
    read it back: the lineage ends at files every executor can read."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(docs: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def with_uid(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a number of each row, and that column's name."""
    uid = free_name(docs, "_uid")
    return staged(docs.withColumn(uid, F.monotonically_increasing_id()), "rows"), uid


SMALL_BYTES = 32 << 20   # values of a table that may be broadcast


def sized(table: DataFrame, most: int = SMALL_BYTES) -> DataFrame:
    """A stored table marked for broadcast if its values take at most ``most``
    bytes: 8 for each number, the measured length of each text. A larger one
    is joined by shuffling."""
    wide = [f.name for f in table.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    leaves = sum(len(f.dataType.fields) if isinstance(f.dataType, T.StructType) else 1
                 for f in table.schema.fields)
    size = F.count(F.lit(1)) * 8 * leaves
    for name in wide:
        size = size + F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
    return F.broadcast(table) if table.agg(size).first()[0] <= most else table


def fold(doc_id: str, parts: int) -> Column:
    """crc32(doc_id as text) mod parts; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def stable_order(doc_id: str) -> Column:
    """A fixed pseudo-random order of ids for bounded samples."""
    return F.xxhash64(F.lit(17), F.col(doc_id).cast("string"))


_KEPT: dict[str, Callable] = {}   # by module: what a worker keeps between tasks


def kept(fn: Callable) -> Callable:
    """``fn`` whose values a worker keeps from task to task, until a task of
    another module takes the worker (``release_others``)."""
    _KEPT[fn.__module__] = cached = lru_cache(maxsize=2)(fn)
    return cached


def release_others(module: str) -> None:
    """Drops what this worker kept for the tasks of other modules: a worker
    lives through all stages and holds the tables of one of them at a time."""
    for name, cached in _KEPT.items():
        if name != module and cached.cache_info().currsize:
            cached.cache_clear()
            gc.collect()                 # caches refer to their owners
            give_back()


def give_back() -> None:
    """Freed memory goes back to the machine: workers live on."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def map_batches(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """``make()`` runs once per task and returns the batch function."""
    module = make.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(module)
        fn = make()
        try:
            for batch in batches:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
        finally:
            give_back()
    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, col: str) -> list[str]:
    """Whole texts, NULL read as empty."""
    return [t or "" for t in batch.column(col).to_pylist()]


class BoundedCache(dict):
    """dict that computes missing keys and starts afresh when full."""

    def __init__(self, fn: Callable, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.fn(key)
        return value


def class_sample(rows: DataFrame, doc_id: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label value (all of a smaller class),
    chosen by a hash of the id: the same documents whatever the partitioning,
    and a bounded number whatever the corpus. One aggregate over two columns;
    the class table (one row per label value) is broadcast."""
    sizes = rows.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    return (rows.join(F.broadcast(sizes), F.col(label) == F.col("_class"))
            .filter(F.pmod(stable_order(doc_id), F.lit(1_000_003)) / F.lit(1_000_003.0)
                    < F.lit(per_class) / F.col("_n"))
            .drop("_class", "_n"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
             id_col: str, folds: int = 5) -> DataFrame:
    """Bounded sample of ``docs`` rows with their 0/1 label, without the held
    out fold (crc32 mod folds = 0). Conflicting labels of an id are decided by
    their mean (0.5 counts as 1); NULL ids and labels teach nothing."""
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
             .groupBy(F.col(id_col).alias("_id"))
             .agg((F.avg(label) >= 0.5).cast("int").alias("_y"))
             .filter(fold("_id", folds) != 0))
    return docs.join(F.broadcast(class_sample(known, "_id", "_y", per_class)),
                     F.col(id_col) == F.col("_id"))
