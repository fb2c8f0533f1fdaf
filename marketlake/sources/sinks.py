"""Sinks: append, truncate-and-load, partition replace, insert-only-new,
landing files, retention.

Layout choices for scale:
* price tables are partitioned by ``year`` directories (a daily directory of a
  few rows per ticker is a small-file trap) and range-clustered on
  (year, ticker, date) before the write: range partitioning samples the key
  distribution, so a hot ticker is split over several files/tasks instead of
  landing in one, and parquet row-group min/max on ticker/date prune reads;
* insert-only-new reads only the key columns of the target, bounded by the
  batch's years, dates and tickers, and anti-joins on (date, ticker) — the
  shuffle key includes the date, so no ticker is a hot key;
* replace-by-run-date uses dynamic partition overwrite: only the run's
  partition is rewritten, atomically per partition through the commit protocol;
* loads with a batch key write to the batch's own folder and replace it when
  the batch runs again, rejects included;
* retention drops whole run-date folders; compaction rewrites only the years
  whose files are many or overlap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.sources.files import API_PRICE_RECORD_SCHEMA, normalize_prices
from marketlake.operators.blocks import materialize
from marketlake.sources.schemas import PRICE_COLUMNS, RAW_PRICE_SCHEMA

KEY = ["date", "ticker"]
VALUE_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]
TARGET_SCHEMA = T.StructType([*RAW_PRICE_SCHEMA.fields,
                              T.StructField("batch", T.StringType(), True),
                              T.StructField("year", T.IntegerType(), True)])


def _clustered(df: DataFrame) -> DataFrame:
    return (df.withColumn("year", F.year("date"))
            .repartitionByRange("year", "ticker", "date")
            .sortWithinPartitions("year", "ticker", "date"))


def _folder(spark: SparkSession, path: str):
    """(file system, path) through Hadoop, for any cluster file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def partition_folders(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """value -> folder of the partitions by ``column`` right under ``path``;
    only the listing is read."""
    fs, p = _folder(spark, path)
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
    return {f.getName().split("=", 1)[1]: f.toString() for f in found
            if f.getName().startswith(f"{column}=")}


def write_prices(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append (or overwrite) price rows, year-partitioned, ticker-clustered."""
    _clustered(df.select(*PRICE_COLUMNS)).write.mode(mode).partitionBy("year").parquet(path)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*PRICE_COLUMNS)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Truncate-and-load."""
    df.write.mode("overwrite").parquet(path)


def replace_partition(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace only the partitions present in ``df`` (delete-by-run-date then
    write, as one atomic-per-partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def admissible(batch: DataFrame) -> DataFrame:
    """Rows with both key columns; the others are rejects."""
    return batch.filter(F.col("date").isNotNull() & F.col("ticker").isNotNull())


def rejects(batch: DataFrame) -> DataFrame:
    """Rows without a date or ticker: the raw table requires both, and a NULL
    key would be added again by every replay."""
    return batch.filter(F.col("date").isNull() | F.col("ticker").isNull())


def latest_per_key(batch: DataFrame) -> DataFrame:
    """One row per (date, ticker): the latest version in the batch."""
    best = F.max(F.struct("ingested_at", *VALUE_COLUMNS)).alias("_b")
    return batch.groupBy(*KEY).agg(best).select(
        "date", *[F.col(f"_b.{c}").alias(c) for c in VALUE_COLUMNS], "ticker",
        F.col("_b.ingested_at").alias("ingested_at")).select(*PRICE_COLUMNS)


def existing_keys(batch: DataFrame, target_path: str, batch_key: str | None = None) -> DataFrame:
    """Keys of the target inside the batch's years, dates and tickers: the
    years prune folders, the ranges reach the parquet scan. Rows that an
    earlier run of the same batch left are not counted."""
    span = batch.agg(F.min("date").alias("d0"), F.max("date").alias("d1"),
                     F.min("ticker").alias("t0"), F.max("ticker").alias("t1")).first()
    keys = batch.sparkSession.read.schema(TARGET_SCHEMA).parquet(target_path)
    if span.d0 is None:
        return keys.select(*KEY).limit(0)
    if batch_key is not None:
        keys = keys.filter(~F.col("batch").eqNullSafe(F.lit(batch_key)))
    return keys.filter(F.col("year").between(span.d0.year, span.d1.year)
                       & F.col("date").between(span.d0, span.d1)
                       & F.col("ticker").between(span.t0, span.t1)).select(*KEY)


def new_rows(batch: DataFrame, target_path: str, batch_key: str | None = None) -> DataFrame:
    """Admissible rows of ``batch``, one per key, whose (date, ticker) is not
    in the target yet. A missing target means first load (checked explicitly;
    other read errors surface instead of being taken as "first run")."""
    rows = latest_per_key(admissible(batch))
    if not _exists(batch.sparkSession, target_path):
        return rows
    return rows.join(existing_keys(rows, target_path, batch_key), KEY, "left_anti")


def insert_new(spark: SparkSession, batch: DataFrame, target_path: str,
               rejects_path: str | None = None, batch_key: str | None = None) -> dict:
    """Idempotent load, for batches and micro-batches: append only unseen
    keys, write nothing when none are left, append rejects to
    ``rejects_path`` if given. The batch is stored once for all its uses.
    With a ``batch_key`` rows and rejects go to the batch's own folder
    (``batch=``), which a second run of the batch replaces: whatever an
    interrupted run left, the tables end as after one clean run.
    Returns the counts before, after, rejected and removed."""
    batch = materialize(batch.select(*PRICE_COLUMNS))
    # stored, so that the count and the write agree
    fresh = materialize(new_rows(batch, target_path, batch_key))
    bad = rejects(batch)
    before, after, rejected = batch.count(), fresh.count(), bad.count()
    own = "" if batch_key is None else f"/batch={batch_key}"
    mode = "append" if batch_key is None else "overwrite"
    if after or (own and _exists(spark, target_path + own)):
        write_prices(fresh, target_path + own, mode)
    if rejects_path and (rejected or (own and _exists(spark, rejects_path + own))):
        bad.write.mode(mode).parquet(rejects_path + own)
    return {"before": before, "after": after, "rejected": rejected,
            "removed": before - rejected - after}


# ------------------------------------------------------------------ landing files

def to_api_records(prices: DataFrame) -> DataFrame:
    """Raw price rows in the shape the market-data API returns them (ISO
    datetime text, ``adjClose``), plus the landing partition columns."""
    return prices.select(
        F.date_format(F.col("date").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("date"),
        *[F.col(c).cast("string").alias(c) for c in ["open", "high", "low", "close"]],
        F.col("adj_close").cast("string").alias("adjClose"),
        F.col("volume").cast("string").alias("volume"),
        F.col("ticker"),
        F.to_date("ingested_at").alias("run_date"),
    )


def write_landing(prices: DataFrame, path: str) -> None:
    """One folder per run date and ticker (JSON Lines inside). Rows are
    range-partitioned by the two first, so a task writes few folders."""
    to_api_records(prices).repartitionByRange("run_date", "ticker", "date").write.mode("append").partitionBy("run_date", "ticker").json(path)


LANDING_SCHEMA = T.StructType(list(API_PRICE_RECORD_SCHEMA.fields) + [
    T.StructField("run_date", T.DateType(), True),
    T.StructField("ticker", T.StringType(), True),
])


def read_landing(spark: SparkSession, path: str, run_date_from=None) -> DataFrame:
    """Landing files back as raw price rows; ticker and ingest time come from
    the partition folders. ``run_date_from`` prunes partitions."""
    df = spark.read.schema(LANDING_SCHEMA).json(path)
    if run_date_from is not None:
        df = df.filter(F.col("run_date") >= F.lit(run_date_from).cast("date"))
    return normalize_prices(df, ticker="ticker",
                            ingested_at=F.col("run_date").cast("timestamp"))


def retention_cutoff(as_of: str, days: int = 365):
    return F.date_sub(F.lit(as_of).cast("date"), days)


def expire_landing(spark: SparkSession, path: str, as_of: str, days: int = 365) -> list[str]:
    """Drop the run-date folders older than ``days``: only the folder listing
    is read, nothing that stays is written. Returns the dropped dates."""
    cutoff = dt.date.fromisoformat(as_of) - dt.timedelta(days=days)
    gone = {d: f for d, f in partition_folders(spark, path, "run_date").items()
            if dt.date.fromisoformat(d) < cutoff}
    for folder in gone.values():
        fs, p = _folder(spark, folder)
        if not fs.delete(p, True):
            raise RuntimeError(f"could not drop {folder}")
    return sorted(gone)


def apply_retention(spark: SparkSession, path: str, out_path: str, as_of: str,
                    days: int = 365) -> DataFrame:
    """A copy of the landing partitions younger than ``days`` (partition-pruned
    read); ``expire_landing`` drops the others in place."""
    kept = spark.read.schema(LANDING_SCHEMA).json(path).filter(
        F.col("run_date") >= retention_cutoff(as_of, days))
    kept.write.mode("overwrite").partitionBy("run_date", "ticker").json(out_path)
    return read_landing(spark, out_path)


# ------------------------------------------------------------------ array files

ARRAY_FILE = r"run_date=([0-9-]+)/file=(.+?)_prices_[0-9]+/[^/]*$"


def write_array_landing(prices: DataFrame, path: str) -> None:
    """Landing files as the API puller leaves them: one JSON array of records
    (without the ticker) a file, the lower-cased ticker in its name; a year's
    records at most, so no array grows with the history."""
    name = F.concat_ws("_", F.lower("ticker"), F.lit("prices"), F.substring("date", 1, 4))
    records = to_api_records(prices).withColumn("file", name)
    fields = [c for c in records.columns if c not in ("run_date", "ticker", "file")]
    arrays = records.groupBy("run_date", "file").agg(
        F.to_json(F.collect_list(F.struct(*fields))).alias("value"))
    arrays.write.mode("append").partitionBy("run_date", "file").text(path)


def read_array_landing(spark: SparkSession, path: str, ticker=F.upper
                       ) -> tuple[DataFrame, DataFrame]:
    """(rows, broken): records of all array files as raw price rows, ticker and
    run date taken from the file's path (``ticker`` maps the lower-cased name
    back), and the files that are not JSON, with their text and path."""
    schema = T.StructType([*API_PRICE_RECORD_SCHEMA.fields,
                           T.StructField("_broken", T.StringType(), True)])
    # stored: a query on the broken records alone would not parse the others
    records = materialize(spark.read.schema(schema).option("multiLine", "true")
                          .option("recursiveFileLookup", "true")
                          .option("columnNameOfCorruptRecord", "_broken").json(path)
                          .withColumn("source_file", F.url_decode(F.col("_metadata.file_path"))),
                          "landing-records")
    named = records.filter(F.col("_broken").isNull()).withColumns({
        # the folder name is escaped once more inside the path
        "ticker": ticker(F.url_decode(F.regexp_extract("source_file", ARRAY_FILE, 2))),
        "run_date": F.regexp_extract("source_file", ARRAY_FILE, 1)})
    rows = normalize_prices(named, ticker="ticker",
                            ingested_at=F.col("run_date").cast("timestamp"))
    return rows, records.filter(F.col("_broken").isNotNull()).select("source_file", "_broken")


# ------------------------------------------------------------------ compaction

def file_spans(spark: SparkSession, path: str) -> DataFrame:
    """(year, file, bytes, rows, first_key, last_key) of a price table's files:
    two columns are read, sizes come from the listing."""
    df = spark.read.schema(TARGET_SCHEMA).parquet(path)
    key = F.struct("ticker", "date")
    return df.groupBy("year", F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
        F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def years_to_compact(spans: DataFrame, target_bytes: int) -> list[int]:
    """Years whose files are more than twice as many as their bytes need, or
    whose key ranges overlap."""
    by_year = Window.partitionBy("year").orderBy("first_key", "last_key")
    crossing = F.col("first_key") <= F.max("last_key").over(
        by_year.rowsBetween(Window.unboundedPreceding, -1))
    per = spans.withColumn("crosses", crossing).groupBy("year").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
        F.max(F.coalesce("crosses", F.lit(False))).alias("crosses"))
    need = F.ceil(F.col("bytes") / F.lit(target_bytes))
    return [r.year for r in per.filter(F.col("crosses") | (F.col("files") > 2 * need)).collect()]


def compact_prices(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> list[int]:
    """Rewrite the years that need it into files of about ``target_bytes``
    with disjoint (ticker, date) ranges; other years keep their files. The new
    files are stored aside first, then replace the year in one overwrite.
    Returns the rewritten years."""
    spans = materialize(file_spans(spark, path), "file-spans")
    years = years_to_compact(spans, target_bytes)
    for year in sorted(years):
        size = spans.filter(F.col("year") == year).agg(F.sum("bytes")).first()[0]
        rows = spark.read.schema(TARGET_SCHEMA).parquet(path).filter(F.col("year") == year)
        files = max(1, -(-size // target_bytes))
        held = materialize(rows.select(*PRICE_COLUMNS, "year")
                           .repartitionByRange(files, "ticker", "date")
                           .sortWithinPartitions("ticker", "date"), "compacted")
        (held.repartitionByRange(files, "ticker", "date").sortWithinPartitions("ticker", "date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year").parquet(path))
    return sorted(years)


def scratch(spark: SparkSession, name: str) -> str:
    from marketlake.session import scratch_path
    return scratch_path(spark, name)

