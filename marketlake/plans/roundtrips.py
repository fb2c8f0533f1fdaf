"""Load / write plans that materialise data and read it back.

Each writes under a fresh folder of the shared checkpoint location (never a
machine-local temp folder) and returns what Spark reads back, so the result
is checked like any other query.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import quality
from marketlake.operators.daily import mart_daily_ohlcv
from marketlake.operators.quarterly import mart_quarterly_summary
from marketlake.operators.returns import mart_stock_returns
from marketlake.operators.staging import stage_metadata, stage_prices
from marketlake.plans import layers
from marketlake.sources import catalog, files, panel, sinks
from marketlake.sources.schemas import PRICE_COLUMNS, RAW_PRICE_SCHEMA

RETENTION_AS_OF = "2002-12-02"  # 365 days after the first landing run date + 1


def load_csv_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "csv-prices")
    files.write_csv(panel.raw_prices(spark, sf_dir), path)
    return files.load_csv_prices(spark, path)


def load_csv_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "csv-metadata")
    files.write_csv(panel.raw_metadata(spark, sf_dir), path)
    return files.load_csv_metadata(spark, path)


def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised metadata exported to CSV and loaded again."""
    path = sinks.scratch(spark, "csv-export")
    files.write_csv(files.normalize_metadata(panel.raw_metadata(spark, sf_dir)), path)
    return files.load_csv_metadata(spark, path)


def sink_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "raw-append")
    for batch in layers.raw_batches(spark, sf_dir).values():
        sinks.write_prices(batch, path, "append")
    return sinks.read_prices(spark, path)


def sink_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "meta-truncate")
    meta = files.normalize_metadata(panel.raw_metadata(spark, sf_dir))
    stale = meta.withColumn("end_date", F.lit(""))
    sinks.overwrite_table(stale, path)   # an older load ...
    sinks.overwrite_table(meta, path)    # ... fully replaced
    return spark.read.parquet(path)


def incremental_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "raw-insert-new")
    for batch in layers.raw_batches(spark, sf_dir).values():
        sinks.insert_new(spark, batch, path)
    return sinks.read_prices(spark, path)


def with_bad_dates(batch: DataFrame) -> DataFrame:
    """The batch as API records in which one ticker's first days of a month
    have an unreadable date, normalised again."""
    junk = (F.col("ticker") == "Brand#11") & F.col("date").substr(9, 2).eqNullSafe("01")
    records = sinks.to_api_records(batch)
    return files.normalize_prices(
        records.withColumn("date", F.when(junk, F.lit("junk")).otherwise(F.col("date"))),
        ticker="ticker", ingested_at=F.col("run_date").cast("timestamp"))


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a load sets aside because the date is unreadable."""
    target, bad = sinks.scratch(spark, "raw-strict"), sinks.scratch(spark, "raw-rejects")
    for batch in layers.raw_batches(spark, sf_dir).values():
        sinks.insert_new(spark, with_bad_dates(batch), target, bad)
    return spark.read.schema(RAW_PRICE_SCHEMA).parquet(bad)


def insert_new_with_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches, each loaded three times: replays add nothing."""
    path = sinks.scratch(spark, "raw-replayed")
    for batch in layers.raw_batches(spark, sf_dir).values():
        rows = with_bad_dates(batch)
        for _ in range(3):
            sinks.insert_new(spark, rows, path)
    return sinks.read_prices(spark, path)


def normalize_api_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company feed under the API's names: every third record lacks its
    ticker, one fetch failed."""
    meta = panel.raw_metadata(spark, sf_dir)
    number = F.regexp_extract("ticker", r"(\d+)", 1).cast("int")
    records = meta.select(
        F.col("ticker").alias("requested"), (number == 11).alias("failed"),
        F.when(number % 3 != 0, F.col("ticker")).alias("ticker"),
        F.col("company_name").alias("name"), "description",
        F.col("exchange").alias("exchangeCode"), F.col("start_date").alias("startDate"),
        F.col("end_date").alias("endDate"), "fetched_at")
    return files.normalize_api_metadata(records)


def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = layers.raw_batches(spark, sf_dir)
    return quality.dedup_report(b["O"], b["F"])


def landing_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "landing")
    sinks.write_landing(panel.raw_prices(spark, sf_dir), path)
    return sinks.read_landing(spark, path)


def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "landing-all")
    sinks.write_landing(panel.raw_prices(spark, sf_dir), path)
    sinks.expire_landing(spark, path, RETENTION_AS_OF)
    return sinks.read_landing(spark, path)


def read_landing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files of both run dates, read with ticker and date from their
    paths; one more file is cut off and set aside."""
    path = sinks.scratch(spark, "landing-arrays")
    sinks.write_array_landing(panel.raw_prices(spark, sf_dir), path)
    (spark.range(1).select(F.lit('[{"date": "1995-01-02", "open": 1').alias("value"))
     .coalesce(1).write.mode("append").text(f"{path}/run_date=2001-12-01/file=cut_prices_1995"))
    rows, broken = sinks.read_array_landing(spark, path, ticker=F.initcap)
    if broken.count() != 1:
        raise RuntimeError("the cut file was not set aside")
    return rows


def foreign_csv(spark: SparkSession, sf_dir: str) -> str:
    """A price file of someone else: volumes of two tickers are no numbers on
    the first of a month, dates of another are missing then."""
    path = sinks.scratch(spark, "csv-foreign")
    first = F.dayofmonth("date") == 1
    raw = panel.raw_prices(spark, sf_dir).select(
        F.when(~(first & (F.col("ticker") == "Brand#13")), F.col("date")).alias("date"),
        "open", "high", "low", "close", "adj_close",
        F.when(first & F.col("ticker").isin("Brand#11", "Brand#12"), F.lit("n/a"))
        .otherwise(F.col("volume").cast("string")).alias("volume"), "ticker", "ingested_at")
    raw.write.options(**{**files.CSV_OPTIONS, "nullValue": ""}).csv(path)
    return path


def load_csv_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.load_csv_with_rejects(spark, foreign_csv(spark, sf_dir), RAW_PRICE_SCHEMA,
                                       required=("date", "ticker"))[0]


def load_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines by reason and ticker."""
    bad = files.load_csv_with_rejects(spark, foreign_csv(spark, sf_dir), RAW_PRICE_SCHEMA,
                                      required=("date", "ticker"))[1]
    return (bad.groupBy("reason", F.regexp_extract("line", r"(Brand#\d+)", 1).alias("ticker"))
            .agg(F.count(F.lit(1)).alias("lines")))


def compacted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches appended in parts, then compacted: the rows stay."""
    path = sinks.scratch(spark, "raw-compacted")
    for batch in layers.raw_batches(spark, sf_dir).values():
        for part in range(3):
            sinks.write_prices(batch.filter(F.pmod(F.month("date"), F.lit(3)) == part), path)
    sinks.compact_prices(spark, path)
    return sinks.read_prices(spark, path)


def load_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "raw-count")
    sinks.write_prices(panel.raw_prices(spark, sf_dir), path, "overwrite")
    return quality.row_count(sinks.read_prices(spark, path))


def normalize_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows -> API record shape -> normalised back (no I/O)."""
    rec = sinks.to_api_records(panel.raw_prices(spark, sf_dir))
    return files.normalize_prices(rec, ticker="ticker",
                                  ingested_at=F.col("run_date").cast("timestamp"))


def normalize_partial_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a feed without adjusted closes and volumes, with a column
    that nobody asked for: what is missing is NULL, the rest as ever."""
    rec = sinks.to_api_records(panel.raw_prices(spark, sf_dir)).drop("adjClose", "volume")
    return files.normalize_prices(rec.withColumn("splitFactor", F.lit("1.0")), ticker="ticker",
                                  ingested_at=F.col("run_date").cast("timestamp"))


def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch frames concatenated by name; a feed without ``adj_close``
    gets NULLs there."""
    b = layers.raw_batches(spark, sf_dir)
    return (b["F"].drop("adj_close").unionByName(b["O"], allowMissingColumns=True)
            .select(*PRICE_COLUMNS))


def filter_ticker_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing keys restricted to the tickers of the incoming batch
    (the IN-list of the dedup query, as a semi-join)."""
    b = layers.raw_batches(spark, sf_dir)
    incoming = b["O"].select("ticker").distinct()
    return b["F"].join(incoming, "ticker", "left_semi").select("date", "ticker").distinct()


def replace_layers(spark: SparkSession, sf_dir: str, prefix: str) -> dict[str, str]:
    """raw -> staging -> marts, every asset built from the tables before it and
    made the table ``prefix``_name by create+replace, as the scheduled run
    does. Returns asset -> table."""
    names = {a: f"{prefix}_{a}" for a in ("stg_stock_prices", "stg_stock_metadata",
                                          "mart_daily_ohlcv", "mart_stock_returns",
                                          "mart_quarterly_summary")}

    def build(asset: str, df: DataFrame, by_date: bool = True) -> DataFrame:
        layout = {"partition_by": "date", "cluster_by": ("ticker",)} if by_date else {}
        catalog.create_or_replace(spark, names[asset], df, **layout)
        return spark.table(names[asset])

    build("stg_stock_metadata", stage_metadata(files.normalize_metadata(
        panel.raw_metadata(spark, sf_dir))), by_date=False)
    staged = build("stg_stock_prices", stage_prices(layers.raw(spark, sf_dir)))
    daily = build("mart_daily_ohlcv", mart_daily_ohlcv(staged))
    build("mart_stock_returns", mart_stock_returns(daily), by_date=False)
    build("mart_quarterly_summary", mart_quarterly_summary(daily), by_date=False)
    return names


def _replaced(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return replace_layers(spark, sf_dir, "run_" + uuid.uuid4().hex[:12])


def end_to_end_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarterly mart read from its table after a whole run."""
    return spark.table(_replaced(spark, sf_dir)["mart_quarterly_summary"])


def replaced_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, tickers and adjusted closes of every table after a whole run."""
    parts = [spark.table(table).agg(F.count(F.lit(1)).alias("rows"),
                                    F.countDistinct("ticker").alias("tickers"))
             .select(F.lit(asset).alias("asset"), "rows", "tickers")
             for asset, table in _replaced(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, parts)
