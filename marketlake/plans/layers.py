"""The layer graph raw -> staging -> marts as composed DataFrame plans.

Like the warehouse layers they replace (create+replace tables read by the
next layer), ``raw``, ``staged``, ``daily`` and ``metadata`` are materialised
once per session and data folder (columnar tables in the shared folder);
every query reading a layer reads that table instead of re-deriving it, with
its columns pruned and its filters pushed down. ``priced`` is the bucketed
series table that the returns and the forecast read without an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.operators.blocks import DEFAULT_BLOCK_ROWS, materialize
from marketlake.operators.daily import mart_daily_ohlcv
from marketlake.operators.quarterly import mart_quarterly_summary
from marketlake.operators.returns import mart_stock_returns, priced_series
from marketlake.operators.staging import stage_metadata, stage_prices
from marketlake.sources.files import normalize_metadata
from marketlake.sources.panel import raw_metadata, raw_prices


_TABLES: dict = {}


def _table(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = build()
    return _TABLES[key]


def release(spark: SparkSession) -> None:
    """Forget the session's layers and drop their catalog tables; the files
    stay with whoever owns the shared folder."""
    for key in [k for k in _TABLES if k[0] == spark.sparkContext.applicationId]:
        name = getattr(_TABLES.pop(key), "table", None)
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "raw", lambda: materialize(raw_prices(spark, sf_dir), "raw"))


def raw_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The two ingest batches (first and second run) read from the raw layer."""
    from pyspark.sql import functions as F

    from marketlake.sources.panel import BATCH_TIMES
    r = raw(spark, sf_dir)
    return {s: r.filter(F.col("ingested_at") == F.lit(t).cast("timestamp"))
            for s, t in BATCH_TIMES.items()}


def staged(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    return _table(spark, sf_dir, f"stg/{block_rows}",
                  lambda: materialize(stage_prices(raw(spark, sf_dir), block_rows), "staged"))


def daily(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    return _table(spark, sf_dir, f"daily/{block_rows}",
                  lambda: materialize(mart_daily_ohlcv(
                      staged(spark, sf_dir, block_rows), block_rows), "daily"))


def priced(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    return _table(spark, sf_dir, f"priced/{block_rows}",
                  lambda: priced_series(daily(spark, sf_dir, block_rows), block_rows))


def returns(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS,
            ordered: bool = False) -> DataFrame:
    return mart_stock_returns(daily(spark, sf_dir, block_rows), block_rows, ordered,
                              priced(spark, sf_dir, block_rows))


def quarterly(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    return mart_quarterly_summary(daily(spark, sf_dir), ordered)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "metadata",
                  lambda: materialize(stage_metadata(normalize_metadata(
                      raw_metadata(spark, sf_dir))), "metadata"))
