"""Data-quality checks and load reports — all single-pass aggregates (partial
aggregation before the shuffle, so they scale with the data, not the key)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.sources.schemas import PRICE_COLUMNS

KEY = ["date", "ticker"]


def duplicate_keys(raw: DataFrame) -> DataFrame:
    """Q1: (date, ticker) keys stored more than once."""
    return (raw.groupBy(*KEY).agg(F.count(F.lit(1)).alias("versions"))
            .filter(F.col("versions") > 1))


def validity_counts(stg: DataFrame) -> DataFrame:
    """Q2: per ticker, staged rows, valid / invalid and the failing rule."""
    c = F.col

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    return stg.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("staged_rows"),
        n(c("is_valid")).alias("valid_rows"),
        n(~c("is_valid")).alias("invalid_rows"),
        n(c("high") < c("low")).alias("high_below_low"),
        n(c("high") < c("close")).alias("high_below_close"),
        n(c("low") > c("close")).alias("low_above_close"),
    )


def rejection_reason() -> F.Column:
    """First admission rule a raw row fails (NULL when admitted)."""
    c = F.col
    return (F.when(c("date").isNull(), "date_null")
            .when(c("ticker").isNull(), "ticker_null")
            .when(c("close").isNull(), "close_null")
            .when(c("close") <= 0, "close_not_positive")
            .when(c("open").isNull(), "open_null")
            .when(c("open") <= 0, "open_not_positive")
            .when(c("volume").isNull(), "volume_null")
            .when(c("volume") < 0, "volume_negative"))


def rejections(raw: DataFrame) -> DataFrame:
    """Q3: rejected raw rows by reason."""
    return (raw.select(rejection_reason().alias("reason")).filter(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows")))


def null_counts(raw: DataFrame) -> DataFrame:
    """Q5: NULLs per column (required columns are date and ticker)."""
    return raw.agg(F.count(F.lit(1)).alias("rows"),
                   *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint")
                     .alias(f"null_{c}") for c in PRICE_COLUMNS])


def load_report(prices: DataFrame) -> DataFrame:
    """A12: rows, distinct tickers, date range."""
    return prices.agg(F.count(F.lit(1)).alias("rows"),
                      F.count_distinct("ticker").alias("tickers"),
                      F.min("date").alias("first_date"),
                      F.max("date").alias("last_date"))


def rows_per_ticker(prices: DataFrame) -> DataFrame:
    """A13."""
    return prices.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))


def row_count(df: DataFrame) -> DataFrame:
    """A11 / K8 as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def dedup_report(batch: DataFrame, existing_keys: DataFrame) -> DataFrame:
    """Q4: before / after / removed around the insert-only-new anti-join, in
    one pass: a left join to the distinct existing keys marks each row."""
    keys = existing_keys.select(*KEY).distinct().withColumn("_seen", F.lit(True))
    marked = batch.select(*KEY).join(keys, KEY, "left")
    return marked.agg(
        F.count(F.lit(1)).alias("before"),
        F.sum(F.when(F.col("_seen").isNull(), 1).otherwise(0)).cast("bigint").alias("after"),
        F.sum(F.when(F.col("_seen"), 1).otherwise(0)).cast("bigint").alias("removed"),
    )


def last_price_at_global_date(daily: DataFrame) -> DataFrame:
    """P9/J3/A10: last close per ticker on the global last date.

    The global MAX(date) is a one-row aggregate; Catalyst joins it as a
    broadcast of a single row (size bound: exactly one row)."""
    last = daily.agg(F.max("date").alias("_last"))
    return (daily.join(F.broadcast(last), F.col("date") == F.col("_last"))
            .select("ticker", F.col("adj_close").alias("last_close"),
                    F.col("date").alias("last_date")))


def tail_per_ticker(df: DataFrame, n: int = 5) -> DataFrame:
    """O6: the last ``n`` rows of every ticker (top-k per group; Catalyst
    limits each group before the shuffle, so a group never exceeds ``n``
    rows in flight)."""
    w = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
            .drop("_rn"))
