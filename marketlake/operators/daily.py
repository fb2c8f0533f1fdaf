"""mart_daily_ohlcv: moving averages, volatility, volume average, 52-week
range and cumulative return over the valid staged bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import relative_change
from marketlake.operators.blocks import (BLK, DEFAULT_BLOCK_ROWS, block_anchors, drop_internal,
                                         over_blocks, store_series)

DAILY_COLUMNS = ["date", "ticker", "open", "high", "low", "close", "adj_close", "volume",
                 "daily_return", "price_range", "ma_7", "ma_30", "ma_90", "ma_200",
                 "volatility_30", "avg_volume_30", "week_52_high", "week_52_low",
                 "cumulative_return"]

# Fixed frame sizes (rows, current row included).
MA_WINDOWS = (7, 30, 90, 200)
VOL_WINDOW = 30
RANGE_WINDOW = 252


def rows(w, n: int):
    return w.rowsBetween(-(n - 1), Window.currentRow)


def daily_windows(w) -> list:
    cols = [F.round(F.avg("adj_close").over(rows(w, n)), 4).alias(f"ma_{n}") for n in MA_WINDOWS]
    cols += [
        F.round(F.stddev_samp("daily_return").over(rows(w, VOL_WINDOW)), 6).alias("volatility_30"),
        F.round(F.avg("volume").over(rows(w, VOL_WINDOW)), 0).alias("avg_volume_30"),
        F.round(F.max("high").over(rows(w, RANGE_WINDOW)), 4).alias("week_52_high"),
        F.round(F.min("low").over(rows(w, RANGE_WINDOW)), 4).alias("week_52_low"),
    ]
    return cols


def mart_daily_ohlcv(stg: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    base = stg.filter(F.col("is_valid")).select(
        "date", "ticker", "open", "high", "low", "close", "adj_close", "volume",
        "daily_return", "price_range")
    series = store_series(base, RANGE_WINDOW - 1, "valid-series", block_rows=block_rows)
    windowed = over_blocks(series, daily_windows)
    # first adj_close of the series (NULL respected), carried to every block
    anchors = block_anchors(series, "ticker", "adj_close", block_rows)
    out = windowed.join(anchors, ["ticker", BLK], "left")
    out = out.withColumn("cumulative_return", relative_change("adj_close", "anchor"))
    return drop_internal(out).select(*DAILY_COLUMNS)
