"""mart_stock_returns: lagged, year-to-date and cumulative returns, rolling
Sharpe-like ratio and win rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import relative_change, safe_divide, up_flag, year_of
from marketlake.operators.blocks import (BLK, CHUNK, DEFAULT_BLOCK_ROWS, block_anchors,
                                         drop_internal, over_blocks, store_series)

RETURNS_COLUMNS = ["date", "ticker", "adj_close", "daily_return", "volume", "weekly_return",
                   "monthly_return", "quarterly_return", "ytd_return", "cumulative_return",
                   "sharpe_ratio_30d", "is_up_day", "win_rate_30d"]

# Fixed lags (trading rows) and rolling frame.
LAGS = {"weekly_return": 5, "monthly_return": 21, "quarterly_return": 63}
ROLL = 30


def returns_windows(w) -> list:
    frame = w.rowsBetween(-(ROLL - 1), Window.currentRow)
    cols = [relative_change("adj_close", F.lag("adj_close", k).over(w)).alias(name)
            for name, k in LAGS.items()]
    up = F.when(F.col("daily_return") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    cols += [
        F.round(safe_divide(F.avg("daily_return").over(frame),
                            F.nullif(F.stddev_samp("daily_return").over(frame), F.lit(0.0))),
                4).alias("sharpe_ratio_30d"),
        F.round(F.avg(up).over(frame), 4).alias("win_rate_30d"),
    ]
    return cols


LOOKBACK = max(max(LAGS.values()), ROLL - 1)


def priced_series(daily: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """The series table of bars with an adjusted close, for the returns and
    the forecast. Chunk = calendar year: a year's first value is an anchor."""
    base = daily.filter(F.col("adj_close").isNotNull()).select(
        "date", "ticker", "adj_close", "daily_return", "volume")
    return store_series(base, LOOKBACK, "priced-series", chunk=year_of("date"),
                        block_rows=block_rows)


def mart_stock_returns(daily: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS,
                       ordered: bool = False, series: DataFrame | None = None) -> DataFrame:
    """``series``: the ``priced_series`` of ``daily`` if it is stored already."""
    series = priced_series(daily, block_rows) if series is None else series
    windowed = over_blocks(series, returns_windows)
    first = block_anchors(series, "ticker", "adj_close", block_rows)
    ytd = block_anchors(series, "ticker", "adj_close", block_rows, by_chunk=True)
    anchors = first.join(ytd, ["ticker", BLK], "left")
    out = windowed.join(anchors, ["ticker", BLK], "left").select(
        "*",
        relative_change("adj_close", F.try_element_at("anchors", F.col(CHUNK))).alias("ytd_return"),
        relative_change("adj_close", "anchor").alias("cumulative_return"),
        up_flag("daily_return").alias("is_up_day"),
    )
    out = drop_internal(out).select(*RETURNS_COLUMNS)
    return out.orderBy("ticker", "date") if ordered else out
