"""mart_quarterly_summary as one partial aggregate per (ticker, year, quarter).

The warehouse form computes FIRST/LAST_VALUE windows and then MIN/MAX of the
per-group constant; ``min_by``/``max_by`` give the same values (a NULL
adj_close on the first/last day is kept) without a window or a second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import quarter_of, safe_divide, year_of
from marketlake.operators.blocks import (BLK, CHUNK, DEFAULT_BLOCK_ROWS, chunk_ends,
                                         store_series)

QUARTERLY_COLUMNS = ["ticker", "year", "quarter", "quarter_start_date", "quarter_end_date",
                     "open_price", "close_price", "high_price", "low_price", "avg_volume",
                     "trading_days", "quarterly_return_pct", "max_drawdown"]


def quarter_boundaries(daily: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Row-level form: every bar with its quarter's first and last date and the
    adjusted close on them (NULL where that bar has none). The ends of a
    quarter are carried to the blocks of its series; rows are not regrouped."""
    quarter = year_of("date") * 4 + quarter_of("date")
    series = store_series(daily.select("ticker", "date", "adj_close"), 0, "quarter-series",
                          chunk=quarter, block_rows=block_rows)
    ends = chunk_ends(series, "ticker", "adj_close", block_rows)
    at = F.try_element_at("ends", F.col(CHUNK))
    return series.join(ends, ["ticker", BLK], "left").select(
        "ticker", "date", "adj_close", at["start"].alias("quarter_start_date"),
        at["end"].alias("quarter_end_date"), at["first"].alias("quarter_open_price"),
        at["last"].alias("quarter_close_price"))


def mart_quarterly_summary(daily: DataFrame, ordered: bool = False) -> DataFrame:
    g = daily.groupBy("ticker", year_of("date").alias("year"), quarter_of("date").alias("quarter"))
    agg = g.agg(
        F.min("date").alias("quarter_start_date"),
        F.max("date").alias("quarter_end_date"),
        F.min_by("adj_close", "date").alias("open_price"),
        F.max_by("adj_close", "date").alias("close_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.round(F.avg("volume"), 0).alias("avg_volume"),
        F.count(F.lit(1)).alias("trading_days"),
    )
    out = agg.select(
        *QUARTERLY_COLUMNS[:11],
        F.round(safe_divide(F.col("close_price") - F.col("open_price"), "open_price") * 100, 4)
         .alias("quarterly_return_pct"),
        F.round(safe_divide(F.col("low_price") - F.col("high_price"), "high_price") * 100, 4)
         .alias("max_drawdown"),
    )
    return out.orderBy("ticker", "year", "quarter") if ordered else out
