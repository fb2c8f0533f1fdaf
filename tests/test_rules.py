"""Hand-sized frames for the null / zero / first-row rules of each layer."""

import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators.daily import mart_daily_ohlcv
from marketlake.operators.quarterly import mart_quarterly_summary
from marketlake.operators.returns import mart_stock_returns
from marketlake.operators.staging import stage_metadata, stage_prices
from marketlake.sources.schemas import RAW_METADATA_SCHEMA, RAW_PRICE_SCHEMA

T1 = dt.datetime(2020, 1, 1)
T2 = dt.datetime(2020, 1, 2)


def d(i):
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def bar(i, close, adj=..., high=None, low=None, open_=None, vol=100, ticker="AAA", t=T1):
    adj = close if adj is ... else adj
    high = close + 1 if high is None else high
    low = close - 1 if low is None else low
    open_ = close if open_ is None else open_
    return (d(i), open_, high, low, close, adj, vol, ticker, t)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_PRICE_SCHEMA)


def by_date(df):
    return {r["date"]: r for r in df.collect()}


def test_admission_and_dedup(spark):
    rows = [bar(0, 10.0), bar(0, 11.0, t=T2),            # same key twice: latest wins
            bar(1, 0.0), bar(2, 5.0, vol=-1),               # rejected: close 0, volume < 0
            (d(3), None, 6.0, 4.0, 5.0, 5.0, 10, "AAA", T1),  # NULL open rejected
            bar(4, 12.0)]
    stg = by_date(stage_prices(raw(spark, rows)))
    assert sorted(stg) == [d(0), d(4)]
    assert stg[d(0)]["close"] == 11.0


def test_zero_divisor_and_null_lag(spark):
    rows = [bar(0, 10.0, adj=0.0), bar(1, 10.0, adj=5.0), bar(2, 10.0, adj=None),
            bar(3, 10.0, adj=6.0)]
    stg = by_date(stage_prices(raw(spark, rows)))
    assert stg[d(0)]["daily_return"] is None          # first row
    assert stg[d(1)]["daily_return"] is None          # previous adj_close is 0
    assert stg[d(2)]["daily_return"] is None          # own adj_close NULL
    assert stg[d(3)]["daily_return"] is None          # previous adj_close NULL


def test_quality_flag_null_high_low_is_valid(spark):
    rows = [(d(0), 10.0, None, None, 10.0, 10.0, 1, "AAA", T1),
            bar(1, 10.0, high=9.0, low=11.0),           # high < low
            bar(2, 10.0, high=9.5, low=9.0)]            # high < close
    stg = by_date(stage_prices(raw(spark, rows)))
    assert stg[d(0)]["is_valid"] is True
    assert stg[d(0)]["price_range"] is None
    assert stg[d(1)]["is_valid"] is False
    assert stg[d(2)]["is_valid"] is False


def test_daily_first_row_and_single_value_stddev(spark):
    rows = [bar(0, 10.0), bar(1, 12.0), bar(2, 9.0)]
    daily = by_date(mart_daily_ohlcv(stage_prices(raw(spark, rows))))
    assert daily[d(0)]["ma_200"] == 10.0               # no minimum-periods rule
    assert daily[d(0)]["volatility_30"] is None        # no return yet
    assert daily[d(1)]["volatility_30"] is None        # one return: stddev NULL
    assert daily[d(2)]["volatility_30"] is not None
    assert daily[d(2)]["week_52_high"] == 13.0 and daily[d(2)]["week_52_low"] == 8.0
    assert daily[d(2)]["cumulative_return"] == round((9.0 - 10.0) / 10.0, 6)


def test_cumulative_anchor_null_first_adj_close(spark):
    # daily: anchor is the first valid row even with a NULL adj_close (-> NULL)
    # returns: NULL adj_close rows are dropped first, so the anchor moves on
    rows = [bar(0, 10.0, adj=None), bar(1, 10.0, adj=8.0), bar(2, 10.0, adj=10.0)]
    daily_df = mart_daily_ohlcv(stage_prices(raw(spark, rows)))
    daily = by_date(daily_df)
    assert daily[d(2)]["cumulative_return"] is None
    ret = by_date(mart_stock_returns(daily_df))
    assert ret[d(2)]["cumulative_return"] == 0.25
    assert ret[d(2)]["ytd_return"] == 0.25


def test_win_rate_counts_null_return_as_zero(spark):
    rows = [bar(0, 10.0), bar(1, 11.0), bar(2, 10.0), bar(3, 12.0)]
    ret = by_date(mart_stock_returns(mart_daily_ohlcv(stage_prices(raw(spark, rows)))))
    assert ret[d(0)]["is_up_day"] == 0 and ret[d(0)]["win_rate_30d"] == 0.0
    assert ret[d(3)]["win_rate_30d"] == 0.5                       # 2 up of 4 rows
    assert ret[d(1)]["sharpe_ratio_30d"] is None                  # one return


def test_quarterly_open_close_keep_nulls(spark):
    rows = [bar(0, 10.0, adj=None), bar(1, 10.0, adj=8.0), bar(2, 10.0, adj=9.0)]
    q = mart_quarterly_summary(mart_daily_ohlcv(stage_prices(raw(spark, rows)))).collect()
    assert len(q) == 1
    assert q[0]["open_price"] is None and q[0]["close_price"] == 9.0
    assert q[0]["quarterly_return_pct"] is None
    assert q[0]["trading_days"] == 3


def test_metadata_rules(spark):
    rows = [(" aaa ", " A ", "x", "nasdaq", "2020", "", T1),
            ("bbb", "B", "y", "nyse", "2020-01-05", "2021-02-03", T1),
            ("  ", "C", "z", "nyse", None, None, T1)]
    meta = {r["ticker"]: r for r in stage_metadata(
        spark.createDataFrame(rows, RAW_METADATA_SCHEMA)).collect()}
    assert sorted(meta) == ["AAA", "BBB"]                 # blank ticker dropped
    assert meta["AAA"]["listing_start_date"] is None      # '2020' is not a date
    assert meta["AAA"]["is_active"] is True and meta["AAA"]["listing_end_date"] is None
    assert meta["BBB"]["listing_end_date"] == dt.date(2021, 2, 3)
    assert meta["BBB"]["is_active"] is False
    assert meta["AAA"]["exchange"] == "NASDAQ"


def test_safe_divide_never_raises(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (2.0, 4.0)], "a double, b double")
    from marketlake.functions import safe_divide
    out = [r[0] for r in df.select(safe_divide("a", "b")).collect()]
    assert out == [None, None, 0.5]
    assert df.select(F.lit(1)).count() == 3
