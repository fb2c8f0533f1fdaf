"""Row and NULL counts of every layer at sf0.01, as recorded in FIXTURES.md."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from marketlake.operators.staging import rejected_rows
from marketlake.plans import layers
from marketlake.sources import panel


def nulls(df, *cols):
    row = df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


@pytest.fixture(scope="module")
def daily(spark):
    return layers.daily(spark, SMALL).cache()


def test_raw_counts(spark):
    raw = panel.raw_prices(spark, SMALL)
    assert raw.count() == 47455
    assert raw.select("date", "ticker").distinct().count() == 38372
    assert nulls(raw, "open", "high", "low", "adj_close") == {
        "open": 426, "high": 415, "low": 415, "adj_close": 438}
    assert rejected_rows(raw).count() == 1363


def test_staging_counts(spark):
    stg = layers.staged(spark, SMALL)
    assert stg.count() == 37268
    assert nulls(stg, "adj_close", "daily_return", "price_range") == {
        "adj_close": 337, "daily_return": 699, "price_range": 334}
    assert stg.filter(~F.col("is_valid")).count() == 76


def test_daily_counts(daily):
    assert daily.count() == 37192
    assert nulls(daily, "adj_close", "volatility_30", "cumulative_return") == {
        "adj_close": 336, "volatility_30": 52, "cumulative_return": 336}


def test_returns_and_quarterly_counts(daily):
    from marketlake.operators.quarterly import mart_quarterly_summary
    from marketlake.operators.returns import mart_stock_returns
    ret = mart_stock_returns(daily)
    assert ret.count() == 36856
    assert nulls(ret, "weekly_return", "monthly_return", "quarterly_return",
                 "sharpe_ratio_30d") == {"weekly_return": 125, "monthly_return": 525,
                                         "quarterly_return": 1575, "sharpe_ratio_30d": 51}
    q = mart_quarterly_summary(daily)
    assert q.count() == 700
    assert nulls(q, "open_price", "close_price", "quarterly_return_pct") == {
        "open_price": 4, "close_price": 5, "quarterly_return_pct": 9}


def test_empty_input_is_skipped(spark):
    from marketlake.sources import sinks
    from marketlake.sources.files import empty_prices
    path = sinks.scratch(spark, "test-empty")
    report = sinks.insert_new(spark, empty_prices(spark), path)
    assert report == {"before": 0, "after": 0, "rejected": 0, "removed": 0}
    assert not sinks._exists(spark, path)      # nothing written
