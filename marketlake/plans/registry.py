"""Registered queries (key -> (spark, sf_dir) -> DataFrame) and their oracle SQL.

Every query reads the given tables (through the derived price panel or the
metadata feed) over their whole extent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import staging as stg_ops
from marketlake.operators.quarterly import quarter_boundaries
from marketlake.plans import layers
from marketlake.plans.sql import with_ctes
from marketlake.sources import panel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _select(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def _sql_cols(cols: list[str]) -> str:
    return ", ".join(cols)


# ------------------------------------------------------------------ raw / staging

register("raw_prices", with_ctes("SELECT * FROM raw", "raw"))(
    lambda s, d: panel.raw_prices(s, d))

register("stg_row_filter", with_ctes(
    "SELECT * FROM raw WHERE date IS NOT NULL AND ticker IS NOT NULL AND close IS NOT NULL "
    "AND close > 0 AND open > 0 AND volume >= 0", "raw"))(
    lambda s, d: stg_ops.admit_rows(layers.raw(s, d)))

register("stg_dedup_latest", with_ctes(
    "SELECT date, ticker, open, high, low, close, adj_close, volume, ingested_at "
    "FROM stg_source WHERE row_num = 1", "stg_source"))(
    lambda s, d: stg_ops.dedup_latest(stg_ops.admit_rows(layers.raw(s, d))))

register("stg_stock_prices", with_ctes("SELECT * FROM stg", "stg"))(
    lambda s, d: layers.staged(s, d))

register("stg_daily_return", with_ctes(
    "SELECT date, ticker, adj_close, daily_return FROM stg", "stg"))(
    lambda s, d: layers.staged(s, d).select("date", "ticker", "adj_close", "daily_return"))

register("stg_quality_flag", with_ctes(
    "SELECT date, ticker, open, high, low, close, volume, price_range, is_valid FROM stg",
    "stg"))(
    lambda s, d: layers.staged(s, d).select("date", "ticker", "open", "high", "low", "close",
                                            "volume", "price_range", "is_valid"))

# ------------------------------------------------------------------ daily mart

register("mart_daily_ohlcv", with_ctes("SELECT * FROM daily", "daily"))(
    lambda s, d: layers.daily(s, d))

_DAILY_PARTS = {
    "ohlcv_moving_averages": ["date", "ticker", "adj_close", "ma_7", "ma_30", "ma_90", "ma_200"],
    "ohlcv_volatility": ["date", "ticker", "daily_return", "volatility_30"],
    "ohlcv_avg_volume": ["date", "ticker", "volume", "avg_volume_30"],
    "ohlcv_52w_range": ["date", "ticker", "high", "low", "week_52_high", "week_52_low"],
    "ohlcv_cumulative_return": ["date", "ticker", "adj_close", "cumulative_return"],
}
for _k, _cols in _DAILY_PARTS.items():
    register(_k, with_ctes(f"SELECT {_sql_cols(_cols)} FROM daily", "daily"))(
        (lambda cols: lambda s, d: layers.daily(s, d).select(*cols))(_cols))

# ------------------------------------------------------------------ returns mart

register("mart_stock_returns", with_ctes("SELECT * FROM returns", "returns"))(
    lambda s, d: layers.returns(s, d))

register("returns_sorted", with_ctes("SELECT * FROM returns ORDER BY ticker, date", "returns"))(
    lambda s, d: layers.returns(s, d, ordered=True))

_RET_PARTS = {
    "returns_lagged": ["date", "ticker", "adj_close", "weekly_return", "monthly_return",
                       "quarterly_return"],
    "returns_ytd": ["date", "ticker", "adj_close", "ytd_return"],
    "returns_cumulative": ["date", "ticker", "adj_close", "cumulative_return"],
    "returns_sharpe": ["date", "ticker", "daily_return", "sharpe_ratio_30d"],
    "returns_win_rate": ["date", "ticker", "daily_return", "win_rate_30d"],
    "returns_up_day": ["date", "ticker", "daily_return", "is_up_day"],
}
for _k, _cols in _RET_PARTS.items():
    register(_k, with_ctes(f"SELECT {_sql_cols(_cols)} FROM returns", "returns"))(
        (lambda cols: lambda s, d: layers.returns(s, d).select(*cols))(_cols))

# ------------------------------------------------------------------ quarterly mart

register("mart_quarterly_summary", with_ctes("SELECT * FROM quarterly", "quarterly"))(
    lambda s, d: layers.quarterly(s, d))

register("quarterly_sorted", with_ctes(
    "SELECT * FROM quarterly ORDER BY ticker, year, quarter", "quarterly"))(
    lambda s, d: layers.quarterly(s, d, ordered=True))

_Q_PARTS = {
    "quarterly_boundaries": ["ticker", "year", "quarter", "quarter_start_date",
                             "quarter_end_date", "open_price", "close_price"],
    "quarterly_open_close": ["ticker", "year", "quarter", "open_price", "close_price"],
    "quarterly_high_low": ["ticker", "year", "quarter", "high_price", "low_price"],
    "quarterly_volume": ["ticker", "year", "quarter", "avg_volume", "trading_days"],
    "quarterly_return": ["ticker", "year", "quarter", "quarterly_return_pct"],
    "quarterly_drawdown": ["ticker", "year", "quarter", "max_drawdown"],
}
for _k, _cols in _Q_PARTS.items():
    register(_k, with_ctes(f"SELECT {_sql_cols(_cols)} FROM quarterly", "quarterly"))(
        (lambda cols: lambda s, d: layers.quarterly(s, d).select(*cols))(_cols))

# ------------------------------------------------------------------ metadata

register("normalize_metadata", with_ctes("SELECT * FROM meta_norm", "meta_norm"))(
    lambda s, d: __import__("marketlake.sources.files", fromlist=["x"]).normalize_metadata(
        panel.raw_metadata(s, d)))

register("stg_metadata", with_ctes("SELECT * FROM meta_stg", "meta_stg"))(
    lambda s, d: layers.metadata(s, d))


# ------------------------------------------------------------------ loads and sinks

from marketlake.operators import quality as dq  # noqa: E402
from marketlake.plans import roundtrips as rt  # noqa: E402
from marketlake.plans.sql import register_cte  # noqa: E402

register_cte("raw_f", "SELECT * FROM raw WHERE ingested_at = TIMESTAMP '2001-12-01 00:00:00'",
             ["raw"])
register_cte("raw_o", "SELECT * FROM raw WHERE ingested_at = TIMESTAMP '2001-12-02 00:00:00'",
             ["raw"])
_RAW_COLS = "date, open, high, low, close, adj_close, volume, ticker, ingested_at"
_NEW_O = ("SELECT o.* FROM raw_o o WHERE NOT EXISTS "
          "(SELECT 1 FROM raw_f f WHERE f.date = o.date AND f.ticker = o.ticker)")

register("load_csv_prices", with_ctes("SELECT * FROM raw", "raw"))(rt.load_csv_prices)
register("load_csv_metadata", with_ctes("SELECT * FROM meta_raw", "meta_raw"))(
    rt.load_csv_metadata)
register("csv_export_roundtrip", with_ctes("SELECT * FROM meta_norm", "meta_norm"))(
    rt.csv_export_roundtrip)
_JUNK = "ticker = 'Brand#11' AND day(date) = 1"
register("load_rejects", with_ctes(
    "SELECT CAST(NULL AS DATE) AS date, open, high, low, close, adj_close, volume, ticker, "
    f"ingested_at FROM raw WHERE {_JUNK}", "raw"))(rt.load_rejects)
register("insert_new_with_bad_dates", with_ctes(
    f"SELECT {_RAW_COLS} FROM (SELECT {_RAW_COLS} FROM raw_f UNION ALL {_NEW_O}) "
    f"WHERE NOT ({_JUNK})", "raw_f", "raw_o"))(rt.insert_new_with_bad_dates)
register("normalize_api_metadata", with_ctes(
    "SELECT CASE WHEN lost THEN ticker ELSE upper(ticker) END AS ticker, "
    + ", ".join(f"CASE WHEN NOT lost THEN coalesce({c}, '') END AS {c}"
                for c in ("company_name", "exchange", "start_date", "end_date"))
    + ", CASE WHEN NOT lost THEN substring(coalesce(description, ''), 1, 300) END AS description, "
    "fetched_at FROM (SELECT *, regexp_extract(ticker, '[0-9]+') = '11' AS lost FROM meta_raw)",
    "meta_raw"))(rt.normalize_api_metadata)
register("sink_append_roundtrip", with_ctes("SELECT * FROM raw", "raw"))(
    rt.sink_append_roundtrip)
register("sink_overwrite_roundtrip", with_ctes("SELECT * FROM meta_norm", "meta_norm"))(
    rt.sink_overwrite_roundtrip)
register("incremental_insert_new", with_ctes(
    f"SELECT {_RAW_COLS} FROM raw_f UNION ALL {_NEW_O}", "raw_f", "raw_o"))(
    rt.incremental_insert_new)
register("landing_json_roundtrip", with_ctes("SELECT * FROM raw", "raw"))(
    rt.landing_json_roundtrip)
register("read_landing_json", with_ctes("SELECT * FROM raw", "raw"))(rt.read_landing_json)
_MALFORMED = "day(date) = 1 AND ticker IN ('Brand#11', 'Brand#12')"
_NO_DATE = "day(date) = 1 AND ticker = 'Brand#13'"
register("load_csv_foreign", with_ctes(
    f"SELECT * FROM raw WHERE NOT ({_MALFORMED}) AND NOT ({_NO_DATE})", "raw"))(
    rt.load_csv_foreign)
register("load_csv_rejects", with_ctes(
    f"SELECT 'malformed' AS reason, ticker, COUNT(*) AS lines FROM raw WHERE {_MALFORMED} "
    f"GROUP BY ticker UNION ALL SELECT 'date missing', ticker, COUNT(*) FROM raw WHERE {_NO_DATE} "
    "GROUP BY ticker", "raw"))(rt.load_csv_rejects)
register("compacted_prices", with_ctes("SELECT * FROM raw", "raw"))(rt.compacted_prices)
register("retention_filter", with_ctes(
    "SELECT * FROM raw WHERE CAST(ingested_at AS DATE) >= DATE '2002-12-02' - INTERVAL 365 DAY",
    "raw"))(rt.retention_filter)
register("load_row_count", with_ctes("SELECT COUNT(*) AS row_count FROM raw", "raw"))(
    rt.load_row_count)
register("normalize_prices", with_ctes("SELECT * FROM raw", "raw"))(rt.normalize_prices)
register("normalize_partial_feed", with_ctes(
    "SELECT date, open, high, low, close, CAST(NULL AS DOUBLE) AS adj_close, "
    "CAST(NULL AS BIGINT) AS volume, ticker, ingested_at FROM raw", "raw"))(
    rt.normalize_partial_feed)
register("union_feeds", with_ctes(
    "SELECT date, open, high, low, close, CAST(NULL AS DOUBLE) AS adj_close, volume, ticker, "
    "ingested_at FROM raw_f UNION ALL SELECT * FROM raw_o", "raw_f", "raw_o"))(rt.union_feeds)
register("filter_ticker_universe", with_ctes(
    "SELECT DISTINCT date, ticker FROM raw_f WHERE ticker IN (SELECT DISTINCT ticker FROM raw_o)",
    "raw_f", "raw_o"))(rt.filter_ticker_universe)
register("distinct_keys", with_ctes("SELECT DISTINCT date, ticker FROM raw", "raw"))(
    lambda s, d: layers.raw(s, d).select("date", "ticker").distinct())
register("end_to_end_marts", with_ctes("SELECT * FROM quarterly", "quarterly"))(
    rt.end_to_end_marts)
register("replaced_layers", with_ctes(" UNION ALL ".join(
    f"SELECT '{asset}' AS asset, COUNT(*) AS rows, COUNT(DISTINCT ticker) AS tickers FROM {cte}"
    for asset, cte in (("stg_stock_prices", "stg"), ("stg_stock_metadata", "meta_stg"),
                       ("mart_daily_ohlcv", "daily"), ("mart_stock_returns", "returns"),
                       ("mart_quarterly_summary", "quarterly"))),
    "stg", "meta_stg", "daily", "returns", "quarterly"))(rt.replaced_layers)
register("quarterly_boundaries_rows", with_ctes(
    "SELECT ticker, date, adj_close, FIRST_VALUE(date) OVER q AS quarter_start_date, "
    "LAST_VALUE(date) OVER q AS quarter_end_date, FIRST_VALUE(adj_close) OVER q "
    "AS quarter_open_price, LAST_VALUE(adj_close) OVER q AS quarter_close_price FROM daily "
    "WINDOW q AS (PARTITION BY ticker, date_trunc('quarter', date) ORDER BY date "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)", "daily"))(
    lambda s, d: quarter_boundaries(layers.daily(s, d)))

# ------------------------------------------------------------------ quality and reports

register("dq_duplicate_keys", with_ctes(
    "SELECT date, ticker, COUNT(*) AS versions FROM raw GROUP BY date, ticker "
    "HAVING COUNT(*) > 1", "raw"))(lambda s, d: dq.duplicate_keys(layers.raw(s, d)))

register("dq_validity_counts", with_ctes(
    "SELECT ticker, COUNT(*) AS staged_rows, "
    "CAST(SUM(CASE WHEN is_valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows, "
    "CAST(SUM(CASE WHEN NOT is_valid THEN 1 ELSE 0 END) AS BIGINT) AS invalid_rows, "
    "CAST(SUM(CASE WHEN high < low THEN 1 ELSE 0 END) AS BIGINT) AS high_below_low, "
    "CAST(SUM(CASE WHEN high < close THEN 1 ELSE 0 END) AS BIGINT) AS high_below_close, "
    "CAST(SUM(CASE WHEN low > close THEN 1 ELSE 0 END) AS BIGINT) AS low_above_close "
    "FROM stg GROUP BY ticker", "stg"))(
    lambda s, d: dq.validity_counts(layers.staged(s, d)))

register("dq_rejections", with_ctes(
    "SELECT reason, COUNT(*) AS rejected_rows FROM (SELECT CASE "
    "WHEN date IS NULL THEN 'date_null' WHEN ticker IS NULL THEN 'ticker_null' "
    "WHEN close IS NULL THEN 'close_null' WHEN close <= 0 THEN 'close_not_positive' "
    "WHEN open IS NULL THEN 'open_null' WHEN open <= 0 THEN 'open_not_positive' "
    "WHEN volume IS NULL THEN 'volume_null' WHEN volume < 0 THEN 'volume_negative' "
    "END AS reason FROM raw) WHERE reason IS NOT NULL GROUP BY reason", "raw"))(
    lambda s, d: dq.rejections(layers.raw(s, d)))

register("dq_null_counts", with_ctes(
    "SELECT COUNT(*) AS rows, "
    + ", ".join(f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{c}"
                for c in ["date", "open", "high", "low", "close", "adj_close", "volume",
                          "ticker", "ingested_at"])
    + " FROM raw", "raw"))(lambda s, d: dq.null_counts(layers.raw(s, d)))

register("dq_dedup_report", with_ctes(
    "SELECT COUNT(*) AS before, "
    "CAST(SUM(CASE WHEN seen IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS after, "
    "CAST(SUM(CASE WHEN seen THEN 1 ELSE 0 END) AS BIGINT) AS removed "
    "FROM raw_o o LEFT JOIN (SELECT DISTINCT date, ticker, TRUE AS seen FROM raw_f) f "
    "USING (date, ticker)", "raw_o", "raw_f"))(rt.dedup_report)

register("load_report", with_ctes(
    "SELECT COUNT(*) AS rows, COUNT(DISTINCT ticker) AS tickers, MIN(date) AS first_date, "
    "MAX(date) AS last_date FROM raw", "raw"))(
    lambda s, d: dq.load_report(layers.raw(s, d)))

register("rows_per_ticker", with_ctes(
    "SELECT ticker, COUNT(*) AS rows FROM raw GROUP BY ticker", "raw"))(
    lambda s, d: dq.rows_per_ticker(layers.raw(s, d)))

register("last_price_global_date", with_ctes(
    "SELECT ticker, adj_close AS last_close, date AS last_date FROM daily "
    "WHERE date = (SELECT MAX(date) FROM daily)", "daily"))(
    lambda s, d: dq.last_price_at_global_date(layers.daily(s, d)))

register("tail_sample", with_ctes(
    "SELECT * FROM daily QUALIFY ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date DESC) <= 5",
    "daily"))(lambda s, d: dq.tail_per_ticker(layers.daily(s, d), 5))

register("scalar_cleaning", with_ctes(
    "SELECT ticker, listing_start_date, listing_end_date, is_active FROM meta_stg", "meta_stg"))(
    lambda s, d: layers.metadata(s, d).select("ticker", "listing_start_date",
                                              "listing_end_date", "is_active"))


# ------------------------------------------------------------------ forecasting

from marketlake.plans import forecasting as fcp  # noqa: E402
from marketlake.streaming import ingest as stream_ingest  # noqa: E402

register("forecast_training_set", with_ctes(
    "SELECT ticker, date, adj_close AS y FROM daily WHERE adj_close IS NOT NULL", "daily"))(
    fcp.training_set)
register("forecast_regularize")(fcp.regularized)
register("forecast_spike_clean")(fcp.spike_clean)
register("forecast_step_adjust")(fcp.step_adjust)
register("forecast_decompose")(fcp.decomposition)
register("forecast_holiday_effect")(fcp.holiday_effect)
register("forecast_holiday_calendar")(fcp.holiday_calendar)
register("forecast_fit")(fcp.fit_candidates)
register("forecast_model_select")(fcp.model_select)
register("forecast_evaluate")(fcp.evaluate)
register("forecast_fit_status")(fcp.fit_status)
register("forecast_order_tests")(fcp.order_tests)
register("forecast_order_candidates")(fcp.order_candidates)
register("forecast_order_search")(fcp.order_models)
register("forecast_order_predictions")(fcp.order_predictions)
register("forecast_predictions")(fcp.predictions)
register("forecast_predictions_sorted")(fcp.predictions_sorted)
register("forecast_business_calendar")(fcp.business_calendar_predictions)
register("forecast_summary")(fcp.summary)
register("replace_run_date")(fcp.replace_run_date)
register("truncate_predictions")(fcp.truncate_predictions)
register("history_and_forecast")(fcp.history_and_forecast)
register("mart_with_metadata", with_ctes(
    "SELECT d.*, m.company_name, m.exchange, m.is_active FROM daily d "
    "LEFT JOIN meta_stg m ON upper(trim(d.ticker)) = m.ticker", "daily", "meta_stg"))(
    fcp.mart_with_metadata)

# oracle SQL of the forecast chain
from marketlake.plans import sql_forecast as sqf  # noqa: E402

register_cte("kpss_value", (
    "SELECT ticker, 0 AS k, i, s AS v FROM (SELECT ticker, s, "
    "row_number() OVER (PARTITION BY ticker ORDER BY date) AS i FROM fc_rows) UNION ALL "
    "SELECT ticker, 1, i, v FROM (SELECT ticker, row_number() OVER w AS i, "
    "s - lag(s) OVER w AS v FROM fc_rows WINDOW w AS (PARTITION BY ticker ORDER BY date)) "
    "WHERE v IS NOT NULL"), ["fc_rows"])
register_cte("kpss_dev", (
    "SELECT ticker, k, i, v - avg(v) OVER (PARTITION BY ticker, k) AS e, "
    "count(*) OVER (PARTITION BY ticker, k) AS n, count(*) OVER (PARTITION BY ticker, k) + k "
    "AS total FROM kpss_value"), ["kpss_value"])
register_cte("kpss_cov", (
    "SELECT a.ticker, a.k, l, sum(a.e * b.e) AS g FROM kpss_dev a, range(40) r(l) JOIN kpss_dev b "
    "ON a.ticker = b.ticker AND a.k = b.k AND a.i = b.i + l "
    "WHERE l <= floor(4 * pow(a.total / 100, 0.25)) GROUP BY a.ticker, a.k, l"), ["kpss_dev"])
register_cte("kpss_stat", (
    "SELECT ticker, k, total, top / (n * n * lrv) AS eta FROM (SELECT ticker, k, total, n, "
    "sum(cum * cum) AS top FROM (SELECT ticker, k, total, n, sum(e) OVER (PARTITION BY ticker, k "
    "ORDER BY i) AS cum FROM kpss_dev) GROUP BY ALL) JOIN (SELECT c.ticker, c.k, "
    "sum(CASE WHEN l = 0 THEN g ELSE 2 * (1 - l / (floor(4 * pow(total / 100, 0.25)) + 1)) * g END) "
    "/ any_value(n) AS lrv FROM kpss_cov c JOIN (SELECT DISTINCT ticker, k, n, total FROM kpss_dev) "
    "USING (ticker, k) GROUP BY c.ticker, c.k) USING (ticker, k)"), ["kpss_dev", "kpss_cov"])

ORACLE.update(sqf.ORACLE)
ORACLE["forecast_predictions"] = sqf.prediction_sql(fcp.MODEL_RUN_DATE)
ORACLE["forecast_predictions_sorted"] = sqf.prediction_sql(
    fcp.MODEL_RUN_DATE, "ORDER BY ticker, forecast_date")
ORACLE["truncate_predictions"] = sqf.prediction_sql(fcp.MODEL_RUN_DATE)
ORACLE["replace_run_date"] = sqf._recursive(with_ctes(
    f"SELECT {sqf.PRED_COLS.format(run=fcp.EARLIER_RUN_DATE)} FROM fc_pred UNION ALL "
    f"SELECT {sqf.PRED_COLS.format(run=fcp.MODEL_RUN_DATE)} FROM fc_pred", "fc_pred"))
ORACLE["forecast_business_calendar"] = sqf.business_prediction_sql(fcp.MODEL_RUN_DATE)
ORACLE["forecast_fit_status"] = with_ctes(
    "SELECT r.ticker, r.rows, CASE WHEN r.rows < 30 THEN 'too_few_rows' "
    "WHEN c.any_ok IS NULL OR c.max_var <= 0 THEN 'zero_variance' "
    "WHEN c.any_ok = 0 THEN 'no_admissible_model' ELSE 'ok' END AS status "
    "FROM (SELECT ticker, COUNT(*) AS rows FROM fc_rows GROUP BY ticker) r "
    "LEFT JOIN (SELECT ticker, MAX(CAST(admissible AS INTEGER)) AS any_ok, "
    "MAX(sigma2) AS max_var FROM fc_cand GROUP BY ticker) c USING (ticker)",
    "fc_rows", "fc_cand")
_PRED_CTE = f"SELECT {sqf.PRED_COLS.format(run=fcp.MODEL_RUN_DATE)} FROM fc_pred"
# level tests by definition: sums of squared partial sums over n^2 times the long-run variance
ORACLE["forecast_order_tests"] = with_ctes(
    "SELECT ticker, any_value(total) AS n, ROUND(max(CASE WHEN k = 0 THEN eta END), 6) AS kpss0, "
    "ROUND(max(CASE WHEN k = 1 THEN eta END), 6) AS kpss1, "
    "CASE WHEN max(CASE WHEN k = 0 THEN eta END) > 0.463 THEN "
    "CASE WHEN max(CASE WHEN k = 1 THEN eta END) > 0.463 THEN 2 ELSE 1 END ELSE 0 END AS d "
    "FROM kpss_stat GROUP BY ticker", "kpss_stat")
ORACLE["history_and_forecast"] = sqf._recursive(with_ctes(
    "SELECT ticker, date, adj_close AS value, CAST(NULL AS DOUBLE) AS lower, "
    "CAST(NULL AS DOUBLE) AS upper, 'history' AS kind FROM daily UNION ALL "
    "SELECT ticker, forecast_date AS date, predicted_close AS value, "
    "prediction_interval_lower_value AS lower, prediction_interval_upper_value AS upper, "
    f"'forecast' AS kind FROM ({_PRED_CTE})", "fc_pred", "daily"))
ORACLE["forecast_summary"] = sqf._recursive(with_ctes(
    "SELECT f.ticker, lp.last_close, f.forecast_date, f.predicted_close AS forecast_close, "
    "f.prediction_interval_lower_value AS lower, f.prediction_interval_upper_value AS upper, "
    "ROUND((f.predicted_close - lp.last_close) / NULLIF(lp.last_close, 0) * 100, 2) "
    "AS change_pct "
    f"FROM ({_PRED_CTE}) f "
    "LEFT JOIN (SELECT ticker, adj_close AS last_close FROM daily "
    "WHERE date = (SELECT MAX(date) FROM daily)) lp USING (ticker) "
    "WHERE f.forecast_date = (SELECT MAX(forecast_date) FROM fc_pred p "
    "WHERE p.ticker = f.ticker)", "fc_pred", "daily"))

# ------------------------------------------------------------------ streaming

register("stream_incremental_ingest", with_ctes(
    f"SELECT {_RAW_COLS} FROM raw_f UNION ALL {_NEW_O}", "raw_f", "raw_o"))(
    stream_ingest.incremental_ingest_demo)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql", "F"]
