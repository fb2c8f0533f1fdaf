"""Forecast plans: daily mart -> prepared series -> models -> predictions.

One ``ForecastRun`` per (application, data folder) is kept for the session:
its stages are stored in the shared folder, so the keys below read
the stored stages instead of re-running the chain each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import forecast as fc
from marketlake.operators.blocks import drop_internal
from marketlake.operators.forecast import predict
from marketlake.operators.forecast.prep import DEFAULT, ForecastConfig
from marketlake.operators.forecast.search import Search, search_orders, search_steps
from marketlake.operators.quality import last_price_at_global_date
from marketlake.plans import layers
from marketlake.sources import sinks

MODEL_RUN_DATE = "2001-12-03"   # run stamp is an argument, never the clock
EARLIER_RUN_DATE = "2001-11-26"

_RUNS: dict = {}


def forecast_run(spark: SparkSession, sf_dir: str, cfg: ForecastConfig = DEFAULT):
    key = (spark.sparkContext.applicationId, sf_dir, cfg)
    if key not in _RUNS:
        _RUNS[key] = fc.run(layers.daily(spark, sf_dir, cfg.block_rows), cfg,
                            layers.priced(spark, sf_dir, cfg.block_rows))
    return _RUNS[key]


def _predictions(spark, sf_dir, run_date=MODEL_RUN_DATE, cfg=DEFAULT) -> DataFrame:
    return fc.predictions(forecast_run(spark, sf_dir, cfg), run_date, cfg)


def order_search(spark: SparkSession, sf_dir: str, cfg: ForecastConfig = DEFAULT) -> Search:
    """The order search over the prepared series of the forecast run."""
    key = (spark.sparkContext.applicationId, sf_dir, cfg, "orders")
    if key not in _RUNS:
        _RUNS[key] = search_orders(forecast_run(spark, sf_dir, cfg).rows, cfg)
    return _RUNS[key]


# ------------------------------------------------------------------ keys

def training_set(spark, sf_dir):
    return fc.prep.training_set(layers.daily(spark, sf_dir))


def regularized(spark, sf_dir):
    return fc.prep.regularize(fc.prep.training_set(layers.daily(spark, sf_dir)),
                              series=layers.priced(spark, sf_dir))


def spike_clean(spark, sf_dir):
    return forecast_run(spark, sf_dir).rows.select("ticker", "date", "y", "observed",
                                                   "is_spike", "y_clean")


def step_adjust(spark, sf_dir):
    return forecast_run(spark, sf_dir).rows.select("ticker", "date", "y_clean", "step_size",
                                                   "y_adj")


def decomposition(spark, sf_dir):
    return forecast_run(spark, sf_dir).rows.select(
        "ticker", "date", "y_adj", "trend", "holiday", "seasonal", "remainder", "s")


def holiday_effect(spark, sf_dir):
    return forecast_run(spark, sf_dir).holiday_effects


def holiday_calendar(spark, sf_dir):
    return forecast_run(spark, sf_dir).holidays


def fit_report(models: DataFrame) -> DataFrame:
    """Candidate / model table at report precision (coefficients 6 decimals,
    log-likelihood and AIC 4, variance 2); the forecast uses full precision."""
    r = F.round
    return models.select(
        "ticker", "d", "p", "q", *[r(c, 6).alias(c) for c in ["c", "ar1", "ar2", "ma1", "ma2"]],
        r("sigma2", 2).alias("sigma2"), "n_fit", r("log_likelihood", 4).alias("log_likelihood"),
        r("aic", 4).alias("aic"), "admissible", r("kpss", 6).alias("kpss"))


def fit_candidates(spark, sf_dir):
    return fit_report(forecast_run(spark, sf_dir).candidates)


def model_select(spark, sf_dir):
    return fit_report(forecast_run(spark, sf_dir).models)


def evaluate(spark, sf_dir):
    return predict.evaluation(forecast_run(spark, sf_dir).models)


def fit_status(spark, sf_dir):
    r = forecast_run(spark, sf_dir)
    return fc.fit.fit_status(r.rows, r.candidates)


def order_report(models: DataFrame) -> DataFrame:
    """Searched orders at report precision."""
    short = lambda c: F.transform(c, lambda x: F.round(x, 4))
    return models.select(
        "ticker", "d", "p", "q", short("ar").alias("ar"), short("ma").alias("ma"),
        F.round("mean", 4).alias("mean"), F.round("sigma2", 2).alias("sigma2"), "n_fit",
        F.round("log_likelihood", 4).alias("log_likelihood"), F.round("aic", 4).alias("aic"))


def order_candidates(spark, sf_dir):
    return order_report(order_search(spark, sf_dir).candidates)


def order_models(spark, sf_dir):
    return order_report(order_search(spark, sf_dir).models)


def order_tests(spark, sf_dir):
    """Differencing orders with the level-test statistics behind them."""
    return order_search(spark, sf_dir).tests.select(
        "ticker", "n", F.round("kpss0", 6).alias("kpss0"), F.round("kpss1", 6).alias("kpss1"), "d")


def order_predictions(spark, sf_dir):
    """The predictions mart from the searched models."""
    run = forecast_run(spark, sf_dir)
    return predict.predictions(search_steps(order_search(spark, sf_dir)), run.weekday_effects,
                               run.holiday_effects, run.holidays, MODEL_RUN_DATE)


def predictions(spark, sf_dir):
    return _predictions(spark, sf_dir)


def predictions_sorted(spark, sf_dir):
    return _predictions(spark, sf_dir).orderBy("ticker", "forecast_date")


def summary(spark, sf_dir):
    last = last_price_at_global_date(layers.daily(spark, sf_dir))
    return predict.summary(_predictions(spark, sf_dir), last)


def replace_run_date(spark, sf_dir):
    """Two runs land in the predictions mart (partitioned by run date); the
    second run is then repeated and replaces only its own partition."""
    path = sinks.scratch(spark, "predictions")
    sinks.replace_partition(_predictions(spark, sf_dir, EARLIER_RUN_DATE), path,
                            "model_run_date")
    stale = _predictions(spark, sf_dir).withColumn("predicted_close", F.lit(0.0))
    sinks.replace_partition(stale, path, "model_run_date")
    sinks.replace_partition(_predictions(spark, sf_dir), path, "model_run_date")
    out = spark.read.parquet(path)
    return out.select("ticker", "forecast_date", "predicted_close",
                      "prediction_interval_lower_value", "prediction_interval_upper_value",
                      "confidence_level", "model_run_date")


def truncate_predictions(spark, sf_dir):
    """Full replace (the default of the predictions load)."""
    path = sinks.scratch(spark, "predictions-full")
    sinks.overwrite_table(_predictions(spark, sf_dir, EARLIER_RUN_DATE), path)
    sinks.overwrite_table(_predictions(spark, sf_dir), path)
    return spark.read.parquet(path)


def history_and_forecast(spark, sf_dir):
    return predict.history_and_forecast(layers.daily(spark, sf_dir),
                                        _predictions(spark, sf_dir))


def business_calendar_predictions(spark, sf_dir):
    cfg = ForecastConfig(calendar="business")
    return _predictions(spark, sf_dir, cfg=cfg)


def mart_with_metadata(spark, sf_dir):
    """Daily mart enriched with the staged company feed (left join on the
    canonical ticker; the feed has one row per ticker)."""
    daily = layers.daily(spark, sf_dir)
    meta = layers.metadata(spark, sf_dir).select(
        F.col("ticker").alias("_mticker"), "company_name", "exchange", "is_active")
    return (daily.join(meta, F.upper(F.trim(daily.ticker)) == F.col("_mticker"), "left")
            .drop("_mticker"))


__all__ = ["drop_internal"]
