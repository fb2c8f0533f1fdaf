"""Forecast horizon, prediction intervals, predictions mart, summary and
the history + forecast view (M10-M13, O3-O5, J2, J4, F15, U4).

The h-step recursion runs per model row with ``aggregate`` over
``sequence(1, horizon)`` — a JVM higher-order function on one row per ticker;
the horizon is then exploded (model x horizon expansion, no join).
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.forecast.prep import DEFAULT, ForecastConfig

Z_90 = 1.6448536269514722  # two-sided 90% normal quantile (fixed value)


def z_value(confidence: float) -> float:
    if abs(confidence - 0.90) < 1e-12:
        return Z_90
    return NormalDist().inv_cdf(0.5 + confidence / 2)


def _recursion(horizon: int) -> Column:
    """Array of (h, level, var_factor) from the model and last-state columns.

    x_hat = c + a1 x1 + a2 x2 + b1 e1 + b2 e2 (future shocks 0); psi weights
    psi_0 = 1, psi_j = a1 psi_{j-1} + a2 psi_{j-2} + b_j; with d = 1 the level
    integrates x_hat and the weights are cumulated.
    """
    c, a1, a2 = F.col("c"), F.col("ar1"), F.col("ar2")
    b1, b2, d = F.col("ma1"), F.col("ma2"), F.col("d")
    init = F.struct(
        F.col("x_n").alias("x1"), F.coalesce(F.col("x_n1"), F.lit(0.0)).alias("x2"),
        F.coalesce(F.col("e_n"), F.lit(0.0)).alias("e1"),
        F.coalesce(F.col("e_n1"), F.lit(0.0)).alias("e2"),
        F.lit(0.0).alias("p1"), F.lit(0.0).alias("p2"), F.lit(0.0).alias("cum_psi"),
        F.col("s_n").alias("level"), F.lit(0.0).alias("acc"),
        F.array().cast("array<struct<h:int,level:double,acc:double>>").alias("out"))

    def step(st, h):
        xh = c + a1 * st["x1"] + a2 * st["x2"] + b1 * st["e1"] + b2 * st["e2"]
        b_j = F.when(h == 2, b1).when(h == 3, b2).otherwise(F.lit(0.0))
        psi = F.when(h == 1, F.lit(1.0)).otherwise(a1 * st["p1"] + a2 * st["p2"] + b_j)
        cum_psi = st["cum_psi"] + psi
        weight = F.when(d == 1, cum_psi).otherwise(psi)
        acc = st["acc"] + weight * weight
        level = F.when(d == 1, st["level"] + xh).otherwise(xh)
        return F.struct(
            xh.alias("x1"), st["x1"].alias("x2"), F.lit(0.0).alias("e1"),
            st["e1"].alias("e2"), psi.alias("p1"), st["p1"].alias("p2"),
            cum_psi.alias("cum_psi"), level.alias("level"), acc.alias("acc"),
            F.concat(st["out"], F.array(F.struct(h.alias("h"), level.alias("level"),
                                                 acc.alias("acc")))).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step)["out"]


def forecast_steps(models: DataFrame, state: DataFrame,
                   cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """(ticker, h, forecast_date, level, half_width) before seasonal terms."""
    j = models.join(state, "ticker")
    z = z_value(cfg.confidence)
    steps = j.select("ticker", "last_date", "sigma2",
                     F.explode(_recursion(cfg.horizon)).alias("f")).select(
        "ticker", "last_date", "sigma2", "f.h", "f.level", "f.acc")
    if cfg.calendar == "business":
        date = business_day_add(F.col("last_date"), F.col("h"))
    else:
        date = F.date_add("last_date", F.col("h"))
    return steps.select("ticker", "h", date.alias("forecast_date"), "level",
                        (F.lit(z) * F.sqrt(F.col("sigma2") * F.col("acc"))).alias("half_width"))


def business_day_add(start: Column, n: Column) -> Column:
    """n-th weekday after ``start`` (Mon-Fri calendar)."""
    wd = F.weekday(start)  # 0 = Monday
    base = F.least(wd, F.lit(4))
    weeks = F.floor((base + n) / 5)
    rem = (base + n) % 5
    return F.date_add(F.date_sub(start, wd), (weeks * 7 + rem).cast("int"))


def predictions(steps: DataFrame, weekday_eff: DataFrame, holiday_eff: DataFrame,
                holidays: DataFrame, run_date: str, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """The predictions mart: seasonal terms added back, rounded to 4 digits."""
    j = (steps.withColumn("dow", F.dayofweek("forecast_date"))
         .join(weekday_eff, ["ticker", "dow"], "left")
         .join(F.broadcast(holidays), F.col("forecast_date") == F.col("date"), "left")
         .join(holiday_eff.select("ticker", "holiday", "holiday_effect"),
               ["ticker", "holiday"], "left"))
    point = (F.col("level") + F.coalesce("weekday_effect", F.lit(0.0))
             + F.coalesce("holiday_effect", F.lit(0.0)))
    return j.select(
        "ticker", "forecast_date",
        F.round(point, 4).alias("predicted_close"),
        F.round(point - F.col("half_width"), 4).alias("prediction_interval_lower_value"),
        F.round(point + F.col("half_width"), 4).alias("prediction_interval_upper_value"),
        F.lit(float(cfg.confidence)).alias("confidence_level"),
        F.lit(run_date).cast("date").alias("model_run_date"))


def significant(x: Column, digits: int) -> Column:
    """``x`` to so many significant digits: sums of many squares hold no more,
    whatever the order they were added in."""
    scale = F.pow(F.lit(10.0), F.ceil(F.log10(F.abs(F.nullif(x, F.lit(0.0))))))
    return F.coalesce(F.round(x / scale, digits) * scale, x)


def evaluation(models: DataFrame) -> DataFrame:
    """Model quality table (M9/M13): AIC, log-likelihood, variance, rounded to
    the decimals of the report and to ten significant digits."""
    return models.select("ticker", F.round("aic", 2).alias("aic"),
                         F.round("log_likelihood", 2).alias("log_likelihood"),
                         F.round(significant(F.col("sigma2"), 10), 4).alias("variance"))


def summary(preds: DataFrame, last_prices: DataFrame) -> DataFrame:
    """Per ticker: last close (only when quoted on the global last date),
    quarter-end forecast (last horizon row), bounds and change in percent."""
    last = preds.groupBy("ticker").agg(F.max_by(F.struct(
        "forecast_date", "predicted_close", "prediction_interval_lower_value",
        "prediction_interval_upper_value"), "forecast_date").alias("f"))
    j = last.join(last_prices.select("ticker", "last_close"), "ticker", "left")
    change = F.try_divide(F.col("f.predicted_close") - F.col("last_close"),
                          F.col("last_close")) * 100
    return j.select("ticker", "last_close",
                    F.col("f.forecast_date").alias("forecast_date"),
                    F.col("f.predicted_close").alias("forecast_close"),
                    F.col("f.prediction_interval_lower_value").alias("lower"),
                    F.col("f.prediction_interval_upper_value").alias("upper"),
                    F.round(change, 2).alias("change_pct"))


def history_and_forecast(daily: DataFrame, preds: DataFrame) -> DataFrame:
    """Dashboard view: history rows and forecast rows in one frame."""
    hist = daily.select("ticker", "date", F.col("adj_close").alias("value"),
                        F.lit(None).cast("double").alias("lower"),
                        F.lit(None).cast("double").alias("upper"),
                        F.lit("history").alias("kind"))
    fc = preds.select("ticker", F.col("forecast_date").alias("date"),
                      F.col("predicted_close").alias("value"),
                      F.col("prediction_interval_lower_value").alias("lower"),
                      F.col("prediction_interval_upper_value").alias("upper"),
                      F.lit("forecast").alias("kind"))
    return hist.unionByName(fc)
