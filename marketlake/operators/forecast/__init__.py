"""Per-ticker ARIMA-style forecasting as Spark jobs (prep -> fit -> predict)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from marketlake.operators.forecast import fit, predict, prep
from marketlake.operators.forecast.prep import DEFAULT, ForecastConfig


@dataclass
class ForecastRun:
    rows: DataFrame           # decomposed series (s = series fitted)
    holiday_effects: DataFrame
    weekday_effects: DataFrame
    holidays: DataFrame
    design: DataFrame
    kpss: DataFrame
    candidates: DataFrame
    models: DataFrame
    state: DataFrame


def run(daily: DataFrame, cfg: ForecastConfig = DEFAULT,
        series: DataFrame | None = None) -> ForecastRun:
    rows, hol_eff, wd_eff = prep.prepare(daily, cfg, series)
    holidays = prep.cut(prep.holiday_windows(rows, cfg))
    design, kp = fit.design(rows, cfg)
    cands = prep.cut(fit.fit_candidates(design, kp, cfg))
    models = fit.select_models(cands)
    state = prep.cut(fit.last_state(design))
    return ForecastRun(rows, hol_eff, wd_eff, holidays, design, kp, cands, models, state)


def predictions(r: ForecastRun, run_date: str, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    steps = predict.forecast_steps(r.models, r.state, cfg)
    return predict.predictions(steps, r.weekday_effects, r.holiday_effects, r.holidays,
                               run_date, cfg)


__all__ = ["ForecastConfig", "ForecastRun", "DEFAULT", "run", "predictions", "fit", "predict",
           "prep"]
