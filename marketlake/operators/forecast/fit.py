"""Automatic ARIMA order choice and fit for every series in one job.

* d in {0, 1} by a KPSS level-stationarity test (Kwiatkowski et al. 1992,
  Bartlett window with one lag): the partial sums come from a blocked running
  sum, the statistic from one grouped aggregate.
* (p, q) with p + q <= 2 fitted by Hannan-Rissanen: a long AR(2) gives
  residual proxies e_t; each candidate is then a least-squares regression of
  x_t on at most two of {x_{t-1}, x_{t-2}, e_{t-1}, e_{t-2}} plus a constant,
  solved in closed form from grouped means and covariances (``avg``,
  ``covar_pop``) — no per-series Python, the shuffle carries one partial
  aggregate row per (ticker, map task).
* Gaussian log-likelihood and AIC on a common sample per ticker; the best
  admissible candidate (stationary, invertible) wins (M7, M9, O4); tickers
  without one get a status instead of failing the job (M14).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.blocks import (IDX, LEN, block_running_sum, block_windows,
                                         join_per_key, series_blocks)
from marketlake.operators.forecast.prep import DEFAULT, ForecastConfig, cut

LOG_2PI = math.log(2 * math.pi)

# Candidate orders (p, q) and their regressors.
CANDIDATES = [
    (0, 0, []),
    (1, 0, ["xl1"]),
    (2, 0, ["xl1", "xl2"]),
    (0, 1, ["el1"]),
    (0, 2, ["el1", "el2"]),
    (1, 1, ["xl1", "el1"]),
]
REGRESSORS = ["xl1", "xl2", "el1", "el2"]


def _lags(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """s lags 1..3 in one blocked pass; cumulative sum of s for KPSS."""
    out = block_windows(rows, "ticker", 3, lambda w: [
        F.lag("s", 1).over(w).alias("s1"), F.lag("s", 2).over(w).alias("s2"),
        F.lag("s", 3).over(w).alias("s3")], cfg.block_rows)
    return block_running_sum(out, "ticker", "s", "s_cum")


def kpss(lagged: DataFrame, cfg: ForecastConfig = DEFAULT, blocks=None) -> DataFrame:
    """Per ticker: n, mean, KPSS statistic and the chosen d."""
    blocks = series_blocks(lagged, "ticker", cfg.block_rows) if blocks is None else blocks
    stats = lagged.groupBy("ticker").agg(F.count("s").alias("n"), F.avg("s").alias("mean_s"))
    j = join_per_key(lagged, stats, "ticker", blocks, how="inner")
    e = F.col("s") - F.col("mean_s")
    e1 = F.col("s1") - F.col("mean_s")
    part = F.col("s_cum") - (F.col(IDX) + 1) * F.col("mean_s")
    agg = j.groupBy("ticker", "n", "mean_s").agg(
        F.sum(part * part).alias("ss_partial"),
        F.sum(e * e).alias("ss_e"),
        F.sum(e * e1).alias("ss_e1"),
    )
    lrv = (F.col("ss_e") + F.col("ss_e1")) / F.col("n")
    eta = F.try_divide(F.col("ss_partial"), F.col("n") * F.col("n") * lrv)
    return agg.select("ticker", "n", "mean_s", eta.alias("kpss"),
                      F.when(eta.isNull() | (eta > cfg.kpss_critical), 1).otherwise(0)
                      .alias("d"))


def _two_reg(m: dict, u: str, v: str):
    """Closed-form least squares of x on (u, v) with intercept."""
    vu, vv, cuv = m[f"v_{u}"], m[f"v_{v}"], m[f"c_{u}_{v}"]
    cuy, cvy = m[f"c_{u}_x"], m[f"c_{v}_x"]
    det = vu * vv - cuv * cuv
    bu = F.try_divide(cuy * vv - cvy * cuv, det)
    bv = F.try_divide(cvy * vu - cuy * cuv, det)
    sigma2 = m["v_x"] - bu * cuy - bv * cvy
    const = m["m_x"] - bu * m[f"m_{u}"] - bv * m[f"m_{v}"]
    return {u: bu, v: bv}, const, sigma2


def _one_reg(m: dict, u: str):
    b = F.try_divide(m[f"c_{u}_x"], m[f"v_{u}"])
    return {u: b}, m["m_x"] - b * m[f"m_{u}"], m["v_x"] - b * m[f"c_{u}_x"]


def design(rows: DataFrame, cfg: ForecastConfig = DEFAULT):
    """Rows with x (differenced per chosen d), its lags and long-AR(2)
    residual lags; returns (design rows, kpss table)."""
    lagged = cut(_lags(rows, cfg))
    blocks = cut(series_blocks(lagged, "ticker", cfg.block_rows))
    k = cut(kpss(lagged, cfg, blocks))
    j = join_per_key(lagged, k.select("ticker", "d"), "ticker", blocks, how="inner")
    d1 = F.col("d") == 1
    j = j.select("*",
                 F.when(d1, F.col("s") - F.col("s1")).otherwise(F.col("s")).alias("x"),
                 F.when(d1, F.col("s1") - F.col("s2")).otherwise(F.col("s1")).alias("xl1"),
                 F.when(d1, F.col("s2") - F.col("s3")).otherwise(F.col("s2")).alias("xl2"))
    # long AR(2) on x
    ok = F.col("xl2").isNotNull()
    ar = j.filter(ok).groupBy("ticker").agg(
        F.avg("x").alias("m_x"), F.avg("xl1").alias("m_xl1"), F.avg("xl2").alias("m_xl2"),
        F.var_pop("xl1").alias("v_xl1"), F.var_pop("xl2").alias("v_xl2"),
        F.covar_pop("xl1", "xl2").alias("c_xl1_xl2"),
        F.covar_pop("xl1", "x").alias("c_xl1_x"), F.covar_pop("xl2", "x").alias("c_xl2_x"),
        F.var_pop("x").alias("v_x"))
    m = {c: F.col(c) for c in ar.columns if c != "ticker"}
    b, const, _ = _two_reg(m, "xl1", "xl2")
    ar = cut(ar.select("ticker", const.alias("ar_c"), b["xl1"].alias("ar_1"),
                       b["xl2"].alias("ar_2")))
    j = join_per_key(j, ar, "ticker", blocks).withColumn(
        "e", F.col("x") - F.col("ar_c") - F.col("ar_1") * F.col("xl1")
        - F.col("ar_2") * F.col("xl2"))
    j = block_windows(j, "ticker", 2, lambda w: [
        F.lag("e", 1).over(w).alias("el1"), F.lag("e", 2).over(w).alias("el2")],
        cfg.block_rows)
    return cut(j), k


def fit_candidates(design_rows: DataFrame, kpss_table: DataFrame,
                   cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """Every candidate order per ticker with coefficients, sigma2, ll, AIC."""
    sample = design_rows.filter(F.col("el2").isNotNull())
    cols = ["x"] + REGRESSORS
    aggs = [F.count(F.lit(1)).alias("n_fit")]
    aggs += [F.avg(c).alias(f"m_{c}") for c in cols]
    aggs += [F.var_pop(c).alias(f"v_{c}") for c in cols]
    for i, u in enumerate(cols):
        for v in cols[i + 1:]:
            aggs.append(F.covar_pop(v, u).alias(f"c_{v}_{u}") if u == "x"
                        else F.covar_pop(u, v).alias(f"c_{u}_{v}"))
    mom = sample.groupBy("ticker").agg(*aggs)
    m = {c: F.col(c) for c in mom.columns if c != "ticker"}
    cands = []
    for p, q, regs in CANDIDATES:
        if not regs:
            coef, const, sigma2 = {}, m["m_x"], m["v_x"]
        elif len(regs) == 1:
            coef, const, sigma2 = _one_reg(m, regs[0])
        else:
            coef, const, sigma2 = _two_reg(m, regs[0], regs[1])

        def c_of(name):
            return coef.get(name, F.lit(0.0))

        cands.append(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"),
                              const.alias("c"), c_of("xl1").alias("ar1"),
                              c_of("xl2").alias("ar2"), c_of("el1").alias("ma1"),
                              c_of("el2").alias("ma2"), sigma2.alias("sigma2")))
    out = (mom.select("ticker", "n_fit", F.explode(F.array(*cands)).alias("m"))
           .select("ticker", "n_fit", "m.*")
           .join(kpss_table.select("ticker", "d", "kpss"), "ticker"))
    n = F.col("n_fit").cast("double")
    ll = -n / 2 * (F.log(F.col("sigma2")) + F.lit(LOG_2PI) + 1)
    k = F.col("p") + F.col("q") + 2
    a1, a2, t1, t2 = F.col("ar1"), F.col("ar2"), F.col("ma1"), F.col("ma2")
    admissible = (
        (F.col("n_fit") >= cfg.min_rows) & (F.col("sigma2") > 0)
        & F.col("c").isNotNull() & a1.isNotNull() & a2.isNotNull()
        & t1.isNotNull() & t2.isNotNull()
        & (a1 + a2 < 1) & (a2 - a1 < 1) & (F.abs(a2) < 1)
        & (t2 + t1 > -1) & (t2 - t1 > -1) & (F.abs(t2) < 1))
    return out.select(
        "ticker", "d", "p", "q", "c", "ar1", "ar2", "ma1", "ma2", "sigma2", "n_fit",
        F.when(F.col("sigma2") > 0, ll).alias("log_likelihood"),
        F.when(F.col("sigma2") > 0, -2 * ll + 2 * k).alias("aic"),
        F.coalesce(admissible, F.lit(False)).alias("admissible"), "kpss")


def select_models(cands: DataFrame) -> DataFrame:
    """Best admissible candidate per ticker (lowest AIC, then simpler order)."""
    w = Window.partitionBy("ticker").orderBy(F.round("aic", 6), "p", "q")
    return (cands.filter("admissible").withColumn("_rk", F.row_number().over(w))
            .filter(F.col("_rk") == 1).drop("_rk"))


def fit_status(rows: DataFrame, cands: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """One status per ticker: ok / too_few_rows / zero_variance /
    no_admissible_model."""
    per = rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))
    best = cands.groupBy("ticker").agg(
        F.max(F.col("admissible").cast("int")).alias("_any"),
        F.max("sigma2").alias("_maxvar"))
    j = per.join(best, "ticker", "left")
    status = (F.when(F.col("rows") < cfg.min_rows, "too_few_rows")
              .when(F.col("_any").isNull() | (F.col("_maxvar") <= 0), "zero_variance")
              .when(F.col("_any") == 0, "no_admissible_model")
              .otherwise("ok"))
    return j.select("ticker", "rows", status.alias("status"))


def last_state(design_rows: DataFrame) -> DataFrame:
    """Values at the end of each series that start the forecast recursion
    (one row per ticker, read by a filter, no aggregation)."""
    return design_rows.filter(F.col(IDX) == F.col(LEN) - 1).select(
        "ticker", F.col("date").alias("last_date"), F.col("s").alias("s_n"),
        F.col("x").alias("x_n"), F.col("xl1").alias("x_n1"),
        F.col("e").alias("e_n"), F.col("el1").alias("e_n1"))
