"""DuckDB oracle SQL for the forecast chain (same definitions as
``operators.forecast``, written over whole series with plain windows, a
running SUM and a recursive CTE for the horizon)."""

from __future__ import annotations

from marketlake.operators.forecast.fit import LOG_2PI
from marketlake.operators.forecast.prep import DEFAULT, MAD_SCALE, US_HOLIDAYS
from marketlake.operators.forecast.predict import Z_90
from marketlake.plans.sql import register_cte, with_ctes

C = DEFAULT
W_T = "PARTITION BY ticker ORDER BY date"

register_cte("fc_train", "SELECT ticker, date, adj_close AS y FROM daily "
                         "WHERE adj_close IS NOT NULL", ["daily"])

register_cte("fc_gaps", f"""
SELECT ticker, date, y, LAG(date) OVER (PARTITION BY ticker ORDER BY date) AS prev_date,
       LAG(y) OVER (PARTITION BY ticker ORDER BY date) AS prev_y,
       date_diff('day', LAG(date) OVER (PARTITION BY ticker ORDER BY date), date) AS gap
FROM fc_train""", ["fc_train"])

register_cte("fc_reg", """
SELECT ticker, date, y, TRUE AS observed FROM fc_train
UNION ALL
SELECT ticker, prev_date + CAST(k AS INTEGER) AS date,
       prev_y + (y - prev_y) * k / gap AS y, FALSE AS observed
FROM (SELECT *, unnest(range(1, gap)) AS k FROM fc_gaps WHERE gap > 1)""", ["fc_gaps"])


def _median(a: str) -> str:
    n = f"len({a})"
    return (f"CASE WHEN {n} % 2 = 1 THEN {a}[({n} + 1) // 2] "
            f"ELSE ({a}[{n} // 2] + {a}[{n} // 2 + 1]) / 2 END")


_H = C.spike_half_window
register_cte("fc_spk0", f"""
SELECT *, list_sort(list(y) OVER ({W_T} ROWS BETWEEN {_H} PRECEDING AND {_H} FOLLOWING))
          AS vals
FROM fc_reg""", ["fc_reg"])
register_cte("fc_spk1", f"SELECT *, {_median('vals')} AS med FROM fc_spk0", ["fc_spk0"])
register_cte("fc_spk2", """
SELECT *, list_sort(list_transform(vals, lambda v: abs(v - med))) AS devs FROM fc_spk1""",
             ["fc_spk1"])
_THR = repr(C.spike_threshold * MAD_SCALE)
register_cte("fc_spk", f"""
SELECT ticker, date, y, observed,
       abs(y - med) > {_THR} * {_median('devs')} AS is_spike,
       CASE WHEN abs(y - med) > {_THR} * {_median('devs')} THEN med ELSE y END AS y_clean
FROM fc_spk2""", ["fc_spk2"])

_K = C.step_window
register_cte("fc_st1", f"""
SELECT *, COUNT(obs) OVER wl AS nl, COUNT(obs) OVER wr AS nr,
       AVG(obs) OVER wr - AVG(obs) OVER wl AS shift,
       SQRT((VAR_SAMP(obs) OVER wl + VAR_SAMP(obs) OVER wr) / 2) AS pooled
FROM (SELECT *, CASE WHEN observed THEN y_clean END AS obs FROM fc_spk)
WINDOW wl AS ({W_T} ROWS BETWEEN {_K} PRECEDING AND 1 PRECEDING),
       wr AS ({W_T} ROWS BETWEEN CURRENT ROW AND {_K - 1} FOLLOWING)""", ["fc_spk"])
register_cte("fc_st2", f"""
SELECT *, CASE WHEN nl >= {C.step_min_obs} AND nr >= {C.step_min_obs} THEN shift END AS sh,
       CASE WHEN nl >= {C.step_min_obs} AND nr >= {C.step_min_obs} AND pooled > 0
            THEN abs(shift) / pooled END AS z
FROM fc_st1""", ["fc_st1"])
register_cte("fc_st3", f"""
SELECT *, CASE WHEN z >= {C.step_threshold}
                AND z = MAX(z) OVER ({W_T} ROWS BETWEEN {_K} PRECEDING AND {_K} FOLLOWING)
               THEN sh END AS step_size
FROM fc_st2""", ["fc_st2"])
register_cte("fc_adj", f"""
SELECT ticker, date, y, observed, is_spike, y_clean, step_size,
       y_clean + (SUM(COALESCE(step_size, 0.0)) OVER (PARTITION BY ticker)
                  - SUM(COALESCE(step_size, 0.0)) OVER ({W_T} ROWS UNBOUNDED PRECEDING))
         AS y_adj
FROM fc_st3""", ["fc_st3"])

# --- holidays (same rules as prep.US_HOLIDAYS, date arithmetic)
_ISO = {"Mon": 1, "Tue": 2, "Wed": 3, "Thu": 4, "Fri": 5, "Sat": 6, "Sun": 7}


def _hday(month, rule, arg) -> str:
    if rule == "fixed":
        return f"make_date(CAST(year AS INTEGER), {month}, {arg})"
    if rule == "nth":
        dow, n = arg
        first = f"make_date(CAST(year AS INTEGER), {month}, 1)"
        return (f"{first} + CAST((({_ISO[dow]} - isodow({first}) + 7) % 7) + {7 * (n - 1)}"
                f" AS INTEGER)")
    last = f"last_day(make_date(CAST(year AS INTEGER), {month}, 1))"
    return f"{last} - CAST(((isodow({last}) - {_ISO[arg]} + 7) % 7) AS INTEGER)"


_HOL_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS holiday, {_hday(month, rule, arg)} AS hday FROM fc_years"
    + (" WHERE year >= 2021" if name == "juneteenth" else "")
    for name, month, rule, arg in US_HOLIDAYS)
register_cte("fc_years", """
SELECT unnest(range(y0, y1 + 2)) AS year
FROM (SELECT MIN(EXTRACT(YEAR FROM date)) AS y0, MAX(EXTRACT(YEAR FROM date)) AS y1
      FROM fc_adj)""", ["fc_adj"])
register_cte("fc_hol", f"""
SELECT date, MIN(holiday) AS holiday FROM (
  SELECT holiday, hday + CAST(k AS INTEGER) AS date
  FROM (SELECT *, unnest(range(-{C.holiday_half_width}, {C.holiday_half_width + 1})) AS k
        FROM ({_HOL_ROWS})))
GROUP BY date""", ["fc_years"])

_T = C.trend_half_window
register_cte("fc_base", f"""
SELECT a.*, AVG(y_adj) OVER ({W_T} ROWS BETWEEN {_T} PRECEDING AND {_T} FOLLOWING) AS trend,
       h.holiday, dayofweek(a.date) + 1 AS dow
FROM fc_adj a LEFT JOIN fc_hol h USING (date)""", ["fc_adj", "fc_hol"])
register_cte("fc_hol_eff", """
SELECT ticker, holiday, AVG(y_adj - trend) AS holiday_effect, COUNT(*) AS days
FROM fc_base WHERE holiday IS NOT NULL GROUP BY ticker, holiday""", ["fc_base"])
register_cte("fc_wd_eff", """
SELECT ticker, dow, raw - AVG(raw) OVER (PARTITION BY ticker) AS weekday_effect
FROM (SELECT ticker, dow, AVG(y_adj - trend) AS raw FROM fc_base
      WHERE holiday IS NULL GROUP BY ticker, dow)""", ["fc_base"])
register_cte("fc_rows", """
SELECT b.*, w.weekday_effect, e.holiday_effect,
       COALESCE(w.weekday_effect, 0.0) + COALESCE(e.holiday_effect, 0.0) AS seasonal,
       y_adj - (COALESCE(w.weekday_effect, 0.0) + COALESCE(e.holiday_effect, 0.0)) AS s,
       y_adj - trend - (COALESCE(w.weekday_effect, 0.0) + COALESCE(e.holiday_effect, 0.0))
         AS remainder
FROM fc_base b LEFT JOIN fc_wd_eff w USING (ticker, dow)
LEFT JOIN fc_hol_eff e USING (ticker, holiday)""", ["fc_base", "fc_wd_eff", "fc_hol_eff"])

# --- fit
register_cte("fc_lag", f"""
SELECT *, LAG(s, 1) OVER ({W_T}) AS s1, LAG(s, 2) OVER ({W_T}) AS s2,
       LAG(s, 3) OVER ({W_T}) AS s3,
       SUM(s) OVER ({W_T} ROWS UNBOUNDED PRECEDING) AS s_cum,
       ROW_NUMBER() OVER ({W_T}) - 1 AS idx, COUNT(*) OVER (PARTITION BY ticker) AS len
FROM fc_rows""", ["fc_rows"])
register_cte("fc_kpss", f"""
SELECT ticker, n, mean_s, eta AS kpss,
       CASE WHEN eta IS NULL OR eta > {C.kpss_critical} THEN 1 ELSE 0 END AS d
FROM (SELECT ticker, n, mean_s,
             ss_partial / NULLIF(n * n * ((ss_e + ss_e1) / n), 0) AS eta
      FROM (SELECT l.ticker, st.n, st.mean_s,
                   SUM((s_cum - (idx + 1) * st.mean_s) * (s_cum - (idx + 1) * st.mean_s))
                     AS ss_partial,
                   SUM((s - st.mean_s) * (s - st.mean_s)) AS ss_e,
                   SUM((s - st.mean_s) * (s1 - st.mean_s)) AS ss_e1
            FROM fc_lag l JOIN (SELECT ticker, COUNT(s) AS n, AVG(s) AS mean_s FROM fc_lag
                                GROUP BY ticker) st USING (ticker)
            GROUP BY l.ticker, st.n, st.mean_s))""", ["fc_lag"])
register_cte("fc_x", """
SELECT l.*, k.d,
       CASE WHEN k.d = 1 THEN s - s1 ELSE s END AS x,
       CASE WHEN k.d = 1 THEN s1 - s2 ELSE s1 END AS xl1,
       CASE WHEN k.d = 1 THEN s2 - s3 ELSE s2 END AS xl2
FROM fc_lag l JOIN fc_kpss k USING (ticker)""", ["fc_lag", "fc_kpss"])


def _two(u: str, v: str, m: str = "") -> tuple[str, str, str, str]:
    det = f"(v_{u} * v_{v} - c_{u}_{v} * c_{u}_{v})"
    bu = f"((c_{u}_x * v_{v} - c_{v}_x * c_{u}_{v}) / NULLIF({det}, 0))"
    bv = f"((c_{v}_x * v_{u} - c_{u}_x * c_{u}_{v}) / NULLIF({det}, 0))"
    sigma2 = f"(v_x - {bu} * c_{u}_x - {bv} * c_{v}_x)"
    const = f"(m_x - {bu} * m_{u} - {bv} * m_{v})"
    return bu, bv, const, sigma2


_bu, _bv, _c, _ = _two("xl1", "xl2")
register_cte("fc_ar", f"""
SELECT ticker, {_c} AS ar_c, {_bu} AS ar_1, {_bv} AS ar_2
FROM (SELECT ticker, AVG(x) AS m_x, AVG(xl1) AS m_xl1, AVG(xl2) AS m_xl2,
             VAR_POP(xl1) AS v_xl1, VAR_POP(xl2) AS v_xl2, COVAR_POP(xl1, xl2) AS c_xl1_xl2,
             COVAR_POP(xl1, x) AS c_xl1_x, COVAR_POP(xl2, x) AS c_xl2_x, VAR_POP(x) AS v_x
      FROM fc_x WHERE xl2 IS NOT NULL GROUP BY ticker)""", ["fc_x"])
register_cte("fc_e", """
SELECT x.*, x.x - a.ar_c - a.ar_1 * x.xl1 - a.ar_2 * x.xl2 AS e
FROM fc_x x LEFT JOIN fc_ar a USING (ticker)""", ["fc_x", "fc_ar"])
register_cte("fc_design", f"""
SELECT *, LAG(e, 1) OVER ({W_T}) AS el1, LAG(e, 2) OVER ({W_T}) AS el2 FROM fc_e""",
             ["fc_e"])

_COLS = ["x", "xl1", "xl2", "el1", "el2"]
_MOM = ["COUNT(*) AS n_fit"] + [f"AVG({c}) AS m_{c}" for c in _COLS] + \
       [f"VAR_POP({c}) AS v_{c}" for c in _COLS]
for _i, _u in enumerate(_COLS):
    for _v in _COLS[_i + 1:]:
        _MOM.append(f"COVAR_POP({_v}, {_u}) AS c_{_v}_x" if _u == "x"
                    else f"COVAR_POP({_u}, {_v}) AS c_{_u}_{_v}")
register_cte("fc_mom", f"""
SELECT ticker, {', '.join(_MOM)} FROM fc_design WHERE el2 IS NOT NULL GROUP BY ticker""",
             ["fc_design"])


def _cand(p, q, regs) -> str:
    coef = {"xl1": "0.0", "xl2": "0.0", "el1": "0.0", "el2": "0.0"}
    if not regs:
        const, sigma2 = "m_x", "v_x"
    elif len(regs) == 1:
        u = regs[0]
        b = f"(c_{u}_x / NULLIF(v_{u}, 0))"
        coef[u] = b
        const, sigma2 = f"(m_x - {b} * m_{u})", f"(v_x - {b} * c_{u}_x)"
    else:
        bu, bv, const, sigma2 = _two(regs[0], regs[1])
        coef[regs[0]], coef[regs[1]] = bu, bv
    return (f"SELECT ticker, n_fit, {p} AS p, {q} AS q, {const} AS c, {coef['xl1']} AS ar1, "
            f"{coef['xl2']} AS ar2, {coef['el1']} AS ma1, {coef['el2']} AS ma2, "
            f"{sigma2} AS sigma2 FROM fc_mom")


from marketlake.operators.forecast.fit import CANDIDATES  # noqa: E402

register_cte("fc_cand0", " UNION ALL ".join(_cand(p, q, r) for p, q, r in CANDIDATES),
             ["fc_mom"])
_LL = f"(-CAST(n_fit AS DOUBLE) / 2 * (ln(sigma2) + {LOG_2PI!r} + 1))"
register_cte("fc_cand", f"""
SELECT c.ticker, k.d, c.p, c.q, c.c, c.ar1, c.ar2, c.ma1, c.ma2, c.sigma2, c.n_fit,
       CASE WHEN sigma2 > 0 THEN {_LL} END AS log_likelihood,
       CASE WHEN sigma2 > 0 THEN -2 * {_LL} + 2 * (c.p + c.q + 2) END AS aic,
       COALESCE(n_fit >= {C.min_rows} AND sigma2 > 0 AND c.c IS NOT NULL
                AND ar1 IS NOT NULL AND ar2 IS NOT NULL AND ma1 IS NOT NULL
                AND ma2 IS NOT NULL AND ar1 + ar2 < 1 AND ar2 - ar1 < 1 AND abs(ar2) < 1
                AND ma2 + ma1 > -1 AND ma2 - ma1 > -1 AND abs(ma2) < 1, FALSE) AS admissible,
       k.kpss
FROM fc_cand0 c JOIN fc_kpss k USING (ticker)""", ["fc_cand0", "fc_kpss"])
register_cte("fc_models", """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY ROUND(aic, 6), p, q) AS rk
  FROM fc_cand WHERE admissible)
WHERE rk = 1""", ["fc_cand"])
register_cte("fc_state", """
SELECT ticker, date AS last_date, s AS s_n, x AS x_n, xl1 AS x_n1, e AS e_n, el1 AS e_n1
FROM fc_design WHERE idx = len - 1""", ["fc_design"])
register_cte("fc_m", """
SELECT m.*, st.last_date, st.s_n, st.x_n, st.x_n1, st.e_n, st.e_n1
FROM fc_models m JOIN fc_state st USING (ticker)""", ["fc_models", "fc_state"])

_HN = "(r.h + 1)"
_XH = "(m.c + m.ar1 * r.x1 + m.ar2 * r.x2 + m.ma1 * r.e1 + m.ma2 * r.e2)"
_PSI = (f"(CASE WHEN {_HN} = 1 THEN 1.0::DOUBLE ELSE m.ar1 * r.p1 + m.ar2 * r.p2 + "
        f"(CASE WHEN {_HN} = 2 THEN m.ma1 WHEN {_HN} = 3 THEN m.ma2 ELSE 0.0::DOUBLE END) END)")
_WT = f"(CASE WHEN m.d = 1 THEN r.cum_psi + {_PSI} ELSE {_PSI} END)"
register_cte("fc_rec(ticker, h, x1, x2, e1, e2, p1, p2, cum_psi, level, acc)", f"""
SELECT ticker, 0, x_n, COALESCE(x_n1, 0.0::DOUBLE), COALESCE(e_n, 0.0::DOUBLE),
       COALESCE(e_n1, 0.0::DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, s_n, 0.0::DOUBLE
FROM fc_m
UNION ALL
SELECT r.ticker, {_HN}, {_XH}, r.x1, 0.0::DOUBLE, r.e1, {_PSI}, r.p1, r.cum_psi + {_PSI},
       CASE WHEN m.d = 1 THEN r.level + {_XH} ELSE {_XH} END,
       r.acc + {_WT} * {_WT}
FROM fc_rec r JOIN fc_m m USING (ticker) WHERE r.h < {C.horizon}""", ["fc_m"])
register_cte("fc_pred", f"""
SELECT r.ticker, m.last_date + CAST(r.h AS INTEGER) AS forecast_date,
       r.level + COALESCE(w.weekday_effect, 0.0) + COALESCE(e.holiday_effect, 0.0) AS point,
       {Z_90!r} * SQRT(m.sigma2 * r.acc) AS half_width
FROM fc_rec r JOIN fc_m m USING (ticker)
LEFT JOIN fc_wd_eff w ON w.ticker = r.ticker
     AND w.dow = dayofweek(m.last_date + CAST(r.h AS INTEGER)) + 1
LEFT JOIN fc_hol hl ON hl.date = m.last_date + CAST(r.h AS INTEGER)
LEFT JOIN fc_hol_eff e ON e.ticker = r.ticker AND e.holiday = hl.holiday
WHERE r.h >= 1""", ["fc_rec(ticker, h, x1, x2, e1, e2, p1, p2, cum_psi, level, acc)",
                    "fc_wd_eff", "fc_hol", "fc_hol_eff"])


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


PRED_COLS = ("ticker, forecast_date, ROUND(point, 4) AS predicted_close, "
             "ROUND(point - half_width, 4) AS prediction_interval_lower_value, "
             "ROUND(point + half_width, 4) AS prediction_interval_upper_value, "
             "CAST(0.9 AS DOUBLE) AS confidence_level, DATE '{run}' AS model_run_date")

REPORT = ("ticker, d, p, q, ROUND(c, 6) AS c, ROUND(ar1, 6) AS ar1, ROUND(ar2, 6) AS ar2, "
          "ROUND(ma1, 6) AS ma1, ROUND(ma2, 6) AS ma2, ROUND(sigma2, 2) AS sigma2, n_fit, "
          "ROUND(log_likelihood, 4) AS log_likelihood, ROUND(aic, 4) AS aic, admissible, "
          "ROUND(kpss, 6) AS kpss")

ORACLE = {
    "forecast_regularize": with_ctes("SELECT * FROM fc_reg", "fc_reg"),
    "forecast_spike_clean": with_ctes(
        "SELECT ticker, date, y, observed, is_spike, y_clean FROM fc_spk", "fc_spk"),
    "forecast_step_adjust": with_ctes(
        "SELECT ticker, date, y_clean, step_size, y_adj FROM fc_adj", "fc_adj"),
    "forecast_holiday_calendar": with_ctes("SELECT * FROM fc_hol", "fc_hol"),
    "forecast_decompose": with_ctes(
        "SELECT ticker, date, y_adj, trend, holiday, seasonal, remainder, s FROM fc_rows",
        "fc_rows"),
    "forecast_holiday_effect": with_ctes("SELECT * FROM fc_hol_eff", "fc_hol_eff"),
    "forecast_fit": with_ctes(f"SELECT {REPORT} FROM fc_cand", "fc_cand"),
    "forecast_model_select": with_ctes(f"SELECT {REPORT} FROM fc_models", "fc_models"),
    "forecast_evaluate": with_ctes(
        "SELECT ticker, ROUND(aic, 2) AS aic, ROUND(log_likelihood, 2) AS log_likelihood, "
        "ROUND(ROUND(sigma2 / m, 10) * m, 4) AS variance FROM (SELECT *, "
        "pow(10.0, ceil(log10(abs(sigma2)))) AS m FROM fc_models)", "fc_models"),
}


def prediction_sql(run_date: str, extra: str = "") -> str:
    return _recursive(with_ctes(
        f"SELECT {PRED_COLS.format(run=run_date)} FROM fc_pred {extra}", "fc_pred"))


# --- business calendar variant: no calendar fill, forecast dates skip weekends


def business_prediction_sql(run_date: str) -> str:
    from marketlake.plans.sql import CTES
    daily_sql = prediction_sql(run_date)
    reg_body = CTES["fc_reg"]
    sql = daily_sql.replace(reg_body, "\nSELECT ticker, date, y, TRUE AS observed FROM fc_train")
    step = "m.last_date + CAST(r.h AS INTEGER)"
    wd = "(isodow(m.last_date) - 1)"
    base = f"least({wd}, 4)"
    bday = (f"(m.last_date - CAST({wd} AS INTEGER) + CAST(floor(({base} + r.h) / 5) * 7 "
            f"+ ({base} + r.h) % 5 AS INTEGER))")
    assert step in sql
    return sql.replace(step, bday)
