"""Forecast preparation, one distributed job over every series at once.

M1 training set -> M2 daily regularisation (linear fill of calendar gaps) ->
M3 spike/dip cleaning (rolling median + MAD, Hampel filter) -> M4 step-change
adjustment (two-window mean-shift z-score, local maxima) -> M6 holiday and
M5 weekday decomposition around a centred moving-average trend.

All per-series windows run on bounded (ticker, block) groups with halos (see
``operators.blocks``); effect tables are per (ticker, weekday/holiday), tiny.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.blocks import (BLK, DEFAULT_BLOCK_ROWS, IDX, OWN, block_running_sum,
                                         block_windows, index_series, join_per_key, materialize,
                                         over_blocks, series_blocks, spread_blocks)


@dataclass(frozen=True)
class ForecastConfig:
    horizon: int = 65                 # steps ahead (~ one quarter)
    confidence: float = 0.90
    calendar: str = "daily"           # 'daily' fills calendar gaps, 'business' keeps rows
    spike_half_window: int = 3        # centred 7-row median
    spike_threshold: float = 3.0      # in robust standard deviations
    step_window: int = 20             # rows on each side of a candidate step
    step_threshold: float = 4.0       # mean shift in pooled standard deviations
    step_min_obs: int = 10            # observed bars needed on each side
    trend_half_window: int = 3        # centred 7-row moving average
    holiday_half_width: int = 1       # days around a holiday
    kpss_critical: float = 0.463      # 5% level, level-stationarity test
    min_rows: int = 30
    block_rows: int = DEFAULT_BLOCK_ROWS


DEFAULT = ForecastConfig()
MAD_SCALE = 1.4826  # MAD -> standard deviation under normality

# US holiday rules (fixed values): name, month, rule, day or (weekday, n).
# rule 'fixed' = day of month; 'nth' = n-th weekday; 'last' = last weekday.
US_HOLIDAYS = [
    ("new_year", 1, "fixed", 1),
    ("mlk_day", 1, "nth", ("Mon", 3)),
    ("presidents_day", 2, "nth", ("Mon", 3)),
    ("memorial_day", 5, "last", "Mon"),
    ("juneteenth", 6, "fixed", 19),
    ("independence_day", 7, "fixed", 4),
    ("labor_day", 9, "nth", ("Mon", 1)),
    ("columbus_day", 10, "nth", ("Mon", 2)),
    ("veterans_day", 11, "fixed", 11),
    ("thanksgiving", 11, "nth", ("Thu", 4)),
    ("christmas", 12, "fixed", 25),
]
JUNETEENTH_FROM = 2021


# ------------------------------------------------------------------ M1

def training_set(daily: DataFrame) -> DataFrame:
    """Series to model: adjusted close per ticker and day, nulls excluded."""
    return daily.filter(F.col("adj_close").isNotNull()).select(
        "ticker", "date", F.col("adj_close").alias("y"))


# ------------------------------------------------------------------ M2

def regularize(train: DataFrame, cfg: ForecastConfig = DEFAULT,
               series: DataFrame | None = None) -> DataFrame:
    """Daily calendar: every day between a series' first and last date; a
    missing day is linearly interpolated between its neighbours. Each
    observation emits the gap before it, so no unbounded window is needed.
    ``series``: the stored series table of the same bars, read without an
    exchange."""
    base = train.select("ticker", "date", "y", F.lit(True).alias("observed"))
    if cfg.calendar != "daily":
        return base
    if series is None:
        spread = spread_blocks(index_series(train), 1, cfg.block_rows)
    else:
        spread = series.select("ticker", "date", F.col("adj_close").alias("y"), IDX, BLK, OWN)
    prev = over_blocks(spread, lambda w: [
        F.lag("date").over(w).alias("prev_date"), F.lag("y").over(w).alias("prev_y")])
    gap = F.datediff("date", "prev_date")
    fills = (prev.filter(gap > 1)
             .select("ticker", "date", "y", "prev_date", "prev_y",
                     gap.alias("gap"), F.explode(F.sequence(F.lit(1), gap - 1)).alias("k"))
             .select("ticker", F.date_add("prev_date", F.col("k")).alias("date"),
                     (F.col("prev_y") + (F.col("y") - F.col("prev_y")) * F.col("k")
                      / F.col("gap")).alias("y"),
                     F.lit(False).alias("observed")))
    return base.unionByName(fills)


# ------------------------------------------------------------------ M3 + M4

def _median_sorted(a: Column) -> Column:
    n = F.size(a)
    mid = F.element_at(a, ((n + 1) / 2).cast("int"))
    lo = F.element_at(a, (n / 2).cast("int").cast("int"))
    hi = F.element_at(a, (n / 2 + 1).cast("int"))
    return F.when(n % 2 == 1, mid).otherwise((lo + hi) / 2)


def _clean_and_steps(df: DataFrame, w, cfg: ForecastConfig) -> DataFrame:
    h, k = cfg.spike_half_window, cfg.step_window
    vals = F.array_sort(F.collect_list("y").over(w.rowsBetween(-h, h)))
    df = df.withColumn("_vals", vals).withColumn("_med", _median_sorted(F.col("_vals")))
    dev = F.array_sort(F.transform("_vals", lambda v: F.abs(v - F.col("_med"))))
    df = df.withColumn("_mad", _median_sorted(dev))
    spike = F.abs(F.col("y") - F.col("_med")) > F.lit(cfg.spike_threshold * MAD_SCALE) * F.col("_mad")
    df = (df.withColumn("is_spike", spike)
          .withColumn("y_clean", F.when(spike, F.col("_med")).otherwise(F.col("y")))
          .drop("_vals", "_med", "_mad"))
    # level-shift statistics use observed bars only: interpolated calendar
    # fills are straight lines and would make the variance look tiny
    left, right = w.rowsBetween(-k, -1), w.rowsBetween(0, k - 1)
    obs = F.when(F.col("observed"), F.col("y_clean"))
    full = ((F.count(obs).over(left) >= cfg.step_min_obs)
            & (F.count(obs).over(right) >= cfg.step_min_obs))
    shift = F.avg(obs).over(right) - F.avg(obs).over(left)
    pooled = F.sqrt((F.var_samp(obs).over(left) + F.var_samp(obs).over(right)) / 2)
    df = df.withColumn("_shift", F.when(full, shift)).withColumn(
        "_z", F.when(full & (pooled > 0), F.abs(shift) / pooled))
    peak = F.max("_z").over(w.rowsBetween(-k, k))
    is_step = (F.col("_z") >= cfg.step_threshold) & (F.col("_z") == peak)
    return (df.withColumn("step_size", F.when(is_step, F.col("_shift")))
            .drop("_shift", "_z"))


def clean_and_adjust(reg: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """Adds is_spike, y_clean, step_size, y_adj (history moved to the latest
    level: y_adj = y_clean + sum of the steps after the row)."""
    indexed = index_series(reg)
    h, k = cfg.spike_half_window, cfg.step_window
    blocked = block_windows(indexed, "ticker", 2 * k + h,
                            lambda df, w: _clean_and_steps(df, w, cfg), cfg.block_rows,
                            lookahead=2 * k - 1 + h, frame=True)
    blocked = cut(blocked.withColumn("_step0", F.coalesce("step_size", F.lit(0.0))))
    cum = block_running_sum(blocked, "ticker", "_step0", "_steps_to_here")
    total = blocked.groupBy("ticker").agg(F.sum("_step0").alias("_steps_total"))
    blocks = series_blocks(blocked, "ticker", cfg.block_rows)
    return (join_per_key(cum, total, "ticker", blocks, how="inner")
            .withColumn("y_adj", F.col("y_clean") + (F.col("_steps_total")
                                                     - F.col("_steps_to_here")))
            .drop("_step0", "_steps_to_here", "_steps_total"))


# ------------------------------------------------------------------ M6 holidays

def _holiday_date(year: Column, month: int, rule: str, arg) -> Column:
    if rule == "fixed":
        return F.make_date(year, F.lit(month), F.lit(arg))
    if rule == "nth":
        dow, n = arg
        first = F.make_date(year, F.lit(month), F.lit(1))
        return F.date_add(F.next_day(F.date_sub(first, 1), dow), 7 * (n - 1))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(last, 7), arg)


def holiday_windows(series: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """(date, holiday) for every day within ``holiday_half_width`` of a US
    holiday, for the years from the first date to the end of the horizon.
    Size bound: 11 holidays x (2w+1) days x years spanned."""
    # a business-day horizon takes up to 7 calendar days for 5 steps
    reach = F.date_add(F.max("date"), F.lit(cfg.horizon * 7 // 5 + 7))
    years = series.agg(F.min(F.year("date")).alias("y0"),
                       F.greatest(F.year(reach), F.max(F.year("date")) + 1).alias("y1"))
    years = years.select(F.explode(F.sequence("y0", "y1")).alias("year"))
    rows = []
    for name, month, rule, arg in US_HOLIDAYS:
        d = _holiday_date(F.col("year"), month, rule, arg)
        keep = F.col("year") >= JUNETEENTH_FROM if name == "juneteenth" else F.lit(True)
        rows.append(years.filter(keep).select(F.lit(name).alias("holiday"), d.alias("hday")))
    hol = rows[0]
    for r in rows[1:]:
        hol = hol.unionByName(r)
    hw = cfg.holiday_half_width
    return (hol.select("holiday", F.explode(F.sequence(F.date_sub("hday", hw),
                                                      F.date_add("hday", hw))).alias("date"))
            .groupBy("date").agg(F.min("holiday").alias("holiday")))


# ------------------------------------------------------------------ M5 decomposition

def cut(df: DataFrame) -> DataFrame:
    """Store as a columnar table under the shared folder and cut the lineage.

    The forecast chain joins per-series aggregates back to their rows many
    times; without a cut every join repeats the whole upstream plan (and its
    scan)."""
    return materialize(df)


def decompose(adj: DataFrame, cfg: ForecastConfig = DEFAULT):
    """Trend (centred moving average), holiday effects, weekday effects.

    Returns (rows, holiday_effects, weekday_effects). rows carry trend,
    holiday, seasonal, s (series to model) and remainder."""
    t = cfg.trend_half_window
    with_trend = block_windows(adj, "ticker", t, lambda w: [
        F.avg("y_adj").over(w.rowsBetween(-t, t)).alias("trend")], cfg.block_rows,
        lookahead=t)
    hol = holiday_windows(adj, cfg)
    base = cut(with_trend.join(F.broadcast(hol), "date", "left")
               .withColumn("_r", F.col("y_adj") - F.col("trend"))
               .withColumn("dow", F.dayofweek("date")))
    hol_eff = cut(base.filter(F.col("holiday").isNotNull())
                  .groupBy("ticker", "holiday")
                  .agg(F.avg("_r").alias("holiday_effect"), F.count(F.lit(1)).alias("days")))
    wd = (base.filter(F.col("holiday").isNull()).groupBy("ticker", "dow")
          .agg(F.avg("_r").alias("_raw")))
    wd_eff = cut(wd.select("ticker", "dow", (F.col("_raw") - F.avg("_raw").over(
        Window.partitionBy("ticker"))).alias("weekday_effect")))
    blocks = series_blocks(base, "ticker", cfg.block_rows)
    out = join_per_key(base, wd_eff, "ticker", blocks, on=("dow",))
    out = join_per_key(out, hol_eff.select("ticker", "holiday", "holiday_effect"), "ticker",
                       blocks, on=("holiday",))
    seasonal = F.coalesce("weekday_effect", F.lit(0.0)) + F.coalesce("holiday_effect",
                                                                       F.lit(0.0))
    out = (out.withColumn("seasonal", seasonal)
           .withColumn("s", F.col("y_adj") - F.col("seasonal"))
           .withColumn("remainder", F.col("y_adj") - F.col("trend") - F.col("seasonal"))
           .drop("_r"))
    return cut(out), hol_eff, wd_eff


def prepare(daily: DataFrame, cfg: ForecastConfig = DEFAULT, series: DataFrame | None = None):
    """daily mart -> (rows ready to fit, holiday effects, weekday effects)."""
    train = training_set(daily)
    adj = cut(clean_and_adjust(regularize(train, cfg, series), cfg))
    return decompose(adj, cfg)


__all__ = ["ForecastConfig", "DEFAULT", "training_set", "regularize", "clean_and_adjust",
           "holiday_windows", "decompose", "prepare", "cut", "IDX", "BLK"]
