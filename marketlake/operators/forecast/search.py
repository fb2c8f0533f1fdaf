"""Automatic order search with an exact likelihood, for all series at once.

* d in {0, 1, 2}: level-stationarity tests (Kwiatkowski et al. 1992) of the
  series and of its first difference, Bartlett window of the usual width
  4 (n / 100)^(1/4), from one blocked pass.
* (p, q) with p + q <= ``max_order``: Hannan-Rissanen. Autocovariances give a
  long autoregression, its errors and the lags give one matrix of moments for
  a series; every order is a set of its rows and columns, so all orders are
  solved from that one matrix inside Spark (elimination as an ``aggregate`` over
  arrays), without another pass.
* The best orders by that criterion are refined by Newton steps of the exact
  Gaussian likelihood. A state-space filter sums up each (ticker, block) of rows
  for every parameter point as one element, and elements chain associatively
  (``arma``): no series is one task, and nothing is approximated at the cuts.

Series too short for the regressions, and constant ones, get the constant
model (0, 0), so every series has a model and a forecast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.blocks import (BLK, IDX, LEN, block_running_sum, block_windows,
                                         join_per_key, materialize, series_blocks)
from marketlake.operators.forecast import arma
from marketlake.operators.forecast.predict import business_day_add, z_value
from marketlake.operators.forecast.prep import DEFAULT, ForecastConfig


@dataclass(frozen=True)
class SearchConfig:
    max_order: int = 5            # p + q at most
    max_d: int = 2
    long_ar: int = 20             # lags of the autoregression behind the errors
    shortlist: int = 4            # orders refined by likelihood
    newton_steps: int = 2
    width: float = 1e-3           # stencil of the numeric derivatives
    criterion: str = "aic"        # or "bic"


SEARCH = SearchConfig()


# ------------------------------------------------------------ differencing

def level_tests(rows: DataFrame, cfg: ForecastConfig, max_d: int) -> DataFrame:
    """(ticker, n, mean0, mean1, d, kpss0, kpss1): d counts the tests that
    reject in a row, at most ``max_d``."""
    size = rows.groupBy("ticker").agg(F.count("s").alias("n"), F.avg("s").alias("mean0"),
                                      F.min_by("s", IDX).alias("first"),
                                      F.max_by("s", IDX).alias("last"))
    size = materialize(size.withColumn("mean1", F.when(
        F.col("n") > 1, (F.col("last") - F.col("first")) / (F.col("n") - 1)))
        .withColumn("wide", F.floor(4 * F.pow(F.col("n") / 100, F.lit(0.25))).cast("int")))
    widest = size.agg(F.max("wide")).first()[0] or 0

    def lags(w):
        return [F.lag("s", k).over(w).alias(f"s{k}") for k in range(1, widest + 2)]

    lagged = block_windows(rows.select("ticker", IDX, LEN, "s"), "ticker", widest + 1, lags,
                           cfg.block_rows)
    sums = block_running_sum(lagged, "ticker", "s", "cum")
    j = join_per_key(sums, size, "ticker", series_blocks(sums, "ticker", cfg.block_rows), how="inner")
    aggs = []
    for name, value, part, n in (
            ("0", lambda k: F.col(f"s{k}" if k else "s") - F.col("mean0"),
             F.col("cum") - (F.col(IDX) + 1) * F.col("mean0"), F.col("n")),
            ("1", lambda k: F.col(f"s{k}" if k else "s") - F.col(f"s{k + 1}") - F.col("mean1"),
             F.when(F.col(IDX) > 0, F.col("s") - F.col("first") - F.col(IDX) * F.col("mean1")),
             F.col("n") - 1)):
        aggs.append(F.sum(part * part).alias(f"partial{name}"))
        for k in range(widest + 1):
            aggs.append(F.sum(F.when(F.lit(k) <= F.col("wide"), value(0) * value(k)))
                        .alias(f"g{name}_{k}"))
    keys = ["ticker", "n", "mean0", "mean1", "wide"]
    m = j.groupBy(*keys).agg(*aggs)

    def stat(name: str, n: Column) -> Column:
        tail = [F.coalesce(2 * (1 - F.lit(k) / (F.col("wide") + 1)) * F.col(f"g{name}_{k}"),
                           F.lit(0.0)) for k in range(1, widest + 1)]
        lrv = sum(tail, F.col(f"g{name}_0")) / n
        return F.try_divide(F.col(f"partial{name}"), n * n * lrv)

    out = m.select("ticker", "n", "mean0", "mean1", stat("0", F.col("n")).alias("kpss0"),
                   stat("1", F.col("n") - 1).alias("kpss1"))
    rejects = lambda c: F.coalesce(F.col(c) > cfg.kpss_critical, F.lit(False))
    d = F.when(rejects("kpss0") & rejects("kpss1"), 2).when(rejects("kpss0"), 1).otherwise(0)
    return out.withColumn("d", F.least(d, F.lit(max_d)))


def differenced(rows: DataFrame, tests: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """(ticker, IDX, LEN, BLK, date, d, s, s1, w): w is the d-th difference
    without its mean, NULL in the first d rows."""
    lagged = block_windows(rows.select("ticker", "date", IDX, LEN, "s"), "ticker", 2, lambda w: [
        F.lag("s", 1).over(w).alias("s1"), F.lag("s", 2).over(w).alias("s2")], cfg.block_rows)
    j = join_per_key(lagged, tests.select("ticker", "d"), "ticker",
                     series_blocks(lagged, "ticker", cfg.block_rows), how="inner")
    x = F.when(F.col("d") == 0, F.col("s")).when(F.col("d") == 1, F.col("s") - F.col("s1")) \
        .otherwise(F.col("s") - 2 * F.col("s1") + F.col("s2"))
    held = materialize(j.withColumn("x", x).drop("s2"))
    mean = held.groupBy("ticker").agg(F.avg("x").alias("mean"))
    out = join_per_key(held, mean, "ticker", series_blocks(held, "ticker", cfg.block_rows))
    return materialize(out.withColumn("w", F.col("x") - F.col("mean")).drop("x"))


# ------------------------------------------------------------ linear systems

def solved(matrix: Column) -> Column:
    """Solution of a symmetric positive system given as rows [a_i1 .. a_ik, b_i]:
    elimination pivot by pivot; NULL where a pivot is not positive."""
    k = F.size(matrix)

    def eliminate(state: Column, j: Column) -> Column:
        pivot = F.get(F.get(state, j), j)
        scaled = F.transform(F.get(state, j), lambda a: a / pivot)
        rest = F.transform(state, lambda row, i: F.when(i == j, scaled).otherwise(
            F.zip_with(row, scaled, lambda a, b: a - F.get(row, j) * b)))
        return F.when(pivot > 1e-9 * F.abs(F.get(F.get(matrix, j), j)), rest)

    done = F.aggregate(F.sequence(F.lit(0), k - 1), matrix, eliminate)
    return F.when(k > 0, F.transform(done, lambda row: F.element_at(row, -1))).otherwise(
        F.array().cast("array<double>"))


def inside_circle(coef: Column) -> Column:
    """Step-down recursion: all partial coefficients inside (-1, 1)."""
    def down(state: Column, _: Column) -> Column:
        a = state["a"]
        last = F.element_at(a, -1)
        shorter = F.slice(a, 1, F.size(a) - 1)
        new = F.zip_with(shorter, F.reverse(shorter),
                         lambda x, y: (x + last * y) / (1 - last * last))
        fine = F.abs(last) < 1 - 1e-6
        return F.struct(F.when(fine, new).otherwise(shorter).alias("a"),
                        (state["ok"] & fine).alias("ok"))

    start = F.struct(coef.alias("a"), F.lit(True).alias("ok"))
    return F.when(F.size(coef) == 0, True).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.size(coef)), start, down)["ok"])


# ------------------------------------------------------------ all orders

def long_autoregression(series: DataFrame, lags: int, cfg: ForecastConfig) -> DataFrame:
    """(ticker, weights): Yule-Walker weights of ``lags`` lags."""
    lagged = block_windows(series.select("ticker", IDX, LEN, "w"), "ticker", lags, lambda w: [
        F.lag("w", k).over(w).alias(f"w{k}") for k in range(1, lags + 1)], cfg.block_rows)
    cov = lagged.groupBy("ticker").agg(F.array(
        F.sum(F.col("w") * F.col("w")),
        *[F.sum(F.col("w") * F.col(f"w{k}")) for k in range(1, lags + 1)]).alias("cov"))
    each = F.sequence(F.lit(1), F.lit(lags))
    system = F.transform(each, lambda i: F.concat(
        F.transform(each, lambda j: F.get("cov", F.abs(i - j))), F.array(F.get("cov", i))))
    return cov.select("ticker", solved(system).alias("weights"))


def moments(series: DataFrame, weights: DataFrame, search: SearchConfig, cfg: ForecastConfig
            ) -> DataFrame:
    """(ticker, n_fit, moment): means of products of [w, w lags, e lags]."""
    k, lags = search.max_order, search.long_ar
    j = join_per_key(series.select("ticker", IDX, LEN, BLK, "w"), weights, "ticker",
                     series_blocks(series, "ticker", cfg.block_rows)).drop(BLK)

    def build(df: DataFrame, w) -> DataFrame:
        before = F.reverse(F.collect_list("w").over(w.rowsBetween(-lags, -1)))
        fitted = F.aggregate(F.zip_with(before, "weights", lambda a, b: a * b), F.lit(0.0),
                             lambda s, v: s + v)
        df = df.withColumn("e", F.when(F.size(before) == lags, F.col("w") - fitted))
        return df.select("*", *[F.lag(c, i).over(w).alias(f"{c}{i}")
                                for c in ("w", "e") for i in range(1, k + 1)])

    full = block_windows(j, "ticker", lags + k, build, cfg.block_rows, frame=True)
    names = ["w", *[f"w{i}" for i in range(1, k + 1)], *[f"e{i}" for i in range(1, k + 1)]]
    mean = {(a, b): F.avg(F.col(names[a]) * F.col(names[b])).alias(f"m_{a}_{b}")
            for a in range(len(names)) for b in range(a + 1)}
    got = full.filter(F.col(f"e{k}").isNotNull()).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_fit"), *mean.values())
    grid = F.array(*[F.array(*[F.col(f"m_{max(a, b)}_{min(a, b)}") for b in range(len(names))])
                     for a in range(len(names))])
    return got.select("ticker", "n_fit", grid.alias("moment"))


def all_orders(moment: DataFrame, search: SearchConfig, min_rows: int) -> DataFrame:
    """(ticker, p, q, beta, rough): regression estimates of every admissible
    order, with their criterion."""
    k = search.max_order
    orders = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"))
                       for p in range(k + 1) for q in range(k + 1 - p)])
    j = moment.filter(F.col("n_fit") >= min_rows).select(
        "*", F.explode(orders).alias("o")).select("*", "o.p", "o.q")
    pick = lambda first, n: F.when(n > 0, F.sequence(
        F.lit(first), F.lit(first - 1) + F.greatest(n, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    j = j.withColumn("at", F.concat(pick(1, F.col("p")), pick(1 + k, F.col("q"))))
    system = F.transform("at", lambda i: F.concat(
        F.transform("at", lambda c: F.get(F.get("moment", i), c)),
        F.array(F.get(F.get("moment", i), F.lit(0)))))
    j = j.withColumn("beta", F.when(F.size("at") > 0, solved(system)).otherwise(
        F.array().cast("array<double>")))
    explained = F.aggregate(F.zip_with("beta", "at", lambda b, i: b * F.get(F.get("moment", i),
                                                                           F.lit(0))),
                            F.lit(0.0), lambda s, v: s + v)
    var = F.get(F.get("moment", F.lit(0)), F.lit(0)) - explained
    n = F.col("n_fit").cast("double")
    penalty = F.log(n) if search.criterion == "bic" else F.lit(2.0)
    ar, ma = F.slice("beta", 1, F.col("p").cast("int")), F.slice("beta", F.col("p").cast("int") + 1, F.col("q").cast("int"))
    return (j.withColumn("var", var)
            .filter(F.col("beta").isNotNull() & (F.col("var") > 0) & inside_circle(ar)
                    & inside_circle(F.transform(ma, lambda x: -x)))
            .select("ticker", "p", "q", "beta",
                    (n * F.log("var") + penalty * (F.col("p") + F.col("q") + 2)).alias("rough")))


# ------------------------------------------------------------ exact likelihood

POINT = "ticker string, p bigint, q bigint, point bigint, beta array<double>"
ELEMENT = f"{POINT}, {BLK} bigint, element array<double>"
VALUE = f"{POINT}, s0 double, logs double, n bigint, state array<double>, log_likelihood double"
MOVE = "ticker string, p bigint, q bigint, beta array<double>, move array<double>"
STEP = "ticker string, last_date date, h bigint, level double, var double"
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(),
          "date": pa.date32(), "array<double>": pa.list_(pa.float64())}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, _ARROW[t]) for n, t in fields]))


def series_values(series: DataFrame) -> DataFrame:
    """(ticker, BLK, start, values): the rows of each block as one array."""
    # the first d rows have no difference: positions count from the first value
    got = series.filter(F.col("w").isNotNull()).groupBy("ticker", BLK).agg(
        F.min(F.col(IDX) - F.col("d")).alias("start"),
        F.sort_array(F.collect_list(F.struct(IDX, "w"))).alias("v"))
    return materialize(got.select("ticker", BLK, "start", F.col("v.w").alias("values")))


def _coefficients(p: int, q: int, beta: list[float]) -> tuple[np.ndarray, np.ndarray]:
    return arma.padded(beta[:p], arma.SIZE), arma.padded(beta[p:p + q], arma.SIZE - 1)


def _elements(batches):
    """Block rows with their series' points -> an element for each point."""
    for batch in batches:
        rows = batch.to_pylist()
        lanes = [(r, c) for r in rows for c in r["points"]]
        for lo in range(0, len(lanes), 2048):
            some = lanes[lo:lo + 2048]
            length = np.array([len(r["values"]) for r, _ in some])
            y = np.zeros((len(some), int(length.max())))
            for i, (r, _) in enumerate(some):
                y[i, :length[i]] = r["values"]
            coef = [_coefficients(c["p"], c["q"], c["beta"]) for _, c in some]
            out = arma.block_elements(y, length, np.array([r["start"] for r, _ in some]),
                                      np.array([c[0] for c in coef]), np.array([c[1] for c in coef]))
            yield _batch([c | {"ticker": r["ticker"], BLK: r[BLK], "element": e}
                          for (r, c), e in zip(some, out)], ELEMENT)


def _chain(batches):
    """Elements of a series and point, in order -> its likelihood."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            s0, logs, n, state = arma.chained(np.array([e["element"] for e in r.pop("elements")]))
            r |= {"s0": s0, "logs": logs, "n": n, "state": list(state),
                  "log_likelihood": arma.log_likelihood(s0, logs, n)}
        if rows:
            yield _batch(rows, VALUE)


def likelihoods(values: DataFrame, points: DataFrame) -> DataFrame:
    """Exact log-likelihood of each parameter point (``POINT`` rows): one
    element for each block and point, chained by series."""
    lists = points.groupBy("ticker").agg(F.collect_list(
        F.struct("p", "q", "point", "beta")).alias("points"))
    spread = values.select("ticker", BLK).join(lists, "ticker")
    elements = values.join(spread, ["ticker", BLK]).mapInArrow(
        _elements, ELEMENT)
    ordered = elements.groupBy("ticker", "p", "q", "point", "beta").agg(
        F.sort_array(F.collect_list(F.struct(BLK, "element"))).alias("elements"))
    return ordered.mapInArrow(_chain, VALUE)


def _points(models: DataFrame, moves) -> DataFrame:
    """POINT rows: the models' parameters moved by each of ``moves(row)``;
    inadmissible points get none."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for i, move in enumerate(moves(r)):
                    beta = np.asarray(r["beta"], float) + move
                    if arma.admissible(beta[:r["p"]], beta[r["p"]:]):
                        out.append({"ticker": r["ticker"], "p": r["p"], "q": r["q"], "point": i,
                                    "beta": beta.tolist()})
            if out:
                yield _batch(out, POINT)
    return models.mapInArrow(run, POINT)


def newton_round(values: DataFrame, models: DataFrame, width: float) -> DataFrame:
    """Models (ticker, p, q, beta) moved one Newton step of the exact
    likelihood, as far as it improves (whole, half or a quarter)."""
    seen = likelihoods(values, _points(models, lambda r: arma.stencil(len(r["beta"]), width)))
    told = seen.groupBy("ticker", "p", "q").agg(F.collect_list(
        F.struct("point", "log_likelihood")).alias("seen"))

    def step(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                k = len(r["beta"])
                value = np.full(len(arma.stencil(k, width)), np.nan)
                for s in r.pop("seen") or []:
                    value[s["point"]] = -2 * s["log_likelihood"]
                out.append(r | {"move": arma.newton_move(value, k, width).tolist() if k else []})
            if out:
                yield _batch(out, MOVE)

    moved = models.join(told, ["ticker", "p", "q"], "left").select(
        "ticker", "p", "q", "beta", "seen").mapInArrow(
        step, MOVE)
    tried = likelihoods(values, _points(materialize(moved), lambda r: [
        np.asarray(r["move"], float) * part for part in (0.0, 0.25, 0.5, 1.0)]))
    return best_point(tried).select("ticker", "p", "q", "beta")


def best_point(tried: DataFrame) -> DataFrame:
    w = Window.partitionBy("ticker", "p", "q").orderBy(F.col("log_likelihood").desc_nulls_last(),
                                                       "point")
    return tried.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


# ------------------------------------------------------------ the search

@dataclass
class Search:
    series: DataFrame      # differenced, centred rows
    tests: DataFrame       # d and test statistics
    candidates: DataFrame  # refined orders with exact likelihood
    models: DataFrame      # the chosen one of each series


def search_orders(rows: DataFrame, cfg: ForecastConfig = DEFAULT, search: SearchConfig = SEARCH
                  ) -> Search:
    """Searches (d, p, q) for every series of ``rows`` (ticker, date, s with
    the series index); see the module."""
    if search.max_order >= arma.SIZE:
        raise ValueError(f"max_order must be below {arma.SIZE}")
    tests = materialize(level_tests(rows, cfg, search.max_d))
    series = differenced(rows, tests, cfg)
    values = series_values(series)
    weights = materialize(long_autoregression(series, search.long_ar, cfg))
    orders = materialize(all_orders(moments(series, weights, search, cfg), search, cfg.min_rows))
    rank = F.row_number().over(Window.partitionBy("ticker").orderBy("rough", "p", "q"))
    short = orders.filter("p + q > 0").withColumn("_r", rank).filter(
        F.col("_r") <= search.shortlist).select(
        "ticker", F.col("p").cast("bigint").alias("p"), F.col("q").cast("bigint").alias("q"), "beta")
    constant = values.select("ticker").distinct().select(
        "ticker", F.lit(0).cast("bigint").alias("p"), F.lit(0).cast("bigint").alias("q"),
        F.array().cast("array<double>").alias("beta"))
    models = materialize(short)
    for _ in range(search.newton_steps):
        models = materialize(newton_round(values, models, search.width))
    last = likelihoods(values, _points(models.unionByName(constant), lambda r: [np.zeros(
        len(r["beta"]))]))
    n, ll = F.col("n").cast("double"), F.nanvl("log_likelihood", F.lit(None).cast("double"))
    k = F.col("p") + F.col("q") + 2
    penalty = F.log(n) * k if search.criterion == "bic" else 2.0 * k
    mean = series.groupBy("ticker").agg(F.first("mean", True).alias("mean"))
    found = materialize(last.join(tests.select("ticker", "d", "kpss0", "kpss1"), "ticker")
                        .join(mean, "ticker").select(
        "ticker", "d", "p", "q", F.slice("beta", 1, F.col("p").cast("int")).alias("ar"),
        F.slice("beta", F.col("p").cast("int") + 1, F.col("q").cast("int")).alias("ma"), "mean",
        (F.col("s0") / n).alias("sigma2"), F.col("n").alias("n_fit"), ll.alias("log_likelihood"),
        (-2 * ll + penalty).alias(search.criterion), "state", "kpss0", "kpss1"))
    w = Window.partitionBy("ticker").orderBy(F.col(search.criterion).asc_nulls_last(),
                                             F.col("p") + F.col("q"), "p")
    chosen = materialize(found.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r"))
    return Search(series, tests, found, chosen)


def search_steps(found: Search, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """(ticker, h, forecast_date, level, half_width) of the chosen models."""
    last = found.series.filter(F.col(IDX) == F.col(LEN) - 1).select(
        "ticker", F.col("date").alias("last_date"), "s", (F.col("s") - F.col("s1")).alias("slope"))
    j = found.models.select("ticker", "d", "ar", "ma", "mean", "sigma2", "state").join(last, "ticker")

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ar, ma = arma.padded(r["ar"], arma.SIZE), arma.padded(r["ma"], arma.SIZE - 1)
                level, var = arma.forecast_path(ar, ma, np.array(r["state"]), r["mean"], r["d"],
                                                [r["s"], r["slope"]], cfg.horizon)
                out += [{"ticker": r["ticker"], "last_date": r["last_date"], "h": h + 1,
                         "level": float(level[h]), "var": float(var[h] * r["sigma2"])}
                        for h in range(cfg.horizon)]
            if out:
                yield _batch(out, STEP)

    steps = j.mapInArrow(run, STEP)
    date = business_day_add(F.col("last_date"), F.col("h")) if cfg.calendar == "business" \
        else F.date_add("last_date", F.col("h").cast("int"))
    return steps.select("ticker", "h", date.alias("forecast_date"), "level",
                        (F.lit(z_value(cfg.confidence)) * F.sqrt("var")).alias("half_width"))
