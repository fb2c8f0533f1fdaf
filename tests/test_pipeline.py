"""Properties of the layers, loads, stream and forecast on the smoke data."""

import pytest
from conftest import SMOKE
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketlake.operators import forecast as fc
from marketlake.plans import layers
from marketlake.sources import panel, sinks
from marketlake.streaming import ingest


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "ma_200" in df.columns


def test_every_oracle_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # every market key has its SQL but the searched orders (test_order_search)
    searched = {"forecast_order_candidates", "forecast_order_search", "forecast_order_predictions"}
    market = set(entry.registry.queries())
    assert market - set(entry.oracle_sql()) == searched
    assert all(n == "pipeline" or n.startswith("op") for n in set(entry.queries()) - market)


def test_staging_key_unique(spark):
    stg = layers.staged(spark, SMOKE)
    assert stg.groupBy("date", "ticker").count().filter("count > 1").count() == 0


def test_52_week_range_and_win_rate_bounds(spark):
    daily = layers.daily(spark, SMOKE)
    bad = daily.filter((F.col("week_52_low") > F.round("low", 4))
                       | (F.col("week_52_high") < F.round("high", 4)))
    assert bad.count() == 0
    ret = layers.returns(spark, SMOKE)
    assert ret.filter((F.col("win_rate_30d") < 0) | (F.col("win_rate_30d") > 1)).count() == 0


def test_insert_new_is_idempotent(spark):
    path = sinks.scratch(spark, "test-insert")
    batches = panel.raw_price_batches(spark, SMOKE)
    first = sinks.insert_new(spark, batches["F"], path)
    assert first["removed"] == 0
    again = sinks.insert_new(spark, batches["F"], path)
    assert again["after"] == 0 and again["removed"] == again["before"]
    sinks.insert_new(spark, batches["O"], path)
    total = sinks.read_prices(spark, path)
    assert total.count() == total.select("date", "ticker").distinct().count()


def test_stream_replay_adds_nothing(spark):
    landing = sinks.scratch(spark, "test-landing")
    target = sinks.scratch(spark, "test-target")
    ckpt = sinks.scratch(spark, "test-ckpt")
    sinks.write_landing(panel.raw_price_batches(spark, SMOKE)["F"], landing)
    ingest.run_once(spark, landing, target, ckpt)
    n1 = sinks.read_prices(spark, target).count()
    ingest.run_once(spark, landing, target, ckpt)              # same checkpoint
    assert sinks.read_prices(spark, target).count() == n1
    ingest.run_once(spark, landing, target, sinks.scratch(spark, "test-ckpt2"))  # replay
    assert sinks.read_prices(spark, target).count() == n1


def test_landing_array_files(spark, tmp_path):
    p = tmp_path / "aapl_prices.json"
    p.write_text('[{"date":"2015-01-02T00:00:00.000Z","open":"1.5","high":2,"low":1,'
                 '"close":1.7,"adjClose":"1.6","volume":"12"},'
                 '{"date":"2015-01-05T00:00:00.000Z","open":"bad","close":1.8}]')
    from marketlake.sources.files import normalize_prices, read_landing_json
    recs = read_landing_json(spark, str(p), array_files=True)
    out = normalize_prices(recs, ticker="AAPL", ingested_at="2015-01-06 00:00:00").collect()
    assert len(out) == 2
    first = [r for r in out if r["date"].day == 2][0]
    assert first["adj_close"] == 1.6 and first["volume"] == 12 and first["ticker"] == "AAPL"
    second = [r for r in out if r["date"].day == 5][0]
    assert second["open"] is None and second["volume"] is None


@pytest.fixture(scope="module")
def run(spark):
    return fc.run(fc.prep.cut(layers.daily(spark, SMOKE)))


def test_forecast_intervals(run):
    preds = fc.predictions(run, "2001-12-03")
    assert preds.count() == 65 * run.models.count()
    assert preds.filter((F.col("prediction_interval_lower_value") > F.col("predicted_close"))
                        | (F.col("predicted_close")
                           > F.col("prediction_interval_upper_value"))).count() == 0


def test_interval_width_grows_for_random_walk(spark, run):
    from marketlake.operators.forecast import predict
    rw = run.candidates.filter("p = 0 AND q = 0").withColumn("d", F.lit(1)).withColumn(
        "c", F.lit(0.0))
    steps = predict.forecast_steps(rw, run.state).groupBy("ticker").agg(
        F.collect_list(F.struct("h", "half_width")).alias("w")).collect()
    for r in steps:
        widths = [x["half_width"] for x in sorted(r["w"])]
        assert all(b >= a for a, b in zip(widths, widths[1:]))


def test_every_ticker_has_a_status(run):
    status = fc.fit.fit_status(run.rows, run.candidates)
    assert status.count() == run.rows.select("ticker").distinct().count()


def test_forecast_block_invariance(spark, run):
    """The whole forecast chain with 300-row blocks (halos both ways,
    cross-block running sums, per-block constants) gives the same models and
    forecasts as with one block per series (up to float summation order)."""
    from marketlake.operators.forecast.prep import ForecastConfig
    cfg = ForecastConfig(block_rows=300)
    small = fc.run(fc.prep.cut(layers.daily(spark, SMOKE, 300)), cfg)
    m_big = {r["ticker"]: (r["d"], r["p"], r["q"]) for r in run.models.collect()}
    m_small = {r["ticker"]: (r["d"], r["p"], r["q"]) for r in small.models.collect()}
    assert m_big == m_small
    a = {(r[0], r[1]): r[2] for r in fc.predictions(run, "2001-12-03").collect()}
    b = {(r[0], r[1]): r[2] for r in fc.predictions(small, "2001-12-03", cfg).collect()}
    assert a.keys() == b.keys()
    for k, v in a.items():
        assert abs(v - b[k]) <= 1e-4 + 1e-9 * abs(v)


def test_stream_sets_rejects_aside(spark):
    landing, target, ckpt = (sinks.scratch(spark, x) for x in ("test-junk", "test-raw", "test-ckpt"))
    bar = '"open": "1", "high": "2", "low": "1", "close": "2", "adjClose": "2", "volume": "5"}'
    lines = [f'{{"date": "2024-01-02T00:00:00.000", {bar}', f'{{"date": "no date", {bar}']
    spark.createDataFrame([(x, "2024-01-03", "AAA") for x in lines],
                          "value string, run_date string, ticker string").coalesce(1) \
        .write.partitionBy("run_date", "ticker").text(landing)
    ingest.run_once(spark, landing, target, ckpt)
    ingest.run_once(spark, landing, target, ckpt)              # nothing new
    assert sinks.read_prices(spark, target).count() == 1
    bad = spark.read.parquet(f"{target}-rejects").collect()
    assert [(r.date, r.ticker, r.close) for r in bad] == [(None, "AAA", 2.0)]
