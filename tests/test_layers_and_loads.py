"""Layer tables, loads that run again, retention, compaction, landing arrays,
rejected lines and row-level quarters."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import blocks
from marketlake.operators.forecast import prep
from marketlake.operators.quarterly import quarter_boundaries
from marketlake.operators.returns import mart_stock_returns, priced_series
from marketlake.sources import catalog, files, panel, sinks
from marketlake.sources.schemas import RAW_METADATA_SCHEMA, RAW_PRICE_SCHEMA
from marketlake.streaming import ingest

SMOKE = "/root/testdata/sf0.001"


def bars(n=400, tickers=("AA", "BB"), start=dt.date(2000, 1, 3)):
    out = []
    for t in tickers:
        for i in range(n):
            price = None if i % 37 == 0 else 100.0 + i % 11 + len(out) % 7
            out.append((start + dt.timedelta(days=i), 1.0, 2.0, 0.5, 1.5, price, 10, t,
                        dt.datetime(2003, 1, 1)))
    return out


@pytest.fixture(scope="module")
def daily(spark):
    return blocks.materialize(spark.createDataFrame(bars(), RAW_PRICE_SCHEMA).withColumn(
        "daily_return", F.col("adj_close") / 100))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- layer tables

def test_windows_over_a_series_table_need_no_exchange(daily):
    series = priced_series(daily, 128)
    out = blocks.over_blocks(series.filter("ticker = 'AA'"), lambda w: [
        F.avg("adj_close").over(w.rowsBetween(-9, 0)).alias("ma")]).select("ticker", "date", "ma")
    plan = plan_of(out)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "EqualTo(ticker,AA)" in plan and "daily_return" not in plan     # pushed and pruned


def test_series_table_has_bounded_buckets(spark):
    assert blocks.bucket_count(spark, 0) == 1
    assert blocks.bucket_count(spark, 10 ** 9) == 500
    assert blocks.bucket_count(spark, 10 ** 13) == 100_000


def test_returns_from_a_stored_series_equal_the_direct_ones(daily):
    direct = mart_stock_returns(daily, 70)
    stored = mart_stock_returns(daily, 128, series=priced_series(daily, 128))
    assert direct.exceptAll(stored).count() == 0 and direct.count() == stored.count()


def test_replace_switches_at_once_and_a_failed_build_leaves_the_old(spark):
    name = "layer_under_test"
    first = spark.createDataFrame([(dt.date(2000, 1, i + 1), "AA", i) for i in range(9)],
                                  "date date, ticker string, n int")
    old = catalog.create_or_replace(spark, name, first, "date", ("ticker",))
    reader = spark.table(name)
    reader.explain()                                  # planned before the switch
    late = first.withColumn("n", F.col("n") + 100)
    new = catalog.create_or_replace(spark, name, late, "date", ("ticker",))
    assert old != new
    assert reader.agg(F.max("n")).first()[0] == 8
    assert spark.table(name).agg(F.min("n")).first()[0] == 100
    assert spark.table(name).columns == first.columns
    layout = catalog.layout_of(spark, name)
    assert (layout["folder"], layout["partition_by"], layout["cluster_by"]) == (new, "date", "ticker")
    bad = late.withColumn("n", F.raise_error(F.lit("build failed")).cast("int"))
    with pytest.raises(Exception, match="build failed"):
        catalog.create_or_replace(spark, name, bad, "date", ("ticker",))
    assert spark.table(name).agg(F.min("n")).first()[0] == 100
    # a new schema is a replace like any other
    catalog.create_or_replace(spark, name, first.select("ticker"))
    assert spark.table(name).columns == ["ticker"]


# ---------------------------------------------------------------- runs again

def landing_rows(spark):
    rows = panel.raw_prices(spark, SMOKE).limit(500)
    return blocks.materialize(sinks.to_api_records(rows).withColumn(
        "date", F.when(F.col("ticker") == "Brand#11", F.lit("junk")).otherwise(F.col("date"))))


def test_a_batch_that_runs_again_replaces_what_it_left(spark, monkeypatch):
    batch = landing_rows(spark)
    results = []
    for fail in (False, True):
        target, bad = sinks.scratch(spark, "t1-target"), sinks.scratch(spark, "t1-rejects")
        handle = ingest.ingest_batch(target, bad)
        handle(batch.limit(100), 0)
        if fail:
            # stops after the rows are written, before the rejects are
            with monkeypatch.context() as m:
                m.setattr(sinks, "rejects", lambda b: b.filter(F.col("date").isNull())
                          .withColumn("ticker", F.raise_error(F.lit("lost")).cast("string")))
                m.setattr(sinks, "write_prices", lambda df, path, mode="append": (
                    sinks_write(df, path, mode), (_ for _ in ()).throw(RuntimeError("lost"))))
                with pytest.raises(Exception, match="lost"):
                    handle(batch, 1)
        handle(batch, 1)
        handle(batch, 1)                               # and again, after a whole run
        results.append((sinks.read_prices(spark, target),
                        spark.read.schema(RAW_PRICE_SCHEMA).parquet(bad)))
    for clean, again in zip(*results):
        assert clean.count() == again.count() > 0
        assert clean.exceptAll(again).count() == 0


sinks_write = sinks.write_prices


def test_a_batch_key_does_not_add_known_keys(spark):
    target = sinks.scratch(spark, "keyed")
    rows = panel.raw_prices(spark, SMOKE).limit(200)
    sinks.insert_new(spark, rows, target, batch_key="a")
    n = sinks.read_prices(spark, target).count()
    assert sinks.insert_new(spark, rows, target, batch_key="b")["after"] == 0
    assert sinks.insert_new(spark, rows, target, batch_key="a")["after"] == n
    assert sinks.read_prices(spark, target).count() == n


# ---------------------------------------------------------------- upkeep

def listing(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/part-*", recursive=True)}


def local(path):
    return path.removeprefix("file:")


def test_retention_drops_folders_and_writes_nothing(spark):
    path = sinks.scratch(spark, "expire")
    sinks.write_landing(panel.raw_prices(spark, SMOKE), path)
    before = listing(local(path))
    assert sinks.expire_landing(spark, path, "2002-12-02") == ["2001-12-01"]
    after = listing(local(path))
    assert after and after == {f: t for f, t in before.items() if "2001-12-02" in f}
    assert sinks.expire_landing(spark, path, "2002-12-02") == []


def test_compaction_bounds_files_and_separates_ranges(spark):
    path = sinks.scratch(spark, "compact")
    rows = spark.createDataFrame(bars(300, ("AA", "BB", "CC")), RAW_PRICE_SCHEMA)
    for k in range(12):
        sinks.write_prices(rows.filter(F.pmod(F.dayofyear("date"), F.lit(12)) == k), path)
    other = spark.createDataFrame(bars(20, ("AA",), dt.date(2005, 1, 3)), RAW_PRICE_SCHEMA)
    sinks.write_prices(other.coalesce(1), path)
    kept = listing(local(path) + "/year=2005")
    before = blocks.materialize(sinks.read_prices(spark, path))
    assert sinks.file_spans(spark, path).filter("year = 2000").count() >= 12
    assert sinks.compact_prices(spark, path, 1 << 12) == [2000]
    spans = sorted(sinks.file_spans(spark, path).filter("year = 2000").collect(),
                   key=lambda r: r.first_key)
    assert len(spans) <= 12
    assert all(a.last_key < b.first_key for a, b in zip(spans, spans[1:]))
    after = sinks.read_prices(spark, path)
    assert after.count() == before.count() and after.exceptAll(before).count() == 0
    assert listing(local(path) + "/year=2005") == kept
    assert sinks.compact_prices(spark, path, 1 << 20) in ([2000], [])


# ---------------------------------------------------------------- loads

def test_array_files_give_ticker_and_date_from_the_path(spark):
    path = sinks.scratch(spark, "arrays")
    raw = blocks.materialize(panel.raw_prices(spark, SMOKE))
    sinks.write_array_landing(raw, path)
    spark.range(1).select(F.lit("[{").alias("value")).coalesce(1).write.mode("append").text(
        f"{path}/run_date=2001-12-02/file=x_prices_2001")
    assert not glob.glob(f"{local(path)}/**/*Brand*", recursive=True)       # lower-cased
    rows, broken = sinks.read_array_landing(spark, path, ticker=F.initcap)
    assert rows.exceptAll(raw).count() == 0 and rows.count() == raw.count()
    assert [r._broken.strip() for r in broken.collect()] == ["[{"]


def test_rejected_lines_and_empty_text(spark):
    path = sinks.scratch(spark, "foreign")
    lines = ['ticker,company_name,description,exchange,start_date,end_date,fetched_at',
             'AA,"A, Inc","",NYSE,2000-01-01,,2001-01-01T00:00:00.000000',
             'BB,B,,NYSE,2000-01-01,"",2001-01-01T00:00:00.000000',
             'CC,C,text,NYSE,2000-01-01,2001-01-01,yesterday',
             ',D,text,NYSE,2000-01-01,2001-01-01,2001-01-01T00:00:00.000000']
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    rows, bad = files.load_csv_with_rejects(spark, path, RAW_METADATA_SCHEMA, ("ticker",))
    got = {r.ticker: (r.description, r.end_date) for r in rows.collect()}
    assert got == {"AA": ("", None), "BB": (None, "")}
    assert sorted((r.reason, "D" in r.line) for r in bad.collect()) == [
        ("malformed", False), ("ticker missing", True)]
    with pytest.raises(ValueError, match="more than 1"):
        files.load_csv_with_rejects(spark, path, RAW_METADATA_SCHEMA, ("ticker",), max_rejects=1)


# ---------------------------------------------------------------- quarters, holidays

def test_row_level_quarters_agree_over_block_sizes(daily):
    from pyspark.sql import Window
    q = Window.partitionBy("ticker", F.year("date"), F.quarter("date")).orderBy("date").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    want = daily.select(
        "ticker", "date", "adj_close", F.first("date").over(q), F.last("date").over(q),
        F.first("adj_close").over(q), F.last("adj_close").over(q))
    for size in (2, 70, 260):
        got = quarter_boundaries(daily, size)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_holiday_dates(spark):
    rows = spark.createDataFrame([(dt.date(2001, 1, 2),), (dt.date(2021, 12, 1),)], "date date")
    got = {(r.holiday, r.date.isoformat()) for r in prep.holiday_windows(
        rows, prep.ForecastConfig(holiday_half_width=0)).collect()}
    for name, day in (("mlk_day", "2001-01-15"), ("presidents_day", "2001-02-19"),
                      ("memorial_day", "2001-05-28"), ("labor_day", "2001-09-03"),
                      ("columbus_day", "2001-10-08"), ("thanksgiving", "2001-11-22"),
                      ("juneteenth", "2021-06-19"), ("independence_day", "2021-07-04")):
        assert (name, day) in got
    assert ("juneteenth", "2020-06-19") not in got
