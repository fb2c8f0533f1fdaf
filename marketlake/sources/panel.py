"""Price and company feeds derived from the given test tables.

The reference ships no price file, so the raw layer is derived from
``lineitem`` and ``part`` (recipe in FIXTURES.md): one bar per
(ship date, brand, line status), two ingest batches (status F, then O) and a
deterministic set of injected defects. The metadata feed is derived from
``part`` and ``region``.

Scale: the lineitem scan is the only large input. Projection is pruned to the
ten columns used; the join to ``part`` is left to AQE (broadcast when the
measured ``part`` projection is small, sort-merge otherwise) and the bar
aggregate is partial (map-side) before its shuffle, so only one row per
(date, brand, status) per map task crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.schemas import METADATA_COLUMNS, PRICE_COLUMNS
from marketlake.sources.tables import read_table

# Fixed values of the fixture recipe (FIXTURES.md).
DEFECT_EPOCH = "1995-01-01"
DEFECT_DAY_FACTOR = 31
DEFECT_BRAND_FACTOR = 17
DEFECT_SWAP_HIGH_LOW = 97
DEFECT_ZERO_CLOSE = 101
DEFECT_NEGATIVE_VOLUME = 103
DEFECT_NULL_ADJ_CLOSE = 107
DEFECT_NULL_OPEN = 109
DEFECT_NULL_HIGH_LOW = 113
BATCH_TIMES = {"F": "2001-12-01 00:00:00", "O": "2001-12-02 00:00:00"}
METADATA_FETCHED_AT = "2001-12-03 12:34:56.123456"
START_DATE_CYCLE = ["1995-01-02", "", "2020", "not a date", None]
END_DATE_CYCLE = ["2001-11-04", "", "  ", None]
DESCRIPTION_UNIT = 'Maker of "{brand}" parts, sold by the case, crate, and pallet; '


def brand_number(brand: F.Column) -> F.Column:
    return F.substring(brand, 7, 10).cast("int")


# Order of the lines inside a bar: lexicographic, one key at every scale.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def price_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean bars (before defects): one per (date, ticker, status).

    Per-line values (date, line position, price, adjusted price) are computed
    before the join, so a shuffle of lineitem — when ``part`` is too large to
    broadcast — carries seven narrow columns instead of ten."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                    "l_tax", "l_linestatus", "l_shipdate")
    px = F.col("l_extendedprice")
    lines = li.select(
        F.to_date("l_shipdate").alias("date"), "l_partkey",
        F.col("l_linestatus").alias("status"),
        F.struct(*LINE_ORDER).alias("pos"),
        px.alias("px"),
        (px * (1 - F.col("l_discount")) / (1 + F.col("l_tax"))).alias("apx"),
        "l_quantity")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    return (
        joined.groupBy("date", F.col("p_brand").alias("ticker"), "status")
        .agg(F.min_by("px", "pos").alias("open"),
             F.max("px").alias("high"),
             F.min("px").alias("low"),
             F.max_by("px", "pos").alias("close"),
             F.max_by("apx", "pos").alias("adj_close"),
             F.sum("l_quantity").cast("bigint").alias("volume"))
    )


def inject_defects(bars: DataFrame) -> DataFrame:
    v = (F.datediff("date", F.lit(DEFECT_EPOCH)) * DEFECT_DAY_FACTOR
         + brand_number(F.col("ticker")) * DEFECT_BRAND_FACTOR)

    def hit(m: int) -> F.Column:
        return (F.col("_v") % m) == 0

    null_hl = hit(DEFECT_NULL_HIGH_LOW)
    swap = hit(DEFECT_SWAP_HIGH_LOW)
    batch = F.when(F.col("status") == "F", F.lit(BATCH_TIMES["F"])) \
        .otherwise(F.lit(BATCH_TIMES["O"])).cast("timestamp")
    return (
        bars.withColumn("_v", v)
        .select(
            "date",
            F.when(hit(DEFECT_NULL_OPEN), F.lit(None).cast("double"))
             .otherwise(F.col("open")).alias("open"),
            F.when(null_hl, F.lit(None).cast("double"))
             .when(swap, F.col("low")).otherwise(F.col("high")).alias("high"),
            F.when(null_hl, F.lit(None).cast("double"))
             .when(swap, F.col("high")).otherwise(F.col("low")).alias("low"),
            F.when(hit(DEFECT_ZERO_CLOSE), F.lit(0.0))
             .otherwise(F.col("close")).alias("close"),
            F.when(hit(DEFECT_NULL_ADJ_CLOSE), F.lit(None).cast("double"))
             .otherwise(F.col("adj_close")).alias("adj_close"),
            F.when(hit(DEFECT_NEGATIVE_VOLUME), F.lit(-1).cast("bigint"))
             .otherwise(F.col("volume")).alias("volume"),
            "ticker",
            batch.alias("ingested_at"),
        )
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw price layer: both ingest batches, defects included."""
    return inject_defects(price_bars(spark, sf_dir)).select(*PRICE_COLUMNS)


def raw_price_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The two landing batches separately (status F first, then O)."""
    bars = inject_defects(price_bars(spark, sf_dir))
    return {
        s: bars.filter(F.col("ingested_at") == F.lit(t).cast("timestamp"))
               .select(*PRICE_COLUMNS)
        for s, t in BATCH_TIMES.items()
    }


def _cycle(values: list, n: F.Column) -> F.Column:
    expr = None
    for i, val in enumerate(values):
        lit = F.lit(val).cast("string")
        expr = F.when(n % len(values) == i, lit) if expr is None else expr.when(
            n % len(values) == i, lit)
    return expr


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company feed: one row per distinct brand, with untidy text fields."""
    brands = read_table(spark, sf_dir, "part", "p_brand").distinct()
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    n = brand_number(F.col("p_brand"))
    unit = F.replace(F.lit(DESCRIPTION_UNIT), F.lit("{brand}"), F.col("p_brand"))
    # repeated text well over 300 characters, with commas and quotes
    description = F.concat(F.lit("  "), F.repeat(unit, 6), F.lit("\nEnd."))
    with_region = brands.withColumn("_n", n).join(
        region, F.col("_n") % 5 == F.col("r_regionkey"), "left")
    return with_region.select(
        F.concat(F.lit("  "), F.lower("p_brand"), F.lit(" ")).alias("ticker"),
        F.concat(F.lit(" Company "), F.col("p_brand"), F.lit(" Inc ")).alias("company_name"),
        description.alias("description"),
        F.lower("r_name").alias("exchange"),
        _cycle(START_DATE_CYCLE, F.col("_n")).alias("start_date"),
        _cycle(END_DATE_CYCLE, F.col("_n")).alias("end_date"),
        F.lit(METADATA_FETCHED_AT).cast("timestamp").alias("fetched_at"),
    ).select(*METADATA_COLUMNS)
