"""File sources: CSV loads, JSON landing files, record normalisation.

All reads pass a declared schema (no inference). Normalisation is column
expressions only, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions import cut, to_bigint, to_double
from marketlake.operators.blocks import materialize
from marketlake.sources.schemas import (API_PRICE_RECORD_SCHEMA, METADATA_COLUMNS,
                                        PRICE_COLUMNS, RAW_METADATA_SCHEMA, RAW_PRICE_SCHEMA)

# CSV dialect of the fixtures: header row, RFC 4180 doubled quotes, quoted
# newlines allowed where text is quoted (``TEXT_OPTIONS``), microsecond
# timestamps without zone, whitespace kept. A marker stands for a missing value
# in files written here. In any file quoted empty text ("") is empty text and a
# field with nothing in it is missing. A malformed line fails the load, unless
# the load has a reject channel (``load_csv_with_rejects``).
CSV_OPTIONS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
    "nullValue": "\\N",
    "mode": "FAILFAST",
}
TEXT_OPTIONS = {"multiLine": "true"}   # one task per file: company text, never prices
METADATA_API_NAMES = {"name": "company_name", "exchangeCode": "exchange",
                      "startDate": "start_date", "endDate": "end_date"}
PRICE_API_RENAMES = {"adjClose": "adj_close"}
PRICE_KEEP = ["date", "open", "high", "low", "close", "adj_close", "volume"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             quoted_lines: bool = False) -> DataFrame:
    options = {**CSV_OPTIONS, **(TEXT_OPTIONS if quoted_lines else {})}
    return spark.read.schema(schema).options(**options).csv(path)


def load_csv_prices(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_PRICE_SCHEMA)


def load_csv_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_METADATA_SCHEMA, quoted_lines=True)


def load_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType,
                          required: tuple[str, ...] = (), max_rejects: int | None = None,
                          quoted_lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): a load that sets aside the lines that do not fit the
    schema (wrong number of fields, unreadable numbers or dates) and those
    without a ``required`` value, with the reason, the line and its file. More
    than ``max_rejects`` of them fail the load."""
    options = {**CSV_OPTIONS, **(TEXT_OPTIONS if quoted_lines else {}), "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": "_line"}
    wide = T.StructType([*schema.fields, T.StructField("_line", T.StringType(), True)])
    # parsed once: rows and rejects are two reads of what is stored
    parsed = materialize(spark.read.schema(wide).options(**options).csv(path).withColumn(
        "_file", F.col("_metadata.file_path")), "parsed-csv")
    missing = [F.when(F.col(c).isNull(), F.lit(f"{c} missing")) for c in required]
    reason = F.when(F.col("_line").isNotNull(), F.lit("malformed")).otherwise(
        F.coalesce(F.lit(None).cast("string"), *missing))
    told = parsed.withColumn("reason", reason)
    bad = told.filter(F.col("reason").isNotNull())
    if max_rejects is not None and (n := bad.limit(max_rejects + 1).count()) > max_rejects:
        raise ValueError(f"more than {max_rejects} rejected lines in {path} ({n} read)")
    shown = F.coalesce("_line", F.to_csv(F.struct(*schema.fieldNames())))
    return (told.filter(F.col("reason").isNull()).select(*schema.fieldNames()),
            bad.select("reason", shown.alias("line"), F.col("_file").alias("file")))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_landing_json(spark: SparkSession, path: str, array_files: bool = False,
                      schema: T.StructType = API_PRICE_RECORD_SCHEMA) -> DataFrame:
    """Landing files: JSON Lines (as written by Spark) or one JSON array per
    file (as written by the API puller; needs ``multiLine``). The source file
    is kept so ticker / run date can be taken from the path."""
    reader = spark.read.schema(schema)
    if array_files:
        reader = reader.option("multiLine", "true")
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_path"))


def normalize_prices(records: DataFrame, ticker=None, ingested_at=None) -> DataFrame:
    """API price records -> raw price rows.

    Renames ``adjClose``, keeps only the known columns that are present (a
    missing one becomes NULL), parses the date from ISO text, coerces numbers
    (bad text -> NULL) and stamps ticker / ingest time (arguments, so the run
    is deterministic; a column name is also accepted for ``ticker``).
    """
    df = records
    for old, new in PRICE_API_RENAMES.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    present = [c for c in PRICE_KEEP if c in df.columns]

    def src(c):
        return F.col(c) if c in present else F.lit(None).cast("string")

    date_txt = src("date").cast("string")
    tick = F.col(ticker) if isinstance(ticker, str) and ticker in df.columns else F.lit(ticker)
    return df.select(
        F.coalesce(date_txt.try_cast("timestamp").cast("date"),
                   date_txt.try_cast("date")).alias("date"),
        *[to_double(src(c).cast("string")).alias(c)
          for c in ["open", "high", "low", "close", "adj_close"]],
        to_bigint(src("volume").cast("string")).alias("volume"),
        tick.cast("string").alias("ticker"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
    ).select(*PRICE_COLUMNS)


def normalize_metadata(records: DataFrame) -> DataFrame:
    """Company records -> raw metadata rows: upper-case ticker, missing text
    becomes '', description cut to 300 characters."""
    def txt(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in records.columns \
            else F.lit("")
    return records.select(
        F.upper(txt("ticker")).alias("ticker"),
        txt("company_name").alias("company_name"),
        cut(txt("description")).alias("description"),
        txt("exchange").alias("exchange"),
        txt("start_date").alias("start_date"),
        txt("end_date").alias("end_date"),
        F.col("fetched_at").cast("timestamp").alias("fetched_at"),
    ).select(*METADATA_COLUMNS)


def normalize_api_metadata(records: DataFrame, requested: str = "requested",
                           failed: str = "failed") -> DataFrame:
    """Records under the API's names -> raw metadata rows. A record without a
    ticker takes the requested one; a failed fetch leaves the requested ticker
    as it was asked for and the fetch time, everything else NULL."""
    present = {old: new for old, new in METADATA_API_NAMES.items() if old in records.columns}
    named = records.withColumnsRenamed(present)
    asked = F.col(requested).cast("string")
    if "ticker" in named.columns:
        named = named.withColumn("ticker", F.coalesce(F.col("ticker").cast("string"), asked))
    else:
        named = named.withColumn("ticker", asked)
    miss = F.coalesce(F.col(failed), F.lit(False))
    good = normalize_metadata(named.filter(~miss))
    bad = named.filter(miss).select(
        asked.alias("ticker"), *[F.lit(None).cast("string").alias(c)
                                 for c in METADATA_COLUMNS if c not in ("ticker", "fetched_at")],
        F.col("fetched_at").cast("timestamp").alias("fetched_at"))
    return good.unionByName(bad).select(*METADATA_COLUMNS)


def empty_prices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_PRICE_SCHEMA)
