"""Declared schemas of the raw layer and of the predictions table.

Loads always pass one of these; nothing is inferred.
"""

from pyspark.sql import types as T

PRICE_COLUMNS = ["date", "open", "high", "low", "close", "adj_close", "volume",
                 "ticker", "ingested_at"]

RAW_PRICE_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("adj_close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("ingested_at", T.TimestampType(), True),
])

METADATA_COLUMNS = ["ticker", "company_name", "description", "exchange",
                    "start_date", "end_date", "fetched_at"]

RAW_METADATA_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("company_name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("exchange", T.StringType(), True),
    T.StructField("start_date", T.StringType(), True),
    T.StructField("end_date", T.StringType(), True),
    T.StructField("fetched_at", T.TimestampType(), True),
])

# Price records as they arrive from the market-data API (landing JSON):
# text dates, camel-case adjusted close, numbers possibly given as text.
API_PRICE_RECORD_SCHEMA = T.StructType([
    T.StructField("date", T.StringType(), True),
    T.StructField("open", T.StringType(), True),
    T.StructField("high", T.StringType(), True),
    T.StructField("low", T.StringType(), True),
    T.StructField("close", T.StringType(), True),
    T.StructField("adjClose", T.StringType(), True),
    T.StructField("volume", T.StringType(), True),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), True),
    T.StructField("forecast_date", T.DateType(), True),
    T.StructField("predicted_close", T.DoubleType(), True),
    T.StructField("prediction_interval_lower_value", T.DoubleType(), True),
    T.StructField("prediction_interval_upper_value", T.DoubleType(), True),
    T.StructField("confidence_level", T.DoubleType(), True),
    T.StructField("model_run_date", T.DateType(), True),
])
