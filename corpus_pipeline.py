"""A training-corpus pipeline: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns the columns of ``docs``; the last returns packed pieces. Stages drop
rows for their own text, whatever their id: NULL or repeated ids are rows like
others. Other columns pass through unchanged whatever their names; helper
columns take names that are free. ``run`` applies the stages to ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import decontamination, jaccard_join, language_id, packing, secret_scan
from marketlake.llm.common import free_name, sized, staged, tune, with_uid
from marketlake.sources.tables import read_table

MIN_LANGUAGE_SCORE = 0.4
MASK = "[secret]"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: texts without a letter or without a clear language go."""
    tune(spark)
    name, certain = free_name(docs, "_language"), free_name(docs, "_certain")
    told = language_id.predictions(docs, language_id.train(docs), names=(name, certain),
                                   keep=True)
    return told.filter((F.col(name) != language_id.UNKNOWN)
                       & (F.col(certain) >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one row of each class of near duplicates stays."""
    tune(spark)
    return jaccard_join.keep_one_row_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: rows that hold a benchmark passage go."""
    benchmark = read_table(tune(spark), sf_dir, "benchmark")
    rows, uid = with_uid(docs)
    told = decontamination.contamination(rows, benchmark, id_col=uid)
    gone = staged(told.filter("contaminated").select(F.col("doc_id").alias(uid)),
                  "contaminated")
    return rows.join(sized(gone), uid, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: secrets are masked in the text; every document stays."""
    tune(spark)
    out = secret_scan.redact_secrets(docs, mask=MASK)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(
        F.contains("text", F.lit(MASK)), F.length("text").cast(docs.schema["n_chars"].dataType))
        .otherwise(F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: what is left becomes sequences of at most 2,048 tokens."""
    tune(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("pack", pack),
]

# Trained and packed results are not SQL; tests hold the rows and texts of the
# stages on a small table against brute-force versions (language: against its
# operator, as its model is trained).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
