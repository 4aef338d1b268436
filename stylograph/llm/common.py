"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def n_words(text: str | Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def columns(df: DataFrame) -> list[Column]:
    """Every column, also those whose names hold dots."""
    return [F.col(f"`{c}`") for c in df.columns]


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns of a row as one struct, so that an operator's own names clash with none of them."""
    return F.struct(*columns(df)).alias(name)
