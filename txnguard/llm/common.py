"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines and words of the corpus contracts: words are runs of anything but these six characters.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; no words for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_width(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
