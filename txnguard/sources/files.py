"""Batch readers."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.columns import account_code, row_digest
from txnguard.schema import TRANSACTION_COLUMNS

log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Transaction CSV with a header, every column as text, in one scan.

    Columns are found by the names in the header line, in any order; others
    pass through, a missing one is an error. Typing happens in cleaning, so a
    bad cell becomes null there instead of turning a whole inferred column into
    text. All files of one read carry the same header line.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    header = reader.option("enforceSchema", False).csv(path)
    missing = [name for name in TRANSACTION_COLUMNS if name not in header.columns]
    if missing:
        raise ValueError(f"the header of {path} lacks {', '.join(missing)}")
    others = [F.col(f"`{name}`") for name in header.columns if name not in TRANSACTION_COLUMNS]
    return header.select(*TRANSACTION_COLUMNS, *others)


def with_txn_id(df: DataFrame, column: str = "txn_id") -> DataFrame:
    """A row key if the data has none: digest of the transaction columns."""
    return df if column in df.columns else df.withColumn(column, row_digest(TRANSACTION_COLUMNS))


def read_blacklist(
    spark: SparkSession, path: str | None = None, inline: Iterable[str] | str = ()
) -> DataFrame:
    """Distinct account ids of a text file and of an inline list, upper case.

    The file has one account per line; blank lines and '#' comments are
    skipped. A missing file is a warning, not an error. ``inline`` may be one
    comma-separated string. Upper case because cleaned rows are upper case.
    """
    names = inline.split(",") if isinstance(inline, str) else list(inline)
    lines = spark.createDataFrame([(name,) for name in names if name], "value STRING")
    if path:
        try:
            lines = lines.unionByName(spark.read.text(path))
        except AnalysisException as problem:
            log.warning("blacklist file %s not read: %s", path, problem)
    account = account_code(F.col("value"))
    return (
        lines.select(account.alias("account"))
        .filter((F.length("account") > 0) & ~F.startswith(F.col("account"), F.lit("#")))
        .distinct()
    )
