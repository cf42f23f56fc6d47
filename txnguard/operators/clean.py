"""Validation and cleaning. Row-wise, so the same code serves batch and stream."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.columns import (
    evaluate_once,
    present,
    to_double,
    to_whole,
    trimmed_upper,
    type_code,
)
from txnguard.schema import (
    ACCOUNT_COLUMNS,
    CRITICAL_COLUMNS,
    MONEY_COLUMNS,
    TRANSACTION_COLUMNS,
    TRANSACTION_TYPES,
)

_TEXT_COLUMNS = ("type", *ACCOUNT_COLUMNS)
_NUMERIC_CRITICAL = tuple(c for c in CRITICAL_COLUMNS if c not in _TEXT_COLUMNS)


def require_columns(df: DataFrame) -> None:
    """Raise if a transaction column is missing; extra columns are fine."""
    absent = sorted(set(TRANSACTION_COLUMNS) - set(df.columns))
    if absent:
        raise ValueError(f"Missing required transaction columns: {', '.join(absent)}")


def _spelled_columns() -> dict[str, Column]:
    accounts = {name: trimmed_upper(F.col(name)) for name in ACCOUNT_COLUMNS}
    return {"type": type_code(F.col("type")), **accounts}


def typed_columns(schema: T.StructType) -> dict[str, Column]:
    """Clean type and spelling of each critical column that its type leaves open."""
    given = {field.name: field.dataType for field in schema.fields}
    computed = _spelled_columns()
    if not isinstance(given["step"], T.IntegerType):
        computed["step"] = to_whole(F.col("step"))
    for name in (*MONEY_COLUMNS, "isFraud"):
        if not isinstance(given[name], T.DoubleType):
            computed[name] = to_double(F.col(name))
    return computed


def standardize(df: DataFrame) -> DataFrame:
    """Cast and normalise every row without dropping any.

    Each critical value is computed once, though the validity filter reads it
    again; ``isFlaggedFraud`` stays outside, so that it is read only if used.
    """
    require_columns(df)
    flagged = F.coalesce(to_whole(F.col("isFlaggedFraud")), F.lit(0))
    return evaluate_once(df, typed_columns(df.schema)).withColumn("isFlaggedFraud", flagged)


def _failures() -> list[tuple[str, Column]]:
    """(reason, condition) pairs over standardized rows, in reporting order."""
    missing = [
        (f"missing_{name}", ~present(F.col(name), floating=name != "step"))
        for name in _NUMERIC_CRITICAL
    ]
    blank = [(f"blank_{name}", F.length(name) == 0) for name in _TEXT_COLUMNS]
    return [*missing, *blank, ("unknown_type", ~F.col("type").isin(*TRANSACTION_TYPES))]


def is_valid() -> Column:
    """True for a standardized row that passes every check.

    A known type is not blank, so that check is left out: it would only make
    the filter normalise the type once more.
    """
    return reduce(and_, (~failed for reason, failed in _failures() if reason != "blank_type"))


def clean_transactions(df: DataFrame) -> DataFrame:
    """Standardize, then keep the valid rows: no shuffle."""
    return standardize(df).filter(is_valid())


def drop_reason() -> Column:
    """First failed check of a standardized row; null if it is kept."""
    column = None
    for reason, failed in _failures():
        column = F.when(failed, reason) if column is None else column.when(failed, reason)
    return column


def drop_reasons(df: DataFrame) -> DataFrame:
    """Number of raw rows per outcome ('kept' or the first failed check)."""
    outcome = F.coalesce(drop_reason(), F.lit("kept"))
    return standardize(df).groupBy(outcome.alias("reason")).agg(F.count("*").alias("row_count"))


def cleaning_counts(df: DataFrame) -> DataFrame:
    """Raw, clean and dropped rows in one pass over the raw data."""
    return (
        standardize(df)
        .agg(F.count("*").alias("raw_rows"), F.count_if(is_valid()).alias("clean_rows"))
        .withColumn("dropped_rows", F.col("raw_rows") - F.col("clean_rows"))
    )
