"""Membership of an account list: literal, broadcast and shuffled forms."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.columns import account_code, flag
from txnguard.session import materialize

MAX_LITERALS = 1_000
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class AccountList:
    """A list of accounts with the decision how to look them up: as literals, or as distinct ``accounts`` to join."""

    accounts: DataFrame | None
    literals: tuple[str, ...] | None
    fits_broadcast: bool

    def joinable(self) -> DataFrame:
        """The join side; hinted only when its measured size is in bounds."""
        return F.broadcast(self.accounts) if self.fits_broadcast else self.accounts


def account_list(
    source: AccountList | DataFrame | Iterable[str] | None,
    max_literals: int = MAX_LITERALS,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> AccountList:
    """Choose a list's form once; the form never changes a result.

    Names and the rows of a DataFrame (column ``account``) are spelled by one
    expression: outer white space goes, letters become upper case, null and
    blank entries are dropped. Up to ``max_literals`` names become an IN set
    whose entries Catalyst folds, without a job. The distinct rows of a
    DataFrame, or of more names, are stored and counted: a list within the row
    and byte bounds is broadcast, and anything larger is an ordinary equi-join,
    in which adaptive execution splits the partition of a hot account. It can do
    so only because the stored list needs no aggregation between its shuffle and
    the join.
    """
    if isinstance(source, AccountList):
        return source
    if not isinstance(source, DataFrame):
        names = tuple(dict.fromkeys(name for name in source or () if name is not None))
        if len(names) <= max_literals:
            return AccountList(None, names, True)
        source = SparkSession.active().createDataFrame([(name,) for name in names], "account STRING")
    spelled = source.select(account_code(F.col("account")).alias("account")).filter("account <> ''")
    accounts = materialize(spelled.distinct(), "accounts")
    rows, size = accounts.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("account")), F.lit(0))
    ).first()
    fits = rows <= max_rows and size <= max_bytes
    names = None
    if rows <= max_literals:
        names = tuple(sorted(row.account for row in accounts.limit(max_literals).collect()))
    return AccountList(accounts, names, fits)


def _listed(source: AccountList, column: str):
    """Whether the account is one of the literals, in their spelling; a blank entry matches nothing."""
    if not source.literals:
        return F.lit(False)
    found = F.col(column).isin(*[account_code(F.lit(name)) for name in source.literals])
    return found & (F.col(column) != "")


def flag_listed(df: DataFrame, source, output: str, column: str = "nameDest") -> DataFrame:
    """Add ``output``: 1.0 if ``column`` is listed, else 0.0. Keeps every row."""
    listed = account_list(source)
    if listed.literals is not None:
        return df.withColumn(output, flag(_listed(listed, column)))
    lookup = listed.joinable().select(F.col("account").alias("_listed"))
    return (
        df.join(lookup, F.col(column) == F.col("_listed"), "left")
        .withColumn(output, flag(F.col("_listed").isNotNull()))
        .drop("_listed")
    )


def only_listed(df: DataFrame, source, column: str = "nameDest") -> DataFrame:
    """Rows whose account is on the list, given in any form."""
    listed = account_list(source)
    if listed.literals is not None:
        return df.filter(_listed(listed, column))
    return df.join(listed.joinable(), F.col(column) == F.col("account"), "left_semi")


def only_unlisted(df: DataFrame, source, column: str = "nameDest") -> DataFrame:
    """Rows whose account is not on the list, given in any form; a missing account is not."""
    listed = account_list(source)
    if listed.literals is not None:
        return df.filter(~F.coalesce(_listed(listed, column), F.lit(False)))
    return df.join(listed.joinable(), F.col(column) == F.col("account"), "left_anti")
