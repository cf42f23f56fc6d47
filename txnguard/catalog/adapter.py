"""Transactions, model scores and account lists derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.columns import flag
from txnguard.operators.blacklist import account_list

LISTED = ("C7", "C31")

# In the order of the leading digit of the order priority, 1 to 5.
_TYPE_OF_PRIORITY = ("TRANSFER", "CASH_OUT", "PAYMENT", "DEBIT", "CASH_IN")

# Declared, so that planning a query does not first open files to infer them.
_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(_SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet*")


def raw_transactions(spark: SparkSession, sf_dir: str, timed: bool = False) -> DataFrame:
    """One transaction per order, with planted faults for the cleaner.

    ``timed`` adds the order date as ``sent_at``.

    Both sides grow with the data, so the join carries no hint: Spark
    broadcasts customers only below its size threshold, and otherwise adaptive
    execution splits the partition of a customer with very many orders.
    """
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    k, price, balance = F.col("o_orderkey"), F.col("o_totalprice"), F.col("c_acctbal")

    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    base = F.get(F.array(*[F.lit(name) for name in _TYPE_OF_PRIORITY]), priority - 1)
    before = F.when(k % 5 == 0, price).otherwise(price + balance + 1000)
    joined = joined.withColumns({"base": base, "old_orig": before})
    outgoing = priority <= 2
    padded = F.concat(F.lit("  "), F.lower(F.translate("base", "_", " ")), F.lit(" "))
    fraud = ((price > 200000) & (k % 5 == 0) & outgoing) | (k % 101 == 0)
    sent = [F.col("o_orderdate").cast("timestamp").alias("sent_at")] if timed else []
    return joined.select(
        k.alias("txn_id"),
        (k % 743 + 1).cast("int").alias("step"),
        F.when(k % 97 == 0, None)
        .when(k % 89 == 0, "UNKNOWN")
        .when(k % 7 == 0, padded)
        .otherwise(F.col("base"))
        .alias("type"),
        F.when(k % 83 == 0, None).otherwise(price).alias("amount"),
        F.concat(F.lit(" c"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("nameOrig"),
        F.col("old_orig").alias("oldbalanceOrg"),
        (F.col("old_orig") - price).alias("newbalanceOrig"),
        F.when(k % 79 == 0, " ")
        .otherwise(F.concat(F.when(outgoing, "C").otherwise("M"), (k % 50).cast("string")))
        .alias("nameDest"),
        F.abs(balance).alias("oldbalanceDest"),
        (F.abs(balance) + price).alias("newbalanceDest"),
        F.when(fraud, 1).otherwise(0).alias("isFraud"),
        F.when(k % 3 == 0, None).when(price > 400000, 1).otherwise(0).alias("isFlaggedFraud"),
        *sent,
    )


def key_scorer(factor: int = 37, modulus: int = 1000):
    """A stand-in model whose probability any engine can compute from the key."""

    def score(df: DataFrame) -> DataFrame:
        share = (F.col("txn_id") * factor % modulus) / float(modulus - 1)
        return df.withColumn("fraud_probability", share).withColumn("prediction", flag(share > 0.5))

    return score


def listed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of customers in debt: a list that grows with the data."""
    debtors = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return debtors.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("account"))


def joined_list(spark: SparkSession, sf_dir: str):
    """The same list, always as a join side, never as literals."""
    return account_list(listed_customers(spark, sf_dir), max_literals=0)
