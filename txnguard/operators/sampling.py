"""Splits, samples and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.functions.columns import hash_bucket
from txnguard.operators.running import running_totals
from txnguard.schema import DEFAULT_SEED, SPLIT_FRACTIONS
from txnguard.session import materialize

_SPLIT_BUCKETS = 10_000
_HASH_RANGE = 2**32
_PREFIXES = 2**20


def with_random_split(df: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Column ``split``, drawn at 70/15/15 in one pass; the seed fixes it for one partitioning."""
    draw, upto, chosen = F.rand(seed), 0.0, None
    for name, share in list(SPLIT_FRACTIONS.items())[:-1]:
        upto += share
        chosen = F.when(F.col("_draw") < upto, name) if chosen is None else chosen.when(F.col("_draw") < upto, name)
    return df.withColumn("_draw", draw).withColumn("split", chosen.otherwise(list(SPLIT_FRACTIONS)[-1])).drop("_draw")


def with_hash_split(df: DataFrame, keys: Sequence[str] = ("txn_id",)) -> DataFrame:
    """Column ``split`` by key hash: the same on every layout and every retry."""
    bucket = hash_bucket(keys, _SPLIT_BUCKETS)
    train_end = round(SPLIT_FRACTIONS["train"] * _SPLIT_BUCKETS)
    validation_end = train_end + round(SPLIT_FRACTIONS["validation"] * _SPLIT_BUCKETS)
    return df.withColumn(
        "split",
        F.when(bucket < train_end, "train").when(bucket < validation_end, "validation").otherwise("test"),
    )


def hash_split(df: DataFrame, keys: Sequence[str] = ("txn_id",)) -> dict[str, DataFrame]:
    tagged = with_hash_split(df, keys)
    return {name: tagged.filter(F.col("split") == name).drop("split") for name in SPLIT_FRACTIONS}


def stratified_sample(
    df: DataFrame, fraction: float | None, salt: int = DEFAULT_SEED, keys: Sequence[str] = ("txn_id",)
) -> DataFrame:
    """The rows whose salted key hash lies in the lowest ``fraction`` of all hashes.

    A hash ignores the label, so every class, known, unknown or null, keeps the
    same share; and the choice is the same on every layout and every retry.
    None keeps all rows.
    """
    share = 1.0 if fraction is None else float(fraction)
    if not 0.0 < share <= 1.0:
        raise ValueError(f"a sample keeps more than none and at most all rows, not a share of {fraction}")
    kept = hash_bucket(keys, _HASH_RANGE, f"{salt}|") < F.lit(round(share * _HASH_RANGE))
    return df if share == 1.0 else df.filter(kept)


def sample_splits(
    splits: dict[str, DataFrame], fraction: float | None, salt: int = DEFAULT_SEED
) -> dict[str, DataFrame]:
    """Every split sampled under a salt of its own: salt, salt + 1, salt + 2."""
    return {name: stratified_sample(part, fraction, salt + place) for place, (name, part) in enumerate(splits.items())}


def bounded_sample(
    df: DataFrame,
    per_label: int,
    keys: Sequence[str] = ("txn_id",),
    label: str = "label",
) -> DataFrame:
    """Exactly min(per_label, class size) rows per class: those of lowest key hash.

    A class may hold nearly all rows, so no task ranks a whole class. Counts
    per hash prefix give each class a cutoff prefix that is certain to cover
    the sample; only rows up to it are ranked, after equal rows are collapsed
    to one row with a count. Columns must be groupable.
    """
    prefix = F.floor(F.col("_hash") / (_HASH_RANGE // _PREFIXES))
    hashed = df.withColumn("_hash", hash_bucket(keys, _HASH_RANGE))
    upto = Window.partitionBy(label).orderBy("_prefix")
    # At most 2**20 prefixes per class, and one cutoff row per class; a table, so any number of classes will do.
    cutoffs = (
        hashed.groupBy(label, prefix.alias("_prefix"))
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
        .filter(F.col("before") < per_label)
        .groupBy(F.col(label).alias("_class"))
        .agg(F.max("_prefix").alias("_cutoff"))
    )
    cutoffs = materialize(cutoffs, "cutoffs")
    chosen = hashed.join(cutoffs, F.col(label).eqNullSafe(F.col("_class")) & (prefix <= F.col("_cutoff"))).drop("_class", "_cutoff")
    order = Window.partitionBy(label).orderBy("_hash", *keys, *df.columns)
    return (
        chosen
        .groupBy("_hash", *df.columns)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_before", F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies"))
        .filter(F.col("_before") < per_label)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("_copies", F.lit(per_label) - F.col("_before")))))
        .select(*df.columns)
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: class counts and balancing weights total / (2 * class count).

    An absent class gets weight 1.0.
    """
    counts = df.agg(F.count("*").alias("total"), F.count_if(F.col(label) == 1.0).alias("fraud_count"))

    def weight(count):
        return F.coalesce(F.try_divide(F.col("total"), 2.0 * count), F.lit(1.0))

    other = F.col("total") - F.col("fraud_count")
    return counts.select(
        "total",
        "fraud_count",
        other.alias("non_fraud_count"),
        weight(F.col("fraud_count")).alias("weight_fraud"),
        weight(other).alias("weight_non_fraud"),
    )


def add_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Column ``weight``; the two weights come from one aggregate over ``df``."""
    found = class_weights(df, label).first()
    return df.withColumn(
        "weight",
        F.when(F.col(label) == 1.0, found.weight_fraud).otherwise(found.weight_non_fraud),
    )


def first_rows(df: DataFrame, limit: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``limit`` rows in a given order; 0 means all.

    Rows are counted per key, prefix sums over the keys find those before the
    limit, and rows of the key that the limit cuts are taken in part. So a
    large limit moves through many tasks.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    if not limit:
        return df
    key = F.struct(*order_by)
    counted = materialize(df.groupBy(key.alias("_key")).agg(F.count("*").alias("_rows")), "key-counts")
    starts = running_totals(counted, "_key", ["_rows"])
    starts = starts.select("_key", (F.col("run__rows") - F.col("_rows")).alias("_before"), "_rows")
    starts = materialize(starts.filter(F.col("_before") < limit), "first-keys")
    placed = df.withColumn("_own", key).join(starts, F.col("_own").eqNullSafe(F.col("_key")))
    whole = F.col("_before") + F.col("_rows") <= limit
    # At most one key lies across the limit.
    cut = placed.filter(~whole)
    place = F.row_number().over(Window.partitionBy("_key").orderBy(*df.columns))
    part = cut.withColumn("_place", place).filter(F.col("_before") + F.col("_place") <= limit)
    return placed.filter(whole).select(*df.columns).unionByName(part.select(*df.columns)).orderBy(*order_by)
