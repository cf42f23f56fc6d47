"""Prefix sums in a global order without one task seeing every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.session import materialize

ROWS_PER_BUCKET = 1_000_000


def running_totals(
    stored: DataFrame,
    order_by: str,
    measures: Sequence[str],
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    rows: int | None = None,
) -> DataFrame:
    """Add ``run_<m>``, the inclusive prefix sum of each measure.

    ``stored`` is a materialized table, since it is read several times, with
    one row per value of the non-null ``order_by``, of any type with an order:
    equal values must be pre-aggregated, which also removes any skew by value.

    The rows are range-partitioned by the key into buckets of about
    ``rows_per_bucket`` and stored with their bucket; each bucket is summed by
    itself and starts from the totals of those before it. The number of
    buckets grows with the rows, so a task never does. Every choice of range
    bounds gives the same sums. A single bucket is not stored again. ``rows`` is
    the row count, if it is known.
    """
    direction = F.desc if descending else F.asc
    rows = stored.count() if rows is None else rows
    buckets = max(1, -(-rows // rows_per_bucket))
    if buckets > 1:
        dealt = stored.repartitionByRange(buckets, direction(order_by))
        ranged = materialize(dealt.withColumn("_bucket", F.spark_partition_id()), "ranges")
    else:
        ranged = stored.withColumn("_bucket", F.lit(0))

    # One row per bucket: a millionth of the rows.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_bucket").agg(*[F.sum(m).alias(f"_total_{m}") for m in measures])
    starts = [F.coalesce(F.sum(f"_total_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures]
    offsets = totals.select("_bucket", *starts)
    inside = (
        Window.partitionBy("_bucket").orderBy(direction(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        ranged.join(offsets, "_bucket")
        .withColumns({f"run_{m}": F.sum(m).over(inside) + F.col(f"_before_{m}") for m in measures})
        .select(*stored.columns, *[f"run_{m}" for m in measures])
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    levels: dict[str, float],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row of interpolated quantiles, exact at any size.

    The built-in exact percentile keeps all distinct values in one buffer;
    here they stay a distributed table of (value, count).
    """
    counted = materialize(
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")),
        "value-counts",
    )
    total = counted.agg(F.sum("n")).first()[0] or 0
    ranked = running_totals(counted, "value", ["n"], rows_per_bucket=rows_per_bucket)

    def at_rank(rank: int):
        here = (F.col("run_n") > rank) & (F.col("run_n") - F.col("n") <= rank)
        return F.max(F.when(here, F.col("value")))

    picks = []
    for name, level in levels.items():
        position = level * max(total - 1, 0)
        low = int(position)
        lower, upper = at_rank(low), at_rank(min(low + 1, max(total - 1, 0)))
        picks.append((lower + (upper - lower) * F.lit(position - low)).alias(name))
    return ranked.agg(*picks)


def running_fraud_share(
    df: DataFrame,
    key: str,
    every: int = 500,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Rows sent so far and fraud share, at each ``every``-th row in key order.

    Rows that share a key count as sent together: a boundary inside them is
    reported once, after the last of them.
    """
    counted = materialize(
        df.groupBy(key).agg(
            F.count("*").alias("sent"),
            F.count_if(F.col("isFraud") == 1).alias("fraud"),
        ),
        "replay-counts",
    )
    totals = running_totals(counted, key, ["sent", "fraud"], rows_per_bucket=rows_per_bucket)
    passed = F.floor(F.col("run_sent") / every) > F.floor((F.col("run_sent") - F.col("sent")) / every)
    return totals.filter(passed).select(
        F.col("run_sent").alias("sent_rows"),
        F.col("run_fraud").alias("fraud_rows"),
        F.round(F.col("run_fraud") * 100.0 / F.col("run_sent"), 4).alias("fraud_percent"),
    )
