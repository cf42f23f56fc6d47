"""Quantile sketches per hour, stored as binary and merged when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of a sketch: its rank error is about 0.7 % and its size a few kilobytes, whatever it holds.
SKETCH_K = 400


def quantile_sketches(df: DataFrame, column: str, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``by``, ``rows`` and a mergeable ``sketch`` of the known values of ``column``.

    Sketches are built before the shuffle and merged after it, so what moves is
    one sketch per task and group. A group without a known value has no row.
    """
    value = F.col(column).cast("double")
    known = df.filter(value.isNotNull() & ~F.isnan(value)).select(*by, value.alias("_value"))
    return known.groupBy(*by).agg(F.count("*").alias("rows"), F.kll_sketch_agg_double("_value", k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, levels: dict[str, float], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Quantiles over any rows of a sketch table, one column per level, without the values themselves."""
    merged = sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(level))).alias(name) for name, level in levels.items()]
    return merged.filter(F.col("rows") > 0).select(*by, "rows", *found)
