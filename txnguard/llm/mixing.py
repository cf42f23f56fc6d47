"""Operator 6: mixing sources to target weights with Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import word_count
from txnguard.session import materialize

#: Fixed by the contract of the query: source weights in turn, the mix as a share of all sizes, epochs at most.
SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
#: Quality weights of documents: labelled good, labelled bad, not labelled.
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}
NO_LABEL = 1.0
SEED = "mix-1"
#: Keys are counted in so many bins of each source, then in so many parts of the bin that the budget cuts;
#: only the documents of the part that it cuts are sorted.
BINS = 1_024


def quality_weights(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``weight``: one row per labelled document, the mean over repeated labels."""
    value = F.coalesce(*(F.when(F.col("quality") == q, w) for q, w in QUALITY_WEIGHTS.items()), F.lit(NO_LABEL))
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg(value).alias("weight"))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """The exponential key ``-ln(u) / weight`` with ``u`` in (0, 1) from the id's hash; null ids share one."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / weight


def source_targets(sources: DataFrame, weights=SOURCE_WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source_size`` to ``target``: the budget by weight, with the excess of full sources reshared.

    Resharing until no source is above its limit ends where every target is
    ``min(limit, level * weight)``; the level follows from one ordering of the
    sources by limit per weight. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("_rank") % len(weights) + 1)
    ranked = (
        sources.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumn("_weight", turn)
        .withColumn("_limit", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    )
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(share)
        - F.sum("_limit").over(by_limit.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        + F.col("_limit")
    ) / F.sum("_weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = ranked.withColumn("_level", level).withColumn(
        "_chosen", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_level"))).over(everything)
    )
    target = F.least("_limit", F.coalesce(F.col("_chosen._level") * F.col("_weight"), F.col("_limit")))
    return levels.select("source", "source_size", target.alias("target"))


def mix(sized: DataFrame, seed: str = SEED, weights=SOURCE_WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sized`` (``doc_id, source, size, weight``) with ``source_size``, ``target`` and ``taken``.

    A source takes its complete epochs first; the rest of its target goes to
    its documents in the order of their keys until the budget is used up, the
    last one in part. Prefix sums need no sort of a whole source: sizes are
    summed per source and key bin, then per part of the bin that the budget
    cuts; every part before the cut is taken whole, and only the documents of
    the part that is cut, a millionth of the source, are ordered. So a source
    with a third of all rows is two aggregations with partial sums.

    ``size`` 0 takes nothing; a null ``source`` is a source of its own, last in
    order; a null or not positive ``weight`` counts as 1. Repeated rows are
    rows like others, and equal keys are ordered by id and size. The choice
    depends on ids and the seed alone, so reruns agree. An empty table gives no
    rows. Input columns beyond the four are dropped.
    """
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(1.0))
    keyed = sized.select("doc_id", "source", "size", sampling_key(F.col("doc_id"), weight, seed).alias("_key"))
    keyed = materialize(keyed.withColumn("_part", F.floor((1 - F.exp(-F.col("_key"))) * BINS**2).cast("int")), "keyed")
    sources = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budgets = targets.withColumn("_epochs", whole).withColumn(
        "_rest", (F.floor("target") - F.col("_epochs") * F.col("source_size")).cast("long")
    )
    budgets = materialize(budgets, "budgets")

    names = budgets.select(F.col("source").alias("_source"), "source_size", "target", "_epochs", "_rest")
    same = F.col("source").eqNullSafe(F.col("_source"))
    at_bin = _cut(keyed.select("source", F.floor(F.col("_part") / BINS).cast("int").alias("_at"), "size"), names, F.lit(0))
    at_bin = materialize(at_bin.select("_source", F.col("_at").alias("_in_bin"), F.col("_before").alias("_base"), "_rest"), "bins")
    inside_bin = keyed.join(at_bin, same & (F.floor(F.col("_part") / BINS) == F.col("_in_bin")))
    inside_bin = materialize(inside_bin.select("source", F.col("_part").alias("_at"), "size"), "inside")
    at_part = _cut(inside_bin, at_bin, F.col("_base")).select(
        F.col("_source").alias("_cut_source"), F.col("_at").alias("_cut_part"), F.col("_before").alias("_cut_before")
    )
    plans = names.join(at_part, F.col("_source").eqNullSafe(F.col("_cut_source")), "left").drop("_cut_source")
    plans = materialize(plans, "cuts")

    rows = keyed.join(plans, same)
    full = F.col("_epochs") * F.col("size")
    in_cut = F.coalesce(F.col("_part") == F.col("_cut_part"), F.lit(False))
    before_cut = F.coalesce(F.col("_part") < F.col("_cut_part"), F.lit(True))
    outside = rows.filter(~in_cut).withColumn("taken", full + F.when(before_cut, F.col("size")).otherwise(0))
    in_order = Window.partitionBy("source").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("_cut_before") + F.sum("size").over(in_order) - F.col("size")
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("_rest") - start))
    inside = rows.filter(in_cut).withColumn("taken", full + part)
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return outside.select(*columns).unionByName(inside.select(*columns))


def _cut(rows: DataFrame, budgets: DataFrame, base: Column) -> DataFrame:
    """Per source the place ``_at`` where the sizes of ``rows`` pass the budget, and ``_before``, the sizes before it.

    ``base`` counts what lies before all rows. There are at most ``BINS`` places of a source.
    """
    summed = materialize(rows.groupBy("source", "_at").agg(F.sum("size").alias("_words")), "sums")
    order = Window.partitionBy("source").orderBy("_at")
    upto = summed.withColumn("_upto", F.sum("_words").over(order))
    over = upto.join(budgets, F.col("source").eqNullSafe(F.col("_source"))).filter(base + F.col("_upto") > F.col("_rest"))
    first = over.groupBy("_source", "_rest").agg(
        F.min(F.struct("_at", (base + F.col("_upto") - F.col("_words")).alias("_before"))).alias("_first")
    )
    return first.select("_source", "_rest", "_first._at", "_first._before")


def size_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, source, size, weight`` of every row; the text is measured before anything is joined."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    marked = quality_weights(labels).withColumnRenamed("doc_id", "_labelled")
    return sized.join(marked, sized.doc_id == marked._labelled, "left").select(
        "doc_id", "source", "size", F.coalesce("weight", F.lit(NO_LABEL)).alias("weight")
    )


def mixing_sql() -> str:
    """DuckDB SQL of the query's result."""
    turn = f"list_extract([{', '.join(f'{w}.0::DOUBLE' for w in SOURCE_WEIGHTS)}], ((k % {len(SOURCE_WEIGHTS)}) + 1)::BIGINT)"
    quality = " ".join(f"WHEN quality = {q} THEN {w}" for q, w in QUALITY_WEIGHTS.items())
    return rf"""
WITH lab AS (SELECT doc_id, avg((CASE {quality} ELSE {NO_LABEL} END)::DOUBLE) AS weight FROM labels
             WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT documents.doc_id, source, coalesce(weight, {NO_LABEL}::DOUBLE) AS weight,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents LEFT JOIN lab ON documents.doc_id = lab.doc_id),
k AS (
  SELECT *, -ln((('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
                / {2**52}::DOUBLE) / weight AS key
  FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM k GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k FROM s),
w AS (SELECT *, {turn} AS weight, source_size * {MAX_EPOCHS} AS lim FROM r),
l AS (
  SELECT *, lim / weight AS ratio,
         ((SELECT sum(source_size) FROM s) * {SHARE}::DOUBLE
          - sum(lim) OVER (ORDER BY lim / weight, k ROWS UNBOUNDED PRECEDING) + lim)
         / sum(weight) OVER (ORDER BY lim / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
c AS (SELECT arg_min(level, (ratio, k)) AS level FROM l WHERE level <= ratio),
t AS (SELECT source, source_size::BIGINT AS source_size,
             least(lim, coalesce((SELECT level FROM c) * weight, lim)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
p AS (
  SELECT k.doc_id, size, source_size, target, epochs, floor(target)::BIGINT - epochs * source_size AS rest,
         (sum(size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING))::BIGINT
           - size AS start
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, epochs * size + least(size, greatest(0, rest - start)) AS taken FROM p"""
