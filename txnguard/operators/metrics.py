"""Confusion counts, classification metrics, AUC and the ROC curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from txnguard.functions.columns import evaluate_once
from txnguard.operators.running import ROWS_PER_BUCKET, running_totals
from txnguard.schema import EVALUATION_METRICS
from txnguard.session import materialize

_CELLS = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row tn, fp, fn, tp, from one aggregate."""
    return df.agg(
        *[
            F.count_if((F.col(label) == actual) & (F.col(prediction) == guess)).alias(cell)
            for cell, (actual, guess) in _CELLS.items()
        ]
    )


def _share(part: Column, whole: Column) -> Column:
    """part / whole as double, 0.0 where the whole is empty."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _weighted_columns() -> list[Column]:
    """Accuracy and class-weighted precision, recall and F1 of a confusion row."""
    tn, fp, fn, tp = (F.col(cell) for cell in _CELLS)
    negative, positive = tn + fp, fn + tp
    p0, p1 = _share(tn, tn + fn), _share(tp, tp + fp)
    r0, r1 = _share(tn, negative), _share(tp, positive)
    f0, f1 = _share(2 * p0 * r0, p0 + r0), _share(2 * p1 * r1, p1 + r1)
    total = negative + positive

    def blend(zero: Column, one: Column) -> Column:
        return _share(zero * negative + one * positive, total)

    return [
        _share(tn + tp, total).alias("accuracy"),
        blend(p0, p1).alias("precision"),
        blend(r0, r1).alias("recall"),
        blend(f0, f1).alias("f1"),
    ]


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return confusion_matrix(df, label, prediction).select(*_weighted_columns())


def score_histogram(
    df: DataFrame,
    score: str | Column = "fraud_probability",
    label: str = "label",
    prediction: str | None = None,
) -> DataFrame:
    """One stored row per distinct score with its class counts.

    All rank metrics read this instead of the rows. Partial aggregation
    collapses a score shared by many rows before the shuffle. Rows without a
    score make one row of their own: they have no rank, but their prediction
    counts, by the same cells as in ``confusion_matrix``.
    """
    value = F.col(score) if isinstance(score, str) else score
    guess = F.col(prediction) if prediction else F.lit(None).cast("double")
    cells = {name: (F.col(label) == actual) & (guess == told) for name, (actual, told) in _CELLS.items()}
    columns = {"score": value.cast("double"), "is_positive": F.col(label) == 1.0, **cells}
    scored = evaluate_once(df, columns).select(*columns).filter("is_positive IS NOT NULL")
    ranked, positive = F.col("score").isNotNull(), F.col("is_positive")
    return materialize(
        scored.groupBy("score").agg(
            F.count_if(ranked & positive).alias("pos"),
            F.count_if(ranked & ~positive).alias("neg"),
            *[F.count_if(F.col(cell)).alias(cell) for cell in _CELLS],
        ),
        "scores",
    )


def histogram_totals(histogram: DataFrame) -> Row:
    """Number of distinct scores and class totals, one small job."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pos", "neg", *_CELLS)]
    return histogram.agg(F.count("score").alias("scores"), *sums).first()


def auc_of(
    histogram: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, rows: int | None = None
) -> DataFrame:
    """Area under the ROC curve: share of (fraud, other) pairs ranked right.

    Ties count one half. Null when one class is absent.
    """
    scores = histogram.filter("score IS NOT NULL")
    ranked = running_totals(scores, "score", ["neg"], rows_per_bucket=rows_per_bucket, rows=rows)
    lower = F.col("run_neg") - F.col("neg") + F.col("neg") / 2.0
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(F.sum(F.col("pos") * lower), pairs).alias("auc"))


def auc(
    df: DataFrame,
    score: str | Column = "fraud_probability",
    label: str = "label",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    return auc_of(score_histogram(df, score, label), rows_per_bucket)


def roc_of(
    histogram: DataFrame,
    max_points: int = 200,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    totals: Row | None = None,
) -> DataFrame:
    """ROC points (point, fpr, tpr) from (0,0) to (1,1) over all rows.

    One point per distinct score, scores falling. Beyond ``max_points`` every
    step-th point and the last are kept, so up to nearly twice as many remain.
    With one class missing only the two corners come out.
    """
    spark = histogram.sparkSession
    schema = "point BIGINT, fpr DOUBLE, tpr DOUBLE"
    totals = totals or histogram_totals(histogram)
    if not totals.pos or not totals.neg:
        return spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 1.0)], schema)
    points = totals.scores + 1
    step = 1 if points <= max_points else max(1, points // (max_points - 1))
    ranked = running_totals(
        histogram.filter("score IS NOT NULL").withColumn("one", F.lit(1)),
        "score",
        ["one", "pos", "neg"],
        descending=True,
        rows_per_bucket=rows_per_bucket,
        rows=totals.scores,
    )
    curve = ranked.select(
        F.col("run_one").cast("bigint").alias("point"),
        (F.col("run_neg") / F.lit(float(totals.neg))).alias("fpr"),
        (F.col("run_pos") / F.lit(float(totals.pos))).alias("tpr"),
    ).filter((F.col("point") % step == 0) | (F.col("point") == totals.scores))
    return spark.createDataFrame([(0, 0.0, 0.0)], schema).unionByName(curve)


def roc_curve(
    df: DataFrame,
    score: str | Column = "fraud_probability",
    label: str = "label",
    max_points: int = 200,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    return roc_of(score_histogram(df, score, label), max_points, rows_per_bucket)


def evaluate(df: DataFrame, score: str | Column, label: str = "label") -> dict:
    """All five metrics, the confusion counts and the ROC points of predictions.

    The predictions are read once, into the score histogram.
    """
    histogram = score_histogram(df, score, label, "prediction")
    totals = histogram_totals(histogram)
    cells = {cell: totals[cell] for cell in _CELLS}
    literals = [F.lit(count).alias(cell) for cell, count in cells.items()]
    area = auc_of(histogram, rows=totals.scores).select(*literals, "auc")
    found = area.select("auc", *_weighted_columns()).first()
    return {
        "metrics": {name: found[name] for name in EVALUATION_METRICS},
        "confusion_matrix": cells,
        "roc_curve": roc_of(histogram, totals=totals),
    }


def best_models(results: DataFrame, metric: str = "validation_auc") -> DataFrame:
    """Mark the best candidate; the earlier one wins a tie.

    ``results`` has one row per trained model, so one window over it is small.
    """
    order = Window.orderBy(F.desc_nulls_last(metric), F.asc("position"))
    first = F.row_number().over(order) == 1
    return results.withColumn("role", F.when(first, "best").otherwise("alternate"))
