import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from txnguard.operators import metrics, running
from txnguard.session import materialize


def predictions(spark, pairs):
    return spark.createDataFrame([(float(s), float(y), float(s > 0.5)) for s, y in pairs], "score DOUBLE, label DOUBLE, prediction DOUBLE")


@pytest.fixture(scope="module")
def mixed(spark):
    draw = random.Random(11)
    pairs = []
    for _ in range(900):
        label = draw.random() < 0.2
        score = min(1.0, max(0.0, draw.gauss(0.6 if label else 0.4, 0.2)))
        pairs.append((round(score, 2) if draw.random() < 0.5 else score, label))
    return pairs, predictions(spark, pairs)


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_bucket", [1_000_000, 37, 1])
def test_auc_matches_brute_force_at_any_bucket_size(mixed, per_bucket):
    pairs, df = mixed
    assert metrics.auc(df, "score", rows_per_bucket=per_bucket).first().auc == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_metrics_match_the_library_evaluators(mixed):
    pairs, df = mixed
    found = metrics.evaluate(df, "score")
    named = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in named.items():
        wanted = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert found["metrics"][ours] == pytest.approx(wanted, abs=1e-12)
    raw = df.withColumn("rawPrediction", array_to_vector(F.array(1 - F.col("score"), "score")))
    wanted = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    assert found["metrics"]["auc"] == pytest.approx(wanted, abs=1e-12)
    assert sum(found["confusion_matrix"].values()) == len(pairs)
    assert found["confusion_matrix"] == metrics.confusion_matrix(df).first().asDict()


def brute_roc(pairs, max_points):
    n1 = sum(1 for _, y in pairs if y)
    points = [(0.0, 0.0)]
    for cut in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(1 for s, y in pairs if y and s >= cut)
        fp = sum(1 for s, y in pairs if not y and s >= cut)
        points.append((fp / (len(pairs) - n1), tp / n1))
    if len(points) <= max_points:
        return points
    step = max(1, len(points) // (max_points - 1))
    kept = points[::step]
    return kept if kept[-1] == points[-1] else [*kept, points[-1]]


@pytest.mark.parametrize("max_points", [10, 200, 10_000])
@pytest.mark.parametrize("per_bucket", [1_000_000, 50])
def test_roc_matches_brute_force(mixed, max_points, per_bucket):
    pairs, df = mixed
    curve = metrics.roc_curve(df, "score", max_points=max_points, rows_per_bucket=per_bucket)
    found = [(r.fpr, r.tpr) for r in curve.orderBy("point").collect()]
    wanted = brute_roc(pairs, max_points)
    assert found[0] == (0.0, 0.0) and found[-1] == (1.0, 1.0)
    assert len(found) == len(wanted)
    for ours, theirs in zip(found, wanted):
        assert ours == pytest.approx(theirs)
    assert found == sorted(found)


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_gives_two_corners_and_no_auc(spark, label):
    df = predictions(spark, [(0.2, label), (0.7, label)])
    points = [(r.fpr, r.tpr) for r in metrics.roc_curve(df, "score").orderBy("point").collect()]
    assert points == [(0.0, 0.0), (1.0, 1.0)]
    assert metrics.auc(df, "score").first().auc is None


def test_metrics_of_never_predicted_class_are_zero(spark):
    found = metrics.classification_metrics(predictions(spark, [(0.1, 0), (0.2, 1), (0.3, 0)])).first()
    assert found.accuracy == pytest.approx(2 / 3)
    assert found.precision == pytest.approx(2 / 3 * 2 / 3)


def test_best_model_first_wins_ties(spark):
    table = spark.createDataFrame(
        [("a", 0, 0.8), ("b", 1, 0.9), ("c", 2, 0.9), ("d", 3, None)],
        "model_key STRING, position INT, validation_auc DOUBLE",
    )
    roles = {r.model_key: r.role for r in metrics.best_models(table).collect()}
    assert roles == {"a": "alternate", "b": "best", "c": "alternate", "d": "alternate"}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("per_bucket", [10_000, 100, 7])
def test_running_totals_match_brute_force(spark, descending, per_bucket):
    draw = random.Random(5)
    # Most values crowd into a tiny range, as model scores do.
    values = {draw.random() * (1e-6 if draw.random() < 0.9 else 1.0) for _ in range(1500)}
    data = [(v, draw.randrange(9), draw.randrange(3)) for v in values]
    stored = materialize(spark.createDataFrame(data, "k DOUBLE, a BIGINT, b BIGINT"))
    totals = running.running_totals(stored, "k", ["a", "b"], descending, per_bucket)
    found = {r.k: (r.run_a, r.run_b) for r in totals.collect()}
    a = b = 0
    for k, x, y in sorted(data, reverse=descending):
        a, b = a + x, b + y
        assert found[k] == (a, b)
    assert len(found) == len(data)


def test_bucketed_running_totals_have_no_global_window(spark):
    stored = materialize(spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("a")))
    plan = running.running_totals(stored, "k", ["a"], rows_per_bucket=50)._jdf.queryExecution().toString()
    assert "windowspecdefinition(_bucket" in plan
    window_over_rows = [line for line in plan.splitlines() if "windowspecdefinition(k" in line]
    assert not window_over_rows


@pytest.mark.parametrize("per_bucket", [10_000, 13])
def test_exact_quantiles(spark, per_bucket):
    draw = random.Random(3)
    values = [round(draw.expovariate(0.01), 1) for _ in range(777)] + [5.0] * 300
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v DOUBLE")
    levels = {"low": 0.0, "mid": 0.5, "high": 0.99, "top": 1.0}
    found = running.exact_quantiles(df, "v", levels, per_bucket).first()
    ordered = sorted(values)
    for name, level in levels.items():
        position = level * (len(ordered) - 1)
        low = int(position)
        high = min(low + 1, len(ordered) - 1)
        assert found[name] == pytest.approx(ordered[low] + (ordered[high] - ordered[low]) * (position - low))


def test_evaluation_and_matrix_count_the_same(spark):
    data = [(1.0, 1.0, 0.9), (0.0, 1.0, None), (1.0, None, 0.4), (0.0, 0.0, 0.1), (None, 1.0, 0.5), (1.0, 0.0, None)]
    df = spark.createDataFrame(data, "label DOUBLE, prediction DOUBLE, s DOUBLE")
    found = metrics.evaluate(df, "s")
    assert found["confusion_matrix"] == metrics.confusion_matrix(df).first().asDict()
    assert found["metrics"]["auc"] == 1.0


def test_running_totals_of_text_keys(spark):
    stored = materialize(spark.range(300).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(1).alias("a")))
    found = [r.run_a for r in running.running_totals(stored, "k", ["a"], rows_per_bucket=40).orderBy("k").collect()]
    assert found == list(range(1, 301))


def test_quantiles_of_nothing_are_null(spark):
    assert running.exact_quantiles(spark.createDataFrame([], "v DOUBLE"), "v", {"mid": 0.5}).first().mid is None
