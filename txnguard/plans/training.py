"""Feature pipeline, candidate models, training, comparison, re-evaluation."""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.columns import positive_class
from txnguard.operators.clean import clean_transactions, standardize
from txnguard.operators.features import add_features, add_label
from txnguard.operators.metrics import evaluate
from txnguard.operators.profile import summary_columns
from txnguard.operators.sampling import (
    add_class_weights,
    hash_split,
    sample_splits,
    with_hash_split,
    with_random_split,
)
from txnguard.schema import DEFAULT_SEED, EVALUATION_METRICS, MODEL_INPUTS, SPLIT_FRACTIONS
from txnguard.session import enable_checkpoints, materialize, scratch_path
from txnguard.sources.files import with_txn_id

log = logging.getLogger(__name__)

# Fixed values: (trees, depth) of the forest, (rounds, depth) of boosting.
PROFILES = {
    "full": {"rf": (80, 10), "gbt": (30, 8)},
    "notebook": {"rf": (40, 8), "gbt": (15, 6)},
    "interactive": {"rf": (20, 6), "gbt": (8, 4)},
}
_GAPS = ", ".join(f"coalesce(nanvl({name}, 0.0D), 0.0D) AS {name}" for name in ("amount_ratio",))
_FILLED = f"SELECT * EXCEPT (amount_ratio), {_GAPS} FROM __THIS__"
# The columns a fit reads, and the fewest and most rows of a partition it reads them in.
_FIT_COLUMNS = (*(name for name in MODEL_INPUTS if name != "type_index"), "type", "label", "weight")
_LEAST_ROWS, _MOST_ROWS = 10_000, 500_000
MODEL_NAMES = {"rf": "RandomForest", "gbt": "GradientBoostedTrees"}


def feature_stages() -> list:
    """Fill gaps, index the type by frequency, assemble the inputs, scale to unit deviation.

    A ratio that does not exist (a balance of -1) becomes 0: kept as NaN it
    would make the deviation of the column NaN and lose it for all rows.
    """
    return [
        SQLTransformer(statement=_FILLED),
        StringIndexer(inputCol="type", outputCol="type_index", handleInvalid="keep"),
        VectorAssembler(inputCols=list(MODEL_INPUTS), outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False),
    ]


def feature_pipeline() -> Pipeline:
    return Pipeline(stages=feature_stages())


def candidate_estimators(profile: str | dict = "full", seed: int = DEFAULT_SEED) -> dict:
    """Weighted classifiers of a named profile, or of given (size, depth) pairs."""
    if isinstance(profile, str):
        if profile not in PROFILES:
            raise ValueError(f"unknown profile {profile!r}; known: {', '.join(sorted(PROFILES))}")
        profile = PROFILES[profile]
    shared = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight", "seed": seed}
    trees, tree_depth = profile["rf"]
    rounds, boost_depth = profile["gbt"]
    return {
        "rf": RandomForestClassifier(numTrees=trees, maxDepth=tree_depth, **shared),
        "gbt": GBTClassifier(maxIter=rounds, maxDepth=boost_depth, **shared),
    }


def evaluate_model(model: PipelineModel, df: DataFrame) -> dict:
    """Metrics, confusion counts and ROC of a fitted model on labelled rows."""
    return evaluate(model.transform(df), positive_class("rawPrediction"))


def fit_detached(estimator, prepared: PipelineModel, df: DataFrame) -> PipelineModel:
    """Fit a classifier behind fitted feature stages; it comes back as stored and loaded.

    A freshly fitted forest still holds its training data frame and session,
    which would be shipped to every task that applies it, and which cannot be
    serialized at all once the session has observed a query.
    """
    fitted = estimator.fit(prepared.transform(df))
    path = scratch_path(df.sparkSession, "fitted")
    fitted.write().save(path)
    return PipelineModel(stages=[*prepared.stages, type(fitted).load(path)])


@dataclass(frozen=True)
class Candidate:
    """One trained classifier and what was measured on it."""

    key: str
    name: str
    seconds: float
    validation: dict[str, float | None]
    test: dict[str, float | None]
    cells: dict[str, int]
    curve: DataFrame
    model: PipelineModel | None = None


@dataclass(frozen=True)
class TrainingRun:
    """All candidates of a run and the parameters that made them."""

    candidates: dict[str, Candidate]
    summary: dict
    profile: str
    sample_fraction: float | None
    seed: int
    data: str
    split_rows: dict[str, int]


def fit_candidate(
    key: str,
    estimator,
    prepared: PipelineModel,
    splits: dict[str, DataFrame],
    include_model: bool = True,
) -> Candidate:
    """Fit on train, time it, evaluate on validation and test."""
    started = time.monotonic()
    model = fit_detached(estimator, prepared, splits["train"])
    seconds = time.monotonic() - started
    test = evaluate_model(model, splits["test"])
    return Candidate(
        key,
        MODEL_NAMES[key],
        seconds,
        evaluate_model(model, splits["validation"])["metrics"],
        test["metrics"],
        test["confusion_matrix"],
        test["roc_curve"],
        model if include_model else None,
    )


def _fit_together(
    estimators: dict, prepared: PipelineModel, splits: dict[str, DataFrame], include_models: bool
) -> dict[str, Candidate]:
    """Fit all candidates at once, each from a thread of its own that inherits the caller's job properties.

    A fit is a chain of jobs, most of them short: another candidate's jobs fill
    the executors while one waits for its driver. Results do not depend on it.
    """

    def fit(key: str) -> Candidate:
        return fit_candidate(key, estimators[key], prepared, splits, include_models)

    with ThreadPoolExecutor(max(1, len(estimators))) as pool:
        fits = {key: pool.submit(inheritable_thread_target(fit), key) for key in estimators}
        return {key: found.result() for key, found in fits.items()}


def labelled_features(raw: DataFrame) -> DataFrame:
    """Cleaned, keyed, labelled rows with features."""
    return with_txn_id(raw.transform(clean_transactions)).transform(add_label).transform(add_features)


def prepare_splits(
    ready: DataFrame,
    sample_fraction: float | None = None,
    seed: int = DEFAULT_SEED,
    stable: bool = True,
) -> dict[str, DataFrame]:
    """Store the rows once, split, sample and weight them.

    ``stable`` splits by key hash, which any later run rebuilds exactly, and
    stores one partition per split; otherwise a seeded random split is used.
    Weights come from the train split alone.
    """
    tagged = with_hash_split(ready) if stable else with_random_split(ready, seed)
    stored = materialize(tagged, "splits", partition_by="split")
    splits = {name: stored.filter(F.col("split") == name).drop("split") for name in SPLIT_FRACTIONS}
    if sample_fraction is not None:
        sampled = sample_splits(splits, sample_fraction, seed)
        splits = {name: materialize(part, f"sampled-{name}") for name, part in sampled.items()}
    return {**splits, "train": add_class_weights(splits["train"])}


def _dealt_evenly(train: DataFrame, rows: int) -> DataFrame:
    """The columns a fit reads, in equal partitions that fill every slot of the cluster in each wave.

    A fit passes over its rows once per level of every round, so all passes wait
    for the largest partition. The stored split has the partitions of the raw
    files, however these lie. Sorted, a partition is the same whenever it is
    rebuilt, which the draws of a seeded fit depend on.
    """
    slots = train.sparkSession.sparkContext.defaultParallelism
    waves = -(-rows // (slots * _MOST_ROWS))
    parts = max(1, min(slots * waves, rows // _LEAST_ROWS))
    return train.select(*_FIT_COLUMNS).repartition(parts).sortWithinPartitions(*_FIT_COLUMNS)


def train_candidates(
    raw: DataFrame,
    profile: str | dict = "full",
    include_models: bool = True,
    sample_fraction: float | None = None,
    seed: int = DEFAULT_SEED,
    stable: bool = True,
    data: str = "",
) -> TrainingRun:
    """Train and evaluate all candidates on ``raw``, which the run log calls ``data``.

    The raw data is scanned once: its summary is observed while the prepared
    rows are stored, and every later step reads the stored splits. The feature
    stages do not depend on the candidate and are fitted once.
    """
    estimators = candidate_estimators(profile, seed)
    enable_checkpoints(raw.sparkSession)
    summary = Observation()
    ready = labelled_features(standardize(raw).observe(summary, *summary_columns()))
    splits = prepare_splits(ready, sample_fraction, seed, stable)
    prepared = feature_pipeline().fit(splits["train"])
    rows = {name: part.count() for name, part in splits.items()}
    fitted_on = {**splits, "train": _dealt_evenly(splits["train"], rows["train"])}
    candidates = _fit_together(estimators, prepared, fitted_on, include_models)
    named = profile if isinstance(profile, str) else "custom"
    return TrainingRun(candidates, summary.get, named, sample_fraction, seed, data, rows)


def _rank(auc: float | None) -> float:
    """An undefined AUC ranks below every defined one, 0 included."""
    return float("-inf") if auc is None else auc


def select_best(run: TrainingRun) -> tuple[str, str]:
    """Keys of the best candidate by validation AUC and of the alternate.

    The earlier candidate wins a tie; an undefined AUC loses.
    """
    ordered = sorted(
        run.candidates.items(),
        key=lambda item: -_rank(item[1].validation["auc"]),
    )
    return ordered[0][0], ordered[1][0]


def comparison_table(spark: SparkSession, run: TrainingRun) -> DataFrame:
    """One row per candidate: its metrics on both splits and the training time."""
    parts = ("validation", "test")
    rows = [
        (c.key, c.name, *[getattr(c, part)[m] for part in parts for m in EVALUATION_METRICS], c.seconds)
        for c in run.candidates.values()
    ]
    columns = [f"{part}_{m} DOUBLE" for part in parts for m in EVALUATION_METRICS]
    schema = ["model_key STRING", "model_name STRING", *columns, "training_time_seconds DOUBLE"]
    return spark.createDataFrame(rows, ", ".join(schema))


def evaluate_saved(raw: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Metrics of stored models on the rebuilt test split; paths that do not exist are skipped.

    A model that is there but cannot be loaded is an error. ``is_best`` marks
    the highest AUC, the earlier model on a tie.
    """
    spark = raw.sparkSession
    test = materialize(hash_split(labelled_features(raw))["test"], "test-split")
    rows = []
    for name, path in paths.items():
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            log.warning("no model %s at %s", name, path)
            continue
        metrics = evaluate_model(PipelineModel.load(path), test)["metrics"]
        rows.append((name, *[metrics[m] for m in EVALUATION_METRICS]))
    best = max(rows, key=lambda row: _rank(row[-1]))[0] if rows else None
    schema = ", ".join(["model STRING", *[f"{m} DOUBLE" for m in EVALUATION_METRICS]])
    return spark.createDataFrame(rows, schema).withColumn("is_best", F.col("model") == F.lit(best))


def scaler_deviations(model: PipelineModel, inputs: Sequence[str] = MODEL_INPUTS) -> list[tuple[str, float]]:
    """The standard deviation the fitted scaler divides each input by."""
    return list(zip(inputs, (float(v) for v in model.stages[3].std)))
