"""Stored models, metrics of the deployed model, and the log of training runs."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from txnguard.plans.training import Candidate, TrainingRun, select_best
from txnguard.schema import SPLIT_FRACTIONS

ROLES = ("best", "alternate")


#: Whole versions that stay beside the newest, for readers that are still loading one.
KEPT_VERSIONS = 3
_READY = "_READY"


@dataclass(frozen=True)
class Deployment:
    """Which candidate stands in which role, and the folder of the version."""

    root: str
    keys: dict[str, str]


def model_path(version: str, role: str) -> str:
    return f"{version}/models/{role}"


def metrics_path(version: str) -> str:
    return f"{version}/model_metrics"


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """The folders of all whole versions below ``root``, newest first."""
    place, files = _files(spark, f"{root}/versions/*/{_READY}")
    found = files.globStatus(place) or ()
    return sorted((status.getPath().getParent().toString() for status in found), reverse=True)


def deployed(spark: SparkSession, root: str) -> str:
    """The folder of the version in use; raises if none was published."""
    found = versions(spark, root)
    if not found:
        raise LookupError(f"no model is deployed in {root}")
    return found[0]


def save_models(spark: SparkSession, run: TrainingRun, root: str) -> Deployment:
    """Publish the two best candidates and the metrics of the best one as a new version below ``root``.

    A version is a folder that is written in full before its marker file, which
    is created in one step. Readers take the newest folder with a marker, so
    during publishing and after a failed one they get the version before,
    whole. Older versions stay for readers in between and then go.
    """
    keys = dict(zip(ROLES, select_best(run)))
    chosen = {role: run.candidates[key] for role, key in keys.items()}
    if any(candidate.model is None for candidate in chosen.values()):
        raise ValueError("this run kept no models; train with include_models=True")
    version = f"{root}/versions/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for role, candidate in chosen.items():
        candidate.model.write().save(model_path(version, role))
    store_metrics(spark, chosen["best"], metrics_path(version))
    marker, files = _files(spark, f"{version}/{_READY}")
    files.create(marker, False).close()
    for old in versions(spark, root)[KEPT_VERSIONS:]:
        place, files = _files(spark, old)
        # The marker goes first, so that nobody starts to read what is being removed.
        files.delete(_files(spark, f"{old}/{_READY}")[0], False)
        files.delete(place, True)
    return Deployment(version, keys)


def load_model(root: str, role: str = "best") -> PipelineModel:
    """A model of the version in use."""
    return PipelineModel.load(model_path(deployed(SparkSession.active(), root), role))


def metric_rows(candidate: Candidate) -> list[tuple[str, float]]:
    """Test metrics, prefixed validation metrics and training time, 6 decimals."""
    named = {**candidate.test, **{f"validation_{name}": value for name, value in candidate.validation.items()}}
    named["training_time_seconds"] = candidate.seconds
    return [(name, round(float(value), 6)) for name, value in named.items() if value is not None]


def store_metrics(spark: SparkSession, candidate: Candidate, path: str, fmt: str = "parquet") -> None:
    """Replace the metrics of the deployed model (a dozen rows)."""
    rows = spark.createDataFrame(metric_rows(candidate), "metric STRING, value DOUBLE")
    rows.write.format(fmt).mode("overwrite").save(path)


_RUN_FIELDS = (
    "model_key STRING, split STRING, metric STRING, value DOUBLE, data STRING, profile STRING, sample_fraction DOUBLE, "
    "seed BIGINT, train_share DOUBLE, validation_share DOUBLE, test_share DOUBLE, split_rows BIGINT, run_id STRING"
)


def log_runs(spark: SparkSession, run: TrainingRun, run_id: str, path: str, fmt: str = "parquet") -> None:
    """Log one row per candidate, split and metric, with all parameters of the run.

    A run owns its rows: logging it again, as a retry does, replaces them.
    """
    fraction = 1.0 if run.sample_fraction is None else float(run.sample_fraction)
    shares = [float(SPLIT_FRACTIONS[name]) for name in ("train", "validation", "test")]
    rows = [
        (candidate.key, split, metric, value, run.data, run.profile, fraction, run.seed, *shares, run.split_rows[split], run_id)
        for candidate in run.candidates.values()
        for split, found in (("validation", candidate.validation), ("test", candidate.test))
        for metric, value in found.items()
    ]
    logged = spark.createDataFrame(rows, _RUN_FIELDS)
    if fmt == "delta":
        writer = logged.write.format(fmt).mode("overwrite").option("replaceWhere", f"run_id = '{run_id}'")
        writer.save(path)
        return
    writer = logged.coalesce(1).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").save(path)


def runs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The log; run ids stay text."""
    if fmt == "delta":
        return spark.read.format(fmt).load(path)
    columns = [field.split()[0] for field in _RUN_FIELDS.split(", ")]
    return spark.read.format(fmt).schema(_RUN_FIELDS).load(path).select("run_id", *columns[:-1])
