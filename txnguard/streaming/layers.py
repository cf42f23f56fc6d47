"""Raw, cleaned and scored layers, written once per micro-batch and retry-safe."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnguard.operators.blacklist import AccountList, account_list
from txnguard.operators.clean import clean_transactions
from txnguard.operators.features import add_features, add_label, alert_json, gold_projection, stamp_partitions
from txnguard.operators.rules import counter_columns, score_rules
from txnguard.schema import DEFAULT_SCORING, ScoringConfig
from txnguard.session import materialize
from txnguard.sources.files import with_txn_id

log = logging.getLogger(__name__)

Scorer = Callable[[DataFrame], DataFrame]

BATCH_METRICS = (
    "raw_rows",
    "total_transactions",
    "dropped_rows",
    "total_fraud",
    "total_ml_alerts",
    "total_rule_alerts",
)


@dataclass(frozen=True)
class LayerConfig:
    """Where the layers go and how rows are scored.

    ``run_id`` names one stream (one checkpoint). Batch numbers restart with a
    new checkpoint, so a new checkpoint needs a new ``run_id``: (run_id,
    batch_id) then identifies a batch for good.
    """

    root: str
    run_id: str = "main"
    fmt: str = "parquet"
    blacklist: AccountList | DataFrame | list | None = None
    scoring: ScoringConfig = field(default=DEFAULT_SCORING)

    def path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"


def write_batch(df: DataFrame, config: LayerConfig, layer: str, batch_id: int) -> None:
    """Write one batch of a layer so that writing it again changes nothing.

    Files: the batch owns its partition directory and replaces it. Delta: the
    table remembers the last batch of each run and skips a repeated one.
    """
    stamped = df.withColumns({"run_id": F.lit(config.run_id), "batch_id": F.lit(batch_id).cast("bigint")})
    writer = stamped.write.format(config.fmt)
    if config.fmt == "delta":
        writer = writer.mode("append").options(txnAppId=f"{config.run_id}-{layer}", txnVersion=str(batch_id))
        writer.partitionBy("dt", "hour").save(config.path(layer))
        return
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt", "hour", "run_id", "batch_id").save(config.path(layer))


def process_batch(batch: DataFrame, batch_id: int, config: LayerConfig, scorer: Scorer) -> dict | None:
    """One micro-batch: raw, cleaned, scored and alert layers and a metrics row.

    The decoded batch is persisted once; counts ride on the writes, so there
    is no counting job. Rows must carry ``processed_at`` (see
    ``transaction_stream``), all of one hour, which is checked before anything
    is written. Returns the batch metrics, None for no rows.
    """
    rows = with_txn_id(stamp_partitions(batch)).persist()
    try:
        stamps = rows.select("dt", "hour").distinct().limit(2).collect()
        if not stamps:
            return None
        if len(stamps) > 1:
            raise ValueError(f"batch {batch_id} carries several processing hours; stamp a batch once")
        found = Observation()
        write_batch(rows.observe(found, F.count("*").alias("raw_rows")), config, "bronze", batch_id)
        seen = {**found.get, "dt": stamps[0].dt, "hour": stamps[0].hour}

        kept = Observation()
        silver = rows.transform(clean_transactions).transform(add_label).transform(add_features)
        write_batch(silver.observe(kept, F.count("*").alias("rows")), config, "silver", batch_id)
        counters = {name: 0 for name in BATCH_METRICS}
        if kept.get["rows"]:
            scored = score_rules(scorer(silver), config.blacklist, config.scoring)
            totals = Observation()
            aggregates = [value.alias(name) for name, value in counter_columns().items()]
            gold = gold_projection(scored, "txn_id").observe(totals, *aggregates)
            write_batch(gold, config, "gold", batch_id)
            counters.update(totals.get)
            _write_alerts(batch.sparkSession, config, batch_id, seen["dt"], seen["hour"])
        counters["raw_rows"] = seen["raw_rows"]
        counters["dropped_rows"] = seen["raw_rows"] - counters["total_transactions"]
        _write_metrics(rows, config, batch_id, counters)
        log.info("batch %s: %s", batch_id, counters)
        return counters
    finally:
        rows.unpersist()


def _write_alerts(spark: SparkSession, config: LayerConfig, batch_id: int, dt: str, hour: str) -> None:
    """The batch's alerts as JSON, from the scored rows just written.

    Reads only the batch's own partition, so rows are not scored again and the
    rest of the table is not listed.
    """
    keys = {"dt": dt, "hour": hour, "run_id": config.run_id, "batch_id": batch_id}
    gold = config.path("gold")
    if config.fmt == "delta":
        mine = spark.read.format("delta").load(gold)
        for name, value in keys.items():
            mine = mine.filter(F.col(name) == value)
    else:
        partition = "/".join([gold, *[f"{name}={value}" for name, value in keys.items()]])
        mine = spark.read.format(config.fmt).load(partition).withColumns({"dt": F.lit(dt), "hour": F.lit(hour)})
    write_batch(alert_json(mine, "txn_id", "step", "processed_at", "dt", "hour"), config, "alerts", batch_id)


def _write_metrics(rows: DataFrame, config: LayerConfig, batch_id: int, counters: dict) -> None:
    """One row of batch counters, in the same partition layout as the layers."""
    literals = [F.lit(counters[name]).cast("bigint").alias(name) for name in BATCH_METRICS]
    stamp = rows.select("processed_at", "dt", "hour").limit(1)
    write_batch(stamp.select(*literals, "processed_at", "dt", "hour"), config, "batch_metrics", batch_id)


def start_layers(
    stream: DataFrame,
    config: LayerConfig,
    scorer: Scorer,
    checkpoint: str,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Start the layered job; ``every=None`` drains what is there and stops.

    The account list is measured once, here, not in every batch.
    """
    measured = LayerConfig(
        config.root, config.run_id, config.fmt, account_list(config.blacklist), config.scoring
    )
    writer = stream.writeStream.foreachBatch(
        lambda batch, batch_id: process_batch(batch, batch_id, measured, scorer) and None
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


_STAMPS = {"dt": "string", "hour": "string", "run_id": "string", "batch_id": "bigint"}


def _landed(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A partitioned folder with text ``dt``, ``hour`` and ``run_id``: run ids 7 and 007 stay two runs."""
    inferred = spark.read.format(fmt).load(path).schema
    kinds = [f"`{f.name}` {_STAMPS.get(f.name, f.dataType.simpleString())}" for f in inferred.fields]
    return spark.read.format(fmt).schema(", ".join(kinds)).load(path)


_HOUR, _BATCH = "dt=*/hour=*", "dt=*/hour=*/run_id=*/batch_id=*"


def _folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Existing folders below ``path`` that match a pattern, as partition paths relative to it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    depth = pattern.count("/") + 1
    found = files.globStatus(hadoop(f"{path}/{pattern}"))
    return ["/".join(status.getPath().toString().split("/")[-depth:]) for status in found or ()]


def _values(folder: str) -> tuple[str, ...]:
    """The values in a partition path."""
    return tuple(unquote(part.split("=", 1)[1]) for part in folder.split("/"))


def read_layer(spark: SparkSession, config: LayerConfig, layer: str) -> DataFrame:
    """All rows of a layer: compacted hours, and landed batches that no compaction holds yet."""
    landing, hours = config.path(layer), f"{config.path(layer)}_hours"
    if config.fmt == "delta":
        return spark.read.format("delta").load(landing)
    if not _folders(spark, f"{hours}/rows", _HOUR):
        return _landed(spark, landing, config.fmt)
    kept = _landed(spark, f"{hours}/rows", config.fmt)
    if not _folders(spark, landing, _BATCH):
        return kept
    return _without_held(kept, _landed(spark, landing, config.fmt))


def _without_held(kept: DataFrame, landed: DataFrame) -> DataFrame:
    """Compacted rows, and landed rows of batches that they do not hold."""
    # The compacted rows themselves say which batches they hold; only hours that have landed again are asked.
    again = landed.select("dt", "hour").distinct()
    held = kept.select(*_STAMPS).join(again, ["dt", "hour"], "left_semi").distinct()
    fresh = landed.join(held, list(_STAMPS), "left_anti")
    return kept.unionByName(fresh.select(*kept.columns), allowMissingColumns=True)


def hours_of(spark: SparkSession, config: LayerConfig, layer: str) -> list[tuple[str, str]]:
    """Every ``(dt, hour)`` a layer has rows of, newest first, from folder names alone."""
    if config.fmt == "delta":
        raise ValueError("hours are listed from the folders of a file layer")
    landing = config.path(layer)
    folders = _folders(spark, landing, _BATCH) + _folders(spark, f"{landing}_hours/rows", _HOUR)
    return sorted({_values(folder)[:2] for folder in folders}, reverse=True)


def read_hours(spark: SparkSession, config: LayerConfig, layer: str, hours: list[tuple[str, str]]) -> DataFrame:
    """The rows of some hours of a layer; no other folder is listed or read."""
    landing, compacted = config.path(layer), f"{config.path(layer)}_hours/rows"

    def some(root: str, inside: str) -> DataFrame | None:
        paths = [f"{root}/dt={dt}/hour={hour}" for dt, hour in hours]
        there = [path for path in paths if _folders(spark, path, inside)]
        if not there:
            return None
        reader = spark.read.format(config.fmt).option("basePath", root)
        inferred = reader.load(there).schema
        kinds = [f"`{f.name}` {_STAMPS.get(f.name, f.dataType.simpleString())}" for f in inferred.fields]
        return reader.schema(", ".join(kinds)).load(there)

    kept, landed = some(compacted, "*"), some(landing, "run_id=*/batch_id=*")
    if kept is None or landed is None:
        return landed if kept is None else kept
    return _without_held(kept, landed)


_ROWS_PER_FILE = 1_000_000


def _dealt(stored: DataFrame, files: int, rows_per_file: int) -> DataFrame:
    """Stored rows, one partition per file to write: ``files`` per hour, or as many as its rows need."""
    # A row's place in the stored files deals out equal rows too, and a repeated task deals alike.
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    placed = stored.withColumn("_place", place)
    starts, first = [], 0
    for hour in stored.groupBy("dt", "hour").agg(F.count("*").alias("rows")).collect():
        parts = max(files, -(-hour.rows // rows_per_file))
        starts.append((hour.dt, hour.hour, first, parts))
        first += parts
    # One row per hour.
    parts = F.broadcast(stored.sparkSession.createDataFrame(starts, "_dt STRING, _hour STRING, _first INT, _parts INT"))
    found = placed.join(parts, F.col("dt").eqNullSafe(F.col("_dt")) & F.col("hour").eqNullSafe(F.col("_hour")))
    target = (F.col("_first") + F.pmod("_place", "_parts")).cast("int")
    return found.repartitionById(max(1, first), target).select(*stored.columns)


def compact_hours(
    spark: SparkSession,
    config: LayerConfig,
    layer: str,
    before: tuple[str, str],
    files: int = 1,
    rows_per_file: int = _ROWS_PER_FILE,
) -> int:
    """Turn the landed batches of hours before ``(dt, hour)`` into few files per hour; returns the hours.

    An hour gets ``files`` files, or more of about ``rows_per_file`` rows, so a
    task never holds an hour that has grown large.

    The batch folders that stand there at the start are noted. The rows of their
    hours, compacted before or landed since, are stored aside and then replace
    the hour, and only then do the noted folders go; a batch that lands
    meanwhile keeps its folder. Rows keep their batch, so rows that stand in
    both places are read once, and a run after any failure ends in the same
    state. A batch that lands late is taken in by the next run; readers see it
    meanwhile. Folders of hours stay, empty: a writer may be about to use them.

    File layers only: a Delta table has a compaction of its own (``OPTIMIZE``).
    """
    if config.fmt == "delta":
        raise ValueError("compact a Delta table with its own OPTIMIZE command")
    landing, hours = config.path(layer), f"{config.path(layer)}_hours"
    noted = [folder for folder in _folders(spark, landing, _BATCH) if _values(folder)[:2] < before]
    due = sorted({_values(folder)[:2] for folder in noted})
    if not due:
        return 0
    stored = materialize(read_hours(spark, config, layer, due), "hours")
    writer = _dealt(stored, files, rows_per_file).write.format(config.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt", "hour").save(f"{hours}/rows")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folders = hadoop(landing).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in noted:
        folders.delete(hadoop(f"{landing}/{folder}"), True)
    return len(due)
