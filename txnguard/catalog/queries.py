"""The registered queries: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.catalog.adapter import (
    LISTED,
    event_stream,
    joined_list,
    key_scorer,
    raw_transactions,
    table,
)
from txnguard.functions.columns import positive_class
from txnguard.operators import blacklist, clean, features, metrics, profile, rules, running, sampling, sketches
from txnguard.plans import registry, serving, training
from txnguard.plans.scoring import model_scorer, score_transactions
from txnguard.schema import (
    ALERT_COLUMNS,
    ENGINEERED_COLUMNS,
    EVALUATION_METRICS,
    GOLD_COLUMNS,
    RULE_FLAGS,
    SPLIT_FRACTIONS,
    TRANSACTION_COLUMNS,
)
from txnguard.session import materialize, scratch_path
from txnguard.sources import events, replay
from txnguard.sources.files import read_blacklist, read_csv
from txnguard.streaming import alert_sink, counters, dedup, late, layers, reports
from txnguard.streaming.alerts import alert_stream, start_append

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_PROFILE = "interactive"
_TIMELESS_GOLD = tuple(c for c in GOLD_COLUMNS if c not in ("processed_at", "dt", "hour"))
_EVENT_FIELDS = events.event_schema(("txn_id", T.LongType()))


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- shared inputs -----------------------------------------------------------


def _clean(spark, sf):
    return raw_transactions(spark, sf).transform(clean.clean_transactions)


def _prepared(spark, sf):
    return raw_transactions(spark, sf).transform(features.prepare_features)


def _scored(spark, sf):
    return score_transactions(raw_transactions(spark, sf), key_scorer(), LISTED)


def _labelled(spark, sf):
    """Prepared rows with the stand-in model's score and prediction."""
    return key_scorer()(_prepared(spark, sf))


# --- cleaning ----------------------------------------------------------------


@query
def clean_transactions(spark, sf):
    return _clean(spark, sf)


@query
def csv_clean_transactions(spark, sf):
    """The same rows after a trip through text files with a header."""
    path = scratch_path(spark, "csv")
    raw = raw_transactions(spark, sf).select(*TRANSACTION_COLUMNS)
    # Quote everything and keep outer blanks, so that faults survive the trip.
    raw.write.option("header", True).option("quoteAll", True).option("nullValue", "").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return clean.clean_transactions(read_csv(spark, path))


@query
def csv_extra_columns(spark, sf):
    """Text files with the columns in another order and two more among them."""
    path = scratch_path(spark, "csv")
    raw = raw_transactions(spark, sf).withColumns({"note": F.lit("x"), "source": F.lit("file")})
    order = ["note", *reversed(TRANSACTION_COLUMNS), "source"]
    raw.select(*order).write.option("header", True).option("quoteAll", True).option("nullValue", "").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return clean.clean_transactions(read_csv(spark, path)).drop("note")


@query
def drop_reasons(spark, sf):
    return clean.drop_reasons(raw_transactions(spark, sf))


@query
def clean_reconciliation(spark, sf):
    return clean.cleaning_counts(raw_transactions(spark, sf))


@query
def dataset_summary(spark, sf):
    return profile.dataset_summary(raw_transactions(spark, sf))


# --- features ----------------------------------------------------------------


@query
def engineered_features(spark, sf):
    return features.add_features(_clean(spark, sf)).select("txn_id", *ENGINEERED_COLUMNS)


@query
def labelled_transactions(spark, sf):
    return features.add_label(_clean(spark, sf)).select("txn_id", "isFraud", "label")


@query
def prepared_features(spark, sf):
    return _prepared(spark, sf)


# --- profiles ----------------------------------------------------------------


@query
def row_count(spark, sf):
    return profile.row_count(raw_transactions(spark, sf))


@query
def null_counts(spark, sf):
    return profile.null_counts(raw_transactions(spark, sf))


@query
def blank_counts(spark, sf):
    return profile.blank_counts(raw_transactions(spark, sf))


@query
def fraud_rate(spark, sf):
    return profile.fraud_rate(raw_transactions(spark, sf))


@query
def counts_by_type(spark, sf):
    return profile.counts_by_type(raw_transactions(spark, sf))


@query
def fraud_by_type(spark, sf):
    return profile.fraud_by_type(raw_transactions(spark, sf))


@query
def amount_quantiles_exact(spark, sf):
    return profile.amount_quantiles(raw_transactions(spark, sf))


@query
def amount_quantiles_approx(spark, sf):
    """How far, in ranks, each approximate quantile lies from its level."""
    amounts = raw_transactions(spark, sf).filter("amount IS NOT NULL").select("amount")
    found, levels = profile.amount_quantiles_approx(amounts).first(), profile.AMOUNT_LEVELS
    counts = [F.count_if(F.col("amount") < found[n]).alias(f"below_{n}") for n in levels]
    counts += [F.count_if(F.col("amount") <= found[n]).alias(f"upto_{n}") for n in levels]
    ranked = amounts.agg(F.count("*").alias("rows"), *counts)
    fits = [
        F.struct(
            F.lit(n).alias("level"),
            ((F.col(f"upto_{n}") >= (q - 0.01) * F.col("rows")) & (F.col(f"below_{n}") <= (q + 0.01) * F.col("rows"))).alias(
                "within_error"
            ),
        )
        for n, q in levels.items()
    ]
    return ranked.select(F.inline(F.array(*fits)))


@query
def class_distribution(spark, sf):
    return profile.class_distribution(_prepared(spark, sf))


@query
def replay_fraud_share(spark, sf):
    return running.running_fraud_share(raw_transactions(spark, sf), "txn_id", every=500)


@query
def amount_quantiles_sketched(spark, sf):
    """Quantiles of any range of days from stored sketches per day: whether each is within 0.01 ranks."""
    path = scratch_path(spark, "sketches")
    sent = raw_transactions(spark, sf, timed=True).withColumn("day", F.to_date("sent_at"))
    sketches.quantile_sketches(sent, "amount", ["day"]).write.parquet(path)
    stored = spark.read.parquet(path)
    out = []
    for name, first, last in (("all", "1900-01-01", "2100-01-01"), ("year", "1995-01-01", "1995-12-31")):
        inside = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        found = sketches.merged_quantiles(stored.filter(inside), profile.AMOUNT_LEVELS).first()
        amounts = sent.filter(inside & F.col("amount").isNotNull())
        counts = [F.count_if(F.col("amount") < found[n]).alias(f"below_{n}") for n in profile.AMOUNT_LEVELS]
        counts += [F.count_if(F.col("amount") <= found[n]).alias(f"upto_{n}") for n in profile.AMOUNT_LEVELS]
        ranked = amounts.agg(F.count("*").alias("rows"), *counts)
        fits = [
            (F.col(f"upto_{n}") >= (q - 0.01) * F.col("rows")) & (F.col(f"below_{n}") <= (q + 0.01) * F.col("rows"))
            for n, q in profile.AMOUNT_LEVELS.items()
        ]
        out.append(ranked.select(F.lit(name).alias("days"), F.col("rows").alias("row_count"), reduce(and_, fits).alias("within_error")))
    return out[0].unionByName(out[1])


@query
def table_file_check(spark, sf):
    required = ("o_orderkey", "o_custkey", "o_comment_text")
    found = profile.file_check(table(spark, sf, "orders"), f"{sf}/orders.parquet", required)
    return found.select((F.col("file_count") > 0).alias("has_files"), "empty_files", "row_count", "missing_columns")


@query
def replay_share_text_key(spark, sf):
    """The same share in the order of a key that is text."""
    keyed = raw_transactions(spark, sf).withColumn("key", F.md5(F.col("txn_id").cast("string")))
    return running.running_fraud_share(keyed, "key", every=500)


# --- account lists -----------------------------------------------------------


@query
def blacklist_accounts(spark, sf):
    """A list file with comments, blanks, padding and repeats, plus inline names."""
    path = scratch_path(spark, "blacklist")
    number = F.col("c_custkey").cast("string")
    lines = F.array(
        F.concat(F.lit("# customer "), number),
        F.lit(""),
        F.concat(F.lit("  c"), number, F.lit(" ")),
        F.concat(F.lit("C"), number),
    )
    debtors = table(spark, sf, "customer").filter("c_acctbal < 0")
    debtors.select(F.explode(lines).alias("value")).write.text(path)
    return read_blacklist(spark, path, ",".join(LISTED)).orderBy("account")


@query
def blacklist_profile(spark, sf):
    return profile.blacklist_profile(raw_transactions(spark, sf), LISTED)


@query
def blacklist_join_flags(spark, sf):
    """The join form, on the sender, against a list that grows with the data."""
    flagged = blacklist.flag_listed(_clean(spark, sf), joined_list(spark, sf), "is_listed", "nameOrig")
    return flagged.select("txn_id", "nameOrig", "is_listed")


@query
def blacklist_semi(spark, sf):
    rows = blacklist.only_listed(_clean(spark, sf), joined_list(spark, sf), "nameOrig")
    return rows.select("txn_id", "nameOrig", "amount")


@query
def blacklist_anti(spark, sf):
    rows = blacklist.only_unlisted(_clean(spark, sf), joined_list(spark, sf), "nameOrig")
    return rows.select("txn_id", "nameOrig", "amount")


@query
def blacklist_forms(spark, sf):
    """One list as names, as rows and as a join side, with blanks, repeats and gaps: three equal flags."""
    names = ["C7", " c31\t", None, "", "  ", "C7"]
    rows = spark.createDataFrame([(name,) for name in names], "account STRING")
    found = _clean(spark, sf)
    forms = {"by_name": names, "by_rows": rows, "by_join": blacklist.account_list(rows, max_literals=0)}
    for output, form in forms.items():
        found = blacklist.flag_listed(found, form, output)
    return found.select("txn_id", *forms)


# --- rules and scores --------------------------------------------------------


@query
def rule_flags(spark, sf):
    ready = key_scorer()(features.add_features(_clean(spark, sf)))
    return rules.add_rule_flags(ready, LISTED).select("txn_id", *RULE_FLAGS)


@query
def hybrid_scores(spark, sf):
    return _scored(spark, sf).select(
        "txn_id", "fraud_probability", "rule_score", "hybrid_score", "is_alert", "alert_source"
    )


@query
def gold_table(spark, sf):
    return _scored(spark, sf).select("txn_id", *_TIMELESS_GOLD)


@query
def alert_payload(spark, sf):
    return features.alert_rows(_scored(spark, sf), "txn_id")


@query
def alert_counters(spark, sf):
    return rules.alert_counters(_scored(spark, sf))


@query
def alerts_by_source(spark, sf):
    return rules.alerts_by_source(_scored(spark, sf))


@query
def kpis(spark, sf):
    return serving.kpis(_scored(spark, sf))


@query
def recent_alerts_top50(spark, sf):
    alerts = features.alert_rows(_scored(spark, sf), "txn_id")
    return serving.recent_alerts(alerts, 50, "step", "txn_id")


@query
def alert_json_skip_bad(spark, sf):
    """An alert feed in which every 11th message is cut off."""
    feed = features.alert_json(_scored(spark, sf), "txn_id")
    cut = F.when(F.col("txn_id") % 11 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    return serving.parse_alerts(feed.withColumn("value", cut), "txn_id")


@query
def alert_json_off_type(spark, sf):
    """Alerts with a number as text or a whole number with a point are kept."""
    feed = features.alert_json(_scored(spark, sf), "txn_id")
    pointed = F.regexp_replace("value", r'"step":(\d+)', r'"step":$1.0')
    quoted = F.regexp_replace("value", r'"amount":([^,]+),', r'"amount":"$1",')
    changed = F.when(F.col("txn_id") % 3 == 0, pointed).when(F.col("txn_id") % 3 == 1, quoted).otherwise(F.col("value"))
    return serving.parse_alerts(feed.withColumn("value", changed), "txn_id")


@query
def gold_table_full(spark, sf):
    """All columns of the scored table, stamped with the time the transactions carry."""
    raw = raw_transactions(spark, sf, timed=True)
    scored = score_transactions(raw, key_scorer(), LISTED).withColumnRenamed("sent_at", "processed_at")
    return features.gold_projection(features.stamp_partitions(scored), "txn_id")


# --- events ------------------------------------------------------------------


@query
def json_roundtrip(spark, sf):
    """With outer white space of every kind on the way in."""
    raw = raw_transactions(spark, sf)
    tabbed = {c: F.concat(F.lit("\t"), c, F.lit("\n ")) for c in ("type", "nameOrig", "nameDest")}
    encoded = events.encode_events(raw.withColumns(tabbed), "txn_id")
    return events.decode_events(encoded, _EVENT_FIELDS)


@query
def json_decode_events(spark, sf):
    """A JSON text column of the given tables, decoded with a fixed schema."""
    parsed = F.from_json("props", "k INT")
    return table(spark, sf, "events").select("event_id", parsed.k.alias("k"))


@query
def replay_limit(spark, sf):
    return sampling.first_rows(raw_transactions(spark, sf), 1000, ["txn_id"])


# --- splits, samples, weights ------------------------------------------------


@query
def hash_split_counts(spark, sf):
    split = sampling.with_hash_split(_prepared(spark, sf))
    return split.groupBy("split").agg(
        F.count("*").alias("row_count"), F.sum("label").cast("bigint").alias("fraud_count")
    )


@query
def random_split(spark, sf):
    """Rows of all splits, and whether each is as large as chance allows: six standard deviations."""
    split = sampling.with_random_split(_prepared(spark, sf)).groupBy("split").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    share = F.create_map(*[F.lit(x) for pair in SPLIT_FRACTIONS.items() for x in pair])[F.col("split")]
    near = F.abs(F.col("n") - share * total) <= 6 * F.sqrt(total * share * (1 - share))
    return split.select("split", total.alias("total_rows"), near.alias("near_share"))


@query
def stratified_sample(spark, sf):
    drawn = sampling.stratified_sample(_prepared(spark, sf), 0.2)
    return drawn.groupBy("label").agg(F.count("*").alias("row_count"))


@query
def class_weights(spark, sf):
    found = sampling.class_weights(_prepared(spark, sf))
    weights = [F.round(c, 9).alias(c) for c in ("weight_fraud", "weight_non_fraud")]
    return found.select("total", "fraud_count", "non_fraud_count", *weights)


@query
def bounded_stratified_sample(spark, sf):
    scores = _labelled(spark, sf).select("txn_id", "fraud_probability", "label")
    return sampling.bounded_sample(scores, 300)


# --- models and metrics ------------------------------------------------------


@query
def type_index(spark, sf):
    return profile.type_ranks(_clean(spark, sf))


@query
def fitted_type_index(spark, sf):
    """The index the fitted pipeline assigns, beside each type it saw."""
    rows = _prepared(spark, sf)
    fitted = training.feature_stages()[1].fit(rows)
    return fitted.transform(rows).groupBy("type", "type_index").agg(F.count("*").alias("row_count"))


@query
def scaled_feature_std(spark, sf):
    model = training.feature_pipeline().fit(_prepared(spark, sf))
    rows = [(name, round(value, 4)) for name, value in training.scaler_deviations(model)]
    return spark.createDataFrame(rows, "feature STRING, std DOUBLE")


@query
def scaled_features(spark, sf):
    """The scaled vector, unpacked: each input over its sample deviation."""
    rows = _prepared(spark, sf)
    vector = vector_to_array("features")
    scaled = training.feature_pipeline().fit(rows).transform(rows)
    return scaled.select(
        "txn_id",
        F.round(F.get(vector, F.lit(0)), 6).alias("amount_scaled"),
        F.round(F.get(vector, F.lit(7)), 6).alias("amount_ratio_scaled"),
        F.round(F.get(vector, F.lit(10)), 6).alias("type_index_scaled"),
    )


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_labelled(spark, sf))


@query
def classification_metrics(spark, sf):
    found = metrics.classification_metrics(_labelled(spark, sf))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query
def auc(spark, sf):
    return metrics.auc(_labelled(spark, sf)).select(F.round("auc", 9).alias("auc"))


@query
def roc_curve(spark, sf):
    return metrics.roc_curve(_labelled(spark, sf)).select(
        "point", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr")
    )


@query
def best_model(spark, sf):
    """Two stand-in models compared by AUC on the validation split."""
    validation = sampling.hash_split(_prepared(spark, sf))["validation"]
    found = []
    for position, (name, factor) in enumerate({"alpha": 37, "beta": 91}.items()):
        area = metrics.auc(key_scorer(factor)(validation)).select(F.round("auc", 9).alias("validation_auc"))
        found.append(area.select(F.lit(name).alias("model_key"), F.lit(position).alias("position"), "validation_auc"))
    return metrics.best_models(found[0].unionByName(found[1]))


def _in_range(names):
    """Every metric lies between 0 and 1."""
    return reduce(and_, [F.col(name).between(0.0, 1.0) for name in names])


def _compared(spark, sf, profile_name):
    run = training.train_candidates(raw_transactions(spark, sf), profile_name, include_models=False)
    names = [f"{part}_{m}" for part in ("validation", "test") for m in EVALUATION_METRICS]
    rows = [F.lit(run.split_rows[name]).cast("bigint").alias(f"{name}_rows") for name in SPLIT_FRACTIONS]
    table = training.comparison_table(spark, run)
    return table.select("model_key", "model_name", F.lit(run.profile).alias("profile"), *rows, _in_range(names).alias("in_range"))


@query
def train_compare(spark, sf):
    return _compared(spark, sf, _PROFILE)


@query
def train_full(spark, sf):
    """The largest profile: 80 trees of depth 10, 30 rounds of depth 8."""
    return _compared(spark, sf, "full")


@query
def saved_model_eval(spark, sf):
    """Stored models on the rebuilt test split, against the same models when they were trained."""
    root = scratch_path(spark, "models")
    raw = raw_transactions(spark, sf)
    run = training.train_candidates(raw, _PROFILE)
    placed = registry.save_models(spark, run, root)
    paths = {role: registry.model_path(placed.root, role) for role in (*registry.ROLES, "absent")}
    found = training.evaluate_saved(raw, paths)
    trained = spark.createDataFrame(
        [(role, run.candidates[key].test["auc"]) for role, key in placed.keys.items()], "role STRING, trained DOUBLE"
    )
    same = F.abs(F.col("auc") - F.col("trained")) < 1e-12
    return found.join(trained, found.model == trained.role).select(
        "model", same.alias("same_as_trained"), _in_range(EVALUATION_METRICS).alias("in_range")
    )


@query
def training_runs(spark, sf):
    """The log of a run: its parameters beside every metric."""
    path = scratch_path(spark, "runs")
    run = training.train_candidates(raw_transactions(spark, sf), _PROFILE, include_models=False, data="orders")
    registry.log_runs(spark, run, "run-1", path)
    return registry.runs(spark, path).withColumn("in_range", F.col("value").between(0.0, 1.0)).drop("value")


def _by_mllib(predictions):
    """The five metrics of stored predictions by MLlib's own evaluators."""
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    several = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    found = {name: several.setMetricName(metric).evaluate(predictions) for name, metric in names.items()}
    ranked = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    return found | {"auc": ranked.evaluate(predictions)}


@query
def deployed_metrics(spark, sf):
    """The served metrics of the deployed model, and how far they are from its stored predictions' metrics."""
    root = scratch_path(spark, "models")
    raw = raw_transactions(spark, sf)
    registry.save_models(spark, training.train_candidates(raw, _PROFILE), root)
    served = serving.model_metrics(spark, registry.metrics_path(registry.deployed(spark, root)))
    scored = registry.load_model(root).transform(sampling.with_hash_split(training.labelled_features(raw)))
    columns = [F.col("label").cast("double").alias("label"), "prediction", positive_class("rawPrediction").alias("score")]
    stored = materialize(scored.select("split", *columns), "predictions", partition_by="split")
    again = {"training_time_seconds": served["training_time_seconds"]}
    for split, prefix in (("test", ""), ("validation", "validation_")):
        again |= {f"{prefix}{name}": value for name, value in _by_mllib(stored.filter(F.col("split") == split)).items()}
    rows = [(name, value, round(abs(value - again[name]), 5)) for name, value in served.items()]
    found = spark.createDataFrame(rows, "metric STRING, value DOUBLE, difference DOUBLE")
    fits = F.when(F.col("metric") == "training_time_seconds", F.col("value") > 0).otherwise(F.col("value").between(0.0, 1.0))
    return found.select("metric", fits.alias("in_range"), "difference")


@query
def train_notebook(spark, sf):
    """The middle profile: 40 trees of depth 8, 15 rounds of depth 6."""
    return _compared(spark, sf, "notebook")


@query
def model_scored_kpis(spark, sf):
    """KPIs of a batch scored by a fitted model instead of the stand-in: what does not depend on the model."""
    raw = raw_transactions(spark, sf)
    ready = sampling.add_class_weights(training.labelled_features(raw))
    estimator = training.candidate_estimators(_PROFILE)["rf"]
    model = training.fit_detached(estimator, training.feature_pipeline().fit(ready), ready)
    found = serving.kpis(score_transactions(raw, model_scorer(model), LISTED))
    bounded = F.col("total_ml_alerts").between(0, F.col("total_transactions"))
    return found.select("total_transactions", "total_rule_alerts", bounded.alias("ml_alerts_bounded"))


# --- streams -----------------------------------------------------------------


_ROWS_PER_FILE = 100_000
_TRIGGERS = 3


def _replayed(spark, sf, root, pruned=False):
    """The transactions as an event stream of several micro-batches at any size."""
    sent = raw_transactions(spark, sf)
    files = events.write_replay(
        sent, f"{root}/events", "txn_id", rows_per_file=_ROWS_PER_FILE, least_files=4 * _TRIGGERS
    )
    raw = events.read_event_stream(spark, "text", f"{root}/events", maxFilesPerTrigger=str(-(-files // _TRIGGERS)))
    return events.transaction_stream(raw, _EVENT_FIELDS, pruned=pruned)


def _layers(spark, sf, name, run_id="007"):
    root = scratch_path(spark, name)
    config = layers.LayerConfig(f"{root}/layers", run_id=run_id, blacklist=LISTED)
    stream = _replayed(spark, sf, root)
    layers.start_layers(stream, config, key_scorer(), f"{root}/checkpoint", every=None).awaitTermination()
    return config


@query
def stream_bronze(spark, sf):
    config = _layers(spark, sf, "stream-bronze")
    return layers.read_layer(spark, config, "bronze").select(*TRANSACTION_COLUMNS, "txn_id", "run_id")


@query
def stream_gold(spark, sf):
    config = _layers(spark, sf, "stream-gold")
    return layers.read_layer(spark, config, "gold").select("txn_id", *_TIMELESS_GOLD)


@query
def compacted_gold(spark, sf):
    """The scored layer after its hours were compacted, half of it twice."""
    config = _layers(spark, sf, "compacted-gold")
    layers.compact_hours(spark, config, "gold", ("9999", ""))
    layers.compact_hours(spark, config, "gold", ("9999", ""))
    return layers.read_layer(spark, config, "gold").select("txn_id", "run_id", *_TIMELESS_GOLD)


@query
def stream_silver(spark, sf):
    config = _layers(spark, sf, "stream-silver")
    return layers.read_layer(spark, config, "silver").drop(
        "event_time", "processed_at", "dt", "hour", "run_id", "batch_id"
    )


@query
def stream_batch_kpis(spark, sf):
    """KPIs summed from the per-batch counters the layered job stores, and the batches' rows."""
    config = _layers(spark, sf, "stream-kpis")
    stored = layers.read_layer(spark, config, "batch_metrics")
    sums = [F.sum(c).alias(c) for c in ("raw_rows", "dropped_rows")]
    return serving.kpis_from_batches(stored, *sums, (F.count("*") > 1).alias("several_batches"))


@query
def stream_alerts(spark, sf):
    root = scratch_path(spark, "stream-alerts")
    scored = score_transactions(_replayed(spark, sf, root), key_scorer(), LISTED)
    feed = alert_stream(scored, "txn_id")
    start_append(feed, f"{root}/alerts", f"{root}/checkpoint").awaitTermination()
    return serving.parse_alerts(spark.read.parquet(f"{root}/alerts"), "txn_id").select(*ALERT_COLUMNS, "txn_id")


@query
def stream_kpi_counters(spark, sf):
    root = scratch_path(spark, "stream-counters")
    scored = score_transactions(_replayed(spark, sf, root), key_scorer(), LISTED)
    totals = counters.running_counters(scored)
    counters.start_snapshots(totals, f"{root}/totals", f"{root}/checkpoint").awaitTermination()
    return counters.latest_snapshot(spark, f"{root}/totals")


@query
def stream_fraud_share(spark, sf):
    root = scratch_path(spark, "stream-share")
    share = counters.running_fraud_counts(_replayed(spark, sf, root, pruned=True))
    counters.start_snapshots(share, f"{root}/share", f"{root}/checkpoint").awaitTermination()
    return counters.latest_snapshot(spark, f"{root}/share")


@query
def stream_window_kpis(spark, sf):
    root = scratch_path(spark, "stream-windows")
    measures = {"event_count": F.count("*"), "total_value": F.round(F.sum("value"), 2)}
    windows = counters.windowed(event_stream(spark, sf), "ts", ["event_type"], measures)
    start_append(windows, f"{root}/windows", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/windows")


@query
def stream_window_counters(spark, sf):
    """KPI counters per day and type, by the time the transactions carry."""
    root = scratch_path(spark, "stream-days")
    sent = raw_transactions(spark, sf, timed=True)
    total = replay.write_replay_table(sent, f"{root}/sent", "txn_id", "sent_at", order_by="sent_at")
    fields = events.event_schema(("txn_id", T.LongType()), ("sent_at", T.TimestampType()))
    raw = replay.read_replay(spark, f"{root}/sent", max(1.0, total / _TRIGGERS), time.time())
    stream = events.transaction_stream(raw, fields, event_time="sent_at")
    daily = counters.windowed_counters(score_transactions(stream, key_scorer(), LISTED), width="1 day")
    running = start_append(daily, f"{root}/days", f"{root}/checkpoint", every="1 second")
    replay.stop_after(running, total, drain=True)
    return spark.read.parquet(f"{root}/days")


@query
def stream_dedup(spark, sf):
    """Every event sent twice, kept once."""
    root = scratch_path(spark, "stream-dedup")
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf))
    once = dedup.drop_repeats(twice, ["event_id"], "ts")
    start_append(once, f"{root}/once", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/once").select("event_id", "user_id", "event_type", "value")


@query
def paced_replay_gold(spark, sf):
    """The scored layer of a replay at a bounded rate, stopped on the way and continued from its checkpoint."""
    root = scratch_path(spark, "paced-replay")
    total = replay.write_replay_table(raw_transactions(spark, sf), f"{root}/sent", "txn_id", rows_per_file=10_000)
    config = layers.LayerConfig(f"{root}/layers", run_id="paced", blacklist=LISTED)
    started = time.time()
    for goal in (total // 3, total):
        raw = replay.read_replay(spark, f"{root}/sent", max(1.0, total / 4), started, rowsPerPartition="5000")
        stream = events.transaction_stream(raw, _EVENT_FIELDS)
        running = layers.start_layers(stream, config, key_scorer(), f"{root}/checkpoint", every="0 seconds")
        replay.stop_after(running, goal)
    return layers.read_layer(spark, config, "gold").select("txn_id", *_TIMELESS_GOLD)


@query
def alert_sink_feed(spark, sf):
    """Alerts through the committing sink, run again after it was done."""
    root = scratch_path(spark, "alert-sink")
    scored = score_transactions(_replayed(spark, sf, root), key_scorer(), LISTED)
    for _ in range(2):
        feed = alert_stream(scored, "txn_id")
        alert_sink.start_alert_sink(feed, f"{root}/alerts", "main", f"{root}/checkpoint").awaitTermination()
    return serving.parse_alerts(alert_sink.stored_alerts(spark, f"{root}/alerts"), "txn_id").select(*ALERT_COLUMNS, "txn_id")


@query
def newest_alerts(spark, sf):
    """The 50 newest alerts of a feed of many hours, from its newest hours alone."""
    config = layers.LayerConfig(scratch_path(spark, "newest-alerts"), run_id="sent")
    month = F.date_trunc("MONTH", "sent_at") + F.make_dt_interval(hours=F.col("txn_id") % 3)
    scored = score_transactions(raw_transactions(spark, sf, timed=True), key_scorer(), LISTED)
    timed = features.stamp_partitions(scored.withColumn("processed_at", month))
    feed = features.alert_json(timed, "txn_id", "step", "processed_at", "dt", "hour")
    layers.write_batch(feed.repartition("dt", "hour"), config, "alerts", 0)
    newest = serving.newest_alerts(spark, config, 50, "processed_at", "step", "txn_id")
    return serving.parse_alerts(newest, "txn_id", "processed_at").select(*ALERT_COLUMNS, "txn_id", "processed_at")


@query
def stream_dedup_hot(spark, sf):
    """Every event sent twice over several triggers, a third of all under one key: one row per key."""
    root = scratch_path(spark, "stream-dedup-hot")
    sent = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("event_id")).alias("key"), F.col("ts").cast("timestamp").alias("ts"), "value"
    )
    for _ in range(2):
        sent.repartition(4, "value").write.mode("append").parquet(f"{root}/sent")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 3).parquet(f"{root}/sent")
    running = dedup.start_once_per_key(stream, ["key"], "ts", f"{root}/once", f"{root}/checkpoint", delay="3650 days")
    running.awaitTermination()
    kept = dedup.kept_rows(spark, f"{root}/once", "key BIGINT, ts TIMESTAMP, value DOUBLE, batch_id BIGINT")
    return kept.groupBy("key").agg(F.count("*").alias("copies"), (F.max("batch_id") < 3).alias("by_trigger"))


@query
def stream_state_counters(spark, sf):
    """The running KPI counters, read from the state of the stream instead of a table it writes."""
    root = scratch_path(spark, "stream-state")
    totals = counters.running_counters(score_transactions(_replayed(spark, sf, root), key_scorer(), LISTED))
    counters.start_snapshots(totals, f"{root}/totals", f"{root}/checkpoint").awaitTermination()
    return counters.counters_in_state(spark, f"{root}/checkpoint")


@query
def stream_late_rows(spark, sf):
    """Events in no order of time: rows in their windows and late rows together are what was sent."""
    root = scratch_path(spark, "stream-late")
    sent = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    sent.repartition(6, "event_id").write.parquet(f"{root}/sent")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/sent")
    late.start_late_split(stream, "ts", f"{root}/split", f"{root}/checkpoint", delay="1 day").awaitTermination()
    stored = late.split_rows(spark, f"{root}/split", "event_id BIGINT, ts TIMESTAMP, event_type STRING")
    in_time = stored.filter("late = 0").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    parts = in_time.select("n", F.lit(0).alias("late")).unionByName(
        stored.filter("late = 1").agg(F.count("*").alias("n")).withColumn("late", F.lit(1))
    )
    return parts.agg(
        F.sum("n").alias("accounted"),
        (F.sum(F.when(F.col("late") == 1, F.col("n"))) > 0).alias("some_late"),
        (F.sum(F.when(F.col("late") == 0, F.col("n"))) > 0).alias("some_in_time"),
    )


@query
def stream_trigger_report(spark, sf):
    """What the listener stored of a layered run and of a second run that found nothing."""
    root = scratch_path(spark, "stream-report")
    listener = reports.report_triggers(spark, f"{root}/reports")
    try:
        stream = _replayed(spark, sf, root)
        config = layers.LayerConfig(f"{root}/layers", blacklist=LISTED)
        for _ in range(2):
            running = layers.start_layers(stream, config, key_scorer(), f"{root}/checkpoint", every=None)
            running.awaitTermination()
        reports.wait_for_reports(spark)
    finally:
        spark.streams.removeListener(listener)
    stored = reports.stored_reports(spark, f"{root}/reports").filter(F.col("query_id") == str(running.id))
    batches = F.col("kind") == "batch"
    landed = layers.read_layer(spark, config, "batch_metrics").agg(F.count("*").alias("written"))
    found = stored.agg(
        F.sum("input_rows").alias("input_rows"),
        (F.count_if(batches) == F.count_distinct("batch_id")).alias("one_row_per_batch"),
        F.count_if(batches & (F.col("input_rows") > 0)).alias("full"),
        F.count_if(F.col("kind") == "ended").alias("ended"),
        F.count_if(F.col("kind") == "failed").alias("failed"),
    )
    same = found.join(landed, F.col("full") == F.col("written"))
    return same.select("input_rows", "one_row_per_batch", "ended", "failed")
