import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.catalog.adapter import key_scorer
from txnguard.operators.blacklist import account_list
from txnguard.operators.rules import alert_counters
from txnguard.plans import serving
from txnguard.plans.scoring import score_transactions
from txnguard.schema import ALERT_COLUMNS, GOLD_COLUMNS
from txnguard.sources import events
from txnguard.streaming import alerts, counters, dedup, layers

FIELDS = events.event_schema(("txn_id", T.LongType()))
LISTED = ["C5"]


def keyed(rows, count, offset=0, **change):
    changes = [
        {
            "step": i,
            "type": ["TRANSFER", "payment", "cash out", "bad"][i % 4],
            "amount": 1000.0 * i if i % 7 else None,
            "newbalanceOrig": 0.0 if i % 3 == 0 else 5.0,
            "nameDest": f"c{i % 9}",
            **change,
        }
        for i in range(offset, offset + count)
    ]
    return rows(*changes).withColumn("txn_id", F.col("step").cast("bigint"))


def as_stream(spark, path, **options):
    raw = events.read_event_stream(spark, "text", path, maxFilesPerTrigger="1", **options)
    return events.transaction_stream(raw, FIELDS)


def run_layers(spark, source, root, checkpoint="cp", scorer=None, **config):
    setup = layers.LayerConfig(f"{root}/layers", blacklist=LISTED, **config)
    query = layers.start_layers(as_stream(spark, source), setup, scorer or key_scorer(), f"{root}/{checkpoint}", every=None)
    query.awaitTermination()
    return {name: spark.read.parquet(setup.path(name)) for name in ("bronze", "silver", "gold", "alerts", "batch_metrics")}


@pytest.fixture(scope="module")
def replayed(spark, rows, tmp_path_factory):
    """Three event files (three micro-batches) and one with broken lines."""
    root = tmp_path_factory.mktemp("events")
    source = f"{root}/events"
    for part in range(3):
        events.encode_events(keyed(rows, 40, 40 * part).coalesce(1), "txn_id").write.mode("append").text(source)
    (root / "events" / "zz.txt").write_text('{"step": 1, \nnot json\n')
    return source


@pytest.fixture(scope="module")
def finished(spark, replayed, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    return root, run_layers(spark, replayed, root)


def batch_result(spark, replayed):
    raw = events.decode_events(spark.read.text(replayed), FIELDS)
    return score_transactions(raw, key_scorer(), LISTED)


def as_set(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_layers_equal_the_batch_result(spark, replayed, finished):
    _, found = finished
    wanted = batch_result(spark, replayed)
    columns = ["txn_id", *[c for c in GOLD_COLUMNS if c not in ("processed_at", "dt", "hour")]]
    assert as_set(found["gold"], columns) == as_set(wanted, columns)
    assert found["bronze"].count() == 122
    assert set(GOLD_COLUMNS) <= set(found["gold"].columns)
    assert {"label", "balance_diff_orig"} <= set(found["silver"].columns)


def test_counters_and_alert_feed_match_gold(finished):
    _, found = finished
    totals = alert_counters(found["gold"]).first()
    assert tuple(serving.kpis_from_batches(found["batch_metrics"]).drop("fraud_rate").first()) == tuple(totals)
    assert serving.kpis(found["gold"]).first() == serving.kpis_from_batches(found["batch_metrics"]).first()
    sums = found["batch_metrics"].agg(F.sum("raw_rows"), F.sum("dropped_rows"), F.sum("total_transactions")).first()
    assert sums[0] == 122 and sums[0] == sums[1] + sums[2]
    parsed = serving.parse_alerts(found["alerts"], "txn_id")
    assert parsed.count() == totals.total_fraud == found["alerts"].count()
    keys = found["alerts"].select("processed_at", "batch_id", "step", "txn_id").collect()
    newest = serving.parse_alerts(serving.recent_alerts(found["alerts"], 5), "txn_id").collect()
    assert [r.txn_id for r in newest] == [r.txn_id for r in sorted(keys, reverse=True)[:5]]


def test_batch_without_valid_rows_writes_raw_rows_and_counters_only(finished):
    _, found = finished
    empty = found["batch_metrics"].filter("total_transactions = 0").collect()
    assert len(empty) == 1 and empty[0].raw_rows == 2
    assert found["silver"].filter(F.col("batch_id") == empty[0].batch_id).count() == 0
    assert found["bronze"].filter(F.col("batch_id") == empty[0].batch_id).count() == 2


def test_one_stamp_per_batch_in_all_layers(finished):
    _, found = finished
    stamps = [
        {(r.batch_id, r.processed_at) for r in found[name].select("batch_id", "processed_at").distinct().collect()}
        for name in ("bronze", "gold")
    ]
    assert len(stamps[0]) == 4
    assert stamps[1] < stamps[0]


def test_restart_continues_and_adds_nothing(spark, replayed, finished):
    root, found = finished
    before = {name: df.count() for name, df in found.items()}
    again = run_layers(spark, replayed, root)
    assert {name: df.count() for name, df in again.items()} == before


def test_batch_written_twice_changes_nothing(spark, rows, tmp_path):
    batch = keyed(rows, 30).withColumn("processed_at", F.lit("2030-01-02 03:04:05").cast("timestamp"))
    config = layers.LayerConfig(str(tmp_path), blacklist=LISTED)
    first = layers.process_batch(batch, 7, config, key_scorer())
    counts = {n: spark.read.parquet(config.path(n)).count() for n in ("bronze", "silver", "gold", "alerts", "batch_metrics")}
    assert layers.process_batch(batch, 7, config, key_scorer()) == first
    again = {n: spark.read.parquet(config.path(n)).count() for n in counts}
    assert again == counts and counts["bronze"] == 30
    layers.process_batch(batch, 8, config, key_scorer())
    assert spark.read.parquet(config.path("bronze")).count() == 60
    where = spark.read.parquet(config.path("gold")).select("dt", "hour").distinct().collect()
    assert [(str(r.dt), int(r.hour)) for r in where] == [("2030-01-02", 3)]


def test_runs_do_not_replace_each_other(spark, rows, tmp_path):
    batch = keyed(rows, 10).withColumn("processed_at", F.lit("2030-01-02 03:04:05").cast("timestamp"))
    for run in ("a", "b"):
        layers.process_batch(batch, 0, layers.LayerConfig(str(tmp_path), run_id=run), key_scorer())
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 20


def test_run_ids_stay_text(spark, rows, tmp_path):
    batch = keyed(rows, 10).withColumn("processed_at", F.lit("2030-01-02 03:04:05").cast("timestamp"))
    for run in ("7", "007"):
        layers.process_batch(batch, 0, layers.LayerConfig(str(tmp_path), run_id=run), key_scorer())
    found = layers.read_layer(spark, layers.LayerConfig(str(tmp_path)), "gold")
    counts = {(r.run_id, r.dt, r.hour): r["count"] for r in found.groupBy("run_id", "dt", "hour").count().collect()}
    assert set(counts) == {("7", "2030-01-02", "03"), ("007", "2030-01-02", "03")} and len(set(counts.values())) == 1


def test_mixed_stamps_are_rejected_before_writing(rows, tmp_path):
    stamp = F.when(F.col("step") % 2 == 0, "2030-01-02 23:59:59").otherwise("2030-01-03 00:00:01").cast("timestamp")
    batch = rows({"step": 1}, {"step": 2}).withColumn("processed_at", stamp)
    with pytest.raises(ValueError, match="several"):
        layers.process_batch(batch, 0, layers.LayerConfig(str(tmp_path)), key_scorer())
    assert not list(tmp_path.iterdir())


def test_compaction_is_repeatable_and_takes_late_batches(spark, rows, tmp_path):
    config = layers.LayerConfig(str(tmp_path), run_id="007")

    def land(batch_id, hour):
        stamp = F.lit(f"2030-01-02 {hour}:04:05").cast("timestamp")
        layers.process_batch(keyed(rows, 10).withColumn("processed_at", stamp), batch_id, config, key_scorer())

    def seen():
        return sorted(map(tuple, layers.read_layer(spark, config, "gold").select("batch_id", "hour", "txn_id").collect()))

    for batch_id, hour in enumerate(("03", "03", "04")):
        land(batch_id, hour)
    before = seen()
    assert layers.compact_hours(spark, config, "gold", ("2030-01-02", "04")) == 1
    assert layers.compact_hours(spark, config, "gold", ("2030-01-02", "04")) == 0
    assert seen() == before and not list((tmp_path / "gold" / "dt=2030-01-02" / "hour=03").rglob("*.parquet"))
    assert len(list((tmp_path / "gold_hours" / "rows").rglob("*.parquet"))) == 1
    # As if the compaction had failed before it dropped the landed batch: both copies stand, one is read.
    land(1, "03")
    assert seen() == before
    assert layers.compact_hours(spark, config, "gold", ("2030-01-02", "04")) == 1 and seen() == before
    land(3, "03")
    late = seen()
    assert len(late) > len(before)
    assert layers.compact_hours(spark, config, "gold", ("2030-01-03", "00")) == 2
    assert seen() == late and layers.compact_hours(spark, config, "gold", ("2031-01-01", "00")) == 0


def test_large_hours_are_compacted_into_files_of_bounded_size(spark, rows, tmp_path):
    config = layers.LayerConfig(str(tmp_path), run_id="007")

    def seen(layer):
        return sorted(map(str, layer.select(*sorted(layer.columns)).collect()))

    # The first hour holds copies of one row only.
    for batch_id, (hour, batch) in enumerate({"03": keyed(rows, 1, 1), "04": keyed(rows, 20)}.items()):
        copies = batch.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(400 // batch.count())))).drop("_copy")
        stamp = F.lit(f"2030-01-02 {hour}:04:05").cast("timestamp")
        layers.process_batch(copies.withColumn("processed_at", stamp), batch_id, config, key_scorer())
    before = seen(layers.read_layer(spark, config, "gold"))
    assert layers.compact_hours(spark, config, "gold", ("2030-01-03", "00"), rows_per_file=100) == 2
    after = layers.read_layer(spark, config, "gold")
    assert seen(after) == before and len(before) == 400 + 260
    files = after.groupBy("hour", "_metadata.file_path").count().collect()
    assert {hour: sum(f.hour == hour for f in files) for hour in ("03", "04")} == {"03": 4, "04": 3}
    assert all(60 <= f["count"] <= 140 for f in files)
    # A second run over a hour that landed again keeps all rows; ``files`` is the least number.
    stamp = F.lit("2030-01-02 03:30:00").cast("timestamp")
    layers.process_batch(keyed(rows, 5).withColumn("processed_at", stamp), 7, config, key_scorer())
    wanted = seen(layers.read_layer(spark, config, "gold"))
    assert layers.compact_hours(spark, config, "gold", ("2030-01-03", "00"), files=2) == 1
    again = layers.read_layer(spark, config, "gold")
    assert seen(again) == wanted and len(wanted) == len(before) + 3
    assert again.filter("hour = '03'").select("_metadata.file_path").distinct().count() == 2


def test_empty_batch_writes_nothing(rows, tmp_path):
    batch = keyed(rows, 1).withColumn("processed_at", F.current_timestamp()).filter("false")
    assert layers.process_batch(batch, 0, layers.LayerConfig(str(tmp_path)), key_scorer()) is None
    assert not list(tmp_path.iterdir())


def test_keyless_rows_get_a_digest(spark, rows, tmp_path):
    batch = keyed(rows, 8).drop("txn_id").withColumn("processed_at", F.current_timestamp())
    flat = lambda df: df.withColumns({"fraud_probability": F.lit(0.9), "prediction": F.lit(1.0)})
    layers.process_batch(batch, 0, layers.LayerConfig(str(tmp_path)), flat)
    ids = [r.txn_id for r in spark.read.parquet(f"{tmp_path}/gold").collect()]
    assert len(set(ids)) == len(ids) and all(len(i) == 32 for i in ids)


@pytest.mark.parametrize("bounds", [{}, {"max_literals": 0}, {"max_literals": 0, "max_rows": 0}])
def test_stream_with_each_list_form(spark, replayed, bounds, tmp_path):
    listed = account_list(spark.createDataFrame([("c5",)], "account STRING"), **bounds)
    scored = score_transactions(as_stream(spark, replayed), key_scorer(), listed)
    alerts.start_append(scored.select("txn_id", "is_alert"), f"{tmp_path}/o", f"{tmp_path}/c").awaitTermination()
    found = as_set(spark.read.parquet(f"{tmp_path}/o"), ["txn_id", "is_alert"])
    assert found == as_set(batch_result(spark, replayed), ["txn_id", "is_alert"])


def test_alert_stream(spark, replayed, tmp_path):
    scored = score_transactions(as_stream(spark, replayed), key_scorer(), LISTED)
    feed = alerts.alert_stream(scored, "txn_id")
    alerts.start_append(feed, f"{tmp_path}/a", f"{tmp_path}/c").awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/a").collect()
    wanted = batch_result(spark, replayed).filter("is_alert = 1").count()
    assert len(stored) == wanted
    assert set(json.loads(stored[0].value)) == set(ALERT_COLUMNS)


def test_running_counters(spark, replayed, tmp_path):
    scored = score_transactions(as_stream(spark, replayed), key_scorer(), LISTED)
    counters.start_snapshots(counters.running_counters(scored), f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    snapshots = spark.read.parquet(f"{tmp_path}/t")
    assert snapshots.count() == 2  # four batches, the last two kept
    assert tuple(counters.latest_snapshot(spark, f"{tmp_path}/t").first()) == tuple(
        alert_counters(batch_result(spark, replayed)).first()
    )


def test_running_fraud_counts(spark, replayed, tmp_path):
    share = counters.running_fraud_counts(as_stream(spark, replayed))
    counters.start_snapshots(share, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    assert tuple(counters.latest_snapshot(spark, f"{tmp_path}/t").first()) == (122, 0, 0.0)


def test_windows_drop_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    schema = "id BIGINT, at TIMESTAMP"

    def send(*pairs):
        data = spark.createDataFrame(pairs, "id BIGINT, at STRING")
        data.select("id", F.col("at").cast("timestamp").alias("at")).coalesce(1).write.mode("append").parquet(str(source))

    def drain():
        stream = spark.readStream.schema(schema).parquet(str(source))
        result = counters.windowed(stream, "at", [], {"n": F.count("*")})
        alerts.start_append(result, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
        found = spark.read.parquet(f"{tmp_path}/out").orderBy("window_start").collect()
        return [(r.window_start.hour, r.n) for r in found]

    send((1, "2030-01-01 10:05:00"), (2, "2030-01-01 10:50:00"), (3, "2030-01-01 11:05:00"))
    assert drain() == []  # 10:00-11:00 is still within the delay
    send((4, "2030-01-01 11:15:00"))
    assert drain() == [(10, 2)]
    send((5, "2030-01-01 10:59:00"), (6, "2030-01-01 12:30:00"))  # the first is late
    assert drain() == [(10, 2), (11, 2)]


@pytest.mark.parametrize("thin_first", [True, False])
def test_repeats_are_dropped_across_batches(spark, tmp_path, thin_first):
    source = str(tmp_path / "in")
    at = F.timestamp_seconds(F.lit(1_900_000_000) + F.col("id") % 60).alias("at")
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key")
    data = spark.range(3000).select(hot, F.col("id").alias("payload"), at)
    for _ in range(2):
        data.write.mode("append").parquet(source)
    stream = spark.readStream.schema("key BIGINT, payload BIGINT, at TIMESTAMP").option("maxFilesPerTrigger", 3).parquet(source)
    once = dedup.drop_repeats(stream, ["key"], "at", thin_first=thin_first)
    alerts.start_append(once, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    found = sorted(r.key for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert found == sorted({i if i % 3 else 7 for i in range(3000)})


def test_repeated_events_reach_the_layers_once(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    for _ in range(2):
        events.encode_events(keyed(rows, 25).coalesce(1), "txn_id").write.mode("append").text(source)
    once = dedup.drop_repeats(as_stream(spark, source), ["txn_id"], "event_time")
    config = layers.LayerConfig(f"{tmp_path}/layers", blacklist=LISTED)
    layers.start_layers(once, config, key_scorer(), f"{tmp_path}/c", every=None).awaitTermination()
    found = sorted(r.txn_id for r in spark.read.parquet(config.path("bronze")).collect())
    assert found == list(range(25))


def test_thinning_keeps_the_first_row_per_key_and_batch():
    import pyarrow as pa

    batch = pa.record_batch({"k": [2, 1, 2, None, 1, None], "v": [10, 11, 12, 13, 14, 15]})
    (thin,) = dedup._first_per_key(["k"])(iter([batch, batch.slice(0, 0)]))
    assert thin.to_pydict() == {"k": [2, 1, None], "v": [10, 11, 13]}
