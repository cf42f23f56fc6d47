"""Paced replay, committing alert sink, newest-first reads, hot-key de-duplication."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.catalog.adapter import key_scorer
from txnguard.plans import serving
from txnguard.plans.scoring import score_transactions
from txnguard.sources import events, replay
from txnguard.streaming import alert_sink, alerts, dedup, layers

FIELDS = events.event_schema(("txn_id", T.LongType()))


def transactions(rows, count):
    kinds = ["TRANSFER", "CASH_OUT", "PAYMENT"]
    changes = [{"step": i, "type": kinds[i % 3], "amount": 900.0 * i, "newbalanceOrig": 0.0} for i in range(count)]
    return rows(*changes).withColumn("txn_id", F.col("step").cast("bigint"))


# --- replay ------------------------------------------------------------------


def options(path, rate=1e9, started=0.0, part=7):
    return {"path": path, "rowsPerSecond": str(rate), "startedAt": str(started), "rowsPerPartition": str(part)}


def sent_keys(reader, start, end):
    out = []
    for part in reader.partitions({"row": start}, {"row": end}):
        assert part.rows <= 7
        for batch in reader.read(part):
            out += [int(v.split('"txn_id":')[1].rstrip("}")) for v in batch.column(0).to_pylist()]
    return out


def test_replay_slices_follow_the_order_of_sending(spark, rows, tmp_path):
    path = str(tmp_path / "sent")
    assert replay.write_replay_table(transactions(rows, 100).repartition(5), path, "txn_id", rows_per_file=13) == 100
    reader = replay.ReplayReader(options(path))
    assert reader.initialOffset() == {"row": 0} and reader.latestOffset() == {"row": 100}
    assert sent_keys(reader, 0, 100) == list(range(100))
    for start, end in ((0, 0), (0, 1), (12, 14), (5, 61), (99, 100)):
        assert sent_keys(reader, start, end) == list(range(start, end))


def test_replay_rate_is_bounded_by_the_clock(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "sent")
    replay.write_replay_table(transactions(rows, 50), path, "txn_id")
    reader = replay.ReplayReader(options(path, rate=4, started=1000.0))
    for now, row in ((900.0, 0), (1000.0, 0), (1002.6, 10), (1012.5, 50), (9999.0, 50)):
        monkeypatch.setattr(replay.time, "time", lambda now=now: now)
        assert reader.latestOffset() == {"row": row}
    with pytest.raises(ValueError, match="positive"):
        replay.ReplayReader(options(path, rate=0))


def test_empty_replay(spark, rows, tmp_path):
    path = str(tmp_path / "sent")
    assert replay.write_replay_table(transactions(rows, 1).limit(0), path, "txn_id") == 0
    assert replay.ReplayReader(options(path)).latestOffset() == {"row": 0}


def test_stream_over_a_replay_continues_after_a_stop(spark, rows, tmp_path):
    path = str(tmp_path / "sent")
    total = replay.write_replay_table(transactions(rows, 400).repartition(3), path, "txn_id", rows_per_file=60)
    started = time.time()
    seen = []
    for goal in (100, total):
        raw = replay.read_replay(spark, path, 150, started, rowsPerPartition="40")
        stream = events.transaction_stream(raw, FIELDS).select("txn_id")
        running = alerts.start_append(stream, f"{tmp_path}/o", f"{tmp_path}/c", every="0 seconds")
        seen.append(replay.stop_after(running, goal, 120))
    assert 100 <= seen[0] <= seen[1] == total
    assert time.time() - started >= total / 150
    stored = spark.read.parquet(f"{tmp_path}/o")
    assert sorted(r.txn_id for r in stored.collect()) == list(range(400))
    assert stored.select(F.input_file_name()).distinct().count() > 1


# --- alert sink --------------------------------------------------------------


def test_failed_and_repeated_batch_leaves_each_alert_once(spark, rows, tmp_path):
    """The commit of the second batch fails half-way, then the stream is started again."""
    source, feed, marker = f"{tmp_path}/in", f"{tmp_path}/feed", f"{tmp_path}/failed"
    data = transactions(rows, 90)
    for part in range(3):
        chosen = data.filter(F.col("txn_id") % 3 == part).repartition(4)
        events.encode_events(chosen, "txn_id").write.mode("append").text(source)

    class FlakySink(alert_sink.AlertSink):
        @classmethod
        def name(cls):
            return "flaky_feed"

        def streamWriter(self, schema, overwrite):
            import os

            from txnguard.streaming.alert_sink import AlertWriter

            class Flaky(AlertWriter):
                def commit(self, messages, batchId):
                    if batchId == 1 and not os.path.exists(marker):
                        files, root = self._place()
                        files.create_dir(f"{root}/_moving-1")
                        name = next(m.file for m in messages if m is not None and m.file)
                        files.move(f"{root}/_staged/{name}", f"{root}/_moving-1/{name}")
                        open(marker, "w").close()
                        raise OSError("lost the connection")
                    super().commit(messages, batchId)

            return Flaky(self.options["path"], self.options["runId"])

    spark.dataSource.register(FlakySink)

    def run():
        raw = events.read_event_stream(spark, "text", source, maxFilesPerTrigger="4")
        scored = score_transactions(events.transaction_stream(raw, FIELDS), key_scorer(), ["C5"])
        writer = alerts.alert_stream(scored, "txn_id").writeStream.format("flaky_feed").option("runId", "a")
        writer = writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True)
        writer.start(feed).awaitTermination()

    with pytest.raises(Exception, match="lost the connection"):
        run()
    half = alert_sink.stored_alerts(spark, feed).select("batch_id").distinct().collect()
    assert [r.batch_id for r in half] == [0]
    run()
    run()
    wanted = score_transactions(data, key_scorer(), ["C5"]).filter("is_alert = 1").select("txn_id").collect()
    found = alert_sink.stored_alerts(spark, feed).collect()
    assert sorted(r.txn_id for r in found) == sorted(r.txn_id for r in wanted) and len(found) > 5
    assert {r.run_id for r in found} == {"a"} and {r.batch_id for r in found} >= {0, 1}
    left = [p.name for p in (tmp_path / "feed" / "run_id=a").rglob("*") if p.is_dir()]
    assert not [n for n in left if n.startswith("_moving")]


def test_sink_writer_commits_once_and_discards(tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alert_sink.TaskContext, "get", lambda: type("C", (), {"partitionId": lambda self: 3})())
    writer = alert_sink.AlertWriter(str(tmp_path), "r")
    batch = pa.record_batch({"value": ["{}", "{}"], "txn_id": [1, 2]})
    first, again, none = (writer.write(iter(b)) for b in ([batch], [batch], [batch.slice(0, 0)]))
    assert none.file is None and first.file != again.file
    writer.commit([first, None, none], 5)
    writer.commit([again], 5)
    files = sorted(p.name for p in tmp_path.rglob("*.parquet"))
    assert files == [first.file] and (tmp_path / "run_id=r" / "batch_id=5" / first.file).exists()
    third = writer.write(iter([batch]))
    writer.abort([third, None], 6)
    writer.commit([], 7)
    assert sorted(p.name for p in tmp_path.rglob("*.parquet")) == files
    with pytest.raises(ValueError, match="runId"):
        alert_sink.AlertWriter(str(tmp_path), "a/b")


# --- newest-first reads ------------------------------------------------------


def land(rows, config, batch_id, stamp, count=60):
    batch = transactions(rows, count).withColumn("processed_at", F.lit(stamp).cast("timestamp"))
    layers.process_batch(batch, batch_id, config, key_scorer())


def test_newest_alerts_read_the_newest_hours_only(spark, rows, tmp_path, monkeypatch):
    config = layers.LayerConfig(str(tmp_path), run_id="007")
    stamps = [f"2030-01-{day:02d} {hour:02d}:04:05" for day in (1, 2) for hour in (3, 4, 5, 6, 7)]
    for number, stamp in enumerate(stamps):
        land(rows, config, number, stamp)
    layers.compact_hours(spark, config, "alerts", ("2030-01-02", "05"))
    land(rows, config, 20, "2030-01-02 04:30:00")  # a late batch beside its compacted hour
    everything = layers.read_layer(spark, config, "alerts")
    assert layers.hours_of(spark, config, "alerts")[:2] == [("2030-01-02", "07"), ("2030-01-02", "06")]
    per_hour = everything.filter("dt = '2030-01-02' AND hour = '07'").count()
    read = []
    plain = layers.read_hours

    def noted(spark, config, layer, hours):
        read.extend(hours)
        return plain(spark, config, layer, hours)

    monkeypatch.setattr(serving.layers, "read_hours", noted)
    for limit, hours in ((1, 1), (per_hour, 1), (per_hour + 1, 3), (3 * per_hour + 1, 7), (500, 10)):
        read.clear()
        newest = serving.newest_alerts(spark, config, limit)
        want = serving.recent_alerts(everything, limit)
        keys = ["processed_at", "batch_id", "step", "txn_id", "run_id", "value"]
        assert newest.select(keys).collect() == want.select(keys).collect()
        assert len(set(read)) == hours
        files = {f.split("/dt=")[1][:18] for f in newest.inputFiles()}
        assert len(files) == hours and max(files) == "2030-01-02/hour=07"
    with pytest.raises(ValueError):
        serving.newest_alerts(spark, config, 501)


def test_newest_alerts_of_an_empty_feed(spark, tmp_path):
    assert serving.newest_alerts(spark, layers.LayerConfig(str(tmp_path)), 5).count() == 0


# --- compaction --------------------------------------------------------------


def test_batch_that_lands_during_compaction_survives(spark, rows, tmp_path, monkeypatch):
    config = layers.LayerConfig(str(tmp_path), run_id="007")
    for number in range(2):
        land(rows, config, number, "2030-01-02 03:04:05")
    plain = layers.materialize

    def storing(df, name, **kind):
        stored = plain(df, name, **kind)
        land(rows, config, 2, "2030-01-02 03:30:00")
        return stored

    monkeypatch.setattr(layers, "materialize", storing)
    assert layers.compact_hours(spark, config, "gold", ("2030-01-02", "04")) == 1
    monkeypatch.setattr(layers, "materialize", plain)
    counts = {r.batch_id: r["count"] for r in layers.read_layer(spark, config, "gold").groupBy("batch_id").count().collect()}
    assert set(counts) == {0, 1, 2} and len(set(counts.values())) == 1
    assert layers.compact_hours(spark, config, "gold", ("2030-01-02", "04")) == 1
    again = {r.batch_id: r["count"] for r in layers.read_layer(spark, config, "gold").groupBy("batch_id").count().collect()}
    assert again == counts


def test_delta_layers_are_not_compacted_as_files(spark, tmp_path):
    with pytest.raises(ValueError, match="OPTIMIZE"):
        layers.compact_hours(spark, layers.LayerConfig(str(tmp_path), fmt="delta"), "gold", ("9999", ""))


# --- hot keys ----------------------------------------------------------------


def send_keys(spark, path, *rows):
    data = spark.createDataFrame(rows, "key STRING, at STRING, payload INT")
    data.select("key", F.col("at").cast("timestamp").alias("at"), "payload").coalesce(1).write.mode("append").parquet(path)


def once(spark, tmp_path, delay="10 minutes"):
    stream = spark.readStream.schema("key STRING, at TIMESTAMP, payload INT").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    dedup.start_once_per_key(stream, ["key"], "at", f"{tmp_path}/once", f"{tmp_path}/c", delay).awaitTermination()
    kept = dedup.kept_rows(spark, f"{tmp_path}/once", "key STRING, at TIMESTAMP, payload INT, batch_id BIGINT")
    return sorted((r.key or "", r.at.strftime("%H:%M"), r.payload) for r in kept.collect())


def test_once_per_key_within_the_delay(spark, tmp_path):
    path = f"{tmp_path}/in"
    send_keys(spark, path, ("a", "2030-01-01 10:01:00", 2), ("a", "2030-01-01 10:00:00", 1), (None, "2030-01-01 10:00:00", 3), ("x", None, 4))
    assert once(spark, tmp_path) == [("", "10:00", 3), ("a", "10:00", 1)]
    send_keys(spark, path, ("a", "2030-01-01 10:05:00", 5), ("b", "2030-01-01 10:15:00", 6), (None, "2030-01-01 10:02:00", 7))
    assert once(spark, tmp_path) == [("", "10:00", 3), ("a", "10:00", 1), ("b", "10:15", 6)]
    # The watermark is 10:05: a stays known until it passes 10:10; 10:04 is late.
    send_keys(spark, path, ("a", "2030-01-01 10:09:00", 8), ("c", "2030-01-01 10:04:00", 9), ("d", "2030-01-01 10:25:00", 10))
    assert once(spark, tmp_path) == [("", "10:00", 3), ("a", "10:00", 1), ("b", "10:15", 6), ("d", "10:25", 10)]
    # Now it is 10:15, so a is new.
    send_keys(spark, path, ("a", "2030-01-01 10:20:00", 11), ("b", "2030-01-01 10:21:00", 12))
    assert once(spark, tmp_path)[1:3] == [("a", "10:00", 1), ("a", "10:20", 11)]
    assert len(once(spark, tmp_path)) == 5


def test_rule_equals_the_built_in_one(spark, tmp_path):
    """The same triggers through the engine's own operator keep the same keys at the same times."""
    path = f"{tmp_path}/in"
    for k in range(4):
        rows = [(f"k{i % 11}", f"2030-01-01 10:{(7 * k + i) % 60:02d}:00", 100 * k + i) for i in range(0, 25, 1 + k % 2)]
        send_keys(spark, path, *rows)
    ours = once(spark, tmp_path)
    stream = spark.readStream.schema("key STRING, at TIMESTAMP, payload INT").option("maxFilesPerTrigger", 1).parquet(path)
    built_in = dedup.drop_repeats(stream, ["key"], "at")
    alerts.start_append(built_in, f"{tmp_path}/engine", f"{tmp_path}/ce").awaitTermination()
    theirs = [r.key for r in spark.read.parquet(f"{tmp_path}/engine").collect()]
    assert sorted(k for k, *_ in ours) == sorted(theirs)


def test_repeated_trigger_changes_nothing_and_a_hot_key_sends_one_row_per_task(spark, tmp_path):
    path = f"{tmp_path}/in"
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7000)).alias("key"),
        F.timestamp_seconds(F.lit(1_900_000_000) + F.col("id") % 60).alias("at"),
        F.col("id").cast("int").alias("payload"),
    )
    hot.repartition(6).write.parquet(path)
    first = once(spark, tmp_path)
    assert len(first) == len({k for k, *_ in first}) and ("hot" in {k for k, *_ in first})
    reduced = dedup._first_of_batch(hot.repartition(16), ["key"], "at")
    reduced.collect()
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Final Plan")[1].split("Initial Plan")[0] if "Final Plan" in plan else plan
    assert "partial_min" in final[final.rindex("Exchange hashpartitioning(key") :]
