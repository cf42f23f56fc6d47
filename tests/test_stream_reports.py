"""Late rows, counters read from state, trigger reports, mergeable quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnguard.operators import sketches
from txnguard.streaming import alerts, counters, late, reports


def send(spark, path, *rows):
    data = spark.createDataFrame(rows, "id INT, at STRING")
    data.select("id", F.col("at").cast("timestamp").alias("at")).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path):
    return spark.readStream.schema("id INT, at TIMESTAMP").option("maxFilesPerTrigger", 1).parquet(path)


def test_late_rows_are_kept_beside_the_others(spark, tmp_path):
    path, split = f"{tmp_path}/in", f"{tmp_path}/split"

    def drain():
        late.start_late_split(stream_of(spark, path), "at", split, f"{tmp_path}/c").awaitTermination()
        stored = late.split_rows(spark, split, "id INT, at TIMESTAMP")
        return {(r.id, r.late, r.batch_id) for r in stored.collect()}

    send(spark, path, (1, "2030-01-01 10:05:00"), (2, "2030-01-01 10:50:00"), (3, None))
    assert drain() == {(1, 0, 0), (2, 0, 0), (3, 1, 0)}
    send(spark, path, (4, "2030-01-01 10:40:00"), (5, "2030-01-01 10:39:59"))  # the watermark is 10:40
    assert drain() == {(1, 0, 0), (2, 0, 0), (3, 1, 0), (4, 0, 1), (5, 1, 1)}
    send(spark, path, (6, "2030-01-01 09:00:00"))
    send(spark, path, (7, "2030-01-01 12:00:00"), (8, "2030-01-01 10:45:00"))
    assert drain() >= {(6, 1, 2), (7, 0, 3), (8, 0, 3)}
    assert len(drain()) == 8


def test_split_agrees_with_the_engine(spark, tmp_path):
    """The engine, which goes by the watermark of the trigger before, drops no row that is in time here."""
    path = f"{tmp_path}/in"
    for k in range(4):
        send(spark, path, *[(100 * k + i, f"2030-01-01 {10 + k}:{(37 * i) % 60:02d}:00") for i in range(12)], (900 + k, f"2030-01-01 0{k}:00:00"))
    late.start_late_split(stream_of(spark, path), "at", f"{tmp_path}/split", f"{tmp_path}/c").awaitTermination()
    stored = late.split_rows(spark, f"{tmp_path}/split", "id INT, at TIMESTAMP")
    # Keyed by id, so that partial aggregation cannot merge dropped rows.
    windows = counters.windowed(stream_of(spark, path), "at", ["id"], {"n": F.count("*")}, width="1 minute")
    running = alerts.start_append(windows, f"{tmp_path}/w", f"{tmp_path}/cw")
    running.awaitTermination()
    dropped = sum(s.numRowsDroppedByWatermark for p in running.recentProgress for s in p.stateOperators)
    assert 0 < dropped <= stored.filter("late = 1").count() == 3
    assert stored.count() == 52


def test_counters_are_read_from_state(spark, tmp_path):
    path = f"{tmp_path}/in"
    schema = "is_alert DOUBLE, is_ml_alert DOUBLE, is_rule_alert DOUBLE"
    for flags in ([(1.0, 1.0, 0.0), (0.0, 0.0, 0.0)], [(1.0, 0.0, 1.0)], [(1.0, 1.0, 1.0), (1.0, 1.0, 0.0)]):
        spark.createDataFrame(flags, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    counters.start_snapshots(counters.running_counters(stream), f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    found = counters.counters_in_state(spark, f"{tmp_path}/c")
    assert [r.asDict() for r in found.collect()] == [r.asDict() for r in counters.latest_snapshot(spark, f"{tmp_path}/t").collect()]
    assert tuple(found.first()) == (5, 4, 3, 2)


def test_one_report_per_batch_also_for_empty_and_failed_ones(spark, tmp_path):
    path, stored = f"{tmp_path}/in", f"{tmp_path}/reports"
    listener = reports.report_triggers(spark, stored)
    try:
        send(spark, path, (1, "2030-01-01 10:00:00"), (2, "2030-01-01 10:30:00"))
        send(spark, path, (5, "2030-01-01 10:40:00"))
        send(spark, path, (4, "2030-01-01 09:00:00"))
        send(spark, path, (3, "2030-01-01 12:30:00"))
        windows = counters.windowed(stream_of(spark, path), "at", [], {"n": F.count("*")})
        running = alerts.start_append(windows, f"{tmp_path}/w", f"{tmp_path}/c")
        running.awaitTermination()
        broken = stream_of(spark, path).select(F.raise_error(F.lit("no good")))
        failing = alerts.start_append(broken, f"{tmp_path}/b", f"{tmp_path}/cb")
        with pytest.raises(Exception, match="no good"):
            failing.awaitTermination()
        reports.wait_for_reports(spark)
    finally:
        spark.streams.removeListener(listener)
    rows = reports.stored_reports(spark, stored).collect()
    mine = sorted((r for r in rows if r.query_id == str(running.id) and r.kind == "batch"), key=lambda r: r.batch_id)
    assert [r.batch_id for r in mine] == list(range(len(mine)))
    assert [r.input_rows for r in mine] == [2, 1, 1, 1, 0]  # the last one emits the windows that the last rows closed
    assert sum(r.late_rows for r in mine) == 1 and all(r.trigger_ms >= 0 and r.state_bytes > 0 for r in mine)
    assert [r.kind for r in rows if r.query_id == str(running.id) and r.kind != "batch"] == ["ended"]
    (failed,) = [r for r in rows if r.query_id == str(failing.id)]
    assert failed.kind == "failed" and "no good" in failed.problem


def test_quantiles_merge_over_any_hours(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.lognormal(3, 2, 20_000), rng.normal(50, 1, 10_000)])
    hours = rng.integers(0, 24, len(values))
    rows = [(int(h), float(v)) for h, v in zip(hours, values)] + [(3, None), (4, float("nan")), (77, None)]
    stored = sketches.quantile_sketches(spark.createDataFrame(rows, "hour INT, amount DOUBLE").repartition(7), "amount", ["hour"])
    assert stored.count() == 24 and stored.agg(F.sum("rows")).first()[0] == len(values)
    levels = {"low": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "high": 1.0}
    for chosen in (range(24), range(5, 9), [23]):
        found = sketches.merged_quantiles(stored.filter(F.col("hour").isin(list(chosen))), levels).first()
        inside = np.sort(values[np.isin(hours, list(chosen))])
        assert found.rows == len(inside)
        for name, level in levels.items():
            below, upto = np.searchsorted(inside, found[name], "left"), np.searchsorted(inside, found[name], "right")
            assert below / len(inside) <= level + 0.01 and upto / len(inside) >= level - 0.01
    assert sketches.merged_quantiles(stored.filter("hour > 99"), levels).count() == 0
    per_hour = sketches.merged_quantiles(stored, {"p50": 0.5}, by=["hour"])
    assert per_hour.count() == 24
